"""Catalogue of registered queries and their DuckDB oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables; the
oracle is ANSI SQL over the same tables (registered as views by name) that
must return the same rows and column names.  Queries without an SQL form
register ``oracle=None`` and are checked against a brute-force fixture in
the tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

#: The source whose key stamps the rows of the registered queries.
SOURCE_URL = "https://source.example.org/api"

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    """Decorator: add ``fn`` under ``name`` with its oracle SQL (or none)."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return wrap
