"""Integrity checks as data (O-39, O-50).

The staging tables' constraints (foreign keys, NOT NULL, length limits,
enum domains, primary keys) become queries that return violations instead
of rejecting writes: a violations table can be stored, counted and alerted
on, and one bad row never blocks a whole load.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.functions.keys import composite_key, quoted
from tallysheet.operators.skew import semi_join_keys


def fk_violations(child: DataFrame, parent: DataFrame, child_cols: Sequence[str], parent_cols: Sequence[str],
                  name: str) -> DataFrame:
    """Foreign-key values without a parent: ``(fk, child_key, n)``, ``n`` child rows each.

    A key with any NULL component passes (SQL MATCH SIMPLE).  The child's key
    columns are counted first (a value held by a third of the children shrinks
    to a row per task before the shuffle), then anti-joined with the parent's
    key: one pass over the key columns only.
    """
    present = F.lit(True)
    for c in child_cols:
        present = present & F.col(quoted(c)).isNotNull()
    counts = child.where(present).groupBy(*[quoted(c) for c in child_cols]).agg(F.count(F.lit(1)).alias("n"))
    keys = parent.select(*[F.col(quoted(p)).alias(c) for p, c in zip(parent_cols, child_cols)])
    missing = counts.join(keys, list(child_cols), "left_anti")
    return missing.select(F.lit(name).alias("fk"), composite_key(child_cols).alias("child_key"), "n")


def fk_violating_rows(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
                      parent_cols: Sequence[str]) -> DataFrame:
    """The child rows themselves whose foreign key has no parent (hot keys are salted)."""
    present = F.lit(True)
    for c in child_cols:
        present = present & F.col(quoted(c)).isNotNull()
    keys = parent.select(*[F.col(quoted(p)).alias(c) for p, c in zip(parent_cols, child_cols)]).distinct()
    return semi_join_keys(child.where(present), keys, child_cols, anti=True)


@dataclass(frozen=True)
class Rule:
    """A column constraint: ``not_null``, ``max_length`` (arg = limit), ``domain`` (arg = values)."""

    name: str
    kind: str
    column: str
    arg: object = None

    def violated(self) -> Column:
        c = F.col(quoted(self.column))
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "max_length":
            return F.coalesce(F.length(c) > int(self.arg), F.lit(False))
        if self.kind == "domain":
            return c.isNotNull() & ~c.isin(*self.arg)
        raise ValueError(f"unknown rule kind {self.kind!r}")


def _shown(keys: Sequence[str]) -> Column:
    """Key values as one text; a NULL part shows as ``?``."""
    return F.concat_ws("-", *[F.coalesce(F.col(quoted(k)).cast("string"), F.lit("?")) for k in keys])


def rule_violations(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """``(rule, key, n)``: how many rows with that key violate the rule; one pass over ``df``.

    Only violating rows leave the scan.
    """
    broken = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(r.violated(), F.lit(r.name)) for r in rules]))
    rows = df.select(_shown(keys).alias("key"), F.explode(broken).alias("rule"))
    return rows.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``(rule, key, n)``: the primary-key values held by more than one row."""
    counts = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return counts.select(F.lit(name).alias("rule"), _shown(keys).alias("key"), "n")
