"""Registered queries over the driver tables, plus the end-to-end flows."""

from tallysheet.plans import (  # noqa: F401  (importing registers the queries)
    integrity_queries,
    load_queries,
    presence_queries,
    report_queries,
    scan_queries,
    state_queries,
    tree_queries,
    warehouse_queries,
)
from tallysheet.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
