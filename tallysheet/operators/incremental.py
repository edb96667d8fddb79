"""Incremental slices and membership filters (O-28..O-30, O-32, O-38).

The fact load pulls only rows updated since a stored mark; the next mark is
the greatest update time seen in the slice (kept when the slice is empty),
so a rerun of an overlapping slice is harmless under a keyed upsert.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.functions.keys import quoted
from tallysheet.operators.skew import semi_join_keys

DEFAULT_MARK = "2018-01-01 00:00:00"


def since_mark(df: DataFrame, ts_col: str, mark: str = DEFAULT_MARK) -> DataFrame:
    """Rows updated at or after ``mark`` (pushed into the scan as a Parquet filter)."""
    return df.where(F.col(quoted(ts_col)) >= F.lit(mark).cast("timestamp_ntz"))


def next_mark(slice_df: DataFrame, ts_col: str, mark: str = DEFAULT_MARK) -> Column:
    """Scalar subquery: greatest ``ts_col`` of the slice, else the old mark.

    Evaluated once per query (not joined to every row).
    """
    top = slice_df.select(F.max(quoted(ts_col))).scalar()
    return F.coalesce(top, F.lit(mark).cast("timestamp_ntz"))


def leaves(units: DataFrame, leaf_col: str = "leaf") -> DataFrame:
    """Leaf org units: the ones facts are reported against."""
    return units.where(F.col(leaf_col))


def having_data(units: DataFrame, landed: DataFrame, unit_col: str, landed_col: str | None = None) -> DataFrame:
    """Units that have landed data (a semi join; no rows of ``landed`` are carried)."""
    landed_col = landed_col or unit_col
    # Distinct first: a unit with a third of all landed rows shrinks to one key per
    # task before the shuffle instead of loading one task with its whole share.
    present = landed.select(F.col(quoted(landed_col)).alias(unit_col)).distinct()
    return units.join(present, unit_col, "left_semi")


def group_members(facts: DataFrame, links: DataFrame, groups: Sequence[str], fact_col: str, link_col: str,
                  group_col: str) -> DataFrame:
    """Facts whose element belongs to one of the configured ``groups`` (via the M:N link)."""
    members = (
        links.where(F.col(quoted(group_col)).isin(*groups)).select(F.col(quoted(link_col)).alias(fact_col)).distinct()
    )
    # A data element holding a third of the facts is salted: never one task per hot element.
    return semi_join_keys(facts, members, [fact_col])


def is_empty(df: DataFrame) -> bool:
    """Empty-input guard for skipping a write (a one-row probe, never a count)."""
    return df.isEmpty()
