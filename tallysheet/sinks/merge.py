"""Row-level MERGE for catalogs whose tables support it (O-08/O-09 on an ACID table format).

Plain Parquet folders cannot be updated in place, so the default upsert is a
set-based rewrite (``operators.upsert``, ``sinks.partitioned_upsert``).  When
the session's catalog holds a table format with row-level operations, the
same upsert is a single ``MERGE INTO`` and only the touched files change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_into_table(batch: DataFrame, table: str, keys: Sequence[str], sparse: bool = False) -> None:
    """``MERGE INTO table`` keyed on ``keys``: update matched rows, insert new ones.

    ``sparse`` keeps the stored value where the batch value is NULL.  Batch
    keys must be unique (fold them first).  Raises for tables without
    row-level support (plain Parquet).
    """
    target = F.col
    cond = None
    for k in keys:
        c = target(f"{table}.{k}") == batch[k]
        cond = c if cond is None else cond & c
    values = {
        c: (F.coalesce(batch[c], target(f"{table}.{c}")) if sparse else batch[c])
        for c in batch.columns
        if c not in keys
    }
    (
        batch.mergeInto(table, cond)
        .whenMatched()
        .update(values)
        .whenNotMatched()
        .insert({c: batch[c] for c in batch.columns})
        .merge()
    )
