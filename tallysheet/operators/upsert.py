"""Keyed upserts on immutable files (O-08..O-12, O-45, O-46).

Every variant is a set-based rewrite: fold the batch per key with an
aggregation (partial per task first, so a key repeated across a third of
the batch never gathers in one place), then one join of target and batch on
the key.  The result is written as a new table version by the caller.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.functions.keys import quoted

CHANGE_COL = "change"
PENDING = ("insert", "update")


def _cols(names: Iterable[str], prefix: str = "") -> list[Column]:
    return [F.col(quoted(prefix + n)) for n in names]


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep, per key, the row with the greatest ``order_by`` (O-45, O-46).

    ``max_by`` over a struct is an aggregate, so Spark combines map-side
    before the shuffle; a window would instead sort every row of a hot key
    in a single task.
    """
    others = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(quoted(c)) if isinstance(c, str) else c for c in order_by])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*_cols(others)), order).alias("_last"))
    return picked.select(*keys, *[F.col("_last").getField(c).alias(c) for c in others]).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep, per key, the row with the smallest ``order_by``."""
    others = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(quoted(c)) if isinstance(c, str) else c for c in order_by])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*_cols(others)), order).alias("_first"))
    return picked.select(*keys, *[F.col("_first").getField(c).alias(c) for c in others]).select(*df.columns)


def fold_sparse(batch: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Fold several partial rows per key in ``seq`` order: per column, the last present value (O-09).

    NULL means "absent from the document"; a column never present stays NULL.
    """
    values = [c for c in batch.columns if c not in keys and c != seq]
    aggs = [
        F.max_by(F.col(quoted(c)), F.when(F.col(quoted(c)).isNotNull(), F.col(seq))).alias(c) for c in values
    ]
    return batch.groupBy(*keys).agg(*aggs)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], sparse: bool = False) -> DataFrame:
    """``INSERT .. ON CONFLICT (keys) DO UPDATE`` as one full outer join (O-08, O-09).

    New keys are inserted; an existing key takes every batch column the batch
    carries (``sparse``: only where the batch value is not NULL); target
    columns the batch lacks keep their stored value.  Batch keys must be
    unique (fold them first with ``fold_sparse`` / ``last_per_key``).
    """
    batch_cols = [c for c in batch.columns if c not in keys]
    t = target.select(*keys, *[F.col(quoted(c)).alias("t__" + c) for c in target.columns if c not in keys])
    b = batch.select(*keys, *[F.col(quoted(c)).alias("b__" + c) for c in batch_cols], F.lit(True).alias("b__hit"))
    joined = t.join(b, list(keys), "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(quoted(c)))
        elif c in batch_cols:
            new, old = F.col(quoted("b__" + c)), F.col(quoted("t__" + c))
            merged = F.coalesce(new, old) if sparse else F.when(F.col("b__hit"), new).otherwise(old)
            out.append(merged.alias(c))
        else:
            out.append(F.col(quoted("t__" + c)).alias(c))
    extra = [F.col(quoted("b__" + c)).alias(c) for c in batch_cols if c not in target.columns]
    return joined.select(*out, *extra)


def insert_new(target: DataFrame, batch: DataFrame, keys: Sequence[str],
               order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """``ON CONFLICT DO NOTHING`` (O-10): append batch rows whose key is new.

    Several batch rows for one new key: the first in ``order_by`` wins (any
    one of them when all columns are keys and ``order_by`` is omitted).
    """
    if order_by:
        batch = first_per_key(batch, keys, order_by)
    else:
        batch = batch.dropDuplicates(list(keys))
    fresh = batch.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def changed_rows(df: DataFrame, change_col: str = CHANGE_COL) -> DataFrame:
    """Rows still to be exported: ``change in ('insert', 'update')`` (O-27)."""
    return df.where(F.col(change_col).isin(*PENDING))


def apply_changes(target: DataFrame, staged: DataFrame, keys: Sequence[str],
                  change_col: str = CHANGE_COL, exclude: Iterable[str] = ()) -> DataFrame:
    """Change-directed warehouse upsert (O-12).

    ``change = 'insert'`` rows are appended; ``'update'`` rows overwrite the
    non-key columns of the target row with the same key (an update whose key
    is missing from the target changes nothing).  Staged keys are unique.
    """
    staged = staged.drop(*exclude)
    inserts = staged.where(F.col(change_col) == "insert").drop(change_col)
    updates = staged.where(F.col(change_col) == "update").drop(change_col)
    upd_cols = [c for c in updates.columns if c not in keys and c in target.columns]
    u = updates.select(*keys, *[F.col(quoted(c)).alias("u__" + c) for c in upd_cols], F.lit(True).alias("u__hit"))
    joined = target.join(u, list(keys), "left")
    merged = []
    for c in target.columns:
        if c in upd_cols:
            merged.append(F.when(F.col("u__hit"), F.col(quoted("u__" + c))).otherwise(F.col(quoted(c))).alias(c))
        else:
            merged.append(F.col(quoted(c)))
    return joined.select(*merged).unionByName(inserts.select(*[c for c in inserts.columns if c in target.columns]),
                                              allowMissingColumns=True)
