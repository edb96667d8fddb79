"""Hot keys in joins: one key with a third of the rows must not fill one task.

AQE splits a skewed shuffle partition only when it is large *in bytes*; rows
that carry little more than a repeated key compress to almost nothing, so a
key held by a third of the rows can still land in one task.  The joins here find
the heavy keys first: those with more than one in ``HEAVY_SHARE`` of the rows, so
there are fewer than ``HEAVY_SHARE`` of them whatever the data's size.  One
frequent-items sketch over the key columns finds them (``approx_top_k`` on the
key's hash, combined in every map task, one pass, no shuffle by key), as a scalar
subquery that both sides of the join share.  A key that the sketch's error lets in
or a colliding hash only costs a few more copies of its entry: the rows of the
result never depend on which keys count as heavy.

Only rows of heavy keys get a salt, and only their entries of the other side are
repeated per salt.  The salt comes from the row's position by default, so identical rows
spread too; over an input that is itself shuffled, name ``spread_by`` columns, as a task that
runs again after a lost executor may meet its rows in another order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.functions.keys import quoted

HEAVY_SHARE = 200
SALTS = 64
#: Counters of the sketch: its error is below one in 2,500 of the rows, far under the heavy share.
SKETCH_ITEMS = 10_000


def _key_hash(on: Sequence[str], like: DataFrame) -> Column:
    """Hash of the key columns, in the types of ``like`` (an int and a long hash differently)."""
    return F.xxhash64(*[F.col(quoted(c)).cast(like.schema[c].dataType) for c in on])


def heavy_hashes(df: DataFrame, on: Sequence[str], share: int = HEAVY_SHARE) -> Column:
    """Scalar subquery: the hashes of the keys with more than one in ``share`` of the rows (fewer than ``share``)."""
    top = F.call_function("approx_top_k", _key_hash(on, df), F.lit(share), F.lit(SKETCH_ITEMS))
    found = df.agg(top.alias("top"), F.count(F.lit(1)).alias("rows"))
    # A NULL key hashes to the seed, so many NULLs are a heavy key like any other.
    heavy = F.expr(f"transform(filter(top, x -> x.count * {share} > rows), x -> x.item)")
    return found.select(heavy).scalar()


def is_heavy(df: DataFrame, on: Sequence[str], share: int = HEAVY_SHARE) -> Column:
    """Whether the row's key holds more than one in ``share`` of the rows of ``df``."""
    return F.array_contains(heavy_hashes(df, on, share), _key_hash(on, df))


def _salted(big: DataFrame, small: DataFrame, on: list[str], share: int, salts: int,
            spread_by: Sequence[str] | None) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: rows of heavy keys are spread, entries of heavy keys repeated."""
    heavy = is_heavy(big, on, share)
    spread = F.xxhash64(*[F.col(quoted(c)) for c in spread_by]) if spread_by else F.monotonically_increasing_id()
    salted_big = big.withColumn("_salt", F.when(heavy, F.pmod(spread, F.lit(salts))).otherwise(0).cast("int"))
    last = F.when(heavy, salts - 1).otherwise(0)
    return salted_big, small.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))


def semi_join_keys(big: DataFrame, keys: DataFrame, on: Sequence[str], anti: bool = False,
                   share: int = HEAVY_SHARE, salts: int = SALTS, spread_by: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``big`` whose ``on`` values are (``anti``: are not) in ``keys``; ``keys`` holds unique rows.

    A NULL in ``on`` equals nothing.
    """
    salted_big, salted_keys = _salted(big, keys.select(*[quoted(c) for c in on]), list(on), share, salts, spread_by)
    joined = salted_big.join(salted_keys, [*on, "_salt"], "left_anti" if anti else "left_semi")
    return joined.select(*[quoted(c) for c in big.columns])


def lookup_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", share: int = HEAVY_SHARE,
                salts: int = SALTS, spread_by: Sequence[str] | None = None) -> DataFrame:
    """``big`` with the other columns of ``small`` by ``on``; rows of a key that fills ``big`` go to many tasks.

    ``how`` is ``"inner"`` or ``"left"``.  Several entries of ``small`` for one key give one row each; a NULL in ``on``
    equals nothing (``left`` keeps the row).  Columns besides ``on`` must have different names on the two sides.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    added = [c for c in small.columns if c not in on]
    clash = {c.lower() for c in big.columns} & {c.lower() for c in added}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    salted_big, salted_small = _salted(big, small, list(on), share, salts, spread_by)
    joined = salted_big.join(salted_small, [*on, "_salt"], how)
    return joined.select(*[quoted(c) for c in big.columns], *[quoted(c) for c in added])
