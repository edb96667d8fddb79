"""Partial documents by the keys they have: a key that is null is not a key that is absent (O-09, O-17).

A mapped row carries ``present``, a bitmap with a bit per mapped column, set where the document has the key.  The bitmap goes
through every step: the fold of several documents for one key, the upsert and the staged table itself, where it says
which columns any document has ever given.  A present null overwrites, an absent key keeps what is stored, and a
late document still fills columns that no newer one has given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.functions.casts import cast_as, spark_type
from tallysheet.functions.keys import quoted, source_key
from tallysheet.operators.changes import ChangeSpec, detect_changes
from tallysheet.operators.mapping import MappingSpec
from tallysheet.sources.variants import ITEM, path_of

PRESENT = "present"
MAX_COLUMNS = 63


def _targets(spec: MappingSpec) -> list[tuple[list[str], Mapping]]:
    """(key path, target) of every mapped column, in order."""
    out = []
    for key, entry in spec.items():
        parts = key.split(".")
        nested = entry.get("nestedColumns")
        out += [([*parts, n], t) for n, t in nested.items()] if nested else [(parts, entry)]
    return out


def present_bits(spec: MappingSpec) -> dict[str, int]:
    """Column -> its bit of the bitmap."""
    columns = [target["column"] for _, target in _targets(spec)]
    if len(columns) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} mapped columns")
    return {c: 1 << i for i, c in enumerate(columns)}


def _has(path: Sequence[str]) -> Column:
    """Whether the item has the key; of a null object, whatever would be inside is present and null."""
    has = F.try_variant_get(ITEM, path_of(*path), "variant").isNotNull()
    for n in range(1, len(path)):
        has = has | F.coalesce(F.is_variant_null(F.try_variant_get(ITEM, path_of(*path[:n]), "variant")), F.lit(False))
    return has


def _text(path: Sequence[str]) -> Column:
    return F.try_variant_get(ITEM, path_of(*path), "string")


def map_present(items: DataFrame, spec: MappingSpec, source_url: str | None = None, source_col: str = "sourceid",
                carry: Sequence[str] = ()) -> DataFrame:
    """Rename + cast the declared keys of ``_item``, with the ``present`` bitmap and the source key."""
    bits = present_bits(spec)
    columns, present = [], F.lit(0).cast("long")
    for path, target in _targets(spec):
        columns.append(cast_as(_text(path), target.get("type", "str"), T.StringType()).alias(target["column"]))
        present = present.bitwiseOR(F.when(_has(path), F.lit(bits[target["column"]])).otherwise(0).cast("long"))
    if source_url is not None:
        columns.append(source_key(source_url).alias(source_col))
    return items.select(*columns, present.alias(PRESENT), *[F.col(quoted(c)) for c in carry])


def malformed_present(spec: MappingSpec) -> Column:
    """Array of ``column: raw text`` for the cells of ``_item`` that hold text which is no value of their declared type."""
    found = []
    for path, target in _targets(spec):
        kind = target.get("type", "str")
        if spark_type(kind) != T.StringType():
            bad = (F.length(F.btrim(_text(path))) > 0) & cast_as(_text(path), kind, T.StringType()).isNull()
            found.append(F.when(bad, F.concat(F.lit(target["column"] + ": "), _text(path))))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def is_present(column: str, bits: Mapping[str, int], bitmap: str = PRESENT) -> Column:
    """Whether the bitmap says that a document gave ``column``; columns without a bit (stamped ones) always are."""
    if column not in bits:
        return F.lit(True)
    return F.coalesce(F.col(quoted(bitmap)).bitwiseAND(F.lit(bits[column]).cast("long")) != 0, F.lit(False))


def fold_present(batch: DataFrame, keys: Sequence[str], seq: str, bits: Mapping[str, int]) -> DataFrame:
    """Several partial rows per key in ``seq`` order: per column the last present value, null or not; bitmaps are united.

    Aggregates only, so a key that a third of the rows share is combined in every task.
    """
    values = [c for c in batch.columns if c not in (*keys, seq, PRESENT)]
    last = [F.max_by(F.col(quoted(c)), F.when(is_present(c, bits), F.col(seq))).alias(c) for c in values]
    return batch.groupBy(*keys).agg(*last, F.bit_or(PRESENT).alias(PRESENT))


def upsert_present(current: DataFrame, batch: DataFrame, spec: ChangeSpec, bits: Mapping[str, int]) -> DataFrame:
    """Change-tracked upsert of a folded batch: present columns are taken, absent ones keep what is stored.

    A value that becomes null is a change.  Both sides carry ``present``.
    """
    return detect_changes(current, batch, replace(spec, null_safe=True), sparse=True, present=(PRESENT, dict(bits)))
