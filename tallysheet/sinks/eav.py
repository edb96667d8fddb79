"""Self-describing dump (O-13, O-24, O-46): ``{pk: {column: {type, value}}}``.

Each row becomes one entity keyed by its key values joined with ``-``; every
cell carries its dtype tag and its value as text.  The dump is written one
entity per line (never one giant object), so it splits across tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.functions.casts import dtype_tag
from tallysheet.functions.keys import composite_key, quoted

PK_COL = "pk"
CELLS_COL = "cells"


def to_eav(
    df: DataFrame,
    unique_keys: Sequence[str],
    order_by: Column | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """``(pk, cells map<column, struct<type, value>>)``; a repeated pk keeps its last row.

    "Last" is the greatest ``order_by``; without it keys must be unique.  The
    fold is an aggregation (partial per task first), so a key repeated a
    million times never gathers its rows in one place.
    """
    excluded = set(exclude)
    # Parts stand in the table's column order, and a missing part fails the dump: it would merge entities.
    parts = [c for c in df.columns if c in set(unique_keys)]
    pk = F.coalesce(composite_key(parts), F.raise_error(F.lit(f"a part of the key {parts} is missing")).cast("string"))
    fields = [f for f in df.schema.fields if f.name not in excluded]
    cells = F.map_from_arrays(
        F.array(*[F.lit(f.name) for f in fields]),
        F.array(
            *[
                F.struct(F.lit(dtype_tag(f.dataType)).alias("type"), F.col(quoted(f.name)).cast("string").alias("value"))
                for f in fields
            ]
        ),
    )
    keyed = df.select(pk.alias(PK_COL), cells.alias(CELLS_COL),
                      *([order_by.alias("_seq")] if order_by is not None else []))
    if order_by is None:
        return keyed
    return keyed.groupBy(PK_COL).agg(F.max_by(CELLS_COL, "_seq").alias(CELLS_COL))


def write_eav(eav: DataFrame, path: str) -> None:
    """One ``{"<pk>": {...}}`` object per line."""
    line = F.to_json(F.create_map(F.col(PK_COL), F.col(CELLS_COL))).alias("value")
    eav.select(line).write.mode("overwrite").text(path)
