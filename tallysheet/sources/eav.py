"""Read a self-describing dump back to typed columns (O-06).

Only the outer ``{pk: ...}`` object is exploded; each wanted column is then a
direct map lookup cast by its dtype tag, so no pivot (and no shuffle) is
needed to turn entity-attribute-value lines back into rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.functions.casts import DTYPE_TAGS, try_number
from tallysheet.session import bounded_rows
from tallysheet.sinks.eav import CELLS_COL, PK_COL

CELL = T.StructType([T.StructField("type", T.StringType()), T.StructField("value", T.StringType())])
LINE = T.MapType(T.StringType(), T.MapType(T.StringType(), CELL))


def read_eav_cells(spark: SparkSession, path: str) -> DataFrame:
    """``(pk, cells)`` rows of a dump folder."""
    lines = spark.read.text(path)
    return lines.select(F.explode(F.from_json("value", LINE)).alias(PK_COL, CELLS_COL))


def column_tags(cells: DataFrame) -> dict[str, str]:
    """Discover ``column -> dtype tag`` (one small aggregate: one row per column)."""
    pairs = cells.select(F.explode(F.map_entries(CELLS_COL)).alias("e")).select(
        F.col("e.key").alias("column"), F.col("e.value.type").alias("type")
    )
    rows = bounded_rows(pairs.groupBy("column").agg(F.max("type").alias("type")), "dump columns")
    return {r["column"]: r["type"] for r in rows}


def typed_columns(cells: DataFrame, tags: Mapping[str, str], exclude: Iterable[str] = (),
                  keep_pk: bool = True) -> DataFrame:
    """One typed column per tagged column; absent cells are NULL."""
    excluded = set(exclude)
    cols = [F.col(PK_COL)] if keep_pk else []
    for name, tag in tags.items():
        if name in excluded:
            continue
        value = F.col(CELLS_COL).getItem(name).getField("value")
        target = DTYPE_TAGS.get(tag, T.StringType())
        if isinstance(target, (T.LongType, T.DoubleType)):
            typed = try_number(value, target)
        else:
            typed = value.try_cast(target)
        cols.append(typed.alias(name))
    return cells.select(*cols)


def read_eav(spark: SparkSession, path: str, tags: Mapping[str, str] | None = None,
             exclude: Iterable[str] = ()) -> DataFrame:
    cells = read_eav_cells(spark, path)
    return typed_columns(cells, tags if tags is not None else column_tags(cells), exclude)
