"""Typed CSV scan (O-05): header row, declared columns typed, the rest text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.functions.casts import spark_type
from tallysheet.functions.keys import quoted

WAREHOUSE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_typed_csv(
    spark: SparkSession,
    path: str,
    declared: Mapping[str, str],
    timestamp_format: str = WAREHOUSE_TS_FORMAT,
) -> DataFrame:
    """Read a CSV folder: declared columns typed by the CSV parser, the rest strings.

    ``declared`` maps column -> vocabulary word (``int``, ``long``, ``float``,
    ``bool``, ``timestamp``, ``date``); timestamps parse with ``timestamp_format``
    straight into ``timestamp_ntz`` (no time-zone round trip); malformed values
    become NULL.  Only the header line is read to learn the column names; no
    inference pass runs.
    """
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    fields = []
    for name in header:
        kind = declared.get(name)
        data_type = T.TimestampNTZType() if kind in ("timestamp", "date") else spark_type(kind or "str")
        fields.append(T.StructField(name, data_type, True))
    typed = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("timestampNTZFormat", timestamp_format)
        .csv(path)
    )
    dates = [n for n in header if declared.get(n) == "date"]
    if not dates:
        return typed
    return typed.select(*[(F.col(quoted(n)).cast("date") if n in dates else F.col(quoted(n))).alias(n) for n in header])


def rejected_cells(spark: SparkSession, path: str, declared: Mapping[str, str],
                   timestamp_format: str = WAREHOUSE_TS_FORMAT) -> DataFrame:
    """``(column, value, row)`` of every non-empty cell that its declared type cannot hold (``read_typed_csv`` reads NULL).

    ``row`` is the whole line as text columns.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)

    def typed(c: str, kind: str):
        if kind in ("timestamp", "date"):
            return F.try_to_timestamp(F.col(quoted(c)), F.lit(timestamp_format))
        return F.col(quoted(c)).try_cast(spark_type(kind))

    cells = [
        F.when(F.col(quoted(c)).isNotNull() & typed(c, kind).isNull(),
               F.struct(F.lit(c).alias("column"), F.col(quoted(c)).alias("value")))
        for c, kind in declared.items() if c in raw.columns and kind in ("timestamp", "date", "int", "long", "float", "bool")
    ]
    if not cells:
        cells = [F.lit(None).cast("struct<column:string,value:string>")]
    bad = raw.select(F.struct(*[quoted(c) for c in raw.columns]).alias("row"), F.array_compact(F.array(*cells)).alias("bad"))
    return bad.select("row", F.inline("bad")).select("column", "value", "row")
