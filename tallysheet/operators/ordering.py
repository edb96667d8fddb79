"""Scans in a global order without a single-task window (O-36, O-51, O-56).

``row_number() over (order by ..)`` with no partition runs in one task.  Here
the rows are range-partitioned by the order (Spark samples the boundaries),
numbered inside each range, and shifted by the row counts of the ranges
before it - a table with one row per range, so tiny.  ``carry_forward``
does the same for "last non-NULL value before this row".  The numbered
rows are checkpointed once so both consumers see the same ranges, and so a
lost executor re-reads the checkpoint instead of re-sorting.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.functions.keys import quoted
from tallysheet.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id: partition index above bit 33, row index below


def _ordered(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Rows sorted by ``order_by`` with their range (``_part``) and rank inside it (``_local``)."""
    mid = F.monotonically_increasing_id()
    ranked = df.orderBy(*order_by).withColumn("_mid", mid)
    ranked = cut_lineage(ranked)
    return ranked.withColumns(
        {
            "_part": F.shiftright("_mid", _ROW_BITS),
            "_local": F.col("_mid").bitwiseAND((1 << _ROW_BITS) - 1) + 1,
        }
    )


def global_ordinal(df: DataFrame, order_by: Sequence[str | Column], name: str = "rn") -> DataFrame:
    """Add ``name`` = 1-based position in the total order ``order_by`` (make it unique)."""
    ranked = _ordered(df, order_by)
    counts = ranked.groupBy("_part").agg(F.max("_local").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    out = ranked.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + F.col("_local"))
    return out.select(*[quoted(c) for c in df.columns], name)


def carry_forward(
    df: DataFrame,
    order_by: Sequence[str | Column],
    value: Column,
    name: str,
    ordinal: str | None = None,
) -> DataFrame:
    """Add ``name`` = last non-NULL ``value`` strictly before each row in ``order_by`` order.

    With ``ordinal`` the global 1-based position is added as well.
    """
    ranked = _ordered(df, order_by).withColumn("_value", value)
    in_range = Window.partitionBy("_part").orderBy("_local").rowsBetween(Window.unboundedPreceding, -1)
    local = ranked.withColumn("_carried", F.last("_value", ignorenulls=True).over(in_range))
    per_range = ranked.groupBy("_part").agg(
        F.max("_local").alias("_n"),
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_local"))).alias("_last"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    edges = per_range.select(
        "_part",
        F.last("_last", ignorenulls=True).over(before).alias("_carry_in"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    out = local.join(F.broadcast(edges), "_part").withColumn(name, F.coalesce("_carried", "_carry_in"))
    extra = [name]
    if ordinal:
        out = out.withColumn(ordinal, F.col("_offset") + F.col("_local"))
        extra.append(ordinal)
    return out.select(*[quoted(c) for c in df.columns], *extra)


def cluster_for_write(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Sort-key clustering for a table write (O-56): ranges of ``keys``, sorted within.

    A hash of the whole row breaks ties inside the range key, so a key value
    holding a third of the rows spreads over neighbouring ranges instead of
    filling one file.
    """
    tiebreak = F.xxhash64(*[F.col(quoted(c)) for c in df.columns])  # by quoted names: any name will do
    n = partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return df.repartitionByRange(int(n), *[F.col(quoted(k)) for k in keys], tiebreak).sortWithinPartitions(
        *[F.col(quoted(k)) for k in keys])


#: Ranges that each column of a Z-order key is cut into (a power of two).
Z_RANGES = 256
#: Accuracy of the sampled quantiles, relative to the number of ranges.
Z_ACCURACY = 20


def _as_number(df: DataFrame, column: str) -> Column:
    """The column as a number in the same order: text by its first seven bytes."""
    value, kind = F.col(quoted(column)), df.schema[column].dataType
    if isinstance(kind, T.StringType):
        prefix = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 7)), 14, "0")
        return F.conv(prefix, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        # The calendar fields, not an instant: no time zone moves them.
        return F.unix_date(value.cast("date")).cast("double") * 86_400 + F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
    return value.cast("double")


def with_z_order_key(df: DataFrame, keys: Sequence[str], name: str = "_z", ranges: int = Z_RANGES) -> DataFrame:
    """Add ``name``, a key whose order keeps rows close that are close in *any* of ``keys``: the interleaved bits of their ranges.

    Each column is cut into ``ranges`` ranges of about as many rows, at quantiles that one aggregate samples
    (``percentile_approx``, combined in every task); a row finds its range by binary search.  A range's number has ``log2(ranges)``
    bits, of which the key takes the first of every column, then the second, and so on.  NULL is in the first range, NaN in the last; a
    value that fills several ranges counts for all of them, so the numbers always reach to the last one.
    """
    bits = int(math.log2(ranges))
    if 2**bits != ranges or bits * len(keys) > 62:
        raise ValueError("ranges must be a power of two, and the key fit into 62 bits")
    cuts = F.lit([i / ranges for i in range(1, ranges)])
    sampled = df.agg(*[F.percentile_approx(_as_number(df, k), cuts, Z_ACCURACY * ranges).alias(f"q{i}") for i, k in enumerate(keys)])
    bounds = [sorted(q or []) for q in sampled.first()]  # one row of ranges - 1 numbers per column
    found, z = df, F.lit(0).cast("long")
    for i, k in enumerate(keys):
        edges = sorted(set(bounds[i])) or [0.0]
        # Range n of the distinct edges begins behind so many of all edges.
        numbers = [0, *[bisect_right(bounds[i], e) for e in edges]]
        value = F.coalesce(_as_number(df, k), F.lit(float("-inf")))
        cut = Bucketizer(splits=[float("-inf"), *edges, float("inf")], inputCol=f"_z_value{i}", outputCol=f"_z_range{i}", handleInvalid="keep")
        found = cut.transform(found.withColumn(f"_z_value{i}", value)).drop(f"_z_value{i}")
        number = F.coalesce(F.get(F.lit(numbers), F.col(f"_z_range{i}").cast("int")), F.lit(ranges - 1)).cast("long")
        for bit in range(bits):
            place = (bits - 1 - bit) * len(keys) + (len(keys) - 1 - i)
            z = z.bitwiseOR(F.shiftleft(F.shiftright(number, bits - 1 - bit).bitwiseAND(1), place))
    return found.withColumn(name, z).drop(*[f"_z_range{i}" for i in range(len(keys))])


def z_order_for_write(df: DataFrame, keys: Sequence[str], partitions: int, ranges: int = Z_RANGES) -> DataFrame:
    """Clustering of a table write by several columns at once (O-56): a filter on any of ``keys`` reads few files.

    Rows go to ``partitions`` ranges of the Z-order key, ties by a hash of the whole row, so equal rows do not
    fill one file; each task writes one file, whose statistics are narrow in every key.
    """
    tiebreak = F.xxhash64(*[F.col(quoted(c)) for c in df.columns])
    keyed = with_z_order_key(df, keys, "_z", ranges)
    return keyed.repartitionByRange(partitions, F.col("_z"), tiebreak).sortWithinPartitions("_z").drop("_z")


def files_read(table: DataFrame, column: str, low, high) -> DataFrame:
    """``(files, hit)``: the files of ``table`` and those whose least and greatest ``column`` meet the range: what a scan cannot skip."""
    spans = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(quoted(column)).alias("least"), F.max(quoted(column)).alias("greatest"))
    meets = (F.col("least") <= F.lit(high)) & (F.col("greatest") >= F.lit(low))
    return spans.agg(F.count(F.lit(1)).alias("files"), F.count(F.when(meets, 1)).alias("hit"))
