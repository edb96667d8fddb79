"""Upsert into a partitioned fact table, rewriting only the partitions a batch touches.

A daily slice of data values touches a handful of periods out of years of
history.  Rewriting the whole table per load would make every load cost the
table size; instead:

1. the batch's partition values prune the current table's scan to those
   folders, and a null-safe semi join keeps exactly their rows (one path for
   any number of values; more than ``MAX_PARTITIONS`` raise, as the table's own
   folder listing would not fit the driver either);
2. the merged rows are checkpointed to the shared checkpoint folder - this
   cuts the lineage back to the files about to be replaced, and a lost
   executor re-reads the checkpoint rather than the half-replaced files;
3. the result is written with ``partitionOverwriteMode=dynamic``: only the
   touched partition folders are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.functions.keys import quoted
from tallysheet.session import cut_lineage, path_is_missing


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if not path_is_missing(e):
            raise
        return spark.createDataFrame([], schema)


# Folders a batch may touch; partition values are metadata, never truncated.
MAX_PARTITIONS = 100_000


def touched_rows(current: DataFrame, batch: DataFrame, partition_cols: Sequence[str],
                 max_partitions: int = MAX_PARTITIONS) -> DataFrame:
    """The rows of ``current`` in partitions that ``batch`` touches; NULL is a partition like any other."""
    touched = batch.select(*partition_cols).distinct()
    values = touched.limit(max_partitions + 1).collect()
    if len(values) > max_partitions:
        raise ValueError(f"the batch touches more than {max_partitions} partitions; load it in smaller slices")
    pruned = current
    for c in partition_cols:
        seen = {r[c] for r in values}
        keep = F.col(quoted(c)).isin(sorted(v for v in seen if v is not None))
        pruned = pruned.where(keep | F.col(quoted(c)).isNull() if None in seen else keep)
    if len(partition_cols) == 1:
        return pruned  # one column: the pruning filter is exact
    spark = current.sparkSession
    exact = F.broadcast(spark.createDataFrame(values, touched.schema))  # max_partitions rows at most
    same = F.lit(True)
    for c in partition_cols:
        same = same & pruned[quoted(c)].eqNullSafe(exact[quoted(c)])
    return pruned.join(exact, same, "left_semi")


def merge_into_partitions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    partition_cols: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    schema: T.StructType,
    max_partitions: int = MAX_PARTITIONS,
) -> DataFrame:
    """``merge(current_rows_of_touched_partitions, batch)`` written back over those partitions.

    ``schema`` is the table schema (partition columns included).  Returns the
    checkpointed merged rows that were written.
    """
    current = touched_rows(read_partitioned(spark, path, schema), batch, partition_cols, max_partitions)
    merged = cut_lineage(merge(current, batch).select(*[F.col(f"`{f.name}`") for f in schema.fields]))
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )
    return merged
