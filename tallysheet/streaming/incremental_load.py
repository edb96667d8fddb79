"""Incremental fact ingest as a Structured Streaming job (O-58).

New landed files are the new slice; the stream checkpoint replaces the
stored high-water date.  Each micro-batch folds its rows per key (latest
version wins) and writes them as its own table version ``batch_id=<n>``
with ``overwrite``, so a replayed batch rewrites exactly its own version
and nothing else - the load stays idempotent and no state lives in a
Python closure.  Readers collapse the versions per key at read time
(merge-on-read, as a replacing-merge table does); ``compact`` folds finished
batches into one version, which readers then start from.  Work per batch is
proportional to the batch, not to the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallysheet.operators.upsert import last_per_key
from tallysheet.session import delete_path, path_exists, path_is_missing

VERSION_COL = "batch_id"
COMPACTED = "_compacted"
LOG = "_commits"


def start_upsert_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    table_path: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    checkpoint: str,
    source_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops once the landed files are consumed."""
    reader = spark.readStream.schema(schema).format(source_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)

    def write_version(batch: DataFrame, batch_id: int) -> None:
        folded = last_per_key(batch, keys, order_by)
        folded.write.mode("overwrite").parquet(f"{table_path}/{VERSION_COL}={batch_id}")

    writer = stream.writeStream.foreachBatch(write_version).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _folded_upto(spark: SparkSession, table_path: str) -> int | None:
    """The last batch that a committed compaction holds."""
    try:
        return spark.read.schema("upto long").parquet(f"{table_path}{COMPACTED}/{LOG}").agg(F.max("upto")).first()[0]
    except AnalysisException as e:
        if not path_is_missing(e):
            raise
        return None


def read_current(spark: SparkSession, table_path: str, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The table as of the last committed batch: newest version per key.

    Reads the newest compaction and only the batches behind it.
    """
    upto = _folded_upto(spark, table_path)
    if upto is None:
        return last_per_key(spark.read.parquet(table_path).drop(VERSION_COL), keys, order_by)
    base = spark.read.parquet(f"{table_path}{COMPACTED}/upto={upto}")
    try:
        later = spark.read.parquet(table_path).where(F.col(VERSION_COL) > upto).drop(VERSION_COL)
    except AnalysisException as e:
        if not path_is_missing(e):
            raise
        return base
    return last_per_key(base.unionByName(later), keys, order_by)


def compact(spark: SparkSession, table_path: str, keys: Sequence[str], order_by: Sequence[str],
            delete_folded: bool = False) -> int | None:
    """Fold all finished batches into one version that readers use from then on; safe while the stream runs.

    The stream goes on writing its own ``batch_id`` folders; the compaction is
    written next to them under the number of the last batch it holds, then
    recorded, so readers see either state.  A batch counts as finished once
    its folder has Spark's success marker.  ``delete_folded`` removes the folders it
    replaces (no reader of an older state may be running).  Returns that batch number.
    """
    before = _folded_upto(spark, table_path)
    batches = [r[0] for r in spark.read.parquet(table_path).select(VERSION_COL).distinct().collect()]
    done = [b for b in sorted(batches) if path_exists(spark, f"{table_path}/{VERSION_COL}={b}/_SUCCESS")]
    new = [b for b in done if before is None or b > before]
    if not new:
        return before
    upto = new[-1]
    frames = [spark.read.parquet(table_path).where(F.col(VERSION_COL).isin(new)).drop(VERSION_COL)]
    if before is not None:
        frames.append(spark.read.parquet(f"{table_path}{COMPACTED}/upto={before}"))
    folded = last_per_key(reduce(DataFrame.unionByName, frames), keys, order_by)
    folded.write.mode("overwrite").parquet(f"{table_path}{COMPACTED}/upto={upto}")
    spark.createDataFrame([(upto,)], "upto long").write.mode("append").parquet(f"{table_path}{COMPACTED}/{LOG}")
    if delete_folded:
        for b in new:
            delete_path(spark, f"{table_path}/{VERSION_COL}={b}")
        if before is not None:
            delete_path(spark, f"{table_path}{COMPACTED}/upto={before}")
    return upto
