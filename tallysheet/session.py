"""Session helpers: defaults for a fresh session and the shared scratch area.

Nothing here overrides what a cluster already configured.  Scratch data
(landed files for round-trip checks, stream checkpoints, lineage cuts)
lives under the shared folder named by ``spark.checkpoint.dir``; only when
that is unset (local tests) is a temporary folder chosen and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults applied only where the session has no value of its own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tallysheet",
                  extra_conf: dict | None = None) -> SparkSession:
    """Session for tests and local benches; a cluster passes its own session instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TALLYSHEET_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**DEFAULT_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a private temp one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            # A temporary folder would be another one on each machine.
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tallysheet-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint area."""
    return f"{checkpoint_root(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder wherever Spark's file systems reach it; whether there was one."""
    fs, target = _file_system(spark, path)
    return bool(fs.delete(target, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return bool(fs.exists(target))


def clean_scratch(spark: SparkSession) -> bool:
    """Delete this session's scratch folders, once nothing reads from them any more.

    Checkpoints of DataFrames go by themselves with
    ``spark.cleaner.referenceTracking.cleanCheckpoints=true``.
    """
    return delete_path(spark, f"{checkpoint_root(spark)}/scratch")


def path_is_missing(error: Exception) -> bool:
    """Whether an analysis error says that a path does not exist (yet), and nothing else."""
    return (error.getCondition() or "").startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"))


# Metadata lists (levels, categories, groups, column tags) that size generated column lists.
MAX_METADATA_ROWS = 10_000


def bounded_rows(df: DataFrame, what: str, limit: int = MAX_METADATA_ROWS) -> list:
    """The rows of a metadata list; raises (never truncates) past ``limit``."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}: too many for generated columns")
    return rows
