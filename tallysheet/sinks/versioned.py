"""Versioned tables on plain Parquet.

A load never overwrites the files it reads: each commit writes a new
``v=<n>`` folder and then appends ``n`` to a small commit log, so readers
see either the old or the new version, never a half-written one, and a
failed load leaves the previous version in place.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.session import delete_path, path_is_missing

LOG = "_commits"


def latest_version(spark: SparkSession, path: str) -> int | None:
    try:
        log = spark.read.schema("version long").parquet(f"{path}/{LOG}")
    except AnalysisException as e:
        if not path_is_missing(e):
            raise
        return None
    return log.agg(F.max("version")).first()[0]


def read_latest(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The newest committed version; ``None`` (or an empty frame of ``schema``) when there is none.

    Columns of ``schema`` that the stored version does not have yet are NULL.
    """
    v = latest_version(spark, path)
    if v is None:
        return spark.createDataFrame([], schema) if schema is not None else None
    stored = spark.read.parquet(f"{path}/v={v}")
    new = [f for f in (schema.fields if schema is not None else ()) if f.name not in stored.columns]
    return stored.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in new])


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete the data of all but the newest ``keep`` committed versions; returns the versions deleted.

    Readers of an older version must have finished.
    """
    log = spark.read.schema("version long").parquet(f"{path}/{LOG}")
    old = [r["version"] for r in log.distinct().orderBy(F.desc("version")).offset(keep).collect()]
    return [v for v in old if delete_path(spark, f"{path}/v={v}")]


def commit(df: DataFrame, path: str) -> int:
    """Write ``df`` as the next version and record it; returns the version number.

    One writer per table (the load job).  A load that dies between the data
    write and the log append leaves an unrecorded folder, which the rerun
    overwrites under the same number.
    """
    spark = df.sparkSession
    current = latest_version(spark, path)
    version = 0 if current is None else current + 1
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    spark.createDataFrame([(version,)], "version long").write.mode("append").parquet(f"{path}/{LOG}")
    return version
