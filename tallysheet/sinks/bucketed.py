"""Keyed upserts into bucketed tables: only the batch is shuffled (O-08, O-09, O-12, O-45).

A rewrite of a stored table joins all of it with a batch that is a thousandth of its size, and without further ado shuffles
both.  A table written with ``bucketBy`` on its key is already dealt: the batch alone is repartitioned to the
same buckets, the join reads the stored buckets where they are, and its result is written bucket by bucket again.
Latest-version reads (``operators.upsert.last_per_key``) of such a table need no shuffle either.

Tables are catalog tables with files of their own for every version.  A load writes ``<table>__next`` and then gives it the
table's name; one that dies in between is finished by the next call (:func:`settled`).  The old version's files stay until :func:`delete_old`.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.functions.keys import quoted
from tallysheet.operators.upsert import upsert
from tallysheet.session import delete_path

NEXT = "__next"


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, base: str, dealt: bool = False) -> None:
    """``df`` as a new table of ``buckets`` buckets by ``keys``, sorted in each, one file a bucket, in a fresh folder under ``base``.

    ``dealt``: the rows are already in one partition per bucket, so they are not shuffled again.
    """
    rows = df if dealt else df.repartition(buckets, *[F.col(quoted(k)) for k in keys])
    (rows.write.format("parquet").option("path", f"{base}/{uuid.uuid4().hex[:12]}")
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))


def layout(spark: SparkSession, table: str) -> tuple[int, list[str], str]:
    """(number of buckets, bucket columns, folder) of a bucketed table."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if described.get("Num Buckets") in (None, "0", "-1"):
        raise ValueError(f"{table} is not bucketed")
    keys = [k.strip().strip("`") for k in described["Bucket Columns"].strip("[]").split(",")]
    return int(described["Num Buckets"]), keys, described["Location"]


def settled(spark: SparkSession, table: str) -> None:
    """Finishes a load that wrote its version but died before it gave it the table's name."""
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(table + NEXT):
        spark.sql(f"ALTER TABLE {table}{NEXT} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {table}{NEXT}")


def upserted(spark: SparkSession, table: str, batch: DataFrame, sparse: bool = False) -> DataFrame:
    """The stored rows with ``batch`` upserted by the bucket columns (``operators.upsert.upsert``); nothing is written.

    ``batch`` has unique keys.  It is dealt to the stored buckets in the stored types of the keys.
    """
    buckets, keys, _ = layout(spark, table)
    stored = spark.table(table)
    batch = batch.withColumns({k: F.col(quoted(k)).cast(stored.schema[k].dataType) for k in keys})
    return upsert(stored, batch.repartition(buckets, *[F.col(quoted(k)) for k in keys]), keys, sparse)


def upsert_bucketed(spark: SparkSession, table: str, batch: DataFrame, sparse: bool = False) -> str:
    """Upserts ``batch`` into the table as its next version; returns the folder of the version it replaces."""
    settled(spark, table)
    buckets, keys, folder = layout(spark, table)
    rows = upserted(spark, table, batch, sparse)
    write_bucketed(rows, table + NEXT, keys, buckets, folder.rsplit("/", 1)[0], dealt=True)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {table}{NEXT} RENAME TO {table}")
    return folder


def delete_old(spark: SparkSession, folder: str) -> bool:
    """Deletes the files of a replaced version, once nothing reads them."""
    return delete_path(spark, folder)
