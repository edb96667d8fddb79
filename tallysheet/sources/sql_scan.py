"""Relational query scans (O-04): an arbitrary SELECT as a DataFrame.

Over DataFrames the SELECT runs through ``spark.sql`` with the frames bound as
parameters (no global temp views); over a live database it is a JDBC read
with the query pushed to the source, split on a numeric column for
parallel reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_frames(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """``spark.sql`` with ``{name}`` placeholders bound to DataFrames."""
    return spark.sql(sql, **frames)


def jdbc_query(spark: SparkSession, url: str, query: str, user: str, password: str,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               partitions: int = 1) -> DataFrame:
    """A SELECT executed by the source database; partitioned reads when bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("user", user).option("password", password)
    if partition_column is None:
        return reader.option("query", query).load()
    return (
        reader.option("dbtable", f"({query}) AS q")
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )
