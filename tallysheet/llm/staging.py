"""Intermediate tables in the shared folder: they survive the loss of executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallysheet.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the session's shared checkpoint folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
