"""File sinks: typed CSV, append, per-partition folders (O-11, O-14, O-16)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from tallysheet.sources.csv_typed import WAREHOUSE_TS_FORMAT


def write_csv(df: DataFrame, path: str, timestamp_format: str = WAREHOUSE_TS_FORMAT) -> None:
    """CSV folder with a header row and no index column; timestamps to the second."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("timestampNTZFormat", timestamp_format)
        .option("timestampFormat", timestamp_format)
        .csv(path)
    )


def append_rows(df: DataFrame, path: str, exclude: Iterable[str] = ()) -> None:
    """Append to a Parquet table, minus the excluded fields."""
    df.drop(*exclude).write.mode("append").parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """One folder per partition value.

    No shuffle: each task sorts its own rows by the partition columns and
    writes at most one file per value it holds, so a hot value is spread
    over every task that has it instead of landing in one.
    """
    (
        df.sortWithinPartitions(*partition_cols)
        .write.mode("overwrite")
        .partitionBy(*partition_cols)
        .parquet(path)
    )
