"""Configuration as tables (O-07).

Pipeline settings (facility code -> org unit, data element -> indicator ->
combo) join like any dimension once they are DataFrames.  Spark sizes them itself
(a local relation's size is known), so it broadcasts a usual one and shuffles
a huge one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def config_table(spark: SparkSession, mapping: Mapping[str, str], key_col: str, value_col: str) -> DataFrame:
    """A ``{key: value}`` setting as a two-column table."""
    rows = [(str(k), None if v is None else str(v)) for k, v in mapping.items()]
    return spark.createDataFrame(rows, f"`{key_col}` string, `{value_col}` string")


def report_entries(spark: SparkSession, dataelements) -> DataFrame:
    """``(indicator, dataElement, categoryOptionCombo)`` rows of a report configuration."""
    rows = [
        (indicator, de["dataElement"], combo)
        for de in dataelements
        for indicator, combo in de["category_option_combo"].items()
    ]
    return spark.createDataFrame(rows, "indicator string, dataElement string, categoryOptionCombo string")
