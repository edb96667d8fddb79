"""Scalar helpers: cast vocabulary, guarded numeric casts, zone-free timestamp text."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.functions.casts import (
    cast_as,
    datetime_text,
    day_text,
    iso_text,
    parse_timestamp,
    truncate_seconds,
    try_number,
)
from tallysheet.functions.keys import composite_key, sanitize


def test_try_number_equals_try_cast(spark):
    values = ["12", " 7 ", "-3", "+4", "1.5", "abc", "", None, "1e3", "NaN", "Infinity", "-inf", "9" * 30, "0x10"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    for target in (T.IntegerType(), T.LongType(), T.DoubleType()):
        got = df.select(try_number(F.col("s"), target).alias("a"), F.col("s").try_cast(target).alias("b")).collect()
        for r, v in zip(got, values):
            a, b = r["a"], r["b"]
            same = (a == b) or (a != a and b != b)  # NaN
            assert same, (target, v, a, b)


def test_cast_vocabulary(spark):
    df = spark.createDataFrame([("42", "2.5", "True", "2021-03-04T10:11:12.345+0000", "x")], "i string, f string, b string, t string, s string")
    row = df.select(
        cast_as(F.col("i"), "int").alias("i"), cast_as(F.col("f"), "float").alias("f"),
        cast_as(F.col("b"), "bool").alias("b"), cast_as(F.col("t"), "timestamp").alias("t"),
        cast_as(F.col("t"), "date").alias("d"), cast_as(F.col("s"), "unknown-word").alias("s"),
    ).collect()[0]
    assert (row["i"], row["f"], row["b"], row["s"]) == (42, 2.5, True, "x")
    assert row["t"] == dt.datetime(2021, 3, 4, 10, 11, 12, 345000) and row["d"] == dt.date(2021, 3, 4)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_wall_clock_helpers_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 on 2024-03-10 does not exist in New York (clocks jump to 03:00)
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 15, 123456),)], "ts timestamp_ntz")
        row = df.select(
            truncate_seconds(F.col("ts")).alias("t"), day_text(F.col("ts")).alias("d"),
            datetime_text(F.col("ts")).alias("dt"), iso_text(F.col("ts")).alias("iso"),
            parse_timestamp(F.lit("2024-03-10T02:30:15.123Z")).alias("p"),
        ).collect()[0]
        assert row["t"] == dt.datetime(2024, 3, 10, 2, 30, 15)
        assert (row["d"], row["dt"], row["iso"]) == ("2024-03-10", "2024-03-10 02:30:15", "2024-03-10T02:30:15.123")
        assert row["p"] == dt.datetime(2024, 3, 10, 2, 30, 15, 123000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_keys_and_names(spark):
    df = spark.createDataFrame([(1, "a", None)], "a int, b string, c string")
    assert df.select(composite_key(["a", "b"]).alias("k")).first()["k"] == "1-a"
    assert sanitize("Age Group ") == "AgeGroup"
