"""Path-hierarchy flattening on the tree fixture (FIXTURES B9)."""

import datetime as dt

from pyspark.sql import functions as F

from tallysheet.functions.casts import truncate_seconds
from tallysheet.operators.hierarchy import flatten_hierarchy, level_columns

UNITS = [
    ("A", "Country", "/A"),
    ("B", "Region", "/A/B"),
    ("C", "District", "/A/B/C"),
    ("D", "Clinic", "/A/B/C/D"),  # deeper than the level table
    ("E", "Orphan", "/X/E"),  # ancestor X is not a known unit
    ("F", "NoPath", ""),
    ("G", "NullPath", None),
]


def test_flatten(spark):
    units = spark.createDataFrame(UNITS, "uid string, name string, path string")
    levels = spark.createDataFrame(
        [("L2", "Sub National", 2), ("L1", "National", 1), ("L3", "District Level", 3)], "uid string, name string, level int"
    )
    cols = level_columns(levels)
    assert cols == [("L1", "National"), ("L2", "SubNational"), ("L3", "DistrictLevel")]
    out = {r["uid"]: r.asDict() for r in flatten_hierarchy(units, cols).collect()}
    assert out["A"] == {"uid": "A", "name": "Country", "level": 1, "L1": "A", "National": "Country",
                        "L2": "", "SubNational": "", "L3": "", "DistrictLevel": ""}
    assert out["C"]["L3"] == "C" and out["C"]["DistrictLevel"] == "District" and out["C"]["SubNational"] == "Region"
    assert out["D"]["level"] == 4 and out["D"]["L3"] == "C"  # extra depth dropped but counted
    assert out["E"]["L1"] == "X" and out["E"]["National"] == "" and out["E"]["SubNational"] == "Orphan"
    for uid in ("F", "G"):
        assert out[uid]["level"] == 0 and out[uid]["L1"] == "" and out[uid]["National"] == ""


def test_levels_sharing_a_name_keep_the_deeper_value(spark):
    units = spark.createDataFrame([("A", "Top", "/A"), ("B", "Low", "/A/B")], "uid string, name string, path string")
    out = {r["uid"]: r.asDict() for r in flatten_hierarchy(units, [("L1", "Area"), ("L2", "Area")]).collect()}
    assert out["A"]["Area"] == "Top" and out["B"]["Area"] == "Low"


def test_truncate_seconds_keeps_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 678000),)], "ts timestamp_ntz")
    out = df.select(truncate_seconds(F.col("ts")).alias("t"))
    assert out.schema["t"].dataType.typeName() == "timestamp_ntz"
    assert out.collect()[0]["t"] == dt.datetime(2024, 1, 2, 3, 4, 5)
