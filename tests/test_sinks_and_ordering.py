"""Payload batching, ordered scans, dumps and typed CSV: properties against brute force."""

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallysheet.operators.ordering import carry_forward, cluster_for_write, files_read, global_ordinal, z_order_for_write
from tallysheet.sinks.eav import to_eav, write_eav
from tallysheet.sinks.files import write_csv
from tallysheet.sinks.payload import payload_chunks, write_payloads
from tallysheet.sources.csv_typed import read_typed_csv
from tallysheet.sources.eav import read_eav


def test_one_ordered_list_is_cut_in_full_chunks(spark, tmp_dir):
    data = [("p1" if i % 3 else "p2", i * 7, f"v{i}") for i in range(500)]
    df = spark.createDataFrame(data, "part string, key long, v string").repartition(5)
    chunks = payload_chunks(df, ["part", "key"], ["key", "v"])
    rows = sorted(chunks.collect(), key=lambda r: r["chunk"])
    assert [r["n"] for r in rows] == [30] * 16 + [20]  # groups of any size never cut a chunk short
    values = [item["key"] for r in rows for item in json.loads(r["payload"])["dataValues"]]
    assert values == [k for _, k, _ in sorted(data)]
    write_payloads(chunks, f"{tmp_dir}/bodies")
    bodies = [r["value"] for r in spark.read.text(f"{tmp_dir}/bodies").collect()]
    assert sorted(bodies) == sorted(r["payload"] for r in rows)


def test_global_ordinal_matches_row_number(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2003).alias("k"), F.col("id")).repartition(7)
    got = {r["id"]: r["rn"] for r in global_ordinal(df, ["k", "id"]).collect()}
    w = Window.orderBy("k", "id")
    expected = {r["id"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == expected


def test_carry_forward_matches_brute_force(spark):
    rows = [(i, f"n{i}" if i % 5 == 0 else None) for i in range(1, 400)]
    df = spark.createDataFrame(rows, "seq int, v string").repartition(6)
    out = {r["seq"]: (r["prev"], r["rn"])
           for r in carry_forward(df, ["seq"], F.col("v"), "prev", ordinal="rn").collect()}
    last = None
    for seq, v in rows:
        assert out[seq] == (last, seq)
        if v is not None:
            last = v


def test_eav_round_trip_with_repeated_key(spark, tmp_dir):
    df = spark.createDataFrame(
        [(1, "a", 10, 1.5, 1), (1, "a", 11, 2.5, 2), (2, "b", 12, None, 1)],
        "k1 long, k2 string, n long, x double, seq int",
    )
    write_eav(to_eav(df, ["k1", "k2"], order_by=F.col("seq"), exclude=["seq"]), tmp_dir)
    lines = [json.loads(r["value"]) for r in spark.read.text(tmp_dir).collect()]
    assert sorted(k for line in lines for k in line) == ["1-a", "2-b"]
    back = {r["pk"]: r.asDict() for r in read_eav(spark, tmp_dir, exclude=["x"]).collect()}
    assert back["1-a"] == {"pk": "1-a", "k1": 1, "k2": "a", "n": 11}  # the later duplicate wins
    assert back["2-b"]["n"] == 12


def test_csv_typed_round_trip(spark, tmp_dir):
    df = spark.createDataFrame(
        [("u1", "Clinic", 3, "2024-01-02 03:04:05")], "uid string, name string, level int, lastupdated string"
    ).withColumn("lastupdated", F.col("lastupdated").cast("timestamp_ntz"))
    write_csv(df, tmp_dir)
    back = read_typed_csv(spark, tmp_dir, {"level": "int", "lastupdated": "timestamp"})
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["string", "string", "int", "timestamp_ntz"]
    assert tuple(back.collect()[0])[:3] == ("u1", "Clinic", 3)


def test_cluster_for_write_sorts_ranges_and_splits_a_hot_key(spark):
    from tallysheet.operators.ordering import cluster_for_write

    data = [(0, i) for i in range(3000)] + [(k, 0) for k in range(1, 300)]
    df = spark.createDataFrame(data, "k int, v int")
    clustered = cluster_for_write(df, ["k"], partitions=6)
    parts = clustered.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
        F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n"), F.sum(F.when(F.col("k") == 0, 1)).alias("hot")
    ).orderBy("p").collect()
    assert sum(r["n"] for r in parts) == len(data)
    assert sum(1 for r in parts if r["hot"]) > 1  # the hot key spans several ranges
    for a, b in zip(parts, parts[1:]):
        assert a["hi"] <= b["lo"]  # ranges are ordered


def test_z_order_reads_a_fraction_of_the_files_for_any_key(spark, tmp_dir):
    import datetime as dt

    df = spark.range(8000).select(
        (F.col("id") * 7919 % 1000).alias("a"), F.concat(F.lit("k"), F.lpad((F.col("id") * 104729 % 500).cast("string"), 3, "0")).alias("b b"),
        F.date_add(F.lit("2020-01-01"), (F.col("id") % 365).cast("int")).alias("d"), F.col("id").alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, None, None, -1)], df.schema))
    z_order_for_write(df, ["a", "b b", "d"], 64).write.parquet(f"{tmp_dir}/z")
    cluster_for_write(df, ["a"], 64).write.parquet(f"{tmp_dir}/plain")
    table, plain = spark.read.parquet(f"{tmp_dir}/z"), spark.read.parquet(f"{tmp_dir}/plain")
    assert table.exceptAll(df).isEmpty() and table.count() == 8001
    for key, value in (("a", 400), ("b b", "k200"), ("d", dt.date(2020, 5, 25))):
        files, hit = files_read(table, key, value, value).first()
        assert files == 64 and 0 < hit <= 32
    assert files_read(plain, "b b", "k200", "k200").first()["hit"] > 32  # one key alone helps no other
    with pytest.raises(ValueError, match="power of two"):
        z_order_for_write(df, ["a"], 4, ranges=100)


def test_z_order_of_equal_rows_and_of_an_empty_table(spark, tmp_dir):
    same = spark.range(3000).select(F.lit(1).alias("a"), F.lit("x").alias("b"), F.col("id").alias("v"))
    sizes = [r["count"] for r in z_order_for_write(same, ["a", "b"], 6).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1500  # equal keys do not fill one file
    assert z_order_for_write(same.where("false"), ["a", "b"], 4).count() == 0
