"""A key holding a third of the rows: joins past the broadcast bound are split by AQE,
aggregations combine map-side; results stay whole."""

import pytest
from pyspark.sql import functions as F

from tallysheet.operators.quality import fk_violating_rows, fk_violations
from tallysheet.operators.skew import lookup_join, semi_join_keys
from tallysheet.operators.upsert import last_per_key

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    # With p partitions a key holding a third of the rows is (1 + p/2) times the
    # median partition; AQE needs more than 5x, so use a cluster-like count.
    "spark.sql.shuffle.partitions": "32",
    # Tiny test data would otherwise be coalesced back into one task.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_fk_check_never_puts_a_hot_key_in_one_task(spark, skew_conf):
    n = 600_000
    child = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id")).alias("fk"), F.col("id").alias("v")
    )
    parent = spark.range(0, n).select(F.col("id").alias("pk"))
    out = fk_violations(child, parent, ["fk"], ["pk"], "fk_hot")
    assert [tuple(r) for r in out.collect()] == [("fk_hot", "-7", n // 3)]  # counted whole, nothing dropped
    scan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in scan  # a hot key is a row per task before the shuffle
    rows = fk_violating_rows(child, parent, ["fk"], ["pk"])
    per_task = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == n // 3 and max(r["count"] for r in per_task) < n // 30


def test_identical_rows_of_a_hot_key_spread(spark, skew_conf):
    n = 90_000
    child = spark.range(0, n).select(F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id")).alias("fk"))
    known = spark.range(0, 50).select((F.col("id") - 10).alias("fk"))
    kept = semi_join_keys(child, known, ["fk"])
    per_task = kept.where("fk = -7").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == n // 3 and max(r["count"] for r in per_task) < n // 10


def test_null_keys_spread_and_survive_the_anti_join(spark, skew_conf):
    big = spark.range(0, 30_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"))
    keys = spark.range(0, 100).select(F.col("id").alias("k"))
    assert semi_join_keys(big, keys, ["k"]).count() == 66
    left = semi_join_keys(big, keys, ["k"], anti=True)
    assert left.count() == 30_000 - 66
    nulls = left.where("k IS NULL").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in nulls) == 10_000 and max(r["count"] for r in nulls) <= 2_500


def test_salted_semi_join_spreads_a_hot_key(spark, skew_conf):
    n = 200_000
    big = spark.range(0, n).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("k"),
                                   F.col("id").alias("v"))
    keys = spark.range(0, 1000).select(F.col("id").alias("k"))
    out = semi_join_keys(big, keys, ["k"], salts=16)
    per_task = out.where(F.col("k") == 5).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == big.where(F.col("k") == 5).count()
    assert len(per_task) > 4  # the hot key is spread over many tasks
    expected = big.join(keys, "k", "left_semi").count()
    assert out.count() == expected
    anti = semi_join_keys(big, keys, ["k"], anti=True, salts=16)
    assert anti.count() == n - expected


def test_hot_key_latest_version_is_whole(spark):
    n = 300_000
    df = spark.range(0, n).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("ts"))
    got = {r["k"]: r["ts"] for r in last_per_key(df, ["k"], ["ts"]).collect()}
    assert got == {1: n - (n % 3 or 3), 0: n - 1}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("spread_by", [None, ["v"]])
def test_lookup_join_carries_columns_and_spreads_a_hot_key(spark, skew_conf, how, spread_by):
    n = 120_000
    key = F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 3 == 1, F.col("id"))  # a third is NULL
    big = spark.range(0, n).select(key.alias("k"), F.col("id").alias("v"))
    small = spark.range(0, 1000).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("twice"))
    out = lookup_join(big, small, ["k"], how, spread_by=spread_by)
    assert out.columns == ["k", "v", "twice"]
    expected = big.join(small, "k", how)
    assert out.count() == expected.count() and out.exceptAll(expected.select(*out.columns)).isEmpty()
    per_task = out.where("k = 5").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == n // 3 and max(r["count"] for r in per_task) < n // 20
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "approx_top_k" in plan  # one sketch, no count per key


def test_lookup_join_refuses_clashing_columns_and_takes_empty_sides(spark):
    big = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    with pytest.raises(ValueError, match="both sides"):
        lookup_join(big, spark.createDataFrame([(1, "x")], "k int, V string"), ["k"])
    with pytest.raises(ValueError, match="how"):
        lookup_join(big, big.select("k"), ["k"], "right")
    empty = spark.createDataFrame([], "k int, w string")
    assert {tuple(r) for r in lookup_join(big, empty, ["k"], "left").collect()} == {(None, "b", None), (1, "a", None)}
    assert lookup_join(empty, big, ["k"]).count() == 0
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string")
    assert sorted(r["w"] for r in lookup_join(big, twice, ["k"]).collect()) == ["x", "y"]
