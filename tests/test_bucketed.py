"""Upserts into bucketed tables shuffle the batch only."""

import uuid

import pytest
from pyspark.sql import functions as F

from tallysheet.operators.upsert import last_per_key, upsert
from tallysheet.sinks.bucketed import NEXT, delete_old, layout, settled, upsert_bucketed, upserted, write_bucketed


@pytest.fixture
def name(spark):
    table = f"t_{uuid.uuid4().hex[:10]}"
    yield table
    for t in (table, table + NEXT):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_only_the_batch_is_shuffled_and_rows_equal_a_plain_upsert(spark, tmp_dir, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("s"), F.lit("old").alias("v"), F.lit(1).alias("n"))
        write_bucketed(stored, name, ["k", "s"], 8, tmp_dir)
        batch = spark.range(4000, 6000, 3).select(F.col("id").cast("int").alias("k"), (F.col("id") % 7).cast("string").alias("s"),
                                                   F.when(F.col("id") % 2 == 0, F.lit("new")).alias("v"))
        batch = batch.unionByName(spark.createDataFrame([(None, "x", "null key")], "k int, s string, v string"))
        for sparse in (False, True):
            plan = upserted(spark, name, batch, sparse)
            assert shuffles(plan) == 1  # the batch's; the stored side has none
            expected = upsert(stored, batch, ["k", "s"], sparse)
            assert plan.exceptAll(expected.select(*plan.columns)).isEmpty() and plan.count() == expected.count()
        assert shuffles(last_per_key(spark.table(name), ["k", "s"], ["n"])) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_versions_stay_bucketed_with_one_file_a_bucket(spark, tmp_dir, name):
    write_bucketed(spark.range(1000).withColumn("v", F.lit(0)), name, ["id"], 4, tmp_dir)
    for i in (1, 2):
        batch = spark.range(500 * i, 500 * i + 800).withColumn("v", F.lit(i))
        folder = upsert_bucketed(spark, name, batch)
        assert delete_old(spark, folder)
    assert spark.table(name).count() == 1800 and layout(spark, name)[:2] == (4, ["id"])
    assert {r["v"]: r["count"] for r in spark.table(name).groupBy("v").count().collect()} == {0: 500, 1: 500, 2: 800}
    assert len(spark.table(name).inputFiles()) == 4
    upsert_bucketed(spark, name, spark.range(0).withColumn("v", F.lit(9)))
    assert spark.table(name).count() == 1800


def test_a_load_that_died_before_the_rename_is_finished(spark, tmp_dir, name):
    write_bucketed(spark.range(10), name, ["id"], 2, tmp_dir)
    write_bucketed(spark.range(20), name + NEXT, ["id"], 2, tmp_dir)
    settled(spark, name)  # the old version still has the name: the unfinished one goes
    assert spark.table(name).count() == 10
    write_bucketed(spark.range(20), name + NEXT, ["id"], 2, tmp_dir)
    spark.sql(f"DROP TABLE {name}")
    settled(spark, name)
    assert spark.table(name).count() == 20 and not spark.catalog.tableExists(name + NEXT)
    spark.range(3).write.saveAsTable(name + NEXT, path=f"{tmp_dir}/plain")
    with pytest.raises(ValueError, match="not bucketed"):
        layout(spark, name + NEXT)
