"""Integrity checks and the streaming load (stream result = batch result, replay-safe)."""

from pyspark.sql import functions as F

from tallysheet.operators.incremental import next_mark, since_mark
from tallysheet.operators.quality import Rule, duplicate_keys, fk_violations, rule_violations
from tallysheet.operators.upsert import last_per_key
from tallysheet.plans.constraints import TABLES, check_store
from tallysheet.session import delete_path, path_exists, scratch_path
from tallysheet.sinks.versioned import commit
from tallysheet.streaming.incremental_load import compact, read_current, start_upsert_stream
from tests.conftest import SF_SMALL


def test_fk_null_passes_and_composite_keys(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b")], "id int, src string")
    child = spark.createDataFrame([(1, "a"), (None, "a"), (3, "a"), (2, "z")], "pid int, psrc string")
    single = sorted(r["child_key"] for r in fk_violations(child, parent, ["pid"], ["id"], "fk1").collect())
    assert single == ["3"]
    pair = sorted(r["child_key"] for r in fk_violations(child, parent, ["pid", "psrc"], ["id", "src"], "fk2").collect())
    assert pair == ["2-z", "3-a"]


def test_column_rules_and_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "en", "abc"), (1, "xx", None), (2, None, "abcdef")], "id int, lang string, t string")
    rules = [Rule("t.nn", "not_null", "t"), Rule("lang.dom", "domain", "lang", ["en"]), Rule("t.len", "max_length", "t", 4)]
    got = {(r["rule"], r["key"]): r["n"] for r in rule_violations(df, rules, ["id"]).collect()}
    assert got == {("t.nn", "1"): 1, ("lang.dom", "1"): 1, ("t.len", "2"): 1}
    assert [tuple(r) for r in duplicate_keys(df, ["id"], "pk").collect()] == [("pk", "1", 2)]
    assert rule_violations(df.limit(0), rules, ["id"]).count() == 0


def test_constraint_catalogue_and_store_check(spark, tmp_dir):
    assert sum(len(t.references) for t in TABLES.values()) == 28 and len(TABLES) == 15
    for name, table in TABLES.items():
        assert set(table.key) <= set(table.columns), name
        assert all(set(cols) <= set(table.columns) and parent in TABLES for cols, parent in table.references.values())
    sources = spark.createDataFrame([("s1", "T", "http://x")], "id string, title string, url string")
    combos = spark.createDataFrame([("c1", "N", "2024-01-01", "2024-01-01", "s1"), ("c2", None, "x", "x", "s9"),
                                    ("c3" * 6, "N", "x", "x", "s1"), ("c1", "again", "x", "x", "s1")],
                                   "uid string, name string, created string, lastupdated string, sourceid string")
    options = spark.createDataFrame([("o1", "N", "x", "x", "c1", "s1"), ("o2", "N", "x", "x", "zz", "s1")],
                                    "uid string, name string, created string, lastupdated string, categorycombo_id string, sourceid string")
    commit(combos, f"{tmp_dir}/categorycombo")
    commit(options, f"{tmp_dir}/categoryoptioncombo")
    got = sorted(tuple(r) for r in check_store(spark, tmp_dir, {"data_source": sources}).collect())
    assert got == [("categorycombo.name.not_null", "c2-s9", 1), ("categorycombo.pk", "c1-s1", 2),
                   ("categorycombo.uid.max_length", "c3c3c3c3c3c3-s1", 1),
                   ("fk_categorycombo_data_source", "s9", 1), ("fk_categoryoptioncombo_categorycombo", "zz-s1", 1)]


def test_high_water_mark(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-05 00:00:00",)], "ts string").select(
        F.col("ts").cast("timestamp_ntz").alias("ts")
    )
    fresh = since_mark(df, "ts", "2024-01-03 00:00:00")
    assert [str(r["m"]) for r in fresh.select(next_mark(fresh, "ts", "2024-01-03 00:00:00").alias("m")).collect()] == [
        "2024-01-05 00:00:00"
    ]
    empty = since_mark(df, "ts", "2030-01-01 00:00:00")
    assert [str(r["m"]) for r in df.limit(1).select(next_mark(empty, "ts", "2030-01-01 00:00:00").alias("m")).collect()] == [
        "2030-01-01 00:00:00"
    ]


def test_stream_equals_batch_and_replay_is_harmless(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    landing = scratch_path(spark, "t_landing")
    events.repartitionByRange(3, "ts").write.parquet(landing)
    table, ckpt = scratch_path(spark, "t_table"), scratch_path(spark, "t_ckpt")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    start_upsert_stream(spark, landing, events.schema, table, keys, order, ckpt, max_files_per_trigger=1).awaitTermination()
    expected = sorted(tuple(r) for r in last_per_key(events, keys, order).collect())
    assert sorted(tuple(r) for r in read_current(spark, table, keys, order).collect()) == expected
    # restart on the same checkpoint: nothing new, nothing changes
    start_upsert_stream(spark, landing, events.schema, table, keys, order, ckpt).awaitTermination()
    assert sorted(tuple(r) for r in read_current(spark, table, keys, order).collect()) == expected


def test_compaction_while_the_stream_goes_on(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    landing = scratch_path(spark, "c_landing")
    table, ckpt = scratch_path(spark, "c_table"), scratch_path(spark, "c_ckpt")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]

    def land(part):
        events.where(F.pmod("event_id", F.lit(4)) == part).coalesce(1).write.mode("append").parquet(landing)
        start_upsert_stream(spark, landing, events.schema, table, keys, order, ckpt).awaitTermination()

    def current():
        return sorted(tuple(r) for r in read_current(spark, table, keys, order).collect())

    def expected(parts):
        some = events.where(F.pmod("event_id", F.lit(4)) < parts)
        return sorted(tuple(r) for r in last_per_key(some, keys, order).collect())

    land(0)
    land(1)
    assert compact(spark, table, keys, order) == 1 and current() == expected(2)
    land(2)  # the stream keeps writing to the same place
    assert current() == expected(3)
    # a batch that is still being written is left for the next compaction
    assert delete_path(spark, f"{table}/batch_id=2/_SUCCESS")
    assert compact(spark, table, keys, order) == 1 and current() == expected(3)
    land(3)
    assert compact(spark, table, keys, order, delete_folded=True) == 3 and path_exists(spark, f"{table}/batch_id=2")
