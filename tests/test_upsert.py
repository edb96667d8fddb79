"""Keyed upserts on hand-written rows (FIXTURES B2 / B7 edge cases)."""

from tallysheet.operators.upsert import (
    apply_changes,
    changed_rows,
    fold_sparse,
    insert_new,
    last_per_key,
    upsert,
)


def rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


TARGET = "k int, name string, price double, extra string"


def test_sparse_fold_takes_last_present_value_per_column(spark):
    batch = spark.createDataFrame(
        [(1, 1, "a", None), (1, 2, None, 10.0), (1, 3, "c", None), (2, 1, None, None)],
        "k int, seq int, name string, price double",
    )
    assert rows(fold_sparse(batch, ["k"], "seq"), ["k"]) == [(1, "c", 10.0), (2, None, None)]


def test_sparse_upsert_keeps_stored_value_of_absent_columns(spark):
    target = spark.createDataFrame([(1, "old", 5.0, "x"), (3, "keep", 1.0, "y")], TARGET)
    batch = spark.createDataFrame([(1, None, 7.0), (2, "new", None)], "k int, name string, price double")
    out = upsert(target, batch, ["k"], sparse=True)
    assert rows(out, ["k"]) == [(1, "old", 7.0, "x"), (2, "new", None, None), (3, "keep", 1.0, "y")]


def test_full_upsert_overwrites_every_batch_column(spark):
    target = spark.createDataFrame([(1, "old", 5.0, "x")], TARGET)
    batch = spark.createDataFrame([(1, None, 7.0)], "k int, name string, price double")
    assert rows(upsert(target, batch, ["k"]), ["k"]) == [(1, None, 7.0, "x")]


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "old", 5.0, "x"), (3, "keep", 1.0, "y")], TARGET)
    batch = spark.createDataFrame([(1, "n1", 7.0), (2, "n2", 2.0)], "k int, name string, price double")
    once = upsert(target, batch, ["k"])
    twice = upsert(once, batch, ["k"])
    assert rows(once, ["k"]) == rows(twice, ["k"])


def test_do_nothing_keeps_existing_and_first_new_row(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "z", 0), (2, "b", 2), (2, "c", 1)], "k int, v string, seq int")
    out = insert_new(target, batch, ["k"], order_by=["seq"])
    assert rows(out.select("k", "v"), ["k"]) == [(1, "a"), (2, "c")]


def test_do_nothing_on_link_rows_is_a_set(spark):
    target = spark.createDataFrame([(1, 10)], "a int, b int")
    batch = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (2, 10)], "a int, b int")
    assert rows(insert_new(target, batch, ["a", "b"]), ["a", "b"]) == [(1, 10), (1, 11), (2, 10)]


def test_change_directed_upsert(spark):
    target = spark.createDataFrame([(1, "one"), (2, "two")], "id int, title string")
    staged = spark.createDataFrame(
        [(1, "ONE", "update"), (3, "three", "insert"), (4, "ghost", "update"), (2, "same", "")],
        "id int, title string, change string",
    )
    out = apply_changes(target, staged, ["id"])
    # the update of id 4 has no target row: nothing happens
    assert rows(out, ["id"]) == [(1, "ONE"), (2, "two"), (3, "three")]


def test_changed_rows_filter(spark):
    staged = spark.createDataFrame([(1, "insert"), (2, "update"), (3, "")], "id int, change string")
    assert rows(changed_rows(staged), ["id"]) == [(1, "insert"), (2, "update")]


def test_last_per_key_with_tiebreak(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00", 5, "a"), (1, "2024-01-02 00:00:00", 1, "b"), (1, "2024-01-02 00:00:00", 3, "c")],
        "k int, ts string, id int, v string",
    )
    assert rows(last_per_key(df, ["k"], ["ts", "id"]), ["k"]) == [(1, "2024-01-02 00:00:00", 3, "c")]


def test_hot_key_fold_keeps_whole_result(spark):
    # one key holds most rows: the aggregate folds it without losing other keys
    data = [(0, i, f"v{i}") for i in range(3000)] + [(k, 0, f"w{k}") for k in range(1, 50)]
    df = spark.createDataFrame(data, "k int, seq int, v string").repartition(8)
    out = dict(rows(last_per_key(df, ["k"], ["seq"]).select("k", "v"), ["k"]))
    assert out[0] == "v2999" and len(out) == 50


def test_merge_into_requires_a_row_level_table(spark):
    import pytest
    from pyspark.errors import AnalysisException, UnsupportedOperationException

    from tallysheet.sinks.merge import merge_into_table

    spark.createDataFrame([(1, "a")], "k int, v string").createOrReplaceTempView("plain_target")
    batch = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    with pytest.raises((AnalysisException, UnsupportedOperationException), match="(?i)merge"):
        merge_into_table(batch, "plain_target", ["k"])
