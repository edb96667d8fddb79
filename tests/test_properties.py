"""Property checks against brute-force Python models."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from tallysheet.operators.upsert import fold_sparse, upsert
from tallysheet.plans.report_queries import CONFIG, SPEC, facility_units, submissions
from tallysheet.operators.report import band_report_wide
from tallysheet.sinks.payload import payload_chunks
from tallysheet.sources.tables import Tables
from tests.conftest import SF_SMALL

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

cell = st.one_of(st.none(), st.integers(min_value=0, max_value=5))
batch_rows = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50), cell, cell), max_size=25,
                      unique_by=lambda r: (r[0], r[1]))
target_rows = st.lists(st.tuples(st.integers(0, 6), cell, cell), max_size=8, unique_by=lambda r: r[0])


def model_fold(rows):
    out = {}
    for k, seq, a, b in sorted(rows, key=lambda r: (r[0], r[1])):
        cur = out.setdefault(k, [None, None])
        if a is not None:
            cur[0] = a
        if b is not None:
            cur[1] = b
    return out


@SETTINGS
@given(target=target_rows, batch=batch_rows)
def test_sparse_upsert_matches_model_and_is_idempotent(spark, target, batch):
    t = spark.createDataFrame(target, "k int, a int, b int")
    b = spark.createDataFrame(batch, "k int, seq int, a int, b int")
    folded = fold_sparse(b, ["k"], "seq")
    once = upsert(t, folded, ["k"], sparse=True)
    expected = {k: [a, bb] for k, a, bb in target}
    for k, (a, bb) in model_fold(batch).items():
        cur = expected.setdefault(k, [None, None])
        cur[0] = a if a is not None else cur[0]
        cur[1] = bb if bb is not None else cur[1]
    got = {r["k"]: [r["a"], r["b"]] for r in once.collect()}
    assert got == expected
    twice = upsert(once, folded, ["k"], sparse=True)
    assert {r["k"]: [r["a"], r["b"]] for r in twice.collect()} == got


@SETTINGS
@given(keys=st.lists(st.integers(0, 10_000), min_size=1, max_size=200, unique=True), size=st.integers(1, 40))
def test_chunks_partition_the_input(spark, keys, size):
    df = spark.createDataFrame([(k % 3, k) for k in keys], "p int, key long")
    chunks = sorted(payload_chunks(df, ["p", "key"], ["key"], size=size).collect(), key=lambda r: r["chunk"])
    assert all(r["n"] == size for r in chunks[:-1]) and 0 < chunks[-1]["n"] <= size
    seen = [v["key"] for r in chunks for v in json.loads(r["payload"])["dataValues"]]
    assert seen == sorted(keys, key=lambda k: (k % 3, k))


def test_report_rows_equal_groups_times_pairs(spark):
    t = Tables(spark, SF_SMALL)
    report = E.queries()["form_report"](spark, SF_SMALL)
    located = band_report_wide(submissions(t), ("interview_date", "health_facility"), SPEC).join(
        facility_units(t), "health_facility")
    assert report.count() == located.count() * len(CONFIG.entries())
    # every configured pair appears once per group
    per_group = report.groupBy("period", "orgUnit").agg(F.count(F.lit(1)).alias("n")).select("n").distinct().collect()
    assert [r["n"] for r in per_group] == [len(CONFIG.entries())]
