"""Page completeness, report deltas, membership bitmaps and presence on small inputs."""

import dataclasses
import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tallysheet.operators.report import (
    BandSpec,
    apply_report_delta,
    changed_submissions,
    report_delta,
    report_totals,
)
from tallysheet.operators.widen import WORD_BITS, group_count, in_group, membership_flags, membership_words
from tallysheet.plans.flows import read_latest, stage_endpoint, stage_present
from tallysheet.sources.paging import check_complete, landed_pages, page_problems
from tallysheet.sources.variants import BAD_TEXT, discover_schema, read_mixed_forms, variant_items
from tests.test_flows import LEVELS, URL, land


def page(folder, name, number, ids, count=3, total=6, key="xs"):
    land(folder, name, {"pager": {"page": number, "pageCount": count, "total": total}, key: [{"id": i} for i in ids]})


def problems(spark, folder):
    return sorted((r["problem"], r["first"], r["last"], r["found"]) for r in page_problems(landed_pages(spark, folder, "xs")).collect())


def test_pages_missing_repeated_and_overlapping(spark, tmp_dir):
    whole, broken = f"{tmp_dir}/whole", f"{tmp_dir}/broken"
    for n in (1, 2, 3):
        page(whole, f"{n}.json", n, [2 * n, 2 * n + 1])
    assert problems(spark, whole) == []
    check_complete(spark, whole, "xs")
    page(broken, "1.json", 1, ["a", "b"], 9, 18)
    page(broken, "4.json", 4, ["c", "b"], 9, 18)
    page(broken, "4b.json", 4, ["c", "b"], 9, 19)
    os.makedirs(broken, exist_ok=True)
    with open(f"{broken}/cut.json", "w") as f:
        f.write('{"pager":{"page":5},"xs":[{"id"')
    open(f"{broken}/empty.json", "w").close()
    assert problems(spark, broken) == [("missing", 2, 3, 2), ("missing", 5, 9, 5), ("overlap", 1, 4, 1), ("repeated", 4, 4, 2),
                                       ("total", None, 19, 3), ("unreadable", None, None, 1), ("unstable", 18, 19, None)]
    with pytest.raises(ValueError, match="missing 2-3"):
        check_complete(spark, broken, "xs")


def test_a_load_of_an_incomplete_pull_fails_before_it_writes(spark, tmp_dir):
    item = {"id": "L1", "name": "A", "level": 1, "lastUpdated": "2024-01-01T00:00:00"}
    land(f"{tmp_dir}/p", "2.json", {"pager": {"page": 2, "pageCount": 2, "total": 1}, "organisationUnitLevels": [item]})
    with pytest.raises(ValueError, match="not complete"):
        stage_endpoint(spark, f"{tmp_dir}/p", LEVELS, f"{tmp_dir}/store", URL, complete=True)
    assert read_latest(spark, f"{tmp_dir}/store/orgunitlevel") is None
    land(f"{tmp_dir}/p", "1.json", {"pager": {"page": 1, "pageCount": 2, "total": 1}, "organisationUnitLevels": []})
    assert stage_endpoint(spark, f"{tmp_dir}/p", LEVELS, f"{tmp_dir}/store", URL, complete=True) == 0


def test_deltas_equal_a_recount_after_random_edits(spark):
    rng = random.Random(3)
    schema = "id int, interview_date string, health_facility int, participant_age int, participant_gender int, case_control int"
    row = lambda i: (i, rng.choice(["d1", "d2", None]), rng.randint(1, 4), rng.randint(0, 60), rng.randint(0, 2), rng.randint(1, 2))
    old = {i: row(i) for i in range(120)}
    new = {i: row(i) if i % 5 == 0 else r for i, r in old.items() if i % 7}
    new.update({i: row(i) for i in range(200, 220)})
    new = {i: r for i, r in new.items() if not (r[1] == "d2" and r[2] == 4)}  # a group that ends up empty
    before, after = (spark.createDataFrame(list(rows.values()), schema) for rows in (old, new))
    totals, expected = report_totals(before), report_totals(after)
    touched, empty = apply_report_delta(totals, report_delta(*changed_submissions(before, after, "id")))
    keys = ["interview_date", "health_facility"]
    result = totals.join(touched.select(*keys).unionByName(empty), keys, "left_anti").unionByName(touched)
    assert sorted(map(tuple, result.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    assert [tuple(r) for r in empty.collect()] == [("d2", 4)]
    nothing = apply_report_delta(totals, report_delta(*changed_submissions(before, before, "id")))
    assert nothing[0].count() == nothing[1].count() == 0  # untouched groups are not rewritten
    assert len(BandSpec().names()) == 20
    with pytest.raises(Exception, match="lost more submissions"):
        apply_report_delta(totals.where("false"), report_delta(before, before.where("false")))[0].collect()


def test_bitmaps_equal_flags_at_word_edges_and_for_unknown_groups(spark):
    uids = [f"g{i}" for i in range(2 * WORD_BITS + 3)]
    rng = random.Random(1)
    links = [(f"k{k}", u) for k in range(6) for u in rng.sample(uids, 40)] + [("k0", uids[62]), ("k0", uids[63]), ("k0", uids[62]), ("lost", "nope"), ("n", None)]
    df = spark.createDataFrame(links, "key string, g string")
    words = membership_words(df, "key", uids, "g")
    got = {r["key"]: r for r in words.select("key", group_count(words).alias("n"), *[in_group(i).alias(u) for i, u in enumerate(uids)]).collect()}
    for key in got:
        mine = {u for k, u in links if k == key and u in uids}
        assert got[key]["n"] == len(mine) and {u for u in uids if got[key][u]} == mine
    flags = {r["key"]: r.asDict() for r in membership_flags(df, "key", [(u, u.upper() + " name") for u in uids], "g").collect()}
    assert flags.keys() == got.keys() == {*(f"k{k}" for k in range(6)), "lost", "n"}
    assert all((flags[k][u] == "t") == bool(got[k][u]) == (flags[k][u.upper() + "name"] == "t") for k in got for u in uids)
    plan = words._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1


FREE = dataclasses.replace(LEVELS, required=())

DOCS = [
    {"id": "L1", "name": "A", "code": "c", "level": 1, "created": "2024-01-01T00:00:00", "lastUpdated": "2024-01-01T00:00:00"},
    {"id": "L1", "code": None, "lastUpdated": "2024-01-02T00:00:00"},
    {"id": "L1", "name": None, "level": 2, "lastUpdated": "2024-01-03T00:00:00"},
    {"id": "L1", "name": "B", "lastUpdated": "2024-01-03T00:00:00"},  # as old as the one before: the later one counts
]


@pytest.mark.parametrize("cuts", [(), (1,), (1, 2), (1, 2, 3), (3,)])
def test_present_nulls_overwrite_and_absent_keys_keep_however_batches_are_cut(spark, tmp_dir, cuts):
    edges = [0, *cuts, len(DOCS)]
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        land(f"{tmp_dir}/b{i}", "p.json", DOCS[lo:hi])
        stage_present(spark, f"{tmp_dir}/b{i}", FREE, f"{tmp_dir}/store", URL)
    rows = [(r["name"], r["code"], r["level"], r["lastupdated"], r["present"]) for r in read_latest(spark, f"{tmp_dir}/store/orgunitlevel").collect()]
    assert rows == [("B", None, 2, dt.datetime(2024, 1, 3), 63)]


def test_late_documents_fill_what_none_has_given_and_null_is_a_change(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    first = {"id": "L1", "name": "A", "level": 1, "created": "2024-01-05T00:00:00", "lastUpdated": "2024-01-05T00:00:00"}
    steps = [first, {"id": "L1", "name": "old", "code": "late", "lastUpdated": "2024-01-02T00:00:00"},
             {"id": "L1", "code": "later still", "lastUpdated": "2024-01-01T00:00:00"}]
    for i, doc in enumerate(steps):
        land(f"{tmp_dir}/s{i}", "p.json", [doc])
        stage_present(spark, f"{tmp_dir}/s{i}", FREE, store, URL)
    row = read_latest(spark, f"{store}/orgunitlevel").first()
    assert (row["name"], row["code"], row["change"]) == ("A", "late", "insert")
    from tallysheet.operators.changes import reset_changes
    from tallysheet.sinks.versioned import commit
    commit(reset_changes(read_latest(spark, f"{store}/orgunitlevel")), f"{store}/orgunitlevel")
    land(f"{tmp_dir}/s9", "p.json", [{"id": "L1", "name": None, "lastUpdated": "2024-01-09T00:00:00"}, {"id": "L1", "level": "x"}, {"name": "?"}])
    for _ in range(2):
        stage_present(spark, f"{tmp_dir}/s9", FREE, store, URL)
    row = read_latest(spark, f"{store}/orgunitlevel").first()
    assert (row["name"], row["previous_name"], row["change"]) == (None, "A", "update")
    reasons = sorted(r["reason"] for r in spark.read.parquet(f"{store}/orgunitlevel_rejects").collect())
    assert reasons == ["malformed level: x", "missing uid"]


@pytest.mark.parametrize("cuts", [(), (1, 2), (2,)])
def test_null_for_a_required_column_is_refused_however_batches_are_cut(spark, tmp_dir, cuts):
    edges = [0, *cuts, 3]
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        land(f"{tmp_dir}/b{i}", "p.json", DOCS[:3][lo:hi])
        stage_present(spark, f"{tmp_dir}/b{i}", LEVELS, f"{tmp_dir}/store", URL)
    assert [(r["name"], r["code"], r["level"]) for r in read_latest(spark, f"{tmp_dir}/store/orgunitlevel").collect()] == [("A", None, 1)]
    assert [r["reason"] for r in spark.read.parquet(f"{tmp_dir}/store/orgunitlevel_rejects").collect()] == ["null for required name"]


def test_undeclared_forms_lose_no_field(spark, tmp_dir):
    land(f"{tmp_dir}/f", "a.json", {"value": [{"s": {"a": 1, "VOID": "v"}, "k": 1, "Note": "n", "d.o t": True}, {"s": {"a": 2.5}, "k": 2, "empty": {}}]})
    land(f"{tmp_dir}/g", "a.json", {"value": [{"s": {"a": 1, "c": [1, None]}, "k": "three", "note": None, "mix": [1]}, {"mix": {"x": 1}}, {}]})
    land(f"{tmp_dir}/h", "a.json", {"value": []})
    rows, report = read_mixed_forms(spark, {n.upper(): f"{tmp_dir}/{n}" for n in "fgh"}, "value")
    got = [r.asDict(recursive=True) for r in rows.collect()]
    assert [(r["SOURCE_FORM"], r["k"], r["Note"], r["d.o t"]) for r in got] == [
        ("F", "1", "n", True), ("F", "2", None, None), ("G", "three", None, None), ("G", None, None, None), ("G", None, None, None)]
    assert got[0]["s"]["VOID"] == "v" and float(got[1]["s"]["a"]) == 2.5 and got[2]["s"]["c"] == [1, None]
    assert [r["mix"] for r in got[2:4]] == ["[1]", '{"x":1}']
    conflicts = {r["field"]: (r["forms"], r["conflict"]) for r in report.collect()}
    assert conflicts == {"Note": ("F,G", False), "d.o t": ("F", False), "empty": ("F", False), "k": ("F,G", True), "mix": ("G", True), "s": ("F,G", False)}


def test_variant_items_list_bad_documents(spark, tmp_dir):
    texts = {"a.json": '[{"id":1}] x', "b.json": '[{"id":1}][2]', "c.json": "[1]", "d.json": '{"xs":[{"id":2},null]}', "e.json": " ",
             "f.json": "{}", "g.json": '{"other":[]}', "h.json": '{"xs":[{"a":1,"a":2}]}', "i.json": '[{"id":3}],"--end of document--"'}
    for name, text in texts.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    rows = variant_items(spark, tmp_dir, "xs", on_bad="skip")
    bad = {os.path.basename(r["_file"]) for r in rows.where(F.col(BAD_TEXT).isNotNull()).collect()}
    assert bad == {"a.json", "b.json", "c.json", "g.json", "h.json", "i.json"}
    good = rows.where(F.col(BAD_TEXT).isNull()).select("_position", F.to_json("_item").alias("i")).collect()
    assert sorted((r["_position"], r["i"]) for r in good) == [(0, '{"id":2}'), (1, None)] or [json.loads(r["i"] or "null") for r in good]
    with pytest.raises(Exception, match="bad document"):
        variant_items(spark, tmp_dir, "xs").collect()
    assert discover_schema(rows.where("false").withColumn("form", F.lit("f")), "form") == []
