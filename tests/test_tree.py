"""Parent pointers, closures and subtrees under renamed units."""

import random

import pytest
from pyspark.sql import functions as F

from tallysheet.operators import tree
from tallysheet.operators.tree import ancestor_closure, inner_path, new_closure_rows, path_mismatches, paths_from_parents, with_descendants
from tallysheet.plans.flows import export_orgunits, stage_endpoint
from tallysheet.sinks.versioned import read_latest
from tests.test_flows import LEVELS, UNITS, URL, land, unit


def brute(parents):
    out = {}
    for uid in parents:
        path, seen, at, status = [uid], {uid}, parents[uid], "ok"
        while at:
            if at in seen:
                status, path = "cycle", None
                break
            path.insert(0, at)
            seen.add(at)
            if at not in parents:
                status = "orphan"
                break
            at = parents[at]
        out[uid] = (None if path is None else "/" + "/".join(path), None if path is None else len(path), status)
    return out


def paths(df, **kw):
    return {r["uid"]: (r["path"], r["level"], r["status"]) for r in paths_from_parents(df, **kw).collect()}


def test_random_pointers_with_cycles_and_orphans(spark):
    rng = random.Random(4)
    parents = {f"u{i}": rng.choice([None, "", " ", "gone", *[f"u{rng.randrange(60)}" for _ in range(12)]]) for i in range(60)}
    df = spark.createDataFrame([(k, v) for k, v in parents.items()], "uid string, parentid string")
    assert paths(df) == brute({k: (v or "").strip() or None for k, v in parents.items()})


def test_chain_self_parent_repeated_and_empty(spark):
    chain = {f"c{i}": f"c{i - 1}" if i else None for i in range(70)}
    df = spark.createDataFrame([*chain.items(), ("s", "s"), ("c5", None), (None, "c0")], "uid string, parentid string")
    assert paths(df) == brute({**chain, "s": "s"})
    deep = paths(df, max_depth=16)
    assert deep["c15"][2] == "ok" and deep["c69"] == (None, None, "cycle")
    assert paths_from_parents(df.where("false")).count() == 0


def test_sources_do_not_mix_and_paths_are_compared(spark):
    rows = [("a", None, "A", "/a"), ("b", "a", "A", "/a/b"), ("b", "x", "B", "/x/b"), ("x", None, "B", "/wrong")]
    df = spark.createDataFrame(rows, "uid string, parentid string, sourceid string, path string")
    found = path_mismatches(df, paths_from_parents(df, source="sourceid"), source="sourceid")
    assert [tuple(r) for r in found.collect()] == [("B", "x", "/wrong", "/x", "ok")]


def test_closure_grows_by_new_paths_only(spark):
    df = spark.createDataFrame([("a", "/a"), ("b", "/a/b"), ("c", "/a/b/c"), ("ab", "/a/b/c/ab"), ("n", None), ("q", "/a//q")],
                               "uid string, path string")
    assert {r[0] for r in df.select(inner_path()).collect()} == {"", "/a", "/a/b", "/a/b/c", "/a/"}
    closure = ancestor_closure(df)
    assert {(r["ancestor"], r["inner"]) for r in closure.collect()} == {
        ("a", "/a"), ("a", "/a/b"), ("b", "/a/b"), ("a", "/a/b/c"), ("b", "/a/b/c"), ("c", "/a/b/c"), ("a", "/a/")}
    more = spark.createDataFrame([("d", "/a/b/d"), ("e", "/a/z/e")], "uid string, path string")
    assert {(r["ancestor"], r["inner"]) for r in new_closure_rows(closure, more).collect()} == {("a", "/a/z"), ("z", "/a/z")}
    below = lambda *ids: {r["uid"] for r in with_descendants(df, df.where(F.col("uid").isin(*ids)), closure).collect()}
    assert below("b") == {"b", "c", "ab"} and below("ab") == {"ab"} and below("a") == {"a", "b", "c", "ab", "q"} and below("zz") == set()
    assert below("a", "b", "n") == {"a", "b", "c", "ab", "q", "n"}


def test_a_renamed_root_reaches_all_below_and_no_others(spark, tmp_dir):
    store, warehouse, later = f"{tmp_dir}/store", f"{tmp_dir}/warehouse", "2024-02-01T00:00:00"
    land(f"{tmp_dir}/levels", "p.json", [{"id": f"L{n}", "name": f"Level {n}", "level": n, "lastUpdated": "2024-01-01T00:00:00"} for n in (1, 2, 3)])
    land(f"{tmp_dir}/r1", "p.json", [unit("A", "Land", "/A"), unit("B", "Part", "/A/B", "A"), unit("C", "Spot", "/A/B/C", "B"), unit("Z", "Else", "/Z")])
    stage_endpoint(spark, f"{tmp_dir}/levels", LEVELS, store, URL)
    stage_endpoint(spark, f"{tmp_dir}/r1", UNITS, store, URL)
    export_orgunits(spark, store, warehouse)
    land(f"{tmp_dir}/r2", "p.json", [unit("A", "Land 2", "/A", ts=later), unit("D", "New", "/A/B/C/D", "C", ts=later)])
    stage_endpoint(spark, f"{tmp_dir}/r2", UNITS, store, URL)
    seen = []
    original = tree.with_descendants

    def spy(*args, **kw):
        out = original(*args, **kw)
        seen.extend(r["uid"] for r in out.collect())
        return out

    from tallysheet.plans import flows
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(flows, "with_descendants", spy)
        export_orgunits(spark, store, warehouse)
    assert sorted(seen) == ["A", "B", "C", "D"]
    got = {r["uid"]: (r["Level1"], r["Level2"], r["Level3"]) for r in read_latest(spark, f"{warehouse}/organisationunit").collect()}
    assert got == {"A": ("Land 2", "", ""), "B": ("Land 2", "Part", ""), "C": ("Land 2", "Part", "Spot"), "D": ("Land 2", "Part", "Spot"),
                   "Z": ("Else", "", "")}
    closure = spark.read.parquet(f"{store}/organisationunit_closure")
    assert closure.count() == closure.distinct().count() == 6
