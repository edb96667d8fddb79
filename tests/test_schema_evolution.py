"""Column planning and applying (FIXTURES B8)."""

import random

import pytest

from tallysheet.operators.schema_evolution import apply_plan, ordered_renames, plan_columns, schema_plan

META = "seq int, uid string, name string, previous_name string, change string"


def plan_rows(df):
    return [(r["action"], r["column_name"], r["anchor"], r["collides"]) for r in df.orderBy("seq").collect()]


def test_update_first_then_two_inserts(spark):
    meta = spark.createDataFrame(
        [
            (1, "u1", "Age Group", "Age", "update"),
            (2, "u2", "Sex", None, "insert"),
            (3, "u3", "Case Type", None, "insert"),
            (4, "u4", "Ignored", None, ""),
        ],
        META,
    )
    assert plan_rows(schema_plan(meta, ["seq"])) == [
        ("RENAME", "AgeGroup", "Age", False),
        ("ADD", "u2", "lastupdated", False),  # no earlier insert: after lastupdated
        ("ADD", "Sex", "u2", False),
        ("ADD", "u3", "Sex", False),
        ("ADD", "CaseType", "u3", False),
    ]


def test_sanitised_name_collision_is_flagged(spark):
    meta = spark.createDataFrame(
        [(1, "u1", "Age Group", None, "insert"), (2, "u2", "AgeGroup", None, "insert")], META
    )
    flags = {(a, c): f for a, c, _, f in plan_rows(schema_plan(meta, ["seq"]))}
    assert flags[("ADD", "AgeGroup")] is True and flags[("ADD", "u1")] is False


def test_plan_columns_is_idempotent():
    base = ["uid", "name", "lastupdated", "x1", "Old"]
    actions = [("ADD", "x1", "lastupdated"), ("ADD", "Sex", "x1"), ("RENAME", "New", "Old"), ("RENAME", "Z", "missing")]
    once = plan_columns(base, actions)
    assert [n for n, _ in once] == ["uid", "name", "lastupdated", "x1", "Sex", "New"]
    twice = plan_columns([n for n, _ in once], actions)
    assert [n for n, _ in twice] == [n for n, _ in once]


def test_apply_plan_fills_new_columns(spark):
    wide = spark.createDataFrame([("a", "A", "2024-01-01", "keep")], "uid string, name string, lastupdated string, Old string")
    meta = spark.createDataFrame([(1, "u1", "New", "Old", "update"), (2, "u2", "Sex", None, "insert")], META)
    out = apply_plan(wide, schema_plan(meta, ["seq"]))
    assert out.columns == ["uid", "name", "lastupdated", "u2", "Sex", "New"]
    assert tuple(out.collect()[0]) == ("a", "A", "2024-01-01", "", "", "keep")


def run(names, statements):
    """The statements one by one on columns that hold their first names; no name may be taken while it is held."""
    columns = {n: n for n in names}
    for old, new in statements:
        if old in columns:
            assert new not in columns
            columns[new] = columns.pop(old)
    return columns


@pytest.mark.parametrize("renames", [
    [("A", "B"), ("B", "A")], [("A", "B"), ("B", "C")], [("B", "C"), ("A", "B")], [("A", "B"), ("B", "C"), ("C", "A")],
    [("A", "B"), ("B", "A"), ("C", "D"), ("D", "E")], [("A", "A"), ("B", "C"), ("C", "B"), ("D", "F")]])
def test_renames_at_the_same_time(renames):
    target = dict(renames)
    names = [n for n in "ABCD" if n in target or n not in target.values()]
    done = run(names, ordered_renames(renames))
    assert done == {target.get(n, n): n for n in names}


def test_random_rename_graphs():
    rng = random.Random(8)
    for _ in range(200):
        names = [f"c{i}" for i in range(9)]
        some = rng.sample(names, rng.randint(0, 9))
        new = rng.sample(some + ["x", "y", "z"], len(some))
        renames = list(zip(some, new))
        rng.shuffle(renames)
        assert run(names, ordered_renames(renames)) == {dict(renames).get(n, n): n for n in names}


def test_swap_chain_and_cycle_in_a_plan(spark):
    wide = spark.createDataFrame([("k", "t", "1", "2", "3", "4")], "uid string, lastupdated string, One string, Two string, Three string, Four string")
    meta = [(1, "a", "Two", "One", "update"), (2, "b", "One", "Two", "update"), (3, "c", "Five", "Three", "update"),
            (4, "d", "Three", "Four", "update"), (5, "e", "Four", None, "insert")]
    out = apply_plan(wide, schema_plan(spark.createDataFrame(meta, META), ["seq"])).first().asDict()
    assert out == {"uid": "k", "lastupdated": "t", "e": "", "Four": "", "Two": "1", "One": "2", "Five": "3", "Three": "4"}
    taken = spark.createDataFrame([(1, "a", "Two", "One", "update")], META)
    with pytest.raises(ValueError, match="cannot be renamed"):  # not skipped and then marked as exported
        apply_plan(wide, schema_plan(taken, ["seq"]))
