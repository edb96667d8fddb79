"""Change tracking on the staged-state fixture (FIXTURES B7)."""

from tallysheet.operators.changes import ChangeSpec, detect_changes, reset_changes

STATE = "uid string, sourceid string, name string, shortname string, previous_name string, change string"
SPEC = ChangeSpec(keys=["uid", "sourceid"], tracked=["name"], previous={"name": "previous_name"})


def current(spark):
    return spark.createDataFrame(
        [
            ("tracked", "s", "Alpha", "a", None, ""),
            ("untracked", "s", "Beta", "b", None, ""),
            ("null_to_value", "s", None, "c", None, ""),
            ("value_to_null", "s", "Delta", "d", None, ""),
            ("pending", "s", "Eps", "e", None, "insert"),
            ("absent", "s", "Zeta", "z", None, "update"),
        ],
        STATE,
    )


def incoming(spark):
    return spark.createDataFrame(
        [
            ("tracked", "s", "Alpha2", "a"),
            ("untracked", "s", "Beta", "b-changed"),
            ("null_to_value", "s", "Gamma", "c"),
            ("value_to_null", "s", None, "d"),
            ("pending", "s", "Eps2", "e"),
            ("new", "s", "Eta", "h"),
        ],
        "uid string, sourceid string, name string, shortname string",
    )


def by_uid(df):
    return {r["uid"]: r.asDict() for r in df.collect()}


def test_trigger_semantics(spark):
    out = by_uid(detect_changes(current(spark), incoming(spark), SPEC))
    assert out["new"]["change"] == "insert" and out["new"]["previous_name"] is None
    assert out["tracked"]["change"] == "update" and out["tracked"]["previous_name"] == "Alpha"
    assert out["tracked"]["name"] == "Alpha2"
    # an untracked column changes silently
    assert out["untracked"]["change"] == "" and out["untracked"]["shortname"] == "b-changed"
    # NULL on either side of <> is not a change
    assert out["null_to_value"]["change"] == "" and out["null_to_value"]["name"] == "Gamma"
    assert out["value_to_null"]["change"] == "" and out["value_to_null"]["name"] is None
    # a row not yet exported stays an insert
    assert out["pending"]["change"] == "insert" and out["pending"]["name"] == "Eps2"
    # a key missing from the batch keeps everything
    assert out["absent"] == {"uid": "absent", "sourceid": "s", "name": "Zeta", "shortname": "z",
                             "previous_name": None, "change": "update"}


def test_null_safe_option_counts_null_transitions(spark):
    spec = ChangeSpec(keys=["uid", "sourceid"], tracked=["name"], previous={"name": "previous_name"}, null_safe=True)
    out = by_uid(detect_changes(current(spark), incoming(spark), spec))
    assert out["null_to_value"]["change"] == "update"
    assert out["value_to_null"]["change"] == "update" and out["value_to_null"]["previous_name"] == "Delta"


def test_reset_after_flush_leaves_nothing_pending(spark):
    staged = detect_changes(current(spark), incoming(spark), SPEC)
    after = reset_changes(staged)
    assert {r["change"] for r in after.collect()} == {""}


def test_reset_only_flushed_keys(spark):
    staged = detect_changes(current(spark), incoming(spark), SPEC)
    flushed = spark.createDataFrame([("tracked", "s")], "uid string, sourceid string")
    out = by_uid(reset_changes(staged, ["uid", "sourceid"], flushed))
    assert out["tracked"]["change"] == "" and out["new"]["change"] == "insert"


def test_version_guard_ignores_older_incoming_rows(spark):
    cur = spark.createDataFrame([("k1", "new", "2024-02-01", ""), ("k2", "old", "2024-01-01", "")],
                                "uid string, name string, lastupdated string, change string")
    inc = spark.createDataFrame([("k1", "stale", "2024-01-15"), ("k2", "fresh", "2024-01-20")],
                                "uid string, name string, lastupdated string")
    spec = ChangeSpec(keys=["uid"], tracked=["name"], version_col="lastupdated")
    out = by_uid(detect_changes(cur, inc, spec))
    assert (out["k1"]["name"], out["k1"]["change"]) == ("new", "")
    assert (out["k2"]["name"], out["k2"]["change"], out["k2"]["lastupdated"]) == ("fresh", "update", "2024-01-20")
