"""Staging and warehouse loads: rejects, batch splits, two sources, evolution, versions."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tallysheet.functions.casts import parse_timestamp
from tallysheet.functions.keys import composite_key
from tallysheet.operators.changes import detect_changes, ChangeSpec
from tallysheet.operators.hierarchy import flatten_hierarchy
from tallysheet.operators.mapping import apply_mapping, read_schema
from tallysheet.operators.report import ReportConfig, fill_cast, form_report
from tallysheet.operators.widen import membership_flags, pivot_options
from tallysheet.plans.endpoints import DATA_VALUE_SPEC, DATA_VALUES, ENDPOINTS
from tallysheet.plans.flows import (
    _staged_schema,
    category_dimension,
    dataelement_dimension,
    data_source_rows,
    export_categories,
    export_data_sources,
    export_dataelements,
    export_orgunits,
    load_data_values,
    read_data_values,
    stage_endpoint,
    stage_rows,
)
from tallysheet.session import bounded_rows
from tallysheet.sinks.eav import to_eav
from tallysheet.sinks.partitioned_upsert import touched_rows
from tallysheet.sinks.versioned import commit, latest_version, read_latest, vacuum
from tests.test_flows import LEVELS, UNITS, URL, land, unit

VALUE = {"dataElement": "de1", "period": "2024", "orgUnit": "U1", "categoryOptionCombo": "c", "attributeOptionCombo": "a"}


def mapped_values(spark, docs):
    schema = read_schema(DATA_VALUE_SPEC)
    rows = [{f: d.get(f) for f in schema.fieldNames()} for d in docs]
    return apply_mapping(spark.createDataFrame(rows, schema), DATA_VALUE_SPEC, URL)


def test_every_split_of_a_load_gives_the_same_table(spark):
    docs = [{**VALUE, "lastUpdated": f"2024-01-0{i}T00:00:00.000", **extra} for i, extra in enumerate(
        [{"value": "5", "storedBy": "u"}, {"value": "6"}, {"storedBy": "w", "followup": "true"}, {"value": "8"}], 1)]
    empty = spark.createDataFrame([], _staged_schema(mapped_values(spark, []), DATA_VALUES))
    results = set()
    for cuts in itertools.chain.from_iterable(itertools.combinations(range(1, 4), k) for k in range(4)):
        table, edges = empty, [0, *cuts, 4]
        for lo, hi in zip(edges, edges[1:]):
            table = stage_rows(table, mapped_values(spark, docs[lo:hi]), DATA_VALUES)
        results.add(tuple(table.select("value", "storedby", "followup", "lastupdated").first()))
    assert results == {("8", "w", True, dt.datetime(2024, 1, 4))}


def test_missing_times_and_keys_are_kept_aside_and_reloads_add_nothing(spark, tmp_dir):
    store, landed = f"{tmp_dir}/store", f"{tmp_dir}/landed"
    land(landed, "U1.json", [  # a bare list, stamps without milliseconds
        {**VALUE, "dataElement": "de1", "value": "1", "lastUpdated": "2024-03-04T10:11:12+0000"},
        {**VALUE, "dataElement": "de2", "value": "2"},
        {**VALUE, "dataElement": None, "value": "3", "lastUpdated": "2024-03-04T10:11:12.000"}])
    for _ in range(3):
        load_data_values(spark, landed, store, URL, "2018-01-01 00:00:00")
    assert [(r["dataelementid"], r["value"]) for r in read_data_values(spark, store).collect()] == [("de1", "1")]
    rejects = spark.read.parquet(f"{store}/datavalue_rejects").collect()  # each once, in three loads
    assert sorted(r["reason"] for r in rejects) == ["missing dataelementid", "missing lastupdated"]
    assert any("de2" in r["row"] for r in rejects)


@pytest.mark.parametrize("split", [1, 2, 3])
def test_ties_of_time_follow_the_order_of_files_however_batches_are_cut(spark, tmp_dir, split):
    same = "2024-01-01T00:00:00.000"
    store = f"{tmp_dir}/store"
    pages = [[{"id": "L1", "name": n, "level": 1, "code": c, "lastUpdated": same} for n, c in items]
             for items in ([("v0", "a"), ("v1", None)], [("v2", "b")], [("v3", None)])]
    for i, page in enumerate(pages):
        land(f"{tmp_dir}/b{i * split // 3}", f"p{i}.json", page)
    for b in sorted({i * split // 3 for i in range(3)}):
        stage_endpoint(spark, f"{tmp_dir}/b{b}", LEVELS, store, URL)
    row = read_latest(spark, f"{store}/orgunitlevel").first()
    assert (row["name"], row["code"], row["change"]) == ("v3", "b", "insert")


def test_malformed_cells_and_incomplete_new_rows_are_listed_once(spark, tmp_dir):
    store, ts = f"{tmp_dir}/store", "2024-01-01T00:00:00.000"
    land(f"{tmp_dir}/r1", "p.json", [
        {"id": "L1", "name": "A", "level": "seven", "lastUpdated": ts}, {"id": "L2", "name": "B", "level": 2, "lastUpdated": ts},
        {"id": "L3", "name": "C", "level": " ", "lastUpdated": ts}, {"id": "L4", "level": 4, "lastUpdated": "soon"}])
    land(f"{tmp_dir}/r2", "p.json", [{"id": "L2", "lastUpdated": "2024-01-02T00:00:00.000", "level": 5}])
    for run in ("r1", "r1", "r2"):  # a partial document of a stored row is fine
        stage_endpoint(spark, f"{tmp_dir}/{run}", LEVELS, store, URL)
    assert [(r["uid"], r["name"], r["level"]) for r in read_latest(spark, f"{store}/orgunitlevel").collect()] == [("L2", "B", 5)]
    reasons = sorted(r["reason"] for r in spark.read.parquet(f"{store}/orgunitlevel_rejects").collect())
    assert reasons == ["malformed created: soon, lastupdated: soon", "malformed level: seven", "missing level"]


def test_endpoint_rejects_and_reload(spark, tmp_dir):
    store, landed = f"{tmp_dir}/store", f"{tmp_dir}/landed"
    land(landed, "p1.json", [{"id": "L1", "name": "A", "level": 1, "lastUpdated": "2024-01-01T00:00:00.000"},
                             {"name": "no id", "level": 2, "lastUpdated": "2024-01-01T00:00:00.000"}])
    with open(f"{landed}/p2.json", "w") as f:
        f.write('{"organisationUnitLevels": [{"id": "L2", "na')
    with pytest.raises(Exception, match="bad document"):
        stage_endpoint(spark, landed, LEVELS, store, URL)
    assert latest_version(spark, f"{store}/orgunitlevel") is None  # a failed load leaves nothing behind
    for _ in range(2):
        stage_endpoint(spark, landed, LEVELS, store, URL, on_bad="skip")
    assert [r["uid"] for r in read_latest(spark, f"{store}/orgunitlevel").collect()] == ["L1"]
    reasons = sorted(r["reason"] for r in spark.read.parquet(f"{store}/orgunitlevel_rejects").collect())
    assert reasons == ["missing uid", "unreadable document"]


def test_new_mapped_columns_are_added(spark):
    current = spark.createDataFrame([(1, "a", "")], "k int, name string, change string")
    incoming = spark.createDataFrame([(1, "b", "C1"), (2, "c", "C2"), (None, "x", "C3")], "k int, name string, code string")
    out = detect_changes(current, incoming, ChangeSpec(["k"], ["name"]))
    assert sorted(tuple(r) for r in out.collect()) == [(1, "b", "update", "C1"), (2, "c", "insert", "C2")]


def test_late_documents_fill_blanks_only(spark):
    current = spark.createDataFrame([(1, None, "new", 5, "")], "k int, a string, b string, v int, change string")
    late = spark.createDataFrame([(1, "late", "old", 3)], "k int, a string, b string, v int")
    spec = ChangeSpec(["k"], ["a", "b"], version_col="v")
    assert tuple(detect_changes(current, late, spec, sparse=True).first())[:4] == (1, "late", "new", 5)


def test_two_sources_with_equal_uids_never_mix(spark):
    s = "uid string, name string, sourceid string, change string"
    combos = spark.createDataFrame([("k", "K of A", "A", "insert"), ("k", "K of B", "B", "insert")], s)
    options = spark.createDataFrame([("o", "O of A", "A", "insert"), ("o", "O of B", "B", "insert")], s)
    categories = spark.createDataFrame([("g", "G 1", "A", "insert"), ("g", "G 1", "B", "insert"), ("h", "G1", "A", "insert")], s)
    links = spark.createDataFrame([("k", "o", "A"), ("k", "o", "B")],
                                  "category_option_combo_id string, category_option_id string, sourceid string")
    cats = spark.createDataFrame([("g", "o", "A"), ("g", "o", "B")], "category_id string, categoryoption_id string, sourceid string")
    wide = category_dimension(combos, links, options, cats, categories, "2024-01-01 00:00:00", changed_only=None)
    got = sorted((r["sourceid"], r["categoryoptioncomboname"], r["g"], r["G1"]) for r in wide.collect())
    assert got == [("A", "K of A", "o", "O of A"), ("B", "K of B", "o", "O of B")]  # "G 1" and "G1" share a column

    elements = spark.createDataFrame([("e", "E", "A"), ("e", "E", "B"), ("f", "F", "B")], "uid string, name string, sourceid string")
    members = spark.createDataFrame([("e", "g", "A"), ("f", "h", "B")], "dataelement_id string, group_id string, sourceid string")
    flags = dataelement_dimension(elements, members, categories.select("uid", "name", "sourceid"), "2024-01-01 00:00:00")
    assert sorted((r["uid"], r["sourceid"], r["g"], r["h"], r["G1"]) for r in flags.collect()) == [
        ("e", "A", "t", "", "t"), ("f", "B", "", "t", "t")]

    units = spark.createDataFrame([("r", "Root A", "/r", "A"), ("r", "Root B", "/r", "B"), ("x", "X", "/r/x", "A"),
                                   ("x", "X", "/r/y/x", "A"), ("x", "X", "/r/x", "B"), ("n", "N", None, "A")],
                                  "uid string, name string, path string, sourceid string")
    flat = flatten_hierarchy(units, [("L1", "One"), ("L2", "Two")], keep=["sourceid"], source="sourceid")
    got = sorted((r["uid"], r["sourceid"], r["level"], r["One"], r["L2"], r["Two"]) for r in flat.collect())
    assert got == [("n", "A", 0, "", "", ""), ("r", "A", 1, "Root A", "", ""), ("r", "B", 1, "Root B", "", ""),
                   ("x", "A", 2, "Root A", "x", "X"), ("x", "A", 3, "Root A", "y", ""), ("x", "B", 2, "Root B", "x", "X")]
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_pivots_survive_name_collisions(spark):
    links = spark.createDataFrame([("k", "a", "o1", "One", 1), ("k", "b", "o2", "Two", 2)],
                                  "key string, cat string, opt string, name string, ord int")
    row = pivot_options(links, "key", [("a", "G 1"), ("b", "G1")], "cat", "opt", "name", "ord").first()
    assert row.asDict() == {"key": "k", "a": "o1", "G1": "Two", "b": "o2"}  # the later name wins
    flags = membership_flags(links, "key", [("a", "G 1"), ("z", "G1")], "cat").first()
    assert flags.asDict() == {"key": "k", "a": "t", "G1": "t", "z": ""}
    cased = membership_flags(links, "key", [("a", "Both"), ("b", "BOTH"), ("z", "A")], "cat").first()
    assert cased.asDict() == {"key": "k", "a": "t", "Both": "t", "b": "t", "z": ""}


def test_null_partitions_survive_a_merge(spark):
    schema = "id string, period string, zone string"
    current = spark.createDataFrame([("a", None, "z"), ("b", "p1", "z"), ("c", "p2", None), ("d", None, None)], schema)
    batch = spark.createDataFrame([("n", None, "z"), ("n", "p2", None)], schema)
    assert sorted(r["id"] for r in touched_rows(current, batch, ["period"]).collect()) == ["a", "c", "d"]
    assert sorted(r["id"] for r in touched_rows(current, batch, ["period", "zone"]).collect()) == ["a", "c"]
    with pytest.raises(ValueError):
        touched_rows(current, batch, ["period"], max_partitions=1)


def test_warehouse_load_over_two_runs(spark, tmp_dir):
    store, warehouse = f"{tmp_dir}/store", f"{tmp_dir}/warehouse"
    level = lambda uid, name, n, ts="2024-01-01T00:00:00": {"id": uid, "name": name, "level": n, "lastUpdated": ts}
    land(f"{tmp_dir}/r1/levels", "p.json", [level("L1", "Country", 1)])
    land(f"{tmp_dir}/r1/units", "p.json", [unit("A", "Land", "/A"), unit("C", "Other", "/C")])
    stage_endpoint(spark, f"{tmp_dir}/r1/levels", LEVELS, store, URL)
    stage_endpoint(spark, f"{tmp_dir}/r1/units", UNITS, store, URL)
    assert export_orgunits(spark, store, warehouse) == 0
    assert export_orgunits(spark, store, warehouse) is None  # everything was reset
    first = read_latest(spark, f"{warehouse}/organisationunit")
    assert first.columns == ["uid", "name", "sourceid", "lastupdated", "level", "L1", "Country"]

    later = "2024-02-01T00:00:00"
    land(f"{tmp_dir}/r2/levels", "p.json", [level("L1", "Nation", 1, later), level("L2", "District", 2, later)])
    land(f"{tmp_dir}/r2/units", "p.json", [unit("A", "Land", "/A"), unit("B", "Part", "/A/B", "A", later)])
    stage_endpoint(spark, f"{tmp_dir}/r2/levels", LEVELS, store, URL)
    stage_endpoint(spark, f"{tmp_dir}/r2/units", UNITS, store, URL)
    assert export_orgunits(spark, store, warehouse) == 1
    table = read_latest(spark, f"{warehouse}/organisationunit")
    assert set(table.columns) == {"uid", "name", "sourceid", "lastupdated", "level", "L1", "Nation", "L2", "District"}
    got = {r["uid"]: (r["name"], r["L1"], r["Nation"], r["L2"], r["District"]) for r in table.collect()}
    assert got == {"A": ("Land", "A", "Land", "", ""), "C": ("Other", "C", "Other", "", ""), "B": ("Part", "A", "Land", "B", "Part")}
    staged = read_latest(spark, f"{store}/organisationunit")
    assert {r["change"] for r in staged.collect()} == {""}
    assert vacuum(spark, f"{store}/organisationunit", keep=1) and read_latest(spark, f"{store}/organisationunit").count() == 3


def test_category_and_element_loads_over_two_runs(spark, tmp_dir):
    store, warehouse = f"{tmp_dir}/store", f"{tmp_dir}/warehouse"
    as_of = "2024-01-01 00:00:00"

    def stage(table, rows, columns, keys=("uid", "sourceid"), previous=False):
        df = spark.createDataFrame([(*r, "A") for r in rows], ", ".join(f"{c} string" for c in (*columns, "sourceid")))
        if "change" not in columns and "uid" in columns:
            df = df.withColumn("change", F.lit("insert"))
        if previous:
            df = df.withColumn("previous_name", F.lit(None).cast("string"))
        commit(df, f"{store}/{table}")

    stage("categoryoptioncombo", [("k1", "Young male"), ("k2", "Old male")], ["uid", "name"])
    stage("categoryoptioncombo_categoryoptions", [("k1", "y"), ("k1", "m"), ("k2", "o"), ("k2", "m")],
          ["category_option_combo_id", "category_option_id"])
    stage("dataelementcategoryoption", [("y", "Young"), ("o", "Old"), ("m", "Male")], ["uid", "name"])
    stage("dataelementcategory_categoryoption", [("age", "y"), ("age", "o"), ("sex", "m")], ["category_id", "categoryoption_id"])
    stage("dataelementcategory", [("age", "Age Band"), ("sex", "Gender")], ["uid", "name"], previous=True)
    assert export_categories(spark, store, warehouse, as_of) == 0
    assert export_categories(spark, store, warehouse, as_of) is None
    table = read_latest(spark, f"{warehouse}/category")
    got = {r["categoryoptioncomboid"]: (r["age"], r["AgeBand"], r["sex"], r["Gender"]) for r in table.collect()}
    assert got == {"k1": ("y", "Young", "m", "Male"), "k2": ("o", "Old", "m", "Male")}

    # an option is renamed: only its combos are exported, whole; then a category is: its column is renamed
    options = read_latest(spark, f"{store}/dataelementcategoryoption")
    y = F.col("uid") == "y"
    commit(options.withColumn("name", F.when(y, "Child").otherwise(F.col("name"))).withColumn(
        "change", F.when(y, "update").otherwise(F.col("change"))), f"{store}/dataelementcategoryoption")
    assert export_categories(spark, store, warehouse, as_of) == 1
    table = read_latest(spark, f"{warehouse}/category")
    got = {r["categoryoptioncomboid"]: (r["age"], r["AgeBand"], r["sex"], r["Gender"]) for r in table.collect()}
    assert got == {"k1": ("y", "Child", "m", "Male"), "k2": ("o", "Old", "m", "Male")}
    # a new link alone: from an option to a combo, then from a category to an option
    def add_link(name, *ids):
        links = read_latest(spark, f"{store}/{name}")
        commit(links.unionByName(spark.createDataFrame([(*ids, "A", "insert")], links.schema)), f"{store}/{name}")
    add_link("categoryoptioncombo_categoryoptions", "k2", "x")
    options = read_latest(spark, f"{store}/dataelementcategoryoption")
    commit(options.unionByName(spark.createDataFrame([("x", "Extra", "A", "")], options.schema)), f"{store}/dataelementcategoryoption")
    assert export_categories(spark, store, warehouse, as_of) == 2
    add_link("dataelementcategory_categoryoption", "sex", "x")
    assert export_categories(spark, store, warehouse, as_of) == 3
    assert export_categories(spark, store, warehouse, as_of) is None
    table = read_latest(spark, f"{warehouse}/category")
    got = {r["categoryoptioncomboid"]: (r["age"], r["AgeBand"], r["sex"], r["Gender"]) for r in table.collect()}
    assert got == {"k1": ("y", "Child", "m", "Male"), "k2": ("o", "Old", "x", "Extra")}
    categories = read_latest(spark, f"{store}/dataelementcategory")
    age = F.col("uid") == "age"
    commit(categories.withColumn("previous_name", F.when(age, F.col("name"))).withColumn(
        "name", F.when(age, "Years").otherwise(F.col("name"))).withColumn(
        "change", F.when(age, "update").otherwise(F.col("change"))), f"{store}/dataelementcategory")
    assert export_categories(spark, store, warehouse, as_of) == 4
    table = read_latest(spark, f"{warehouse}/category")
    assert "AgeBand" not in table.columns
    assert {r["categoryoptioncomboid"]: r["Years"] for r in table.collect()} == {"k1": "Child", "k2": "Old"}

    stage("dataelement", [("e1", "Element"), ("e2", "Other")], ["uid", "name"])
    stage("dataelement_dataelementgroup", [("e1", "g")], ["dataelement_id", "group_id"])
    stage("dataelementgroup", [("g", "Group One")], ["uid", "name"], previous=True)
    assert export_dataelements(spark, store, warehouse, as_of) == 0
    assert export_dataelements(spark, store, warehouse, as_of) is None
    assert [(r["uid"], r["GroupOne"]) for r in read_latest(spark, f"{warehouse}/dataelement").collect()] == [("e1", "t")]

    add_link("dataelement_dataelementgroup", "e2", "g")  # only a link is new
    assert export_dataelements(spark, store, warehouse, as_of) == 1
    assert export_dataelements(spark, store, warehouse, as_of) is None
    flags = {r["uid"]: r["GroupOne"] for r in read_latest(spark, f"{warehouse}/dataelement").collect()}
    assert flags == {"e1": "t", "e2": "t"}

    commit(data_source_rows(spark, None, URL, "Source"), f"{store}/data_source")
    assert export_data_sources(spark, store, warehouse) == 0 and export_data_sources(spark, store, warehouse) is None
    assert [r["title"] for r in read_latest(spark, f"{warehouse}/data_source").collect()] == ["Source"]


def test_read_latest_adds_columns_of_the_schema(spark, tmp_dir):
    commit(spark.createDataFrame([(1,)], "k int"), f"{tmp_dir}/t")
    wanted = spark.createDataFrame([], "k int, code string").schema
    assert [tuple(r) for r in read_latest(spark, f"{tmp_dir}/t", wanted).collect()] == [(1, None)]


def test_report_text_fractions_text_facilities_and_any_sum(spark):
    rows = spark.createDataFrame(
        [("2024-01-02", 7, "12.0", "1", "1", 3), ("2024-01-02", 7, "3.7", "1", "1", 4), ("2024-01-02", 9, "1e1", "2", "2", 5)],
        "interview_date string, health_facility int, participant_age string, participant_gender string, case_control string, nets int")
    filled = fill_cast(rows)
    assert [r["participant_age"] for r in filled.orderBy("nets").collect()] == [12, 3, 10]
    config = ReportConfig([{"dataElement": "DE", "category_option_combo": {"5-14-Male-Case": "c1", "nets": "c2"}}], "aoc")
    orgunits = spark.createDataFrame([("7", "OU7"), ("X-9", "OU9")], "health_facility string, orgUnit string")
    got = sorted((r["orgUnit"], r["categoryOptionCombo"], r["value"]) for r in form_report(filled, config, orgunits).collect())
    assert got == [("OU7", "c1", 1), ("OU7", "c2", 7)]


def test_stamps_and_keys(spark):
    stamps = ["2021-03-04T10:11:12+0000", "2021-03-04T10:11:12.345+0000", "2021-03-04T10:11:12.345678Z", "2021-03-04", "x", None]
    got = spark.createDataFrame([(s,) for s in stamps], "s string").select(parse_timestamp(F.col("s")).alias("t")).collect()
    base = dt.datetime(2021, 3, 4, 10, 11, 12)
    assert [r["t"] for r in got] == [base, base.replace(microsecond=345000), base.replace(microsecond=345000),
                                     dt.datetime(2021, 3, 4), None, None]
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert [r[0] for r in df.select(composite_key(["x", "y", "z"])).collect()] == [None, None]
    with pytest.raises(Exception, match="missing"):
        to_eav(df, ["x", "y", "z"]).collect()
    with pytest.raises(ValueError):
        bounded_rows(spark.range(5), "rows", limit=4)


def test_endpoints_cover_the_metadata_tables():
    assert {e.table for e in ENDPOINTS.values()} >= {"organisationunit", "orgunitlevel", "categorycombo", "dataelement"}
