"""End-to-end jobs on hand-written landed documents (FIXTURES B1..B4, B7, B9)."""

import json
import os

from pyspark.sql import functions as F

from tallysheet.plans.endpoints import ENDPOINTS, LINKS
from tallysheet.plans.flows import (
    case_control_payloads,
    category_dimension,
    dataelement_dimension,
    load_data_values,
    orgunit_dimension,
    read_data_values,
    stage_endpoint,
    stage_links,
)
from tallysheet.operators.report import ReportConfig
from tallysheet.sinks.versioned import read_latest

URL = "https://source.example.org/api"
LEVELS = ENDPOINTS["organisationUnitLevels"]
UNITS = ENDPOINTS["organisationUnits"]


def land(path, name, doc):
    """Items with a time of change also get one of creation, which every staged row must have."""
    for items in doc.values() if isinstance(doc, dict) else [doc]:
        for item in items:
            if isinstance(item, dict) and "lastUpdated" in item:
                item.setdefault("created", item["lastUpdated"])
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        json.dump(doc, f, indent=1)


def unit(uid, name, path, parent=None, ts="2024-01-01T00:00:00.123"):
    row = {"id": uid, "name": name, "shortName": name[:3], "path": path, "lastUpdated": ts, "leaf": False}
    if parent:
        row["parent"] = {"id": parent}
    return row


def test_orgunit_flow_two_runs(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    run1 = f"{tmp_dir}/run1"
    land(f"{run1}/levels", "p1.json", {"organisationUnitLevels": [
        {"id": "L1", "name": "National", "level": 1, "lastUpdated": "2024-01-01T00:00:00.000"},
        {"id": "L2", "name": "Sub National", "level": 2, "lastUpdated": "2024-01-01T00:00:00.000"}]})
    land(f"{run1}/units", "p1.json", {"organisationUnits": [unit("A", "Country", "/A")]})
    land(f"{run1}/units", "p2.json", {"organisationUnits": [unit("B", "Region", "/A/B", "A")]})
    stage_endpoint(spark, f"{run1}/levels", LEVELS, store, URL)
    stage_endpoint(spark, f"{run1}/units", UNITS, store, URL)
    levels = read_latest(spark, f"{store}/orgunitlevel")
    units = read_latest(spark, f"{store}/organisationunit")
    plan, rows = orgunit_dimension(units, levels)
    assert [(r["action"], r["column_name"], r["anchor"]) for r in plan.orderBy("seq").collect()] == [
        ("ADD", "L1", "lastupdated"), ("ADD", "National", "L1"), ("ADD", "L2", "National"), ("ADD", "SubNational", "L2")]
    got = {r["uid"]: r.asDict() for r in rows.collect()}
    assert got["B"]["National"] == "Country" and got["B"]["SubNational"] == "Region" and got["B"]["level"] == 2
    assert got["B"]["lastupdated"].microsecond == 0

    # second run: a level renamed, one unit renamed, one unchanged document re-sent
    run2 = f"{tmp_dir}/run2"
    land(f"{run2}/levels", "p1.json", {"organisationUnitLevels": [
        {"id": "L2", "name": "Province", "level": 2, "lastUpdated": "2024-02-01T00:00:00.000"}]})
    land(f"{run2}/units", "p1.json", {"organisationUnits": [
        unit("B", "Region 2", "/A/B", "A", "2024-02-01T00:00:00.000"), unit("A", "Country", "/A")]})
    # the warehouse exported run 1: reset before the second load
    from tallysheet.operators.changes import reset_changes
    from tallysheet.sinks.versioned import commit

    commit(reset_changes(levels), f"{store}/orgunitlevel")
    commit(reset_changes(units), f"{store}/organisationunit")
    stage_endpoint(spark, f"{run2}/levels", LEVELS, store, URL)
    stage_endpoint(spark, f"{run2}/units", UNITS, store, URL)
    levels = read_latest(spark, f"{store}/orgunitlevel")
    units = read_latest(spark, f"{store}/organisationunit")
    status = {r["uid"]: r["change"] for r in units.collect()}
    assert status == {"A": "", "B": "update"}
    plan, rows = orgunit_dimension(units, levels)
    assert [(r["action"], r["column_name"], r["anchor"]) for r in plan.collect()] == [("RENAME", "Province", "SubNational")]
    assert [r["uid"] for r in rows.collect()] == ["B"]


def test_link_table_is_insert_only(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    land(f"{tmp_dir}/combos", "p1.json", {"categoryCombos": [
        {"id": "cc1", "name": "Combo", "lastUpdated": "2024-01-01T00:00:00", "categories": [{"id": "c1"}, {"id": "c2"}, {}]},
        {"id": "cc2", "name": "Empty", "lastUpdated": "2024-01-01T00:00:00"}]})
    link = LINKS["dataelementcategory_categorycombo"]
    stage_links(spark, f"{tmp_dir}/combos", link, store, URL)
    stage_links(spark, f"{tmp_dir}/combos", link, store, URL)  # replay: no duplicates
    rows = sorted((r["categorycombo_id"], r["dataelementcategory_id"])
                  for r in read_latest(spark, f"{store}/{link.table}").collect())
    # the same pages also feed the combo table itself
    stage_endpoint(spark, f"{tmp_dir}/combos", ENDPOINTS["categoryCombos"], store, URL)
    assert sorted(r["uid"] for r in read_latest(spark, f"{store}/categorycombo").collect()) == ["cc1", "cc2"]
    assert rows == [("cc1", "c1"), ("cc1", "c2")]
    rejects = spark.read.parquet(f"{store}/{link.table}_rejects").collect()  # a child without an id, listed once
    assert [r["reason"] for r in rejects] == ["missing dataelementcategory_id"] and "cc1" in rejects[0]["row"]


def value(de, ou, v, ts, stored_by="u"):
    row = {"dataElement": de, "period": "202401", "orgUnit": ou, "categoryOptionCombo": "coc", "attributeOptionCombo": "aoc",
           "value": v, "lastUpdated": ts}
    if stored_by:
        row["storedBy"] = stored_by
    return row


def test_fact_load_incremental_and_idempotent(spark, tmp_dir):
    landed, store = f"{tmp_dir}/values", f"{tmp_dir}/store"
    land(landed, "OU1.json", {"dataValues": [
        value("de1", "OU1", "5", "2024-02-01T00:00:00.000"),
        value("de1", "OU1", "6", "2024-02-02T00:00:00.000", stored_by=None),  # same key twice: newest wins
        value("de2", "OU1", "1", "2017-01-01T00:00:00.000"),  # older than the mark
    ]})
    open(os.path.join(landed, "OU2.json"), "w").close()
    links = spark.createDataFrame([("de1", "g1"), ("de2", "g1")], "dataelement_id string, group_id string")
    mark = load_data_values(spark, landed, store, URL, "2018-01-01 00:00:00", links, ["g1"])
    rows = read_data_values(spark, store).collect()
    assert [(r["dataelementid"], r["value"], r["storedby"], r["change"]) for r in rows] == [("de1", "6", "u", "insert")]
    assert str(mark) == "2024-02-02 00:00:00"
    assert load_data_values(spark, landed, store, URL, str(mark), links, ["g1"]) == mark  # replay: same mark
    again = read_data_values(spark, store).collect()
    assert [(r["value"], r["change"]) for r in again] == [("6", "insert")]


def test_fact_load_rewrites_only_touched_periods(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    first, second = f"{tmp_dir}/v1", f"{tmp_dir}/v2"
    jan = value("de1", "OU1", "1", "2024-02-01T00:00:00.000")
    feb = dict(value("de1", "OU1", "2", "2024-03-01T00:00:00.000"), period="202402")
    land(first, "OU1.json", {"dataValues": [jan, feb]})
    load_data_values(spark, first, store, URL, "2018-01-01 00:00:00")
    jan_dir = os.path.join(store, "datavalue", "period=202401")
    before = sorted(os.listdir(jan_dir))
    land(second, "OU1.json", {"dataValues": [dict(feb, value="3", lastUpdated="2024-03-02T00:00:00.000")]})
    load_data_values(spark, second, store, URL, "2024-03-01 00:00:00")
    assert sorted(os.listdir(jan_dir)) == before  # the untouched period keeps its files
    got = sorted((r["period"], r["value"], r["change"]) for r in read_data_values(spark, store).collect())
    assert got == [("202401", "1", "insert"), ("202402", "3", "insert")]


def test_case_control_payloads(spark):
    form = spark.createDataFrame(
        [([{"s1": {"interview_date": "2024-01-02", "health_facility": "F1"}, "s2": {"participant_age": "3"},
            "s3": {"participant_gender": "1"}, "s4": {"case_control": "1"}, "s6": {}, "s7": {}}] * 3,)],
        "value array<struct<s1:struct<interview_date:string,health_facility:string>,s2:struct<participant_age:string>,"
        "s3:struct<participant_gender:string>,s4:struct<case_control:string>,s6:struct<x:string>,s7:struct<y:string>>>",
    )
    indicators = [f"{b}-{s}-{a}" for b in ("0-4", "5-14", "15-24", "25-49", ">=50") for a in ("Case", "Control")
                  for s in ("Male", "Female")]
    config = ReportConfig([{"dataElement": f"de{j}", "category_option_combo": {i: f"c{j}_{k}" for k, i in enumerate(indicators)}}
                           for j in range(2)], "aoc")
    units = spark.createDataFrame([("F1", "OU1")], "health_facility string, orgUnit string")
    chunks = case_control_payloads({"formA": form}, config, units).collect()
    assert sorted(r["n"] for r in chunks) == [10, 30]  # 40 values in bodies of at most 30
    values = [v for r in chunks for v in json.loads(r["payload"])["dataValues"]]
    assert len(values) == 40 and {v["period"] for v in values} == {"20240102"}
    hot = [v for v in values if v["value"] != 0]
    assert len(hot) == 2 and all(v["value"] == 3 for v in hot)


def test_category_and_dataelement_dimensions(spark):
    combos = spark.createDataFrame([("coc1", "Male, <5")], "uid string, name string")
    combo_options = spark.createDataFrame([("coc1", "o1"), ("coc1", "o2")],
                                          "category_option_combo_id string, category_option_id string")
    options = spark.createDataFrame([("o1", "Male", "s", "insert"), ("o2", "<5", "s", "update")],
                                    "uid string, name string, sourceid string, change string")
    cat_options = spark.createDataFrame([("c1", "o1"), ("c2", "o2")], "category_id string, categoryoption_id string")
    categories = spark.createDataFrame([("c1", "Sex"), ("c2", "Age Group")], "uid string, name string")
    row = category_dimension(combos, combo_options, options, cat_options, categories, "2024-01-01 00:00:00").collect()[0]
    assert (row["c1"], row["Sex"], row["c2"], row["AgeGroup"]) == ("o1", "Male", "o2", "<5")
    elements = spark.createDataFrame([("de1", "ANC", "s"), ("de2", "OPD", "s")], "uid string, name string, sourceid string")
    links = spark.createDataFrame([("de1", "g1")], "dataelement_id string, group_id string")
    groups = spark.createDataFrame([("g1", "Maternal Health"), ("g2", "Other")], "uid string, name string")
    out = {r["uid"]: r.asDict() for r in dataelement_dimension(elements, links, groups, "2024-01-01 00:00:00").collect()}
    assert out["de1"]["g1"] == "t" and out["de1"]["MaternalHealth"] == "t" and out["de1"]["g2"] == ""
    assert "de2" not in out  # no group: not exported (inner join semantics)


def test_streamed_fact_load_equals_batch_load(spark, tmp_dir):
    from tallysheet.plans.flows import start_data_value_stream

    landed = f"{tmp_dir}/landing"
    docs = [
        ("OU1.json", [value("de1", "OU1", "1", "2024-02-01T00:00:00.000"), value("de2", "OU1", "2", "2024-02-01T00:00:00.000")]),
        ("OU2.json", [value("de1", "OU2", "3", "2024-02-02T00:00:00.000")]),
        ("OU1b.json", [value("de1", "OU1", "9", "2024-02-03T00:00:00.000")]),  # a later change of an earlier key
    ]
    for name, rows in docs:
        land(landed, name, {"dataValues": rows})
    batch_store, stream_store = f"{tmp_dir}/batch", f"{tmp_dir}/stream"
    load_data_values(spark, landed, batch_store, URL, "2018-01-01 00:00:00")
    ckpt = f"{tmp_dir}/ckpt"
    start_data_value_stream(spark, landed, stream_store, URL, ckpt, max_files_per_trigger=1).awaitTermination()
    start_data_value_stream(spark, landed, stream_store, URL, ckpt).awaitTermination()  # restart: nothing new

    def snapshot(store):
        return sorted((r["dataelementid"], r["organisationunitid"], r["value"]) for r in read_data_values(spark, store).collect())

    assert snapshot(stream_store) == snapshot(batch_store) == [("de1", "OU1", "9"), ("de1", "OU2", "3"), ("de2", "OU1", "2")]


def test_data_source_seed_and_export(spark):
    from tallysheet.operators.changes import reset_changes
    from tallysheet.plans.flows import data_source_dimension, data_source_rows

    staged = data_source_rows(spark, None, URL, "Main source")
    again = data_source_rows(spark, staged, URL, "Main source")  # seeding twice keeps one row
    assert again.count() == 1
    empty = spark.createDataFrame([], "id string, title string, url string, description string")
    warehouse = data_source_dimension(empty, again)
    assert [(r["url"], r["title"]) for r in warehouse.collect()] == [(URL, "Main source")]
    renamed = reset_changes(again).withColumn("title", F.lit("Main source 2")).withColumn("change", F.lit("update"))
    assert [r["title"] for r in data_source_dimension(warehouse, renamed).collect()] == ["Main source 2"]


def test_fact_load_only_leaf_units_and_empty_slice(spark, tmp_dir):
    landed, store = f"{tmp_dir}/values", f"{tmp_dir}/store"
    land(landed, "OU1.json", {"dataValues": [value("de1", "OU1", "5", "2024-02-01T00:00:00.000")]})
    land(landed, "OUX.json", {"dataValues": [value("de1", "OUX", "7", "2024-02-01T00:00:00.000")]})
    leaves = spark.createDataFrame([("OU1",), ("OU2",)], "uid string")
    mark = load_data_values(spark, landed, store, URL, "2018-01-01 00:00:00", leaf_units=leaves)
    assert [r["organisationunitid"] for r in read_data_values(spark, store).collect()] == ["OU1"]
    # nothing newer than the mark: no write, mark unchanged
    assert load_data_values(spark, landed, store, URL, "2030-01-01 00:00:00", leaf_units=leaves) == "2030-01-01 00:00:00"
    assert str(mark) == "2024-02-01 00:00:00"
