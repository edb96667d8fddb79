"""Landed documents through scan + mapping (FIXTURES B1, B2, B3)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.operators.mapping import apply_mapping, read_schema, spread_sections
from tallysheet.operators.unnest import explode_links
from tallysheet.operators.upsert import insert_new
from tallysheet.sources.csv_typed import read_typed_csv, rejected_cells
from tallysheet.sources.documents import (
    parsed_files,
    placed_items,
    read_documents,
    read_unit_documents,
    rejected_documents,
    tag_union,
)

ORG_UNIT_SPEC = {
    "id": {"column": "uid", "type": "str"},
    "name": {"column": "name", "type": "str"},
    "lastUpdated": {"column": "lastupdated", "type": "timestamp"},
    "openingDate": {"column": "openingdate", "type": "date"},
    "parent.id": {"column": "parentid", "type": "str"},
    "leaf": {"column": "leaf", "type": "bool"},
    "geometry": {"nestedColumns": {"type": {"column": "featuretype", "type": "str"},
                                   "coordinates": {"column": "coordinates", "type": "str"}}},
}


def write_json(path, name, doc, pretty=True):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(json.dumps(doc, indent=2 if pretty else None))


def test_metadata_scan_maps_declared_keys_only(spark, tmp_dir):
    page1 = {"organisationUnits": [
        {"id": "OU1", "name": "Country", "lastUpdated": "2021-03-04T10:11:12.345+0000", "openingDate": "1990-01-01T00:00:00.000",
         "path": "/OU1", "leaf": False, "unmapped": "x",
         "geometry": {"type": "Polygon", "coordinates": [[1.5, 2.5], [3, 4]]}},
    ]}
    page2 = {"organisationUnits": [
        {"id": "OU2", "name": "Clinic", "lastUpdated": "2021-03-05T00:00:00.000", "parent": {"id": "OU1"},
         "leaf": True},
    ]}
    write_json(tmp_dir, "page1.json", page1)
    write_json(tmp_dir, "page2.json", page2)
    items = read_documents(spark, tmp_dir, "organisationUnits", read_schema(ORG_UNIT_SPEC), multi_line=True)
    out = {r["uid"]: r.asDict() for r in apply_mapping(items, ORG_UNIT_SPEC, source_url="https://x.org").collect()}
    assert set(out) == {"OU1", "OU2"}
    assert out["OU1"]["lastupdated"] == dt.datetime(2021, 3, 4, 10, 11, 12, 345000)
    assert out["OU1"]["openingdate"] == dt.date(1990, 1, 1)
    assert out["OU1"]["parentid"] is None and out["OU2"]["parentid"] == "OU1"
    assert out["OU1"]["featuretype"] == "Polygon"
    assert json.loads(out["OU1"]["coordinates"]) == [[1.5, 2.5], [3, 4]]  # sub-tree kept as text
    assert out["OU2"]["leaf"] is True
    assert "unmapped" not in out["OU1"]
    import hashlib

    assert out["OU2"]["sourceid"] == hashlib.md5(b"https://x.org").hexdigest()


DATA_VALUE = T.StructType([T.StructField(n, T.StringType()) for n in
                           ["dataElement", "period", "orgUnit", "categoryOptionCombo", "attributeOptionCombo",
                            "value", "storedBy", "lastUpdated"]])


def test_unit_files_with_empty_and_missing_units(spark, tmp_dir):
    write_json(tmp_dir, "OUa.json", {"dataValues": [
        {"dataElement": "de1", "period": "202401", "orgUnit": "OUa", "categoryOptionCombo": "c", "attributeOptionCombo": "a",
         "value": "5", "storedBy": "u", "lastUpdated": "2024-02-01T00:00:00.000"},
        {"dataElement": "de1", "period": "202401", "orgUnit": "OUa", "categoryOptionCombo": "c", "attributeOptionCombo": "a",
         "value": "6", "lastUpdated": "2024-02-02T00:00:00.000"},
    ]})
    write_json(tmp_dir, "OUb.json", {})  # no values
    open(os.path.join(tmp_dir, "OUc.json"), "w").close()  # an empty download
    rows = read_unit_documents(spark, tmp_dir, "dataValues", DATA_VALUE, "unit", layout="file", multi_line=True)
    got = sorted((r["unit"], r["value"], r["storedBy"]) for r in rows.collect())
    assert got == [("OUa", "5", "u"), ("OUa", "6", None)]


def test_bare_and_named_lists_and_rejects(spark, tmp_dir):
    item = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
    write_json(tmp_dir, "a.json", [{"id": "1", "name": "x"}, {"id": "2"}])  # the layout downloads are written in
    write_json(tmp_dir, "b.json", {"items": [{"id": "3", "name": "]"}]})
    bad = {"c.json": '[{"id": "4"}, {"id": "5"', "d.json": '{"items": [{"id": "6"}]', "e.json": "not json",
           "f.json": '{"other": [{"id": "7"}]}', "g.json": '[{"id": "8"} {"id": "9"}]'}
    for name, text in bad.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    args = (spark, tmp_dir, "items", item, True)
    got = sorted((r["id"], r["name"]) for r in read_documents(*args, on_bad="skip").collect())
    assert got == [("1", "x"), ("2", None), ("3", "]")]
    rejects = {os.path.basename(r["file"]): r["text"] for r in rejected_documents(*args).collect()}
    assert rejects == bad  # nothing is lost: every document is read whole or listed
    with pytest.raises(Exception, match="bad document"):
        read_documents(*args).collect()
    only = {os.path.basename(r["file"]) for r in rejected_documents(*args, shape="list").collect()}
    assert only == {*bad, "b.json"}


def test_csv_cells_that_do_not_fit_their_type_are_listed(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write("uid,level,lastupdated\nu1,3,2024-01-02 03:04:05\nu2,three,2024-01-02 03:04:05\nu3,,yesterday\n")
    declared = {"level": "int", "lastupdated": "timestamp"}
    assert [r["level"] for r in read_typed_csv(spark, tmp_dir, declared).orderBy("uid").collect()] == [3, None, None]
    cells = sorted((r["row"]["uid"], r["column"], r["value"]) for r in rejected_cells(spark, tmp_dir, declared).collect())
    assert cells == [("u2", "level", "three"), ("u3", "lastupdated", "yesterday")]


def test_survey_sections_spread_with_optional_section(spark, tmp_dir):
    form = {"value": [
        {"s1": {"interview_date": "2024-01-02", "health_facility": "F1"}, "s2": {"participant_age": 4, "note": "s2"},
         "s3": {"participant_gender": 1}, "s4": {"case_control": 1}, "s6": {}, "s7": {"consent_granted": 1},
         "s5": {"note": "s5 wins"}},
        {"s1": {"interview_date": "2024-01-02", "health_facility": None}, "s2": {"participant_age": None, "note": "only s2"},
         "s3": {}, "s4": {"case_control": 2}, "s6": {}, "s7": {}},
    ]}
    write_json(tmp_dir, "formA.json", form)
    rows = spark.read.option("multiLine", True).json(tmp_dir)  # survey forms: inferred, heterogeneous keys
    flat = spread_sections(rows.select(F.explode("value").alias("r")).select("r.*"),
                           ["s1", "s2", "s3", "s4", "s6", "s7", "s5"], tag=("SOURCE_FORM", F.lit("formA")))
    got = sorted((r["note"], r["SOURCE_FORM"], r["participant_age"]) for r in flat.collect())
    assert got == [("only s2", "formA", None), ("s5 wins", "formA", 4)]


def test_tag_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3.0)], "k int, b double")
    out = sorted(tuple(r) for r in tag_union({"A": a, "B": b}).collect())
    assert out == [("A", 1, "x", None), ("B", 2, None, 3.0)]


def test_mn_explode_then_insert_only(spark):
    docs = spark.createDataFrame(
        [("cc1", "Combo", [("c1",), ("c2",), ("c1",)]), ("cc2", "NoList", None)],
        "id string, name string, categories array<struct<id:string>>",
    )
    links = explode_links(docs, {"id": {"column": "categorycombo_id", "type": "str"}}, "categories",
                          {"id": {"column": "dataelementcategory_id", "type": "str"}}, "https://x.org")
    existing = links.limit(0)
    out = insert_new(existing, links, ["categorycombo_id", "dataelementcategory_id", "sourceid"])
    got = sorted((r["categorycombo_id"], r["dataelementcategory_id"]) for r in out.collect())
    assert got == [("cc1", "c1"), ("cc1", "c2")]


def test_section_field_beats_the_source_tag(spark):
    rows = spark.createDataFrame(
        [({"a": 1}, {"SOURCE_FORM": "from-section"}), ({"a": 2}, None)],
        "s1 struct<a:int>, s2 struct<SOURCE_FORM:string>",
    )
    flat = spread_sections(rows, ["s1", "s2"], tag=("SOURCE_FORM", F.lit("formA")))
    assert sorted((r["a"], r["SOURCE_FORM"]) for r in flat.collect()) == [(1, "from-section"), (2, "formA")]


def test_text_behind_the_value_and_bad_leaves_make_a_bad_document(spark, tmp_dir):
    item = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])
    good = {"a.json": '\ufeff [{"id": "1", "n": 1}, null]\n', "b.json": '{"xs": [{"id": "2", "z": {}}], "pager": {"page": 1}}',
            "c.json": " { } ", "d.json": '{"xs": []}', "e.json": '[{"id": "[x]\\"}"}]'}
    bad = {"f.json": '[{"id":"a"}][{"id":"b"}]', "g.json": '{"xs":[{"id":"c"}]}{"xs":[{"id":"d"}]}', "h.json": '[{"id":"f"}] x ]',
           "i.json": '[{"id":"g"}],"end":true', "j.json": '{"xs":[]},{"xs":[{"id":"h"}]}', "k.json": '[{"id":"i","n":"abc"}]',
           "l.json": '{"xs":[{"id":"j","n":"abc"}]}', "m.json": '{"xs":{"id":"k"}}', "n.json": "[1,2]", "o.json": '[{"id":"l"}]}',
           "p.json": '{"xs":[{"id":"m"}]}]', "q.json": "null", "r.json": '{"xs":null}', "s.json": '"[]"'}
    for name, text in {**good, **bad}.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    parsed = parsed_files(spark, tmp_dir, "xs", item, True)
    rejects = {os.path.basename(r["file"]): r["text"] for r in rejected_documents(spark, tmp_dir, "xs", item, True).collect()}
    assert rejects == bad
    rows = placed_items(parsed).collect()
    assert {os.path.basename(r["_file"]): r["_bad_text"] for r in rows if r["_bad_text"] is not None} == bad
    items = sorted((os.path.basename(r["_file"]), r["_position"], r["id"], r["n"]) for r in rows if r["_bad_text"] is None)
    assert items == [("a.json", 0, "1", 1), ("a.json", 1, None, None), ("b.json", 0, "2", None), ("e.json", 0, '[x]"}', None)]
    with pytest.raises(Exception, match="bad document"):
        placed_items(parsed, on_bad="fail").collect()


def test_a_document_is_trimmed_and_parsed_once(spark, tmp_dir):
    item = T.StructType([T.StructField("id", T.StringType())])
    plan = read_documents(spark, tmp_dir, "xs", item, True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 2 and plan.count("trim") == 1  # one per shape, of which a row takes one


def test_links_are_dealt_to_more_tasks_as_lines_grow(spark, tmp_dir, monkeypatch):
    import __spark_entry__ as E
    from tallysheet.plans import load_queries

    lines = [(o, p, n) for o in range(60) for n, p in enumerate((o % 7, o % 7, o % 5 + 10), 1)]
    lines += [(5, p % 40, 1) for p in range(400)] + [(None, 1, 1), (777, 1, 1), (8, None, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int").repartition(3).write.parquet(
        f"{tmp_dir}/lineitem.parquet")
    orders = [*range(60), 3, None]  # one order comes twice
    spark.createDataFrame([(o, "F") for o in orders], "o_orderkey long, o_orderstatus string").write.parquet(
        f"{tmp_dir}/orders.parquet")
    monkeypatch.setattr(load_queries, "LINES_PER_TASK", 50)
    links = E.queries()["mn_explode"](spark, tmp_dir)
    assert "hashpartitioning(l_orderkey" in (plan := links._jdf.queryExecution().executedPlan().toString())
    assert plan.count("REPARTITION_BY_NUM") == 2 and f", {-(-len(lines) // 50)}), REPARTITION_BY_NUM" in plan
    got = sorted((r["order_id"], r["part_id"]) for r in links.where("part_id IS NOT NULL").collect())
    assert got == sorted({(o, p) for o, p, _ in lines if o in range(60) and p is not None})
    assert links.where("part_id IS NULL").count() == 1
