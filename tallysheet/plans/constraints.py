"""The staging tables' declared constraints as configuration, and a check of a whole store (O-39, O-50)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tallysheet.operators.quality import Rule, duplicate_keys, fk_violations, rule_violations
from tallysheet.sinks.versioned import read_latest


@dataclass(frozen=True)
class Table:
    """Primary key, columns (greatest length, or "required", or both) and foreign keys (column(s) -> parent)."""

    key: tuple[str, ...]
    columns: Mapping[str, str]
    references: Mapping[str, tuple[tuple[str, ...], str]]


def _times() -> dict[str, str]:
    return {"created": "required", "lastupdated": "required"}


def _of(parent: str, *columns: str) -> tuple[tuple[str, ...], str]:
    return (*columns, "sourceid"), parent


_SOURCE = (("sourceid",), "data_source")
_BY_UID = ("uid", "sourceid")

# The declared columns, lengths, keys and foreign-key names of the staging tables.
TABLES = {
    "data_source": Table(("id",), {"id": "50", "title": "150 required", "url": "255 required", "description": "255"}, {}),
    "organisationunit": Table(_BY_UID, {
        "uid": "11", "code": "50", **_times(), "name": "230 required", "shortname": "50 required", "parentid": "11",
        "path": "255", "contactperson": "255", "address": "255", "email": "150", "phonenumber": "150",
        "featuretype": "255", "sourceid": "50"}, {"fk_organisationunit_data_source": _SOURCE}),
    "orgunitlevel": Table(_BY_UID, {
        "uid": "11", "code": "50", **_times(), "name": "230 required", "previous_name": "230", "level": "required",
        "sourceid": "50"}, {}),
    "optionset": Table(_BY_UID, {
        "uid": "11", "code": "50", **_times(), "name": "230 required", "valuetype": "50 required", "sourceid": "50"},
        {"fk_optionset_data_source": _SOURCE}),
    "categorycombo": Table(_BY_UID, {"uid": "11 required", **_times(), "name": "230 required", "sourceid": "50"},
                           {"fk_categorycombo_data_source": _SOURCE}),
    "dataelementcategory": Table(_BY_UID, {
        "uid": "11", **_times(), "name": "230 required", "previous_name": "230", "sourceid": "50"},
        {"fk_dataelementcategory_data_source": _SOURCE}),
    "dataelementcategoryoption": Table(_BY_UID, {
        "uid": "11", **_times(), "name": "230 required", "shortname": "50", "sourceid": "50"},
        {"fk_dataelementcategoryoption_data_source": _SOURCE}),
    "dataelementcategory_categoryoption": Table(
        ("category_id", "categoryoption_id", "sourceid"),
        {"category_id": "11", "categoryoption_id": "11", "sourceid": "50"},
        {"fk_dataelementcategory_categoryoption_dataelementcategory": _of("dataelementcategory", "category_id"),
         "fk_dataelementcategory_categoryoption_dataelementcategoryoption": _of("dataelementcategoryoption", "categoryoption_id"),
         "fk_dataelementcategory_categoryoption_data_source": _SOURCE}),
    "dataelementcategory_categorycombo": Table(
        ("categorycombo_id", "dataelementcategory_id", "sourceid"),
        {"categorycombo_id": "11", "dataelementcategory_id": "11", "sourceid": "50"},
        {"fk_dataelementcategorycombo_categorycombo": _of("categorycombo", "categorycombo_id"),
         "fk_dataelementcategorycombo_dataelementcategory": _of("dataelementcategory", "dataelementcategory_id"),
         "fk_dataelementcategory_categorycombo_data_source": _SOURCE}),
    "categoryoptioncombo": Table(_BY_UID, {
        "uid": "11", "name": "230 required", **_times(), "categorycombo_id": "11", "sourceid": "50"},
        {"fk_categoryoptioncombo_categorycombo": _of("categorycombo", "categorycombo_id"),
         "fk_categoryoptioncombo_data_source": _SOURCE}),
    "categoryoptioncombo_categoryoptions": Table(
        ("category_option_combo_id", "category_option_id", "sourceid"),
        {"category_option_combo_id": "11", "category_option_id": "11", "sourceid": "50"},
        {"fk_categoryoptioncombo_categoryoptions_categoryoptioncombo": _of("categoryoptioncombo", "category_option_combo_id"),
         "fk_categoryoptioncombo_categoryoptions_dataelementcategoryoption": _of("dataelementcategoryoption", "category_option_id"),
         "fk_categoryoptioncombo_categoryoptions_data_source": _SOURCE}),
    "dataelement": Table(_BY_UID, {
        "uid": "11 required", "code": "50", **_times(), "name": "230 required", "shortname": "50 required",
        "formname": "230", "valuetype": "50 required", "domaintype": "255 required", "aggregationtype": "50 required",
        "categorycomboid": "11 required", "url": "255", "optionsetid": "11", "sourceid": "50"},
        {"fk_dataelement_optionset": _of("optionset", "optionsetid"),
         "fk_dataelement_categorycombo": _of("categorycombo", "categorycomboid"),
         "fk_dataelement_data_source": _SOURCE}),
    "dataelementgroup": Table(_BY_UID, {
        "uid": "11 required", **_times(), "name": "230 required", "previous_name": "230", "formname": "230",
        "aggregationtype": "50", "sourceid": "50"}, {"fk_dataelementgroup_data_source": _SOURCE}),
    "dataelement_dataelementgroup": Table(
        ("dataelement_id", "group_id", "sourceid"), {"dataelement_id": "11", "group_id": "11", "sourceid": "50"},
        {"fk_dataelement_dataelementgroup_dataelement": _of("dataelement", "dataelement_id"),
         "fk_dataelement_dataelementgroup_dataelementgroup": _of("dataelementgroup", "group_id"),
         "fk_dataelement_dataelementgroup_data_source": _SOURCE}),
    "datavalue": Table(
        ("dataelementid", "period", "organisationunitid", "categoryoptioncomboid", "attributeoptioncomboid", "sourceid"),
        {"dataelementid": "11 required", "period": "50 required", "organisationunitid": "11 required",
         "categoryoptioncomboid": "11 required", "attributeoptioncomboid": "11 required", **_times(), "value": "50000",
         "storedby": "230", "sourceid": "50"},
        {"fk_dataelement_datavalue": _of("dataelement", "dataelementid"),
         "fk_organisationunit_datavalue": _of("organisationunit", "organisationunitid"),
         "fk_categoryoptioncombo_datavalue": _of("categoryoptioncombo", "categoryoptioncomboid"),
         "fk_categoryoptioncombo_datavalue_2": _of("categoryoptioncombo", "attributeoptioncomboid"),
         "fk_source_datavalue": _SOURCE}),
}
CHANGE_STATUS = ["insert", "update", ""]


def column_rules(name: str, columns: list[str]) -> list[Rule]:
    """The NOT NULL, length and status rules of a table, for the columns it has; key columns are required too."""
    table, rules = TABLES[name], []
    for column, declared in table.columns.items():
        if column not in columns:
            continue
        if "required" in declared or column in table.key:
            rules.append(Rule(f"{name}.{column}.not_null", "not_null", column))
        length = declared.split()[0]
        if length.isdigit():
            rules.append(Rule(f"{name}.{column}.max_length", "max_length", column, int(length)))
    if "change" in columns:
        rules.append(Rule(f"{name}.change.domain", "domain", "change", CHANGE_STATUS))
    return rules


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(rule, key, n)`` for every violated constraint of the given staging tables.

    Foreign keys are checked where both tables are given.
    """
    found = []
    for name, df in tables.items():
        table = TABLES[name]
        key = [c for c in table.key if c in df.columns]
        found.append(rule_violations(df, column_rules(name, df.columns), key))
        found.append(duplicate_keys(df, key, f"{name}.pk"))
        for fk, (columns, parent) in table.references.items():
            if parent in tables and set(columns) <= set(df.columns):
                broken = fk_violations(df, tables[parent], columns, TABLES[parent].key, fk)
                found.append(broken.selectExpr("fk AS rule", "child_key AS key", "n"))
    return reduce(DataFrame.unionByName, found)


def check_store(spark: SparkSession, store: str, extra: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``check_tables`` over the newest versions in a staging store; ``extra`` adds tables kept elsewhere."""
    stored = {name: read_latest(spark, f"{store}/{name}") for name in TABLES if name != "datavalue"}
    return check_tables({**{n: df for n, df in stored.items() if df is not None}, **(extra or {})})
