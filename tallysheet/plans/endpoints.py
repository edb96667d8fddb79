"""Endpoint configuration: API list key -> staging table, mapping, keys, tracked columns.

Configuration only; ``flows.stage_endpoint`` / ``flows.stage_links`` run it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from tallysheet.operators.changes import PREVIOUS_NAME, TRACKED
from tallysheet.operators.mapping import MappingSpec
from tallysheet.plans.constraints import TABLES


@dataclass(frozen=True)
class Endpoint:
    """One metadata endpoint and the staging table it feeds."""

    list_key: str
    spec: MappingSpec
    table: str
    keys: Sequence[str] = ("uid", "sourceid")
    tracked: Sequence[str] = ("name",)
    previous: Mapping[str, str] = field(default_factory=dict)
    order_col: str = "lastupdated"
    required: Sequence[str] = ()  # besides the keys; a new row without them is rejected


@dataclass(frozen=True)
class LinkSpec:
    """An M:N link table built from a child list of an endpoint's objects."""

    list_key: str
    parent_spec: MappingSpec
    child_key: str
    child_spec: MappingSpec
    table: str
    keys: Sequence[str]


def _str(column: str) -> dict:
    return {"column": column, "type": "str"}


# The mapping specs of the API endpoints (API key -> staging
# column and type word), with each staging table's primary key.
ORG_UNIT_LEVEL_SPEC = {
    "id": {"column": "uid", "type": "str"},
    "code": {"column": "code", "type": "str"},
    "created": {"column": "created", "type": "timestamp"},
    "lastUpdated": {"column": "lastupdated", "type": "timestamp"},
    "name": {"column": "name", "type": "str"},
    "level": {"column": "level", "type": "int"},
}
ORG_UNIT_SPEC = {
    "id": {"column": "uid", "type": "str"},
    "code": {"column": "code", "type": "str"},
    "created": {"column": "created", "type": "timestamp"},
    "lastUpdated": {"column": "lastupdated", "type": "timestamp"},
    "name": {"column": "name", "type": "str"},
    "shortName": {"column": "shortname", "type": "str"},
    "parent.id": {"column": "parentid", "type": "str"},
    "path": {"column": "path", "type": "str"},
    "leaf": {"column": "leaf", "type": "bool"},
    "openingDate": {"column": "openingdate", "type": "date"},
    "closedDate": {"column": "closeddate", "type": "date"},
    "contactPerson": {"column": "contactperson", "type": "str"},
    "address": {"column": "address", "type": "str"},
    "email": {"column": "email", "type": "str"},
    "phoneNumber": {"column": "phonenumber", "type": "str"},
    "geometry": {"nestedColumns": {"type": {"column": "featuretype", "type": "str"},
                                   "coordinates": {"column": "coordinates", "type": "str"}}},
}
CATEGORY_SPEC = {
    "id": {"column": "uid", "type": "str"},
    "created": {"column": "created", "type": "timestamp"},
    "lastUpdated": {"column": "lastupdated", "type": "timestamp"},
    "name": {"column": "name", "type": "str"},
    "dataDimension": {"column": "datadimension", "type": "bool"},
}
CATEGORY_COMBO_SPEC = {
    "id": {"column": "uid", "type": "str"},
    "created": {"column": "created", "type": "timestamp"},
    "lastUpdated": {"column": "lastupdated", "type": "timestamp"},
    "name": {"column": "name", "type": "str"},
}
CATEGORY_OPTION_SPEC = {
    "id": {"column": "uid", "type": "str"},
    "created": {"column": "created", "type": "timestamp"},
    "lastUpdated": {"column": "lastupdated", "type": "timestamp"},
    "name": {"column": "name", "type": "str"},
    "shortName": {"column": "shortname", "type": "str"},
}
CATEGORY_OPTION_COMBO_SPEC = {
    "id": {"column": "uid", "type": "str"},
    "created": {"column": "created", "type": "timestamp"},
    "lastUpdated": {"column": "lastupdated", "type": "timestamp"},
    "name": {"column": "name", "type": "str"},
    "categoryCombo": {"nestedColumns": {"id": {"column": "categorycombo_id", "type": "str"}}},
}
DATA_ELEMENT_SPEC = {
    "id": {"column": "uid", "type": "str"},
    "code": {"column": "code", "type": "str"},
    "created": {"column": "created", "type": "timestamp"},
    "lastUpdated": {"column": "lastupdated", "type": "timestamp"},
    "name": {"column": "name", "type": "str"},
    "shortName": {"column": "shortname", "type": "str"},
    "formName": {"column": "formname", "type": "str"},
    "valueType": {"column": "valuetype", "type": "str"},
    "domainType": {"column": "domaintype", "type": "str"},
    "aggregationType": {"column": "aggregationtype", "type": "str"},
    "categoryCombo": {"nestedColumns": {"id": {"column": "categorycomboid", "type": "str"}}},
    "href": {"column": "url", "type": "str"},
}
DATA_ELEMENT_GROUP_SPEC = {
    "id": {"column": "uid", "type": "str"},
    "created": {"column": "created", "type": "timestamp"},
    "lastUpdated": {"column": "lastupdated", "type": "timestamp"},
    "name": {"column": "name", "type": "str"},
    "displayFormName": {"column": "formname", "type": "str"},
    "aggregationType": {"column": "aggregationtype", "type": "str"},
}
DATA_VALUE_SPEC = {
    "dataElement": {"column": "dataelementid", "type": "str"},
    "created": {"column": "created", "type": "timestamp"},
    "lastUpdated": {"column": "lastupdated", "type": "timestamp"},
    "period": {"column": "period", "type": "str"},
    "orgUnit": {"column": "organisationunitid", "type": "str"},
    "categoryOptionCombo": {"column": "categoryoptioncomboid", "type": "str"},
    "attributeOptionCombo": {"column": "attributeoptioncomboid", "type": "str"},
    "value": {"column": "value", "type": "str"},
    "storedBy": {"column": "storedby", "type": "str"},
    "followup": {"column": "followup", "type": "bool"},
}
DATA_VALUE_KEYS = ["dataelementid", "period", "organisationunitid", "categoryoptioncomboid",
                   "attributeoptioncomboid", "sourceid"]

# Link tables: (endpoint list key, parent key mapping, child list key, child key mapping, table, primary key).
LINKS = {
    "dataelementcategory_categorycombo": LinkSpec(
        "categoryCombos", {"id": _str("categorycombo_id")}, "categories", {"id": _str("dataelementcategory_id")},
        "dataelementcategory_categorycombo", ["categorycombo_id", "dataelementcategory_id", "sourceid"],
    ),
    "dataelementcategory_categoryoption": LinkSpec(
        "categoryOptions", {"id": _str("categoryoption_id")}, "categories", {"id": _str("category_id")},
        "dataelementcategory_categoryoption", ["category_id", "categoryoption_id", "sourceid"],
    ),
    "categoryoptioncombo_categoryoptions": LinkSpec(
        "categoryOptionCombos", {"id": _str("category_option_combo_id")}, "categoryOptions",
        {"id": _str("category_option_id")},
        "categoryoptioncombo_categoryoptions", ["category_option_combo_id", "category_option_id", "sourceid"],
    ),
    "dataelement_dataelementgroup": LinkSpec(
        "dataElements", {"id": _str("dataelement_id")}, "dataElementGroups", {"id": _str("group_id")},
        "dataelement_dataelementgroup", ["dataelement_id", "group_id", "sourceid"],
    ),
}


def _endpoint(list_key: str, spec: MappingSpec, table: str) -> Endpoint:
    mapped = {e["column"] for e in spec.values() if "column" in e} | {
        n["column"] for e in spec.values() for n in e.get("nestedColumns", {}).values()
    }
    tracked = [c for c in TRACKED.get(table, ["name"]) if c in mapped]
    declared = TABLES[table]
    required = [c for c, rule in declared.columns.items() if "required" in rule and c in mapped and c not in declared.key]
    return Endpoint(list_key, spec, table, tracked=tracked, previous=PREVIOUS_NAME.get(table, {}), required=required)


ENDPOINTS = {
    "organisationUnitLevels": _endpoint("organisationUnitLevels", ORG_UNIT_LEVEL_SPEC, "orgunitlevel"),
    "organisationUnits": _endpoint("organisationUnits", ORG_UNIT_SPEC, "organisationunit"),
    "categories": _endpoint("categories", CATEGORY_SPEC, "dataelementcategory"),
    "categoryCombos": _endpoint("categoryCombos", CATEGORY_COMBO_SPEC, "categorycombo"),
    "categoryOptions": _endpoint("categoryOptions", CATEGORY_OPTION_SPEC, "dataelementcategoryoption"),
    "categoryOptionCombos": _endpoint("categoryOptionCombos", CATEGORY_OPTION_COMBO_SPEC, "categoryoptioncombo"),
    "dataElements": _endpoint("dataElements", DATA_ELEMENT_SPEC, "dataelement"),
    "dataElementGroups": _endpoint("dataElementGroups", DATA_ELEMENT_GROUP_SPEC, "dataelementgroup"),
}
DATA_VALUES = Endpoint("dataValues", DATA_VALUE_SPEC, "datavalue", keys=DATA_VALUE_KEYS, tracked=["value"],
                       required=["lastupdated"])
