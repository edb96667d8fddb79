"""Landed JSON documents as VARIANT values: which keys an item has, and of what types, is kept (O-01, O-03, O-17).

A declared read schema (``sources.documents``) cannot tell a key that is absent from one that is null, and drops keys
that nobody declared.  Here each document is parsed once into a VARIANT; items keep their keys, so a partial
document can be folded by presence (``operators.presence``), and the schema of forms that were never declared
can be discovered (:func:`discover_schema`).

Two differences to the declared scan: numbers take their shortest text (``1.50`` reads as ``1.5``), and a document that names a
key twice is a bad one.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.functions.keys import quoted
from tallysheet.session import bounded_rows
from tallysheet.sources.documents import BAD_TEXT, BLANKS, FILE, POSITION, SHAPES

ITEM = "_item"
#: Stands behind the document while it is parsed: whatever ends the value early hides it.
_END = "--end of document--"


def path_of(*keys: str) -> str:
    """A VARIANT path to a key; dots and blanks in a key's name mean nothing."""
    return "$" + "".join('["' + k.replace("\\", "\\\\").replace('"', '\\"') + '"]' for k in keys)


def parse_variant(text: Column) -> Column:
    """The one JSON value that ``text`` is, as VARIANT; NULL if it is not one value and nothing else."""
    framed = F.try_parse_json(F.concat(F.lit("["), F.btrim(text, F.lit(BLANKS)), F.lit(f',"{_END}"]')))
    parts = F.try_variant_get(framed, "$", "array<variant>")
    whole = F.transform(F.array(parts), lambda p: F.when(
        (F.size(p) == 2) & F.coalesce(F.try_variant_get(F.get(p, F.lit(1)), "$", "string") == _END, F.lit(False)), F.get(p, F.lit(0))))
    return F.get(whole, F.lit(0))


def variant_items(spark: SparkSession, path: str, list_key: str, multi_line: bool = True, shape: str = "either",
                  on_bad: str = "fail") -> DataFrame:
    """``(_file, _position, _bad_text, _item variant)``: one row per list element and, in the same pass, one per bad document.

    Shapes and bad documents are those of ``sources.documents``; an element that is no object is a bad document's too.
    """
    if shape not in SHAPES or on_bad not in ("fail", "skip"):
        raise ValueError(f"shape is one of {SHAPES}, on_bad 'fail' or 'skip'")
    docs = spark.read.schema("value string").text(path, wholetext=multi_line)
    docs = docs.select(F.col("_metadata.file_path").alias(FILE), F.col("value").alias("text"), parse_variant(F.col("value")).alias("doc"))
    bare, named = F.try_variant_get("doc", "$", "array<variant>"), F.try_variant_get("doc", path_of(list_key), "array<variant>")
    items = {"list": bare, "named": named, "either": F.coalesce(bare, named)}[shape]
    empty = F.array().cast("array<variant>")
    nothing = (F.length(F.btrim("text", F.lit(BLANKS))) == 0) | F.coalesce(F.schema_of_variant("doc") == "OBJECT<>", F.lit(False))
    docs = docs.withColumn("items", F.when(nothing, empty).otherwise(items))
    is_object = F.forall("items", lambda i: i.isNull() | F.is_variant_null(i) | F.schema_of_variant(i).startswith("OBJECT<"))
    docs = docs.withColumn("items", F.when(is_object, F.col("items")))
    bad = F.array(F.lit(None).cast("variant"))
    if on_bad == "fail":
        bad = F.raise_error(F.concat(F.lit("bad document in "), F.col(FILE))).cast("array<variant>")
    return docs.select(FILE, F.when(F.col("items").isNull(), F.col("text")).alias(BAD_TEXT),
                       F.posexplode(F.coalesce("items", bad)).alias(POSITION, ITEM)).select(FILE, POSITION, BAD_TEXT, ITEM)


@dataclass(frozen=True)
class Field:
    """A discovered key: its spellings (the first names the column), its type, and whether the forms disagreed."""

    name: str
    spellings: tuple[str, ...]
    type: T.DataType
    forms: tuple[str, ...]
    conflict: bool


def _as_type(schema: str) -> T.DataType:
    """The Spark type a VARIANT schema text names: objects are structs, and VOID is what was only ever null."""
    return T.DataType.fromDDL(re.sub(r"(^|: |ARRAY<)OBJECT<", r"\1STRUCT<", schema))


def _ddl(t: T.DataType) -> str:
    """DDL of a type with every field name quoted."""
    if isinstance(t, T.StructType):
        return "struct<" + ",".join(f"{quoted(f.name)}:{_ddl(f.dataType)}" for f in t.fields) + ">"
    if isinstance(t, T.ArrayType):
        return f"array<{_ddl(t.elementType)}>"
    return t.simpleString()


def _is_number(t: T.DataType) -> bool:
    return isinstance(t, (T.IntegralType, T.DecimalType, T.DoubleType, T.FloatType))


def _wider_number(a: T.DataType, b: T.DataType) -> T.DataType:
    digits = {True: lambda t: t, False: lambda t: T.DecimalType(19, 0)}
    if isinstance(a, (T.DoubleType, T.FloatType)) or isinstance(b, (T.DoubleType, T.FloatType)):
        return T.DoubleType()
    if not isinstance(a, T.DecimalType) and not isinstance(b, T.DecimalType):
        return T.LongType()
    a, b = (digits[isinstance(t, T.DecimalType)](t) for t in (a, b))
    scale = max(a.scale, b.scale)
    whole = max(a.precision - a.scale, b.precision - b.scale)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def merge_types(a: T.DataType, b: T.DataType) -> tuple[T.DataType, bool]:
    """The type that holds both, and whether they disagree: text holds everything.

    Numbers widen, objects and lists merge inside, and a key that is only ever null (VOID) takes the other type.
    """
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return (b if isinstance(a, T.NullType) else a), False
    if a == b:
        return a, False
    if _is_number(a) and _is_number(b):
        return _wider_number(a, b), False
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields, conflict = {f.name: f.dataType for f in a.fields}, False
        for f in b.fields:
            fields[f.name], lost = merge_types(fields.get(f.name, T.NullType()), f.dataType)
            conflict |= lost
        return T.StructType([T.StructField(n, t, True) for n, t in sorted(fields.items())]), conflict
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element, conflict = merge_types(a.elementType, b.elementType)
        return T.ArrayType(element, True), conflict
    return T.StringType(), True


def _readable(t: T.DataType) -> tuple[T.DataType, bool]:
    """The type to read, and whether items of one form disagreed (VARIANT): these, nulls and empty objects are text."""
    if isinstance(t, T.StructType) and t.fields:
        parts = [(f.name, *_readable(f.dataType)) for f in t.fields]
        return T.StructType([T.StructField(n, p, True) for n, p, _ in parts]), any(c for *_, c in parts)
    if isinstance(t, T.ArrayType):
        element, conflict = _readable(t.elementType)
        return T.ArrayType(element, True), conflict
    if isinstance(t, (T.VariantType, T.NullType, T.StructType)):
        return T.StringType(), isinstance(t, T.VariantType)
    return t, False


def discover_schema(items: DataFrame, form: str) -> list[Field]:
    """The keys of all forms' items, each with one type: one aggregate pass, nothing declared.

    ``items`` has a ``form`` column and ``_item``.  Spark merges the items of a form
    (``schema_of_variant_agg``, combined in every task); the forms, one row each, are merged here.  Keys that differ
    in case only share a column, as Spark resolves names so.
    """
    rows = items.where(F.col(ITEM).isNotNull()).groupBy(form).agg(F.schema_of_variant_agg(ITEM).alias("schema"))
    found: dict[str, dict] = {}
    for row in sorted(bounded_rows(rows, "forms"), key=lambda r: r[form]):
        if not row["schema"].startswith("OBJECT<"):
            continue  # only nulls
        for field in _as_type(row["schema"]).fields:
            entry = found.setdefault(field.name.lower(), {"spellings": [], "type": T.NullType(), "forms": [], "conflict": False})
            if field.name not in entry["spellings"]:
                entry["spellings"].append(field.name)
            entry["type"], lost = merge_types(entry["type"], field.dataType)
            entry["conflict"] |= lost
            if row[form] not in entry["forms"]:
                entry["forms"].append(row[form])
    out = []
    for _, e in sorted(found.items()):
        readable, mixed = _readable(e["type"])
        out.append(Field(e["spellings"][0], tuple(e["spellings"]), readable, tuple(e["forms"]), e["conflict"] or mixed))
    return out


def read_fields(items: DataFrame, fields: Sequence[Field], carry: Sequence[str] = ()) -> DataFrame:
    """``items`` as columns, one per discovered field; absent keys are NULL."""
    def value(f: Field) -> Column:
        found = [F.try_variant_get(ITEM, path_of(s), _ddl(f.type)) for s in f.spellings]
        return reduce(lambda a, b: F.coalesce(a, b), found).alias(f.name)

    return items.select(*carry, *[value(f) for f in fields])


def schema_report(spark: SparkSession, fields: Sequence[Field]) -> DataFrame:
    """``(field, type, forms, conflict)``: what was found, and where forms or items disagreed about a type."""
    rows = [(f.name, f.type.simpleString(), ",".join(f.forms), f.conflict) for f in fields]
    return spark.createDataFrame(rows, "field string, type string, forms string, conflict boolean")


def read_mixed_forms(spark: SparkSession, paths: Mapping[str, str], list_key: str, tag: str = "SOURCE_FORM",
                     multi_line: bool = True, on_bad: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Survey forms with different, undeclared keys as one table tagged with the form, and its schema report (O-03, O-57).

    An item's own key named like the tag beats the tag.
    """
    frames = [variant_items(spark, path, list_key, multi_line, on_bad=on_bad).where(F.col(BAD_TEXT).isNull())
              .select(F.lit(form).alias("_form"), ITEM) for form, path in paths.items()]
    items = reduce(lambda a, b: a.unionByName(b), frames)
    fields = discover_schema(items, "_form")
    rows = read_fields(items, fields, carry=["_form"])
    own = next((f.name for f in fields if f.name.lower() == tag.lower()), None)
    tagged = F.col("_form") if own is None else F.coalesce(F.col(quoted(own)).cast("string"), F.col("_form"))
    kept = [F.col(quoted(f.name)) for f in fields if f.name != own]
    return rows.select(tagged.alias(tag), *kept), schema_report(spark, fields)
