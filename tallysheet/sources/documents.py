"""Landed JSON documents: metadata lists, per-unit data values, survey forms.

A page lands as one JSON document, either a bare list ``[item, ...]`` or an
object ``{"<list key>": [item, ...]}``; a folder of pages is one DataFrame
(pages merge by reading the folder).  Every scan takes a declared item
schema, so nothing is inferred and only the declared keys are parsed
(O-01..O-03, O-55, O-57).

No document is lost silently.  One that cannot be parsed whole (truncated, not
JSON, neither shape, without the list, with text or another value behind its end, with a typed leaf that does not fit) fails the scan by default; with
``on_bad="skip"`` it is left out and :func:`rejected_documents` lists it.
Blank documents (an empty download) and ``{}`` are valid and give no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHAPES = ("either", "list", "named")


#: What may stand around a document: JSON's blanks, other line ends, and a byte-order mark.
BLANKS = " \t\n\r\x0b\f\ufeff"


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _whole(body: Column, element: T.DataType, items) -> Column:
    """``items`` of the one JSON value that ``body`` is; NULL if it is not one value of that type and nothing else.

    The body is parsed once, as the only element of a list with a mark behind it: text after the value
    breaks the list, hides the mark or makes a second element, and a value of another type is a corrupt record.
    """
    schema = T.StructType([T.StructField("value", T.ArrayType(element, True)), T.StructField("end", T.BooleanType()),
                           T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(F.concat(F.lit('{"value":['), body, F.lit('],"end":true}')), schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return _once(parsed, lambda p: F.when(
        p["_corrupt_record"].isNull() & F.coalesce(p["end"], F.lit(False)) & (F.size(p["value"]) == 1),
        items(F.get(p["value"], F.lit(0)))))


def parse_documents(text: Column, list_key: str, item_schema: T.StructType, shape: str = "either") -> Column:
    """Items of a JSON document held as text (one response body per row); NULL for a bad document.

    ``shape`` says which layouts count: a bare ``list``, a ``named`` list, or ``either``.  Either is parsed
    once, by the shape its first character tells.  A typed leaf that does not fit makes the document a bad one in both.
    """
    if shape not in SHAPES:
        raise ValueError(f"shape must be one of {SHAPES}, not {shape!r}")
    listed = T.ArrayType(item_schema, True)
    named = T.StructType([T.StructField(list_key, listed, True)])

    def items(body: Column) -> Column:
        out = F.when((F.length(body) == 0) | (body.startswith("{") & body.rlike(r"^\{\s*\}$")), F.array().cast(listed))
        if shape != "named":
            out = out.when(body.startswith("["), _whole(body, listed, lambda value: value))
        if shape != "list":
            out = out.when(body.startswith("{"), _whole(body, named, lambda value: value[list_key]))
        return out

    return _once(F.btrim(text, F.lit(BLANKS)), items)


def parsed_files(spark: SparkSession, path: str, list_key: str, item_schema: T.StructType, multi_line: bool,
                 extra_fields: tuple[T.StructField, ...] = (), shape: str = "either") -> DataFrame:
    """``(file, *extra fields, text, items)`` of every document under ``path``; ``items`` is NULL for a bad one."""
    schema = T.StructType([T.StructField("value", T.StringType()), *extra_fields])
    docs = spark.read.schema(schema).text(path, wholetext=multi_line)
    return docs.select(F.col("_metadata.file_path").alias("file"), *[f.name for f in extra_fields],
                       F.col("value").alias("text"), parse_documents(F.col("value"), list_key, item_schema, shape).alias("items"))


def items_of(parsed: DataFrame, keep: tuple[str, ...], on_bad: str) -> DataFrame:
    """One row per list element; a bad document fails the query or is skipped."""
    if on_bad not in ("fail", "skip"):
        raise ValueError(f"on_bad must be 'fail' or 'skip', not {on_bad!r}")
    items = F.col("items")
    if on_bad == "fail":
        items = F.coalesce(items, F.raise_error(F.concat(F.lit("bad document in "), F.coalesce("file", F.lit("a stream")))))
    return parsed.select(*keep, F.explode(items).alias("_item")).select(*keep, "_item.*")


#: Columns of :func:`placed_items`: where an item stood, and the text of a document that gave none.
FILE, POSITION, BAD_TEXT = "_file", "_position", "_bad_text"


def placed_items(parsed: DataFrame, keep: tuple[str, ...] = (), on_bad: str = "skip") -> DataFrame:
    """Items with their place (``_file``, ``_position``) and, in the same pass, a row per bad document (``_bad_text``)."""
    if on_bad not in ("fail", "skip"):
        raise ValueError(f"on_bad must be 'fail' or 'skip', not {on_bad!r}")
    items = F.col("items")
    none = F.array(F.lit(None).cast(parsed.schema["items"].dataType.elementType))
    if on_bad == "fail":
        none = F.raise_error(F.concat(F.lit("bad document in "), F.coalesce("file", F.lit("a stream"))))
    rows = parsed.select(*keep, F.col("file").alias(FILE), F.when(items.isNull(), F.col("text")).alias(BAD_TEXT),
                         F.posexplode(F.coalesce(items, none)).alias(POSITION, "_item"))
    return rows.select(*keep, FILE, POSITION, BAD_TEXT, "_item.*")


def read_documents(
    spark: SparkSession,
    path: str,
    list_key: str,
    item_schema: T.StructType,
    multi_line: bool = False,
    extra_fields: tuple[T.StructField, ...] = (),
    shape: str = "either",
    on_bad: str = "fail",
) -> DataFrame:
    """Items of every document under ``path``: one row per list element (O-01, O-55).

    ``multi_line`` reads one document per file (pages as they are downloaded);
    the default reads one document per line, which splits across tasks.
    ``extra_fields`` are read next to the list (partition columns, say).
    """
    parsed = parsed_files(spark, path, list_key, item_schema, multi_line, extra_fields, shape)
    return items_of(parsed, tuple(f.name for f in extra_fields), on_bad)


def rejected_documents(spark: SparkSession, path: str, list_key: str, item_schema: T.StructType,
                       multi_line: bool = False, extra_fields: tuple[T.StructField, ...] = (),
                       shape: str = "either") -> DataFrame:
    """``(file, *extra fields, text)`` of the documents no item can be read from."""
    parsed = parsed_files(spark, path, list_key, item_schema, multi_line, extra_fields, shape)
    return parsed.where("items IS NULL").drop("items")


def read_unit_documents(
    spark: SparkSession,
    path: str,
    list_key: str,
    item_schema: T.StructType,
    unit_col: str,
    layout: str = "directory",
    multi_line: bool = False,
    shape: str = "either",
    on_bad: str = "fail",
) -> DataFrame:
    """Per-unit landed documents with the unit id taken from the path (O-02).

    ``layout="directory"``: ``<path>/<unit_col>=<id>/...`` (read as text, never
    type-inferred).  ``layout="file"``: ``<path>/<id>.json``, the id being the
    file name up to its first dot.  Units without a file, or with an empty
    one, contribute zero rows.
    """
    parsed = unit_files(spark, path, list_key, item_schema, unit_col, layout, multi_line, shape)
    return items_of(parsed, (unit_col,), on_bad)


def unit_files(spark: SparkSession, path: str, list_key: str, item_schema: T.StructType, unit_col: str,
               layout: str = "directory", multi_line: bool = False, shape: str = "either") -> DataFrame:
    """:func:`parsed_files` of per-unit documents, with the unit id taken from the path."""
    if layout == "directory":
        field = T.StructField(unit_col, T.StringType(), True)
        return parsed_files(spark, path, list_key, item_schema, multi_line, (field,), shape)
    parsed = parsed_files(spark, path, list_key, item_schema, multi_line, shape=shape)
    return parsed.withColumn(unit_col, F.regexp_extract(F.col("file"), r"([^/.]*)[^/]*$", 1))


def read_forms(spark: SparkSession, paths: Mapping[str, str], list_key: str, item_schema: T.StructType,
               multi_line: bool = True, on_bad: str = "fail") -> dict[str, DataFrame]:
    """The landed submissions of several survey forms: form name -> its items (O-03); tag them with ``tag_union``."""
    return {form: read_documents(spark, path, list_key, item_schema, multi_line, on_bad=on_bad)
            for form, path in paths.items()}


def tag_union(frames: Mapping[str, DataFrame], tag_col: str = "SOURCE_FORM") -> DataFrame:
    """Bag union by column name, each row tagged with its source; missing columns -> NULL (O-03, O-57)."""
    out: DataFrame | None = None
    for name, frame in frames.items():
        tagged = frame.select(F.lit(name).alias(tag_col), *[F.col(f"`{c}`") for c in frame.columns])
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no frames to union")
    return out
