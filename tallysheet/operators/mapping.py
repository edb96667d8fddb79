"""Mapping projections: declared keys -> typed staging columns (O-17..O-22).

A mapping spec is the dictionary the ingest tasks are configured with::

    {"id": {"column": "uid", "type": "str"},
     "lastUpdated": {"column": "lastupdated", "type": "timestamp"},
     "categoryCombo": {"nestedColumns": {"id": {"column": "categorycomboid", "type": "str"}}}}

It compiles to one ``select`` list: rename + cast every declared key, drop
the rest.  The same spec also yields the read schema for landed JSON, so
the scan never infers and only the declared keys are parsed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.functions.casts import cast_as, spark_type
from tallysheet.functions.keys import quoted, source_key

MappingSpec = Mapping[str, Mapping]


def _path(key: str) -> list[str]:
    return key.split(".")


def read_schema(spec: MappingSpec, raw_types: Mapping[str, T.DataType] | None = None) -> T.StructType:
    """JSON read schema holding only the mapped keys (leaves as text unless typed in ``raw_types``).

    A dotted key (``parent.id``) reads a field of a nested object.
    """
    raw_types = raw_types or {}
    root: dict = {}
    for key, entry in spec.items():
        node = root
        parts = _path(key)
        for part in parts[:-1]:
            node = node.setdefault(part, {})
        if "nestedColumns" in entry:
            leaf = node.setdefault(parts[-1], {})
            for nested in entry["nestedColumns"]:
                leaf[nested] = raw_types.get(f"{key}.{nested}", T.StringType())
        else:
            node[parts[-1]] = raw_types.get(key, T.StringType())

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [
                T.StructField(name, build(child) if isinstance(child, dict) else child, True)
                for name, child in node.items()
            ]
        )

    return build(root)


def _field_type(schema: T.StructType, parts: Sequence[str]) -> T.DataType | None:
    current: T.DataType = schema
    for part in parts:
        if not isinstance(current, T.StructType) or part not in current.fieldNames():
            return None
        current = current[part].dataType
    return current


def mapping_columns(spec: MappingSpec, schema: T.StructType) -> list[Column]:
    """The compiled ``select`` list; keys absent from ``schema`` become typed NULLs."""
    out: list[Column] = []
    for key, entry in spec.items():
        parts = _path(key)
        if "nestedColumns" in entry:
            for nested, target in entry["nestedColumns"].items():
                out.append(_mapped(schema, [*parts, nested], target))
        else:
            out.append(_mapped(schema, parts, entry))
    return out


def _mapped(schema: T.StructType, parts: Sequence[str], target: Mapping) -> Column:
    kind = target.get("type", "str")
    source_type = _field_type(schema, parts)
    if source_type is None:
        return F.lit(None).cast(spark_type(kind)).alias(target["column"])
    col = F.col(".".join(quoted(p) for p in parts))
    return cast_as(col, kind, source_type).alias(target["column"])


def apply_mapping(df: DataFrame, spec: MappingSpec, source_url: str | None = None,
                  source_col: str = "sourceid", carry: Sequence[str] = ()) -> DataFrame:
    """Rename + cast the declared keys, drop the rest, and stamp the source key; ``carry`` columns come along as they are."""
    cols = mapping_columns(spec, df.schema)
    if source_url is not None:
        cols.append(source_key(source_url).alias(source_col))
    return df.select(*cols, *[F.col(quoted(c)) for c in carry])


def malformed_cells(spec: MappingSpec, schema: T.StructType) -> Column:
    """Array of ``column: raw text`` for the cells that hold text which is no value of their declared type.

    Blank text counts as no value.
    """
    found = []
    for key, entry in spec.items():
        parts = _path(key)
        targets = [([*parts, n], t) for n, t in entry["nestedColumns"].items()] if "nestedColumns" in entry else [(parts, entry)]
        for path, target in targets:
            if isinstance(_field_type(schema, path), T.StringType) and spark_type(target.get("type", "str")) != T.StringType():
                raw = F.col(".".join(quoted(p) for p in path))
                bad = (F.length(F.btrim(raw)) > 0) & _mapped(schema, path, target).isNull()
                found.append(F.when(bad, F.concat(F.lit(target["column"] + ": "), raw)))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def spread_sections(
    df: DataFrame,
    sections: Sequence[str],
    tag: tuple[str, Column] | None = None,
) -> DataFrame:
    """Merge struct columns ``sections`` into one flat row (O-21).

    Sections are applied in order and a later section wins a name clash; the
    ``tag`` column (e.g. the source form) is applied first, so any section
    field of the same name beats it.  Presence decides: a section that is there
    wins with NULL as well, one that is missing leaves the earlier values in place.
    Names are compared without case, as Spark resolves them.
    """
    present = [s for s in sections if s in df.columns]
    holders: dict[str, list[tuple[str, str]]] = {}  # lower-case name -> (section, field) in order
    for section in present:
        for field in df.schema[section].dataType.fieldNames():
            holders.setdefault(field.lower(), []).append((section, field))
    cols: list[Column] = []
    if tag is not None and tag[0].lower() not in holders:
        cols.append(tag[1].alias(tag[0]))
    for lower, owners in holders.items():
        tagged = tag is not None and tag[0].lower() == lower
        value = tag[1] if tagged else None
        for section, field in owners:
            own = F.col(f"{quoted(section)}.{quoted(field)}")
            earlier = F.lit(None) if value is None else value
            value = F.when(F.col(quoted(section)).isNotNull(), own).otherwise(earlier)
        cols.append(value.alias(tag[0] if tagged else owners[0][1]))
    return df.select(*cols)
