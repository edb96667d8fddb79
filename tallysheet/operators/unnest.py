"""Many-to-many unnesting of metadata documents (O-54).

A metadata object lists its children (``{"id": .., "categories": [{"id": ..}, ..]}``);
the link table gets one row per (parent, child) with the parent's mapped
columns, the source key and the child's mapped columns.  A parent without
the list yields no rows (plain ``explode``).  Links are insert-only, so the
rows are then added with ``insert_new`` (ON CONFLICT DO NOTHING).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallysheet.functions.keys import quoted, source_key
from tallysheet.operators.mapping import MappingSpec, mapping_columns


def explode_links(docs: DataFrame, parent_spec: MappingSpec, list_key: str, child_spec: MappingSpec,
                  source_url: str | None = None, source_col: str = "sourceid") -> DataFrame:
    parent_cols = mapping_columns(parent_spec, docs.schema)
    extra = [source_key(source_url).alias(source_col)] if source_url is not None else []
    exploded = docs.select(*parent_cols, *extra, F.explode(F.col(quoted(list_key))).alias("_child"))
    child_cols = mapping_columns({f"_child.{k}": v for k, v in child_spec.items()},
                                 exploded.select("_child").schema)
    keep = [c for c in exploded.columns if c != "_child"]
    return exploded.select(*[quoted(c) for c in keep], *child_cols)
