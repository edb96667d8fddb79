"""Write rows as landed JSON documents (the shape an API page arrives in).

Used to land data for the scans and by the payload sink.  Rows are grouped
into documents by a caller-given page key whose groups are bounded (for
example a key range), so no document - and no task - grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_documents(
    df: DataFrame,
    path: str,
    list_key: str | None,
    page: Column,
    partition_by: Sequence[str] = (),
    order_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """One JSON document per (partition, page) written as a line of text: ``{"<list_key>": [...]}``,
    or a bare list without a ``list_key``.

    ``partition_by`` columns become ``col=value`` folders (the unit id of a
    per-unit landing) and are left out of the items.
    """
    items = [c for c in df.columns if c not in partition_by]
    item = F.struct(*[F.col(f"`{c}`") for c in items])
    if order_by:
        # Sort key first, so array_sort orders the items by it.
        item = F.struct(F.struct(*order_by).alias("_k"), item.alias("_v"))
    grouped = df.groupBy(*partition_by, page.alias("_page")).agg(F.collect_list(item).alias("_items"))
    listed = F.col("_items")
    if order_by:
        listed = F.transform(F.array_sort(listed), lambda x: x["_v"])
    text = F.to_json(listed if list_key is None else F.struct(listed.alias(list_key))).alias("value")
    out = grouped.select(*partition_by, text)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.text(path)
