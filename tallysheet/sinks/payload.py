"""Payload batching (O-15): one ordered list of rows cut into chunks of at most N values.

Each chunk becomes one request body ``{"dataValues": [...]}``.  The rows are
numbered over the whole order (range-partitioned, no one-task window), so
every chunk but the last has exactly ``size`` values, chunk order follows the
sort key, and the concatenation of the chunks is the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallysheet.functions.keys import quoted
from tallysheet.operators.ordering import global_ordinal

DEFAULT_SIZE = 30  # values per request


def payload_chunks(df: DataFrame, order_by: Sequence[str], items: Sequence[str], size: int = DEFAULT_SIZE,
                   list_key: str = "dataValues") -> DataFrame:
    """``(chunk, n, payload)``; ``order_by`` makes a total order, ``items`` are the fields of a value."""
    needed = list(dict.fromkeys([*order_by, *items]))
    numbered = global_ordinal(df.select(*[quoted(c) for c in needed]), [F.col(quoted(c)) for c in order_by], "_rn")
    item = F.struct("_rn", F.struct(*[F.col(quoted(c)) for c in items]).alias("_v"))
    grouped = numbered.groupBy(F.floor((F.col("_rn") - 1) / size).alias("chunk")).agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(item).alias("_items")
    )
    values = F.transform(F.array_sort("_items"), lambda x: x["_v"])
    return grouped.select("chunk", "n", F.to_json(F.struct(values.alias(list_key))).alias("payload"))


def write_payloads(chunks: DataFrame, path: str) -> None:
    """Request bodies as JSON lines in chunk order (what a sender task posts)."""
    chunks.orderBy("chunk").select(F.col("payload").alias("value")).write.mode("overwrite").text(path)
