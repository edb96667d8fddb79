"""Dynamic-width dimensions: option maps and pivots with generated columns (O-42..O-44).

The generated column list always comes from metadata (categories, groups):
it is collected - it is a list of names, not data - and passed to the
pivot explicitly, so Spark never has to discover pivot values with an
extra pass and the output schema is known before the job runs.
Every fold pre-aggregates per (row key, column) first, so a dimension row
with millions of links never collects more than one entry per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.functions.keys import merge_named, merged_names, quoted, sanitize
from tallysheet.session import MAX_METADATA_ROWS


def _head(carry: Sequence[str], order: str) -> Column:
    """Struct ordered by ``order`` first: ``min`` of it is the first row's ``carry`` columns."""
    return F.struct(F.col(order).alias("_ord"), *[F.col(quoted(c)).alias(c) for c in carry])


def option_entries(links: DataFrame, key: str, cat_uid: str, cat_name: str, opt_uid: str, opt_name: str,
                   order: str, carry: Sequence[str] = ()) -> DataFrame:
    """Per (row key, map key): the last value in ``order``, for both id->id and name->name entries.

    ``carry`` columns travel along as ``_head`` (the first row in ``order``).
    """
    entries = links.select(
        key, order, _head(carry, order).alias("_h"),
        F.inline(
            F.array(
                F.struct(F.col(cat_uid).alias("k"), F.col(opt_uid).alias("v")),
                F.struct(F.col(cat_name).alias("k"), F.col(opt_name).alias("v")),
            )
        ),
    )
    return entries.groupBy(key, "k").agg(F.max_by("v", order).alias("v"), F.min("_h").alias("_head"))


def fold_option_map(links: DataFrame, key: str, name: str, cat_uid: str, cat_name: str, opt_uid: str,
                    opt_name: str, order: str) -> DataFrame:
    """``key, name, options map`` (O-42): the first name in ``order`` wins, map entries last-wins.

    Two aggregations (per entry, then per key), no join: the name rides along.
    """
    entries = option_entries(links, key, cat_uid, cat_name, opt_uid, opt_name, order, carry=[name])
    return entries.groupBy(key).agg(
        F.min("_head").getField(name).alias(name),
        F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("options"),
    )


def map_as_text(m: Column, sep: str = ";") -> Column:
    """Deterministic text of a map: ``k=v`` entries sorted, joined by ``sep``."""
    pairs = F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), sep)


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def pivot_options(links: DataFrame, key: str | Sequence[str], categories: Sequence[tuple[str, str]], cat_uid: str,
                  opt_uid: str, opt_name: str, order: str, fill: str = "", carry: Sequence[str] = ()) -> DataFrame:
    """Per key: ``<category uid>`` = option uid and ``<category name>`` = option name (O-43).

    ``key`` may be several columns (uid and source).  ``categories`` is the (uid,
    name) metadata list; the last option in ``order`` wins; a category with no
    option is ``fill``.  Categories whose names sanitise alike share a column
    (``merge_named``).  ``carry`` columns come out as the values of the key's first
    row in ``order``.
    """
    keys = _keys(key)
    last = links.groupBy(*keys, cat_uid).agg(
        F.max_by(F.struct(F.col(opt_uid).alias("u"), F.col(opt_name).alias("n")), order).alias("o"),
        F.min(_head(carry, order)).alias("_h"),
    )
    uids = list(dict.fromkeys(uid for uid, _ in categories))
    cells = [F.first(F.when(F.col(cat_uid) == uid, F.col("o")), ignorenulls=True).alias(f"_c{i}")
             for i, uid in enumerate(uids)]
    wide = last.groupBy(*keys).agg(F.min("_h").alias("_h"), *cells)
    cols = [F.col("_h").getField(c).alias(c) for c in carry]
    pairs = []
    for uid, name in categories:
        cell = F.col(f"_c{uids.index(uid)}")
        pairs += [(uid, cell.getField("u").cast("string")), (sanitize(name), cell.getField("n").cast("string"))]
    merged = wide.select(*keys, *cols, *merge_named(pairs))
    return merged.fillna(fill, subset=[quoted(n) for n in merged_names(n for n, _ in pairs)])


#: Bits of one bitmap column: a long's without its sign.
WORD_BITS = 63
_WORD = "_bits"


def membership_words(links: DataFrame, key: str | Sequence[str], group_uids: Sequence[str], group_uid: str) -> DataFrame:
    """Per key, the groups it is in as a bitmap: ``_bits0``, ``_bits1``, ... of ``WORD_BITS`` groups each, in the list's order.

    One numeric aggregate over the links, whatever the number of groups (5,000 are 80 columns): the group's number is looked
    up in the list (broadcast, metadata-sized) and its bit is or-ed, first in every map task.  Links need not be distinct.
    A key whose groups are all unknown has no bit.
    """
    keys = _keys(key)
    numbers = [(u, i // WORD_BITS, 1 << (i % WORD_BITS)) for i, u in enumerate(dict.fromkeys(group_uids))]
    if len(numbers) > MAX_METADATA_ROWS:
        raise ValueError(f"more than {MAX_METADATA_ROWS} groups")
    spark = links.sparkSession
    known = spark.createDataFrame(numbers, f"{quoted(group_uid)} {links.schema[group_uid].dataType.simpleString()}, _word int, _bit long")
    marked = links.select(*keys, group_uid).join(F.broadcast(known), group_uid, "left")
    words = range(-(-len(numbers) // WORD_BITS))
    bits = [F.bit_or(F.when(F.col("_word") == w, F.col("_bit")).otherwise(F.lit(0).cast("long"))).alias(f"{_WORD}{w}") for w in words]
    return marked.groupBy(*keys).agg(*bits) if bits else marked.select(*keys).distinct()


def in_group(number: int) -> Column:
    """Whether the bitmap of :func:`membership_words` has the group of that number in the list."""
    return F.col(f"{_WORD}{number // WORD_BITS}").bitwiseAND(F.lit(1 << (number % WORD_BITS)).cast("long")) != 0


def group_count(words: DataFrame) -> Column:
    """In how many groups a key of :func:`membership_words` is."""
    return sum((F.bit_count(c) for c in words.columns if c.startswith(_WORD)), F.lit(0))


def membership_flags(links: DataFrame, key: str | Sequence[str], groups: Sequence[tuple[str, str]], group_uid: str,
                     flag: str = "t", fill: str = "") -> DataFrame:
    """Per key: ``<group uid>`` and ``<group name>`` = ``flag`` when a member, else ``fill`` (O-44).

    ``key`` may be several columns (uid and source); groups whose names sanitise
    alike share a column, flagged if either has the member.  Memberships are aggregated as bitmaps; the text flags
    are a projection of them.
    """
    keys = _keys(key)
    uids = list(dict.fromkeys(u for u, _ in groups))
    number = {u: i for i, u in enumerate(uids)}
    wide = membership_words(links, keys, uids, group_uid)
    pairs = []
    for uid, name in groups:
        shown = F.when(in_group(number[uid]), F.lit(flag))
        pairs += [(uid, shown), (sanitize(name), shown)]
    merged = wide.select(*keys, *merge_named(pairs))
    names = [quoted(n) for n in merged_names(n for n, _ in pairs)]
    return merged.fillna(fill, subset=names) if names else merged
