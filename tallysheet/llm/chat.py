"""Chat formatting after collapsing cumulative snapshots (DataFrame functions).

Logged conversations are often snapshots of one that grew.  The rolling hash of a
conversation after ``i`` turns is the XOR of a 128-bit hash of ``(i, role, text)`` over
its first ``i`` turns.  A conversation whose hash over all its turns is the hash of a
proper prefix of another is dropped (anti-join); of equal conversations the least
``conv_id`` stays.  What remains is rendered.

Scale: only hashes are shuffled until the last step.  Turns are numbered through a global range sort, then hashed and
rendered in blocks of ``BLOCK`` turns, with offsets added from one row per
block (texts are numbered only where a conversation has more than one): a conversation that holds a third of all turns is spread over tasks and
rendered in parts, whatever its turn numbers are (all null or all the same included).  Prefixes are made distinct
with map-side combining before the
anti-join, so a first turn that every conversation shares is one row.

Defined cases: turns without ``conv_id`` belong to no conversation; null ``turn`` numbers come
last; turns with one number are ordered by a hash of role and text; null role and text
differ from empty ones when compared and are rendered as ``unknown`` and as nothing;
template marks inside texts are broken up, so no text can end its own turn; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallysheet.llm.prefix_trie import numbered_turns
from tallysheet.llm.staging import staged
from tallysheet.operators.skew import semi_join_keys

BLOCK = 4096
OPEN, CLOSE, END = "<|", "|>", "<|end|>"


def _content(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(),
                      F.coalesce("text", F.lit("")))


def _numbered(conversations: DataFrame, *carried: str) -> DataFrame:
    """``(conv_id, n_turns, pos, block, h1, h2, *carried)``: turns in order, numbered from 1, in blocks of ``BLOCK``."""
    rows = conversations.where("conv_id is not null").select(
        "conv_id", "turn", _content(1).alias("h1"), _content(2).alias("h2"), *carried)
    rows = numbered_turns(rows.withColumn("tie", F.struct("h1", "h2")), nulls_first=False).drop("turn", "tie")
    return rows.withColumn("block", F.expr(f"(pos - 1) div {BLOCK}"))


def _before(value: str, agg) -> Column:
    """Over the blocks of a conversation in order: the aggregate of those before."""
    w = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(agg(value).over(w), F.lit(0))


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, pos, x1, x2)``: the rolling hash after each turn."""
    rows = staged(_numbered(conversations), "chat-turns").select(
        "conv_id", "n_turns", "block", "pos", F.xxhash64("pos", "h1").alias("h1"), F.xxhash64("pos", "h2").alias("h2"))
    totals = rows.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    # A row per block, staged: the join deals rows by block, not by conversation.
    totals = staged(totals.select("conv_id", "block", _before("b1", F.bit_xor).alias("o1"), _before("b2", F.bit_xor).alias("o2")),
                    "chat-prefixes")
    run = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("r1", F.bit_xor("h1").over(run)).withColumn("r2", F.bit_xor("h2").over(run))
    return rows.join(totals, ["conv_id", "block"]).select(
        "conv_id", "n_turns", "pos", F.col("r1").bitwiseXOR(F.col("o1")).alias("x1"),
        F.col("r2").bitwiseXOR(F.col("o2")).alias("x2"))


def maximal(conversations: DataFrame) -> DataFrame:
    """``(conv_id, n_turns)`` of the conversations that are no prefix of another."""
    hashes = staged(prefix_hashes(conversations), "chat-hashes")
    whole = hashes.where("pos = n_turns").groupBy("n_turns", "x1", "x2").agg(F.min("conv_id").alias("conv_id"))
    proper = hashes.where("pos < n_turns").select(F.col("pos").alias("n_turns"), "x1", "x2").distinct()
    return whole.join(proper, ["n_turns", "x1", "x2"], "left_anti").select("conv_id", "n_turns")


def render(conversations: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, part, text)``: the maximal conversations, in parts of ``BLOCK`` turns.

    A conversation of one part is put in order as it is collected; only longer ones are numbered with their texts.
    """
    kept = staged(maximal(conversations), "chat-maximal")
    safe = F.replace(F.coalesce("text", F.lit("")), F.lit(OPEN), F.lit("< |"))
    said = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit(CLOSE + "\n"), safe, F.lit(END + "\n"))
    order = F.struct(F.col("turn").isNull(), "turn", _content(1).alias("h1"), _content(2).alias("h2"), said.alias("said"))
    short = kept.where(F.col("n_turns") <= BLOCK)
    rows = conversations.select("conv_id", order.alias("t")).join(short, "conv_id")
    rows = rows.select("conv_id", "n_turns", F.lit(0).alias("part"), "t")
    out = _joined(rows)
    long = kept.where(F.col("n_turns") > BLOCK)
    if not long.isEmpty():
        turns = _numbered(semi_join_keys(conversations, long.select("conv_id"), ["conv_id"]), "role", "text")
        out = out.unionByName(_joined(turns.select(
            "conv_id", "n_turns", F.col("block").cast("int").alias("part"), F.struct("pos", said.alias("said")).alias("t"))))
    return out


def _joined(rows: DataFrame) -> DataFrame:
    """Turns ``t`` (order first, then ``said``) of each part as one text: ``BLOCK`` turns at most."""
    rows = rows.groupBy("conv_id", "n_turns", "part").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return rows.select("conv_id", "n_turns", "part", F.array_join(F.transform("turns", lambda t: t["said"]), "").alias("text"))
