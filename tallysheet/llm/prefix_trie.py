"""Prefix trie of conversations, built from vertical bitmaps.

Conversations are dealt, in order of ``conv_id``, to shards of ``SHARD``.  A shard indexes every (depth, turn) to the
bitset of its conversations that have that turn there.  Depth first, the bitset of a node intersected with a
posting of the next depth gives a child; its popcount is the child's number of members, its lowest bit
the least member, and the members whose last turn is there are the child's end list.  A node of several shards is merged
by the 128-bit hash of its prefix: popcounts are added, end lists follow each other in shard order.

Sums over subtrees need the merged trie, which may be as deep as a conversation is long.  Every node names its longest member
(the least id of several); nodes of one name are a path, and paths hang on each other like a tree of few levels.  Round by
round, paths on which nothing unfinished hangs add their totals to the path they hang on; what is left are
running sums along each path.

Scale: texts are read once, only hashes and lengths are shuffled.  Turns are numbered through a global range sort, a shard
works on ``DEPTHS`` depths at a time, starting from the groups with the same prefix, and sums along a path go by
``DEPTHS`` depths too: a conversation that holds a third of all turns is many small tasks.  Copies
are bits of their shards; a prefix that all share is one row per shard before the merge.  Joins
that look up a parent salt parents of many children.  The ids that end at one node are hashed as a sorted stream.  There are
as many rounds as paths hang below each other, at most the square root of twice the number of turns.

Defined cases: turns without ``conv_id`` belong to no conversation; turns of one number are ordered by the MD5 of role and
text; null roles and texts count as empty; repeated rows are turns of their own; other columns are ignored; without conversations
there is no node, not even the root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallysheet.llm.staging import staged
from tallysheet.operators.ordering import global_ordinal
from tallysheet.operators.skew import lookup_join

SHARD = 512
DEPTHS = 1024
HEAD_TURNS = 6
HEAD_BLOCK = 100
NODE = ["x1", "x2", "depth"]


def numbered_turns(conversations: DataFrame, nulls_first: bool = True) -> DataFrame:
    """``(conv_id, pos, n_turns, tie, *other columns)``: turns numbered from 1 in each conversation, hot ones as well.

    ``conversations`` needs ``conv_id``, ``turn`` and ``tie``, which orders turns of one number.
    """
    turn = F.col("turn").asc_nulls_first() if nulls_first else F.col("turn").asc_nulls_last()
    # Repeated rows are told apart by their position, so that they fill several ranges.
    rows = global_ordinal(conversations, [F.col("conv_id"), turn, F.col("tie"), F.monotonically_increasing_id()], "__g")
    spans = rows.groupBy("conv_id").agg((F.min("__g") - 1).alias("__before"), F.count(F.lit(1)).alias("n_turns"))
    rows = lookup_join(rows, spans, ["conv_id"], spread_by=["__g"])
    return rows.withColumn("pos", F.col("__g") - F.col("__before")).drop("__g", "__before")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, n_turns, tie, size)``: the turns' hashes (MD5 of role and text) and lengths in code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    tie = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", tie.alias("tie"), F.length(text).cast("long").alias("size"))
    return staged(numbered_turns(rows).drop("turn"), "trie-turns")


def head_length() -> Column:
    """How many first turns of conversation ``conv_id`` come from the first of its hundred."""
    return (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_TURNS).cast("int")


def with_shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, n_turns)`` and the turns of the rebuilt conversations: the first ``h`` turns of conversation
    ``conv_id - conv_id % 100``, then the own ones after the first ``h``.
    """
    base = F.col("conv_id") - F.col("conv_id") % HEAD_BLOCK
    heads = turns.where((F.col("conv_id") % HEAD_BLOCK == 0) & (F.col("pos") < HEAD_TURNS))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "tie", "size"))).alias("head"))
    known = turns.where("pos = 1").select("conv_id", F.col("n_turns").alias("own"), base.alias("base"), head_length().alias("h"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.expr("cast(array() as array<struct<pos:bigint,tie:string,size:bigint>>)"))
    known = staged(known.join(heads, "base", "left").select(
        "conv_id", "h", head.alias("head"), (F.size(head) + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("n_turns")),
        "trie-heads")
    shift = known.select("conv_id", (F.size("head") - F.col("h")).alias("shift"))
    own = lookup_join(turns.where(F.col("pos") > head_length()).drop("n_turns"), shift, ["conv_id"], spread_by=["pos"])
    own = own.select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "tie", "size")
    first = known.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.tie", "t.size")
    return known.select("conv_id", "n_turns"), own.unionByName(first)


def _shard_rows(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """``(shard, part, conv_id, n_turns, depth, h1, h2, size, o1, o2)``: what the shards walk.

    Row ``depth`` 0 stands for the root.  ``o1, o2`` is the prefix hash before the part's first depth.
    """
    shards = global_ordinal(convs, ["conv_id"], "number")
    shards = staged(shards.withColumn("shard", F.expr(f"(number - 1) div {SHARD}")).drop("number"), "trie-shards")
    rows = lookup_join(turns.withColumnRenamed("pos", "depth"), shards, ["conv_id"], spread_by=["depth"])
    rows = rows.select("shard", "conv_id", "n_turns", "depth", F.xxhash64("depth", "tie").alias("h1"),
                       F.xxhash64(F.lit("2"), "depth", "tie").alias("h2"), "size")
    zero = F.lit(0).cast("long")
    roots = shards.select("shard", "conv_id", "n_turns", *[zero.alias(c) for c in ("depth", "h1", "h2", "size")])
    rows = staged(rows.unionByName(roots).withColumn("part", F.expr(f"depth div {DEPTHS}")), "trie-rows")
    totals = rows.groupBy("conv_id", "part").agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("conv_id", "part", F.bit_xor("t1").over(before).alias("o1"), F.bit_xor("t2").over(before).alias("o2"))
    # Only parts behind the first have anything before them.
    rows = rows.join(offsets.where("part > 0"), ["conv_id", "part"], "left")
    return rows.withColumns({"o1": F.coalesce("o1", zero), "o2": F.coalesce("o2", zero)})


_LOCAL = pa.schema([(c, pa.int64()) for c in ("x1", "x2", "depth", "p1", "p2", "n_convs", "conv_id", "longest", "longest_id", "size")]
                   + [("ends", pa.list_(pa.int64()))])
_LOCAL_SQL = ",".join(f"{f.name} long" for f in _LOCAL if f.name != "ends") + ",ends array<long>"


def bits_of(bitset: int):
    """The numbers of the set bits, ascending."""
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def walk_shard(table: pa.Table) -> pa.Table:
    """The nodes of one shard and part, from vertical bitmaps, depth first."""
    data = {n: table.column(n).to_numpy() for n in ("conv_id", "n_turns", "depth", "h1", "h2", "size", "o1", "o2")}
    order = np.lexsort((data["depth"], data["conv_id"]))
    data = {n: a[order] for n, a in data.items()}
    ids, first = np.unique(data["conv_id"], return_index=True)
    spans = np.append(first, len(order))
    x1, x2 = data["h1"].copy(), data["h2"].copy()
    for i, j in zip(spans[:-1], spans[1:]):  # prefix hashes: running XOR from the part's beginning
        x1[i:j] = np.bitwise_xor.accumulate(x1[i:j]) ^ data["o1"][i]
        x2[i:j] = np.bitwise_xor.accumulate(x2[i:j]) ^ data["o2"][i]
    member = np.repeat(np.arange(len(ids)), np.diff(spans)).tolist()
    first, start = first.tolist(), data["depth"][first].tolist()
    depth, turn = data["depth"].tolist(), list(zip(data["h1"].tolist(), data["h2"].tolist()))
    x1, x2, size = x1.tolist(), x2.tolist(), data["size"].tolist()
    postings: dict = {}
    alive: dict = {}
    ended: dict = {}
    lengths: dict = {}
    groups: dict = {}
    for r, (m, d, t) in enumerate(zip(member, depth, turn)):
        postings[d, t] = postings.get((d, t), 0) | 1 << m
        alive[d] = alive.get(d, 0) | 1 << m
    ids_list = ids.tolist()
    for m, n in enumerate(data["n_turns"][first].tolist()):
        ended[n] = ended.get(n, 0) | 1 << m
        key = (int(data["o1"][first[m]]), int(data["o2"][first[m]]))
        groups[key] = groups.get(key, 0) | 1 << m
    lengths = sorted(ended.items(), reverse=True)
    out: dict = {f.name: [] for f in _LOCAL}
    stack = [(members, min(start), key) for key, members in groups.items()]
    while stack:
        members, d, parent = stack.pop()
        rest = members & alive.get(d, 0)
        while rest:
            m = (rest & -rest).bit_length() - 1
            row = first[m] + d - start[m]
            child = members & postings[d, turn[row]]
            rest ^= child
            n, bits = next((n, child & b) for n, b in lengths if child & b)
            node = (x1[row], x2[row])
            for name, value in zip(out, (*node, d, *parent, child.bit_count(), ids_list[m], n,
                                         ids_list[(bits & -bits).bit_length() - 1], size[row],
                                         [ids_list[i] for i in bits_of(child & ended.get(d, 0))])):
                out[name].append(value)
            stack.append((child, d + 1, node))
    return pa.Table.from_pydict(out, schema=_LOCAL)


def shard_nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of every shard: ``_LOCAL``."""
    return _shard_rows(convs, turns).groupBy("shard", "part").applyInArrow(walk_shard, _LOCAL_SQL)


def merged_nodes(local: DataFrame) -> DataFrame:
    """A row per node of the whole trie, with its parent's least member and its path."""
    longest = F.max(F.struct("longest", (-F.col("longest_id")).alias("id"))).alias("longest")
    nodes = local.groupBy(*NODE).agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), longest, F.max("size").alias("size"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = staged(nodes.withColumn("path", -F.col("longest.id")).drop("longest"), "trie-merged")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = staged(nodes.join(children, NODE, "left").fillna(0, ["n_children"]), "trie-counted")
    parents = nodes.where("n_children > 0").select(
        F.col("x1").alias("p1"), F.col("x2").alias("p2"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"), F.col("path").alias("parent_path"))
    linked = lookup_join(nodes, parents, ["p1", "p2", "depth"], "left", spread_by=["x1"])
    saved = ((F.col("n_convs") - 1) * F.col("size")).alias("saved")
    return staged(linked.select(*NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "path", "parent_path", saved),
                  "trie-linked")


def hanging_totals(nodes: DataFrame) -> DataFrame:
    """``(path, depth, saved_below, leaves_below)``: totals of the paths that hang on a node, all that hangs on them included."""
    own = nodes.groupBy("path").agg(F.sum("saved").alias("saved"))
    tops = nodes.where("parent_path IS NULL OR parent_path <> path").select("path", "parent_path", (F.col("depth") - 1).alias("at"))
    hanging = tops.where("parent_path IS NOT NULL").groupBy(F.col("parent_path").alias("path")).agg(F.count(F.lit(1)).alias("open"))
    # A path ends at its longest member's last turn, so it has one leaf.
    active = tops.join(own, "path").join(hanging, "path", "left").fillna(0, ["open"]).withColumn("leaves", F.lit(1).cast("long"))
    finished = []
    while True:
        active = staged(active, "trie-paths")
        done, rest = active.where("open = 0"), active.where("open > 0")
        finished.append(done)
        if rest.isEmpty():
            break
        sums = done.groupBy(F.col("parent_path").alias("path")).agg(
            F.sum("saved").alias("s"), F.sum("leaves").alias("l"), F.count(F.lit(1)).alias("c"))
        active = rest.join(sums, "path", "left").fillna(0, ["s", "l", "c"]).select(
            "path", "parent_path", "at", (F.col("saved") + F.col("s")).alias("saved"),
            (F.col("open") - F.col("c")).alias("open"), (F.col("leaves") + F.col("l")).alias("leaves"))
    whole = finished[0]
    for done in finished[1:]:
        whole = whole.unionByName(done)
    return whole.where("parent_path IS NOT NULL").groupBy(F.col("parent_path").alias("path"), F.col("at").alias("depth")).agg(
        F.sum("saved").alias("saved_below"), F.sum("leaves").alias("leaves_below"))


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``saved_tokens`` and ``n_leaves`` over each node's subtree."""
    nodes = nodes.join(hanging_totals(nodes), ["path", "depth"], "left").fillna(0, ["saved_below", "leaves_below"])
    nodes = nodes.select(*[c for c in nodes.columns if c not in ("saved", "saved_below", "leaves_below")],
                         (F.col("saved") + F.col("saved_below")).alias("s"),
                         ((F.col("n_children") == 0).cast("long") + F.col("leaves_below")).alias("l"),
                         F.expr(f"depth div {DEPTHS}").alias("part"))
    nodes = staged(nodes, "trie-values")
    parts = nodes.groupBy("path", "part").agg(F.sum("s").alias("ps"), F.sum("l").alias("pl"))
    later = Window.partitionBy("path").orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("path", "part", F.sum("ps").over(later).alias("ps"), F.sum("pl").over(later).alias("pl")).where("ps IS NOT NULL")
    below = Window.partitionBy("path", "part").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    nodes = nodes.withColumn("s", F.sum("s").over(below)).withColumn("l", F.sum("l").over(below))
    nodes = nodes.join(parts, ["path", "part"], "left").fillna(0, ["ps", "pl"])
    return nodes.withColumn("saved_tokens", F.col("s") + F.col("ps")).withColumn("n_leaves", F.col("l") + F.col("pl"))


def end_hashes(local: DataFrame) -> DataFrame:
    """``(x1, x2, depth, ends_sha256)``: SHA-256 of the ids that end at a node, ascending, comma-joined.

    Shards follow each other in ids, so a node's lists in order of their first id are one ascending list; it
    is hashed as it streams by.
    """
    lists = local.where("size(ends) > 0").select(*NODE, "ends")
    lists = lists.repartition("x1", "x2", "depth").sortWithinPartitions("x1", "x2", "depth", F.get("ends", F.lit(0)))

    def per_task(batches):
        current, digest = None, None
        for batch in batches:
            done: dict = {"x1": [], "x2": [], "depth": [], "ends_sha256": []}
            for *node, ends in zip(*(batch.column(i).to_pylist() for i in range(4))):
                joined = ",".join(map(str, ends)).encode()
                if node == current:
                    digest.update(b"," + joined)
                    continue
                if current is not None:
                    for name, value in zip(done, (*current, digest.hexdigest())):
                        done[name].append(value)
                current, digest = node, hashlib.sha256(joined)
            yield pa.RecordBatch.from_pydict(done, schema=_ENDS)
        if current is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(_ENDS.names, (*current, digest.hexdigest())))], schema=_ENDS)

    return lists.mapInArrow(per_task, "x1 long, x2 long, depth long, ends_sha256 string")


_ENDS = pa.schema([("x1", pa.int64()), ("x2", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])


def trie(conversations: DataFrame, shared_heads: bool = True) -> DataFrame:
    """A row per node: ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``.

    With ``shared_heads`` the conversations are rebuilt first (:func:`with_shared_heads`).
    """
    turns = turn_rows(conversations)
    if shared_heads:
        convs, turns = with_shared_heads(turns)
    else:
        convs = turns.where("pos = 1").select("conv_id", "n_turns")
        turns = turns.select("conv_id", "pos", "tie", "size")
    local = staged(shard_nodes(convs, turns), "trie-local")
    nodes = subtree_sums(merged_nodes(local)).join(end_hashes(local), NODE, "left")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
