"""Merkle manifest of a dataset: leaf coordinates by bitmap rank, levels reduced through keyed slot arrays.

Every document is a leaf; per source, leaves ascend by ``doc_id``, and runs of ``FAN`` nodes
become one until a single node, the subroot, remains; the subroots, by source, give the root.

Leaves are not sorted.  A source's doc_ids are a bitmap of 64-bit words, of which
only those with a bit are kept (compressed bitmap): ``bit_or`` merges what the tasks hold.  A directory
adds up the popcounts before each word, in steps of ``2**DIRECTORY_BITS`` words, so that no
window spans a source.  A leaf's coordinate is its word's directory entry plus the popcount of the
word's lower bits.  Leaves then go to slots of blocks of ``BLOCK`` consecutive ones; a block reduces
its slot array by six levels at once, its result is a leaf of the next round, and so on.
On the way back every block learns its path to the root once, and makes the proofs of its leaves.

Scale: documents are read once (both leaf hashes); then 150 bytes per document are shuffled twice.
A source that holds a third of the rows is many words and many blocks; no task holds
more than a block.  A round divides the nodes by 729.

Defined cases: null ``doc_id`` is a leaf before all others of its source, and never
tampered with.  Rows that repeat a ``doc_id`` in a source are leaves next to each other, in the order of their
hashes; only words that hold such rows (more rows than bits) are numbered by a sort, in ranges, so
a repeated id with a third of the rows stays spread.  Null source is a source of its own and comes first; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallysheet.llm.staging import staged
from tallysheet.operators.ordering import global_ordinal
from tallysheet.operators.skew import lookup_join

FAN = 3
LEVELS_PER_ROUND = 6
BLOCK = FAN**LEVELS_PER_ROUND
DIRECTORY_BITS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _part(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column | None = None) -> Column:
    """Lowercase hex SHA-256 of a document's fields; ``text`` replaces the text column."""
    parts = [_part(text if c == "text" and text is not None else F.col(c)) for c in FIELDS]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaves(documents: DataFrame, tampered_text: Column | None = None) -> DataFrame:
    """``(doc_id, tree, leaf, changed)``: ``changed`` is the leaf of ``tampered_text``, null where that is the text.

    ``tree`` names the source so that plain string order is null first, then by UTF-8 bytes.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "n_chars", "text")
    changed = F.lit(None).cast("string")
    if tampered_text is not None:
        changed = F.when(~tampered_text.eqNullSafe(F.col("text")), leaf_hash(tampered_text))
    return rows.select("doc_id", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"),
                       leaf_hash().alias("leaf"), changed.alias("changed"))


def _from_bit(ones: int) -> Column:
    """``ones`` shifted to the doc_id's bit of its word: 1 is the bit itself, -1 that and all higher ones."""
    return F.call_function("shiftleft", F.lit(ones).cast("long"), F.col("doc_id").bitwiseAND(63).cast("int"))


def bitmap(rows: DataFrame) -> tuple[DataFrame, int]:
    """``(tree, word, bits, n_rows)``: the words of each source's doc_id bitmap that hold a bit, and the least ``doc_id >> 6``.

    Words count from 1 at that number; word 0 holds the null doc_ids.
    """
    words = rows.groupBy("tree", F.shiftright("doc_id", 6).alias("word")).agg(
        F.bit_or(F.coalesce(_from_bit(1), F.lit(1))).alias("bits"), F.count(F.lit(1)).alias("n_rows"))
    words = staged(words, "manifest-words")
    low = words.select(F.min("word")).first()[0] or 0
    return words.withColumn("word", _word(F.col("word"), low)), low


def _word(number: Column, low: int) -> Column:
    return F.coalesce(number - low + 1, F.lit(0)).cast("long")


def directory(words: DataFrame) -> DataFrame:
    """Adds ``before``: the rows of the same source in earlier words.

    Words are summed into pages of ``2**DIRECTORY_BITS`` words, these into larger ones, up to one page for
    all; each window spans one page.
    """
    high = words.select(F.max("word")).first()[0] or 0
    levels = [words.withColumnRenamed("word", "p0")]
    while high >> DIRECTORY_BITS:
        k, high = len(levels), high >> DIRECTORY_BITS
        page = F.shiftright(f"p{k - 1}", DIRECTORY_BITS).alias(f"p{k}")
        levels.append(staged(levels[-1].groupBy("tree", page).agg(F.sum("n_rows").alias("n_rows")), "manifest-pages"))
    known = None
    for k in reversed(range(len(levels))):
        page = F.shiftright(f"p{k}", DIRECTORY_BITS)
        inside = Window.partitionBy("tree", page).orderBy(f"p{k}").rowsBetween(Window.unboundedPreceding, -1)
        level = levels[k].withColumn("before", F.coalesce(F.sum("n_rows").over(inside), F.lit(0)))
        if known is not None:
            upper = known.select("tree", f"p{k + 1}", F.col("before").alias("upper"))
            level = level.withColumn(f"p{k + 1}", page).join(upper, ["tree", f"p{k + 1}"])
            level = level.withColumn("before", F.col("upper") + F.col("before")).drop("upper", f"p{k + 1}")
        known = level
    return known.withColumnRenamed("p0", "word")


def coordinates(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank``: the leaf's place among its source's leaves, from 0."""
    words, low = bitmap(rows)
    words = staged(directory(words), "manifest-directory")
    rows = rows.withColumn("word", _word(F.shiftright("doc_id", 6), low))
    found = lookup_join(rows, words, ["tree", "word"], spread_by=["leaf"])
    # A word of plain ids has a bit per row; that of the null ids has one bit in all.
    single = (F.col("n_rows") == F.bit_count("bits")) & ((F.col("word") > 0) | (F.col("n_rows") == 1))
    below = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(_from_bit(-1))))
    columns = [*[c for c in rows.columns if c != "word"], "rank"]
    plain = found.where(single).withColumn("rank", F.col("before") + F.coalesce(below, F.lit(0))).select(*columns)
    if words.where(~single).isEmpty():
        return plain
    # Words with repeated ids: a global number over their rows, less that of the word's first row.
    repeated = found.where(~single).drop("bits", "n_rows")
    repeated = staged(global_ordinal(repeated, ["tree", "word", "doc_id", "leaf", F.monotonically_increasing_id()], "number"),
                      "manifest-repeated")
    first = repeated.groupBy("tree", "word").agg(F.min("number").alias("first"))
    repeated = lookup_join(repeated, first, ["tree", "word"], spread_by=["number"])
    repeated = repeated.withColumn("rank", F.col("before") + F.col("number") - F.col("first"))
    return plain.unionByName(repeated.select(*columns))


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def reduce_slots(nodes: list[str], whole: bool) -> list[list[str]]:
    """The levels above ``nodes``: ``LEVELS_PER_ROUND`` of them, or for a ``whole`` tree until one node remains."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= LEVELS_PER_ROUND:
        last = levels[-1]
        levels.append([_h("".join(last[i:i + FAN])) for i in range(0, len(last), FAN)])
    return levels


def siblings(levels: list[list[str]], slot: int) -> list[tuple[str, str]]:
    """What stands left and right of the node in its run, level by level, as joined digests."""
    out = []
    for level in levels[:-1]:
        start = slot - slot % FAN
        out.append(("".join(level[start:slot]), "".join(level[slot + 1:start + FAN])))
        slot //= FAN
    return out


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    """The digest at the end of ``path``."""
    for left, right in path:
        digest = _h(left + digest + right)
    return digest


def _slot_arrays(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """``(tree, block, slots, whole)``: at most ``BLOCK`` nodes each, in order of their keys.

    ``whole``: the tree's only block, reduced until one node remains (a full one reduces the same in either way).
    """
    block = F.expr(f"rank div {BLOCK}").alias("block")
    slots = nodes.groupBy("tree", block).agg(F.sort_array(F.collect_list(F.struct("rank", *payload))).alias("slots"))
    return staged(slots.withColumn("whole", (F.col("block") == 0) & (F.size("slots") < BLOCK)), "manifest-slots")


def _block_hashes(slots: DataFrame) -> DataFrame:
    """``(tree, rank, digest)``: the node each block becomes."""
    def per_task(batches):
        for batch in batches:
            nodes, whole = batch.column("digests").to_pylist(), batch.column("whole").to_pylist()
            digests = [reduce_slots(n, w)[-1][0] for n, w in zip(nodes, whole)]
            yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("block"), pa.array(digests, pa.string())],
                                             ["tree", "rank", "digest"])

    rows = slots.select("tree", "block", F.col("slots.digest").alias("digests"), "whole")
    return rows.mapInArrow(per_task, "tree string, rank long, digest string")


_PATH = "array<struct<left:string,right:string>>"
_PATH_ARROW = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def tree_paths(nodes: DataFrame) -> DataFrame:
    """Trees over nodes ``(tree, rank, digest)``: ``(tree, rank, path, top)`` per node.

    ``path`` leads from the node to ``top``, its tree's last node.  For few nodes (blocks, sources): the
    leaves of documents take :func:`proofs`, where a path is not kept per row.
    """
    slots = _slot_arrays(nodes, ["digest"])
    upper = _upper_paths(slots)

    def per_task(batches):
        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            for tree, block, digests, whole, path, top in zip(*(cols[c] for c in ("tree", "block", "digests", "whole", "path", "top"))):
                levels = reduce_slots(digests, whole)
                rest = [(s["left"], s["right"]) for s in path]
                paths = [[{"left": x, "right": y} for x, y in siblings(levels, i) + rest] for i in range(len(digests))]
                n = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * n, pa.string()), pa.array(range(block * BLOCK, block * BLOCK + n), pa.int64()),
                     pa.array(paths, _PATH_ARROW), pa.array([top] * n, pa.string())], ["tree", "rank", "path", "top"])

    rows = upper.select("tree", "block", F.col("slots.digest").alias("digests"), "whole", "path", "top")
    made = rows.mapInArrow(per_task, f"tree string, rank long, path {_PATH}, top string")
    return staged(made, "manifest-paths")


def _upper_paths(slots: DataFrame) -> DataFrame:
    """``slots`` with each block's ``path`` to its tree's ``top``: reduced round by round until every tree is one block."""
    made = staged(_block_hashes(slots), "manifest-blocks")
    if made.where("rank > 0").isEmpty():
        done = made.select("tree", "rank", F.array().cast(_PATH).alias("path"), F.col("digest").alias("top"))
    else:
        done = tree_paths(made)
    return slots.join(done.withColumnRenamed("rank", "block"), ["tree", "block"])


def proofs(rows: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row of :func:`leaves`.

    ``proof_sha256`` hashes the siblings, level by level via the subroot to the root.  ``folded_root`` is computed from
    the changed leaf, where there is one, and the original siblings.
    """
    ranked = coordinates(rows).select("tree", "rank", F.col("leaf").alias("digest"), "doc_id", "changed")
    slots = _upper_paths(_slot_arrays(ranked, ["digest", "doc_id", "changed"]))
    slots = staged(slots, "manifest-leaf-blocks")
    subroots = slots.where("block = 0").select("tree", F.col("top").alias("digest"))
    order = global_ordinal(subroots, ["tree"], "number")
    forest = tree_paths(order.select(F.lit("").alias("tree"), (F.col("number") - 1).alias("rank"), "digest"))
    numbers = order.select("tree", (F.col("number") - 1).alias("rank"))
    forest = forest.select("rank", F.col("path").alias("root_path"), F.col("top").alias("root"))
    sources = staged(numbers.join(forest, "rank").drop("rank"), "manifest-sources")
    blocks = lookup_join(slots, sources, ["tree"], spread_by=["block"])

    def per_task(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                slot, whole, path, subroot, root_path, root = (batch.column(c)[i].as_py() for c in (
                    "slots", "whole", "path", "top", "root_path", "root"))
                levels = reduce_slots([s["digest"] for s in slot], whole)
                rest = [(s["left"], s["right"]) for s in path + root_path]
                shared = "".join(left + right for left, right in rest)
                out = {"doc_id": [], "leaf": [], "proof_sha256": [], "folded_root": [], "verified": []}
                for k, leaf in enumerate(slot):
                    own = siblings(levels, k)
                    folded = fold(leaf["changed"] or leaf["digest"], own + rest)
                    out["doc_id"].append(leaf["doc_id"])
                    out["leaf"].append(leaf["digest"])
                    out["proof_sha256"].append(_h("".join(left + right for left, right in own) + shared))
                    out["folded_root"].append(folded)
                    out["verified"].append(folded == root)
                n = len(slot)
                yield pa.RecordBatch.from_pydict({**out, "subroot": [subroot] * n, "root": [root] * n}, schema=_PROOFS)

    kept = blocks.select("slots", "whole", "path", "top", "root_path", "root")
    return kept.mapInArrow(per_task, "doc_id long, leaf string, subroot string, root string, proof_sha256 string,"
                                     "folded_root string, verified boolean")


_PROOFS = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                     ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])


def without_line_feeds() -> Column:
    """The text, its line feeds deleted where 2 divides crc32 of the decimal ``doc_id``."""
    even = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def manifest(documents: DataFrame, tampered_text: Column | None = None) -> DataFrame:
    """Leaf, subroot, root and proof of every document; see :func:`proofs`."""
    return proofs(staged(leaves(documents, tampered_text), "manifest-leaves"))
