"""N-gram Jaccard join by MinHash banding.

Two documents are linked if the Jaccard similarity of their sets of 5-word
n-grams (lower-cased, split at white space; a shorter text is one n-gram) is
``THRESHOLD`` or more.  The result has a row per document: the class it belongs
to (documents connected through links), how many documents it is linked to, and
the document whose n-gram set it shares.

Method
1. A map over texts hashes the n-grams and keeps ``bands * rows`` MinHash values;
   ``choose_bands`` takes the most selective split that reaches the target recall.
2. Documents with equal n-gram sets fall into one *copy class*; only one of each
   goes on, weighted by its size.
3. A shuffle on band hashes finds buckets with several classes.  Buckets with the
   same members (usual for small groups, which agree in most bands) are kept once.
4. The n-gram sets of the classes in such buckets are rebuilt from their texts
   and every pair of a bucket is verified on the full sets, inside the task; a pair
   that shares several buckets is counted in the first of them.  No pair leaves a
   task: it returns link counts, and a spanning forest of the links.
5. Connected components of the forests (label propagation with pointer jumping,
   staged after each round) give the classes.

Scale: a bucket whose members or n-grams exceed one task's share is dealt in
blocks, and its pairs of blocks go to different tasks, so neither memory nor
time of a task follows the bucket; nothing is capped.  Copies, of which a third
of all rows may be, are counted by map-side aggregation and never compared.

Defined cases: null and word-less texts have no n-grams: they are linked to
nothing and form their own class.  Rows repeated in ``documents`` are copies of
each other.  Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.llm.staging import staged

NGRAM = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
MAX_HASHES = 64
#: A task's share of a bucket: classes, and n-grams over all of them (8 bytes each).
BLOCK_CLASSES = 2_000
BLOCK_GRAMS = 2_000_000
_CHUNK_WORDS = 200_000


def choose_bands(threshold: float = THRESHOLD, recall: float = TARGET_RECALL,
                 max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """``(bands, rows)``: the most rows a band for which a pair at the threshold meets in some band
    with probability ``recall``, within ``max_hashes`` values; all of these are then spent on bands."""
    for rows in range(max_hashes, 0, -1):
        bands = max_hashes // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return bands, rows
    raise ValueError(f"recall {recall} at {threshold} needs more than {max_hashes} hashes")


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _gram_hashes(words: list[str], n: int) -> np.ndarray:
    """Hashes of the n-grams in order; the words are taken in chunks, so memory stays bounded."""
    if len(words) < n:
        if not words:
            return np.empty(0, np.uint64)
        h = xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass"), seed=len(words))
        return np.array([h], np.uint64)
    parts = [pd.util.hash_array(np.array(words[i:i + _CHUNK_WORDS], dtype=object), categorize=False)
             for i in range(0, len(words), _CHUNK_WORDS)]
    h = np.concatenate(parts)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out = _mix(out + h[j:len(h) - n + 1 + j])
    return out


def gram_set(text: str | None, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct 64-bit n-gram hashes of the whole text."""
    return np.unique(_gram_hashes((text or "").lower().split(), n))


def signature(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band."""
    rng = np.random.default_rng(20)
    a = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    low = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(grams), 4096):
        np.minimum(low, (grams[i:i + 4096, None] * a + b).min(axis=0), out=low)
    out = np.arange(bands, dtype=np.uint64)
    for r in range(rows):
        out = _mix(out + low.reshape(bands, rows)[:, r])
    return out.view(np.int64)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("tk", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                     ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])


def _keyed(documents: DataFrame) -> DataFrame:
    # tk tells apart the texts of rows that share a doc_id
    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tk"), "text")


def _signed(documents: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    def per_batch(batches):
        for batch in batches:
            out: dict[str, list] = {name: [] for name in _SIGNED.names}
            for doc_id, tk, text in zip(*(batch.column(i) for i in range(3))):
                grams = gram_set(text.as_py(), n)
                key = xxhash.xxh3_128_digest(grams.tobytes())
                got = (doc_id.as_py(), tk.as_py(), int.from_bytes(key[:8], "little", signed=True),
                       int.from_bytes(key[8:], "little", signed=True), len(grams),
                       signature(grams, bands, rows) if len(grams) else None)
                for column, value in zip(out.values(), got):
                    column.append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_SIGNED)

    return _keyed(documents).mapInArrow(
        per_batch, "doc_id long, tk long, k1 long, k2 long, n long, bands array<long>")


def _buckets(classes: DataFrame) -> DataFrame:
    """Members of buckets with several classes: ``(k, band, bucket, blocks)``, each set of members once."""
    members = classes.select("k", "n", F.posexplode("bands").alias("band", "bucket"))
    several = members.groupBy("band", "bucket").agg(
        F.count("*").alias("members"), F.sum("n").alias("grams"), F.bit_xor(F.xxhash64("k")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit(1), "k")).alias("x2")).where("members > 1")
    once = several.groupBy("members", "grams", "x1", "x2").agg(F.min(F.struct("band", "bucket")).alias("b"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_CLASSES), F.ceil(F.col("grams") / BLOCK_GRAMS))
    once = once.select("b.band", "b.bucket", blocks.cast("int").alias("blocks"))
    return members.join(once, ["band", "bucket"]).select("k", "band", "bucket", "blocks")


def _verify(threshold: float, bands: int):
    """Links among the classes of one bucket, or between two of its blocks."""
    def links(key, rows):
        band, _, first, second = key
        rows = rows.drop_duplicates(["k1", "k2"]).sort_values(["k1", "k2"], ignore_index=True)
        sets = [np.frombuffer(g, np.uint64) for g in rows["grams"]]
        size = np.array([len(s) for s in sets], np.int64)
        ends = np.cumsum(size)
        starts = ends - size
        ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
        shared = np.zeros((len(rows), bands), np.int64)  # the buckets that a class is in, by band
        held = np.zeros((len(rows), bands), bool)
        for i, (at, which) in enumerate(zip(rows["in_bands"], rows["in_buckets"])):
            shared[i, at], held[i, at] = which, True
        block, weight = rows["block"].to_numpy(), rows["copies"].to_numpy(np.int64)
        count, parent = np.zeros(len(rows), np.int64), np.arange(len(rows))

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        flag = np.zeros(ids.max() + 1, np.uint8)
        for i in range(len(rows) - 1):
            rest = slice(i + 1, len(rows))
            seen = ((shared[rest, :band] == shared[i, :band]) & held[rest, :band] & held[i, :band]).any(axis=1)
            lo, hi = np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i])
            ok = ~seen & (lo >= threshold * hi - 1e-9)
            if first != second:
                ok &= block[rest] != block[i]
            js = np.flatnonzero(ok) + i + 1
            if not len(js):
                continue
            flag[ids[starts[i]:ends[i]]] = 1
            if 4 * len(js) > len(rows) - i:
                inter = np.add.reduceat(flag[ids[starts[i + 1]:]], starts[i + 1:] - starts[i + 1], dtype=np.int64)
                inter = inter[js - i - 1]
            else:
                inter = np.array([int(flag[ids[starts[j]:ends[j]]].sum(dtype=np.int64)) for j in js])
            flag[ids[starts[i]:ends[i]]] = 0
            js = js[inter >= threshold * (size[js] + size[i] - inter) - 1e-9]
            count[i] += weight[js].sum()
            count[js] += weight[i]
            for j in js:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        linked = np.flatnonzero(count)
        top = [root(i) for i in linked]
        out = pd.DataFrame({"k1": rows["k1"].to_numpy()[linked], "k2": rows["k2"].to_numpy()[linked],
                            "links": count[linked], "r1": rows["k1"].to_numpy()[top], "r2": rows["k2"].to_numpy()[top]})
        return out

    return links


def _links(documents: DataFrame, classes: DataFrame, n: int, threshold: float, bands: int) -> DataFrame:
    """``(k, links, r)``: for each bucket a class has links in, their number and a class it is connected to."""
    inside = _buckets(classes).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("band", "bucket", "blocks")))
                                                .alias("at"))
    inside = inside.join(classes.select("k", "rep", "copies"), "k")
    texts = _keyed(documents)
    chosen = texts.join(inside, texts.doc_id.eqNullSafe(F.col("rep.doc_id")) & (texts.tk == F.col("rep.tk")))
    chosen = chosen.select("text", F.col("k.k1"), F.col("k.k2"), "copies", F.col("at.band").alias("in_bands"),
                           F.col("at.bucket").alias("in_buckets"), F.col("at.blocks").alias("in_blocks"))
    schema = pa.schema([("band", pa.int32()), ("bucket", pa.int64()), ("first", pa.int32()), ("second", pa.int32()),
                        ("block", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("copies", pa.int64()),
                        ("in_bands", pa.list_(pa.int32())), ("in_buckets", pa.list_(pa.int64())), ("grams", pa.binary())])

    def dealt(batches):
        for batch in batches:
            for row in (r for i in range(len(batch)) for r in batch.slice(i, 1).to_pylist()):
                grams = gram_set(row["text"], n).tobytes()
                out = []
                for band, bucket, blocks in zip(row["in_bands"], row["in_buckets"], row["in_blocks"]):
                    own = row["k1"] % blocks
                    for other in range(blocks):
                        out.append((band, bucket, min(own, other), max(own, other), own, row["k1"], row["k2"],
                                    row["copies"], row["in_bands"], row["in_buckets"], grams))
                        if len(out) * len(grams) > 8_000_000:  # a hot bucket's many blocks leave in parts
                            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out))), schema=schema)
                            out = []
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out))), schema=schema)

    dealt_rows = chosen.mapInArrow(
        dealt, "band int, bucket long, first int, second int, block int, k1 long, k2 long, copies long,"
               "in_bands array<int>, in_buckets array<long>, grams binary")
    found = dealt_rows.groupBy("band", "bucket", "first", "second").applyInPandas(
        _verify(threshold, bands), "k1 long, k2 long, links long, r1 long, r2 long")
    return found.select(F.struct("k1", "k2").alias("k"), "links", F.struct(F.col("r1").alias("k1"),
                                                                            F.col("r2").alias("k2")).alias("r"))


def components(edges: DataFrame) -> DataFrame:
    """``(k, label)``: the least node of the connected component, for every node of ``edges (k, r)``.

    Each round takes the least label of all neighbours, then the label of the
    label; the rounds follow the logarithm of the longest path.
    """
    both = staged(edges.union(edges.select(F.col("r").alias("k"), F.col("k").alias("r"))).distinct(), "ngram-edges")
    labels = staged(both.groupBy("k").agg(F.least("k", F.min("r")).alias("label")), "ngram-labels")
    while True:
        near = both.join(labels.select(F.col("k").alias("r"), F.col("label").alias("seen")), "r")
        near = near.groupBy("k").agg(F.min("seen").alias("seen"))
        stepped = labels.join(near, "k").select("k", F.col("label").alias("was"), F.least("label", "seen").alias("label"))
        jump = stepped.select(F.col("k").alias("label"), F.col("label").alias("next"))
        new = staged(stepped.join(jump, "label").select("k", "was", F.least("label", "next").alias("label")),
                     "ngram-labels")
        changed = new.where("label != was").limit(1).count()
        labels = new.drop("was")
        if not changed:
            return labels


def _rep() -> Column:
    """What the least of a class is chosen by: rows without an id come last, texts of one id are told apart."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tk")


def _members(documents: DataFrame, n: int, threshold: float, recall: float, max_hashes: int) -> DataFrame:
    """A row per row of ``documents``: the columns of :func:`similarity_classes`, ``tk`` and the class's ``top`` text."""
    bands, rows = choose_bands(threshold, recall, max_hashes)
    signed = staged(_signed(documents, n, bands, rows), "ngram-signatures")
    signed = signed.withColumn("k", F.struct("k1", "k2"))
    some = signed.where("n > 0")
    classes = staged(some.groupBy("k").agg(
        F.min(_rep()).alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("bands").alias("bands")), "ngram-classes")
    links = staged(_links(documents, classes, n, threshold, bands), "ngram-links")
    labels = components(links.select("k", "r"))
    tops = labels.join(classes.select("k", "rep"), "k").groupBy("label").agg(F.min("rep").alias("top"))
    grouped = labels.join(tops, "label").select("k", "top")
    grouped = grouped.join(links.groupBy("k").agg(F.sum("links").alias("links")), "k")
    known = classes.select("k", "rep", "copies").join(grouped, "k", "left")
    known = known.withColumn("top", F.coalesce("top", "rep"))
    # Staged, so that the join deals both sides anew and Spark can split the class of many copies.
    known = staged(known, "ngram-known")
    out = some.select("doc_id", "tk", "k").join(known, "k")
    out = out.select("doc_id", "tk", "top", F.col("top.doc_id").alias("class_id"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.col("rep.doc_id").alias("copy_of"), F.col("copies").alias("n_copies"))
    alone = signed.where("n = 0").select(
        "doc_id", "tk", _rep().alias("top"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("doc_id").alias("copy_of"), F.lit(1).cast("long").alias("n_copies"))
    return out.union(alone)


def similarity_classes(documents: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD,
                       recall: float = TARGET_RECALL, max_hashes: int = MAX_HASHES) -> DataFrame:
    """``(doc_id, class_id, n_links, copy_of, n_copies)`` per row of ``documents``.

    ``class_id`` and ``copy_of`` are the least ``doc_id`` of the class, and of the
    documents with the same n-gram set (null only if none of them has an id);
    ``n_links`` counts linked documents, copies included.
    """
    return _members(documents, n, threshold, recall, max_hashes).drop("tk", "top")


def one_of_each(documents: DataFrame) -> DataFrame:
    """One row of each class, that of least ``doc_id``; columns unchanged.

    A row without an id stays only where its class has no row with one; of several
    texts of one id, or without one, the text of least hash stays.  Rows that repeat both
    ``doc_id`` and text stay once.
    """
    keep = _members(documents, NGRAM, THRESHOLD, TARGET_RECALL, MAX_HASHES)
    keep = keep.where("doc_id <=> top.doc_id and tk = top.tk").select(
        F.col("doc_id").alias("__id"), F.col("tk").alias("__tk")).distinct()
    same = documents["doc_id"].cast("long").eqNullSafe(keep["__id"]) & (F.xxhash64(documents["text"]) == keep["__tk"])
    return documents.join(keep, same, "left_semi").dropDuplicates(["doc_id", "text"])
