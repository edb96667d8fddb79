"""Benchmark decontamination by winnowing (DataFrame functions only).

A *window* is ``SPAN`` consecutive words of a benchmark item; an item of fewer
words (but not none) is one window.  A document word inside any occurrence of
a window is hit.

Method.  Every word run of ``SPAN`` words holds ``SPAN - K + 1`` k-grams; its
fingerprint is the least k-gram hash among them (the winnowing minimum), so two
equal runs always have equal fingerprints and no shared run of ``SPAN`` words
can be missed.  Document fingerprints are joined with the benchmark's; where
one is found, the whole window is rebuilt and must equal a benchmark window
word for word (the extension of the hit), and neighbouring windows join into
longer spans.

The benchmark's windows are broadcast only when their counted bytes are within
``max_broadcast``.  Beyond it no text of a document moves before a hash of it is
known to be shared: documents shuffle the distinct hashes of their windows (of
items of fewer words too), those that share one give the places, and only these
are compared word for word.  Both joins salt a hash or window that fills the
corpus, such as an item of one frequent word.

Defined cases: null and word-less texts have no words and no hits; null or
word-less items match nothing; a repeated item counts once; an item without an
id marks words but is not listed; rows repeated in ``documents`` each get the
same result; other columns of either table are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.llm.staging import staged
from tallysheet.operators.skew import lookup_join, semi_join_keys

SPAN = 10
#: Words in a k-gram, a power of two; a fingerprint is the least of SPAN - K + 1 gram hashes.
K = 8
#: What parts words: everything in ASCII but digits and letters (A-Z are lower-cased later, word by word).
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of the benchmark's windows that each executor may hold, rows and hash tables included.
MAX_BROADCAST = 128 << 20
#: Bytes of a window's two rows (fingerprint, and window with item) besides its text.
ROW_BYTES = 128


def ascii_lower(col: Column) -> Column:
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def pieces_of(text: Column) -> Column:
    """Words in their own case; text that begins or ends with a gap has an empty first or last piece.

    Splitting is linear in the text; extracting all matches would copy the text at each match.
    """
    return F.split(F.coalesce(text, F.lit("")), GAP)


def n_words(pieces: Column) -> Column:
    empty = [(p == "").cast("int") for p in (F.get(pieces, F.lit(0)), F.element_at(pieces, -1))]
    # A text without words is one empty piece, or two if it is a gap.
    return F.greatest(F.size(pieces) - empty[0] - empty[1], F.lit(0))


def _word_hashes(words: Column) -> Column:
    # Full lower-casing is coarser than A-Z alone, so no match is lost; the extension step is exact.
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def _with_gram_hashes(df: DataFrame, k: int) -> DataFrame:
    """Adds ``g``: the hash of the k words from each word on, by doubling: each step hashes two neighbours' hashes."""
    df = df.withColumn("g", _word_hashes(F.col("words")))
    step = 1
    while step < k:
        df = df.withColumn("g", F.transform("g", lambda x, i: F.xxhash64(x, F.get(F.col("g"), i + step))))
        step *= 2
    return df


def _minima(g: Column, n: Column, span: int, k: int) -> Column:
    width = span - k + 1
    mins = F.transform(g, lambda _, i: F.least(*[F.get(g, i + j) for j in range(width)]))
    # The last windows would run over the end.
    return F.slice(mins, 1, F.greatest(n - (span - 1), F.lit(0)))


def _with_minima(df: DataFrame, span: int, k: int) -> DataFrame:
    """Adds ``fps``: the fingerprint of the window that starts at each word (no item has an empty one,
    so windows over the empty pieces at the ends match nothing).

    One column per step, each used more than once by the next: the optimiser then
    evaluates every array once a row and does not inline it into the lambdas.  The
    generators over these arrays are the outer kind, for which no filter on the
    array's size is inferred and pushed down through all of these steps.
    """
    if k & (k - 1) or k > span:
        raise ValueError("k must be a power of two and at most span")
    df = _with_gram_hashes(df.withColumn("n", F.size("words")), k)
    return df.withColumn("fps", _minima(F.col("g"), F.col("n"), span, k)).drop("g")


def _window_text(start: Column, length) -> Column:
    return ascii_lower(F.array_join(F.slice("words", start + 1, length), " "))


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text").withColumn("tk", F.xxhash64("text"))


def benchmark_windows(benchmark: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """``(win, fp, n_win, item_id)``: each window of each item once; ``fp`` is null for short items."""
    items = benchmark.select("item_id", F.array_remove(pieces_of(F.col("text")), "").alias("words"))
    items = _with_minima(items.where(F.size("words") > 0), span, k)
    long = items.where(F.col("n") >= span).select("item_id", "words", F.posexplode_outer("fps").alias("start", "fp"))
    long = long.select(_window_text(F.col("start"), span).alias("win"), "fp", F.lit(span).alias("n_win"), "item_id")
    short = items.where(F.col("n") < span).select(
        _window_text(F.lit(0), F.col("n")).alias("win"), F.lit(None).cast("long").alias("fp"),
        F.col("n").alias("n_win"), "item_id")
    return long.union(short).distinct()


def _counted(words: Column) -> Column:
    return n_words(words).cast("long").alias("n_words")


def _in_one_pass(docs: DataFrame, fps: DataFrame, span: int, k: int) -> DataFrame:
    """A row with ``n_words`` per document, and one for each window whose fingerprint is the benchmark's.

    The probe sits in the generator's own loop: the words ride along by reference, and only
    the rows that stay are written.
    """
    rows = _with_minima(docs.withColumn("words", pieces_of(F.col("text"))).drop("text"), span, k)
    first = F.array(F.lit(None).cast("long"))  # the document's own row stands before those of its windows
    rows = rows.select("doc_id", "tk", "words", F.posexplode_outer(F.concat(first, "fps")).alias("at", "fp"))
    rows = rows.join(F.broadcast(fps.withColumn("found", F.lit(True))), "fp", "left").where("at = 0 or found")
    own = F.col("at") == 0
    return rows.select("doc_id", "tk", F.when(own, _counted(F.col("words"))).alias("n_words"),
                       F.when(~own, F.col("at") - 1).alias("start"), F.when(~own, F.lit(span)).alias("n_win"),
                       F.when(~own, _window_text(F.col("at") - 1, span)).alias("win"))


def _in_two_passes(docs: DataFrame, wins: DataFrame, span: int, k: int, lengths: list[int]) -> DataFrame:
    """The same rows, and those of shorter windows, where the benchmark's windows are too many to broadcast.

    Hashes move first: the distinct ones of each document, then those of all windows of the
    documents that share one; texts join the places that are left, at most once a document.
    """
    words = docs.withColumn("words", pieces_of(F.col("text"))).drop("text")
    own = words.select("doc_id", "tk", _counted(F.col("words")))

    def place(start, length, fp):
        return F.struct(start.cast("int").alias("start"), F.lit(length).alias("n_win"), fp.alias("fp"))

    def short_places(length):
        starts = F.when(F.col("n") >= length, F.sequence(F.lit(0), F.greatest(F.col("n") - length, F.lit(0))))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")),
                           lambda i: place(i, length, F.xxhash64(_window_text(i, length))))

    runs = _with_minima(words, span, k)
    kinds = [F.transform("fps", lambda fp, i: place(i, span, fp)), *(short_places(m) for m in lengths)]
    runs = runs.select("doc_id", "tk", F.concat(*kinds).alias("runs"))
    keys = wins.select(F.coalesce("fp", F.xxhash64("win")).alias("fp")).distinct()
    some = runs.select("doc_id", "tk", F.explode_outer(F.array_distinct("runs.fp")).alias("fp"))
    some = semi_join_keys(some, keys, ["fp"], spread_by=["doc_id", "tk"])
    shared = staged(some.select(F.col("doc_id").alias("hit_id"), F.col("tk").alias("hit_tk"),
                                F.col("fp").alias("hit_fp")).distinct(), "benchmark-hashes")
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("tk") == F.col("hit_tk"))
    places = runs.join(shared.select("hit_id", "hit_tk").distinct(), same, "left_semi")
    places = places.select("doc_id", "tk", F.explode_outer("runs").alias("run")).select("doc_id", "tk", "run.*")
    places = places.join(shared, same & (F.col("fp") == F.col("hit_fp")), "left_semi")
    places = places.groupBy(F.col("doc_id").alias("hit_id"), F.col("tk").alias("hit_tk")).agg(
        F.collect_set(F.struct("start", "n_win")).alias("places"))
    found = words.join(places, same).select("doc_id", "tk", "words", F.explode_outer("places").alias("at"))
    found = found.select("doc_id", "tk", "at.start", "at.n_win", _window_text(F.col("at.start"), F.col("at.n_win")).alias("win"))
    return own.unionByName(found, allowMissingColumns=True)


def _short_candidates(docs: DataFrame, lengths: list[int]) -> DataFrame | None:
    """Every run of each short item length (lengths that occur in the benchmark; fewer than SPAN)."""
    out = None
    words = docs.withColumn("words", pieces_of(F.col("text"))).drop("text").withColumn("n", F.size("words"))
    for m in lengths:
        d = words.where(F.col("n") >= m).withColumn("starts", F.sequence(F.lit(0), F.col("n") - m))
        d = d.select("doc_id", "tk", "words", F.explode_outer("starts").alias("start"))
        d = d.select("doc_id", "tk", F.lit(None).cast("long").alias("n_words"), "start", F.lit(m).alias("n_win"),
                     _window_text(F.col("start"), m).alias("win"))
        out = d if out is None else out.union(d)
    return out


def contamination(documents: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K,
                  max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``(doc_id, n_words, n_hit, spans, item_ids)`` per row of ``documents``.

    ``spans`` is the sorted array of ``(start, end)`` ranges of the matched windows, in
    pieces of the text (:func:`pieces_of`), ``item_ids`` the sorted array of items (as strings).
    """
    wins = benchmark_windows(benchmark, span, k)
    # The size check is one pass over the benchmark, which does not grow with the documents; span rows at most.
    sizes = wins.groupBy("n_win").agg(F.sum(F.octet_length("win") + ROW_BYTES).alias("bytes"),
                                      F.bool_or(F.col("fp").isNull()).alias("short")).collect()
    lengths = sorted(r["n_win"] for r in sizes if r["short"])
    docs = _keyed(documents)
    known = wins.select("win", "item_id", F.lit(True).alias("known"))
    if sum(r["bytes"] for r in sizes) <= max_broadcast:
        fps = wins.where(F.col("fp").isNotNull()).select("fp").distinct()
        rows = _in_one_pass(docs, fps, span, k)
        short = _short_candidates(docs, lengths)
        if short is not None:
            rows = rows.union(short)
        hits = rows.join(F.broadcast(known), "win", "left")
    else:  # documents' own rows have no window: they stay out of the join
        rows = _in_two_passes(docs, wins, span, k, lengths)
        windows = lookup_join(rows.where("win is not null"), known, ["win"], spread_by=["doc_id", "tk", "start"])
        hits = rows.where("win is null").unionByName(windows, allowMissingColumns=True)
    span_of = F.struct("start", (F.col("start") + F.col("n_win")).alias("end"))
    found = hits.groupBy("doc_id", "tk").agg(
        F.max("n_words").alias("n_words"), F.count("n_words").alias("rows"),
        F.array_sort(F.collect_set(F.when(F.col("known"), span_of))).alias("spans"),
        F.array_sort(F.collect_set(F.when(F.col("known"), F.col("item_id").cast("string")))).alias("item_ids"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda a, s: F.struct((a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["upto"]), F.lit(0))).alias("n"),
                              F.greatest(s["end"], a["upto"]).alias("upto")),
        lambda a: a["n"])
    found = found.select("doc_id", "n_words", covered.cast("long").alias("n_hit"), "spans", "item_ids", "rows")
    # A row of its own for each of the rows that repeat one id and text.
    return found.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).drop("row", "rows")


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without the rows that hold a benchmark window; columns unchanged."""
    found = contamination(documents, benchmark).where("n_hit > 0").select(F.col("doc_id").alias("__hit")).distinct()
    return documents.join(found, documents["doc_id"].eqNullSafe(found["__hit"]), "left_anti")
