"""Line dedup: winnowing over line hashes.

A *window* is the shortest stretch of non-blank lines, from some line on, that
holds ``MIN_LINES`` lines or ``MIN_WORDS`` words.  A window is *repeated* if
the same lines stand at an earlier place, places being ordered by ``(doc_id,
line)``.  Every line of a repeated window goes; overlapping windows join into
runs.  A run may end with short lines that no window inside it holds (behind a
line of ``MIN_WORDS`` words, or at the end of the text).  With ``whole_runs``, as
the query and the pipeline have it, each window is extended over them as far as
the same lines follow at an earlier place: a later copy of a run of any length
that holds a window goes whole, and its first occurrence stays.  Without it
windows alone count.  Inside one document only lines behind the earlier place go.

Method.  The fingerprint of a window is its least line hash (the rightmost of
equal ones).  Equal windows have equal fingerprints, so only fingerprints that
occur more than once are followed: at each of their positions the match is
extended both ways through the windows around it, which are compared by a hash
of all their lines.  To the left a run needs no extension, as a window starts at
each of its lines.  To the right a window is followed by its *stretches*, which
start with it and end before the window of the next line does; each has a hash of
its own, so any earlier place can match, not only the window's first.  Starts and
ends only grow, so a text has at most one stretch per line besides its windows.
Every repeated window and stretch is found, none is reported wrongly (128-bit
hashes), and text that shares nothing is left after the first step.

Scale: the first pass is a map over texts; only hashes and positions are
shuffled.  Counting a fingerprint and finding a window's first place are
aggregates with map-side combining, so a line that a third of all documents
hold is one row per task.  Joins back to them are plain shuffle joins that Spark
splits where a key is hot.

Defined cases: lines are compared without surrounding blanks; blank lines
neither count nor interrupt a run, and go only between two lines that go; null
text stays null; a document without ``doc_id`` comes before all others; rows
repeated under one ``doc_id`` hold each place once, so neither row loses lines
to the other.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallysheet.llm.staging import staged

MIN_LINES = 3
MIN_WORDS = 50

_OCCURRENCE = pa.schema([
    ("doc_id", pa.int64()), ("tk", pa.int64()), ("fp", pa.int64()),
    ("wins", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])))])


def line_windows(text: str, min_lines: int, min_words: int):
    """``[(start, end, h1, h2, fingerprint position)]``, the line hashes and the digests, over the non-blank lines."""
    lines = [s for s in (x.strip() for x in text.split("\n")) if s]
    digest = [xxhash.xxh3_128_digest(s.encode("utf-8", "surrogatepass")) for s in lines]
    hashes = [int.from_bytes(x[:8], "little", signed=True) for x in digest]
    words = [len(s.split()) for s in lines]
    out = []
    end = total = 0
    for start in range(len(lines)):
        end = max(end, start)
        while end < len(lines) and end - start < min_lines and total < min_words:
            total += words[end]
            end += 1
        if end - start < min_lines and total < min_words:
            break  # the rest of the text is shorter than a window
        whole = xxhash.xxh3_128_digest(b"".join(digest[start:end]))
        least = min(range(start, end), key=lambda i: (hashes[i], -i))
        out.append((start, end, int.from_bytes(whole[:8], "little", signed=True),
                    int.from_bytes(whole[8:], "little", signed=True), least))
        total -= words[start]
    return out, hashes, digest


def stretches(wins, digest, i: int) -> list[dict]:
    """Window ``i`` and those longer ones from its start on that end before the next window does."""
    start, end, h1, h2, _ = wins[i]
    out = [{"s": start, "e": end, "h1": h1, "h2": h2}]
    upto = wins[i + 1][1] if i + 1 < len(wins) else len(digest) + 1
    if end + 1 < upto:
        state = xxhash.xxh3_128(b"".join(digest[start:end]))
        for e in range(end, upto - 1):
            state.update(digest[e])
            whole = state.digest()
            out.append({"s": start, "e": e + 1, "h1": int.from_bytes(whole[:8], "little", signed=True),
                        "h2": int.from_bytes(whole[8:], "little", signed=True)})
    return out


def _occurrences(documents: DataFrame, min_lines: int, min_words: int, whole_runs: bool) -> DataFrame:
    """A row for each fingerprint position: ``(doc_id, fp, windows that hold the position)``."""
    def per_batch(batches):
        for batch in batches:
            for doc_id, tk, text in zip(*(batch.column(i) for i in range(3))):
                if not text.is_valid:
                    continue
                wins, hashes, digest = line_windows(text.as_py(), min_lines, min_words)
                rows = []
                for p in sorted({w[4] for w in wins}):
                    # windows start at each line and have min_lines lines at most
                    near = [i for i in range(max(0, p - min_lines + 1), min(p + 1, len(wins))) if p < wins[i][1]]
                    # a stretch repeats only where its window does, so the window's own position names it
                    found = [x for i in near
                             for x in stretches(wins, digest, i)[:None if whole_runs and wins[i][4] == p else 1]]
                    rows.append({"doc_id": doc_id.as_py(), "tk": tk.as_py(), "fp": hashes[p], "wins": found})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_OCCURRENCE)

    return _keyed(documents).select("doc_id", "tk", "text").mapInArrow(
        per_batch, "doc_id long, tk long, fp long, wins array<struct<s:int,e:int,h1:long,h2:long>>")


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tk"), "text")


def repeated_ranges(documents: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS,
                    whole_runs: bool = False) -> DataFrame:
    """``(doc_id, tk, ranges)``: the ``[s, e)`` ranges of non-blank lines that repeat an earlier run.

    ``tk`` is the hash of the text: it parts rows with one ``doc_id`` but different texts.
    """
    occ = staged(_occurrences(documents, min_lines, min_words, whole_runs), "line-fingerprints")
    # Staged, so that the join deals both sides anew and Spark can split a hot fingerprint.
    shared = staged(occ.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "line-shared")
    around = (occ.join(shared, "fp", "left_semi").select("doc_id", "tk", F.explode("wins").alias("w"))
              .select("doc_id", "tk", "w.*").distinct())  # neighbouring positions name the same window
    around = staged(around, "line-windows")
    first = staged(around.groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "tk", "s", "e")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "line-first")
    later = around.join(first, ["h1", "h2"]).where(F.struct("doc_id", "tk", "s", "e") > F.col("first"))
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tk") == F.col("first.tk"))
    later = later.select("doc_id", "tk", F.when(own, F.greatest("s", "first.e")).otherwise(F.col("s")).alias("s"), "e")
    return later.where("s < e").groupBy("doc_id", "tk").agg(
        F.array_sort(F.collect_set(F.struct("s", "e"))).alias("ranges"))


def drop_ranges(text: str, ranges) -> tuple[str, int]:
    """The text without the lines in ``ranges`` (numbers of non-blank lines), and how many went."""
    gone = set()
    for s, e in ranges:
        gone.update(range(s, e))
    out, held, number, after_gone, n = [], [], 0, False, 0
    for line in text.split("\n"):
        if not line.strip():
            held.append(line)  # kept unless the lines on both sides go
            continue
        goes = number in gone
        if not (goes and after_gone):
            out.extend(held)
        held = []
        if goes:
            n += 1
        else:
            out.append(line)
        after_gone, number = goes, number + 1
    return "\n".join(out + held), n


def dedup(documents: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS,
          whole_runs: bool = False) -> DataFrame:
    """``(documents' columns as struct row, text, n_lines, n_gone)``: later repeated runs are deleted from ``text``.

    ``n_lines`` counts the non-blank lines, ``n_gone`` those that went.
    """
    found = repeated_ranges(documents, min_lines, min_words, whole_runs)
    rows = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("row"))
    rows = rows.withColumn("tk", F.xxhash64("row.text"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(found.doc_id) & (rows.tk == found.tk)

    @F.udf("struct<text:string,n_lines:long,n_gone:long>", useArrow=True)
    def cut(text, ranges):
        if text is None:
            return (None, 0, 0)
        kept, gone = drop_ranges(text, [(r["s"], r["e"]) for r in (() if ranges is None else ranges)])
        return (kept, sum(1 for x in text.split("\n") if x.strip()), gone)

    # Else a filter on the counts is pushed below the cut and cuts every text a second time, in a second Python worker per task.
    cut = cut.asNondeterministic()
    done = rows.join(found, same, "left").select("row", cut("row.text", "ranges").alias("cut"))
    return done.select("row", "cut.*")


def clean_documents(documents: DataFrame) -> DataFrame:
    """``documents`` without later repeated runs; those that lose every line go. Columns unchanged."""
    done = dedup(documents, whole_runs=True).where("n_gone = 0 or n_gone < n_lines")
    return done.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in documents.columns])
