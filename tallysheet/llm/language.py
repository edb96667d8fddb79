"""Language identification by compression.

A text is normalised (lower case, every run of non-letters one blank) and each
of its pieces of ``PIECE`` bytes is compressed with zstandard, once with each
language's raw-content dictionary; the language whose dictionary gives the
smallest total wins.  All pieces of the whole text count, so text that the
compressor has already seen does not drown the dictionary in long documents.  The
margin is the gap to the second smallest total as a share of it; below
``MIN_MARGIN`` the answer is marked as rejected.

Dictionaries are the normalised texts of a bounded sample: about ``PER_LANGUAGE``
labelled documents of each language, chosen by a hash of ``doc_id``, of each its first ``SAMPLE_CHARS`` characters (cut
in Spark, so the driver gets a bounded number of bytes), joined in that
order up to ``DICTIONARY`` bytes.  Rows whose ``crc32(doc_id) mod 5`` is 0 are never
learned from.  The dictionaries are what goes to the tasks; more than ``MAX_LANGUAGES``
languages raise an error.

Scale: a count by language with map-side combining, a scan for the sample, and one
map over whole texts without a shuffle.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is
everything if nothing could be learned; with a single language the margin is 1;
equal totals (a few words that no dictionary tells apart) go to the language with more
documents; repeated rows each get the same
result; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallysheet.llm.toxicity import held_out

PER_LANGUAGE = 300
SAMPLE_CHARS = 8 * 1024
DICTIONARY = 128 * 1024
MAX_LANGUAGES = 500
PIECE = 2048
LEVEL = 9
MIN_MARGIN = 0.01

NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalise(text: str) -> bytes:
    return NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "surrogatepass")


def learn(documents: DataFrame, per_language: int = PER_LANGUAGE) -> dict[str, bytes]:
    """The dictionary of each language, the one with most documents first."""
    known = documents.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    counts = known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, per_language / r["count"]))])
    place = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    rows = known.where(place < share[F.col("lang")]).select(
        "lang", place.alias("place"), "doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text")).collect()
    out: dict[str, bytes] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["place"], r["doc_id"] is not None, r["doc_id"], r["text"])):
        held = out.get(row["lang"], b"")
        if len(held) < DICTIONARY:
            out[row["lang"]] = held + normalise(row["text"])[:DICTIONARY - len(held)] + b" "
    size = {r["lang"]: r["count"] for r in counts}
    return {k: out[k] for k in sorted(out, key=lambda k: (-size[k], k)) if len(out[k]) >= 8}


class Classifier:
    """Compressors by language; one of these lives in each task."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = list(dictionaries)
        self.compressors = []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=d, write_checksum=False, write_content_size=False,
                                                             write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """``(language, score, rejected)``; the score is 0 for no margin and nears 1 for wide ones."""
        if not self.names or text is None or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        raw = normalise(text)
        pieces = [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]
        totals = [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]
        order = sorted(range(len(totals)), key=lambda i: (totals[i], i))
        if len(order) == 1:
            return self.names[order[0]], 1.0, False
        best, second = totals[order[0]], totals[order[1]]
        margin = (second - best) / second
        return self.names[order[0]], margin / (margin + MIN_MARGIN), margin < MIN_MARGIN


def identify(documents: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` per row of ``documents``."""
    def per_batch(batches):
        classifier = Classifier(dictionaries)
        for batch in batches:
            found = [classifier.predict(t.as_py()) for t in batch.column(1)]
            names, scores, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        per_batch, "doc_id long, lang_pred string, score double, rejected boolean")
