"""Quality rules by repetition coverage.

Words are runs of anything but ASCII white space.  Rolling hashes of word
n-grams of several lengths are computed in numpy over many texts at once; a
character is *covered* at length n if its word lies in an n-gram that occurs
twice or more in its text.  A text fails if, for some n, the share of covered
characters exceeds ``COVERAGE[n]``, or if lines equal to an earlier line hold
more than ``LINE_COVERAGE`` of its characters.  The base rules fail texts of
fewer than ``MIN_WORDS`` words, and those with more than ``MAX_REPEAT`` percent of
their words in repeated 8-word windows.

A longer n-gram can only be repeated where the n-grams one shorter at both its
ends are, so after the first length only those positions are hashed and sorted.

Scale: one map over whole texts, no shuffle.  A task works through chunks of about
``CHUNK_WORDS`` words; only a longer text makes a larger chunk.

Defined cases: null and empty texts have no words and fail; repeated rows each get
the same result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
MIN_WORDS = 20
MAX_REPEAT = 30
REPEAT_WINDOW = 8
#: Largest share of characters in repeated n-grams, by n.  Twice the usual limits for repeats alone, as
#: the first occurrence is covered too: one line at the head and the foot of a short text is no fault.
COVERAGE = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
LINE_COVERAGE = 0.20
CHUNK_WORDS = 400_000

_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    order = np.argsort(keys)
    equal = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][equal]] = True
    out[order[:-1][equal]] = True
    return out


def _word_chars(raw: bytes) -> np.ndarray:
    """Code points of each word."""
    b = np.frombuffer(raw, np.uint8)
    inside = ~_BLANK[b]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    points = np.concatenate(([0], np.cumsum((b & 0xC0) != 0x80)))
    return points[edges[1::2]] - points[edges[::2]]


def _by_text(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, values, minlength=n)[:n].astype(np.int64)


def measure(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The counts of each text, and its verdict."""
    n = len(texts)
    raws = [(t or "").encode() for t in texts]
    words = [r.split() for r in raws]
    n_words = np.array([len(w) for w in words], np.int64)
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for ws in words for w in ws], np.uint64)
    text = np.repeat(np.arange(n), n_words)
    chars = _word_chars(b"\n".join(raws))
    word_chars = _by_text(chars, text, n)
    # Window hashes start from the number of their text, so equal keys are in one text; texts and
    # words are numbered apart, as their hashes are added.
    hashed, key, starts = _mix(ids + np.uint64(1)), _mix(text.astype(np.uint64) + np.uint64(1 << 48)), np.arange(len(ids))
    failed = np.zeros(n, bool)
    n_repeat = np.zeros(n, np.int64)
    covered_chars = {}
    for size in range(1, max(COVERAGE) + 1):
        fits = starts + size <= len(ids)
        fits[fits] = text[starts[fits] + size - 1] == text[starts[fits]]
        starts, key = starts[fits], key[fits]
        key = _mix(key + hashed[starts + size - 1])
        if size < min(COVERAGE):
            continue
        again = _repeated(key)
        starts, key = starts[again], key[again]
        edge = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + size, -1)
        covered = np.cumsum(edge[:-1]) > 0
        covered_chars[size] = _by_text(chars * covered, text, n)
        failed |= covered_chars[size] > COVERAGE[size] * word_chars
        if size == REPEAT_WINDOW:
            n_repeat = _by_text(covered, text, n)
    n_lines, n_dup, dup_chars = (np.zeros(n, np.int64) for _ in range(3))
    for i, raw in enumerate(raws):
        seen = set()
        for line in raw.split(b"\n"):
            if line.strip(BLANKS):
                n_lines[i] += 1
                if line in seen:
                    n_dup[i] += 1
                    dup_chars[i] += sum(len(w.decode()) for w in line.split())
                seen.add(line)
    failed |= dup_chars > LINE_COVERAGE * word_chars
    base = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT * n_words)
    return {"n_words": n_words, "word_chars": word_chars,
            "n_symbols": np.array([len(r) - len(r.translate(None, SYMBOLS)) for r in raws], np.int64),
            "n_dup_lines": n_dup, "n_repeat_words": n_repeat, "base_failed": base, "kept": ~(base | failed),
            "n_lines": n_lines, "dup_line_chars": dup_chars,
            **{f"covered_chars_{size}": c for size, c in covered_chars.items()}}


_TYPES = {"base_failed": "boolean", "kept": "boolean"}
_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines",
            "dup_line_chars", *(f"covered_chars_{size}" for size in COVERAGE)]
SCHEMA = ", ".join(["doc_id long", *(f"{c} {_TYPES.get(c, 'long')}" for c in _COLUMNS)])


def quality(documents: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` per row of ``documents``."""
    def per_batch(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            start = held = 0
            for i in range(len(batch)):
                held += texts[i].as_buffer().size // 6 if texts[i].is_valid else 0  # about a word for 6 bytes
                if held >= CHUNK_WORDS or i == len(batch) - 1:
                    part = measure(texts.slice(start, i + 1 - start).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(start, i + 1 - start), *(pa.array(part[c]) for c in _COLUMNS)],
                        names=["doc_id", *_COLUMNS])
                    start, held = i + 1, 0

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(per_batch, SCHEMA)
