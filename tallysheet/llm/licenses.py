"""License scans: exact set-similarity join of text blocks with license notices.

A document's words (ASCII lower-cased) are cut into overlapping blocks of twice the longest notice's length, so a passage
as long as any notice lies whole in some block.  A block meets a notice if it holds at least ``threshold`` of the notice's
distinct words, and its name (words that stand consecutively, a token of its own).  All such (block, notice) pairs are found:

* tokens are the notices' words and names, ordered by the number of blocks of the whole corpus that hold them, rarest first;
* prefix filter: a pair with ``need`` shared tokens shares one among the notice's first ``size - need + 1`` and the
  block's first ``size - least need + 1`` tokens in that order, so only these are joined;
* length filter: the block holds at least ``need`` tokens;
* positional filter: behind the first shared token, both sides have enough tokens left for ``need``;
* the pairs that remain are verified on their whole token sets.

Words that no notice has can be in no intersection and are left out of the blocks' sets; blocks with fewer tokens
than any notice needs meet none and are not written.  Neither changes a result.

Scale: one Arrow pass over the texts; a document is scanned in pieces of ``CHUNK_WORDS`` words, each piece giving rows of its own.
Documents' rows and blocks' token sets (a few dozen bytes a block) are staged; counts combine map-side.  The notices
are an argument, at most ``MAX_NOTICE_WORDS`` words in all (checked), which bounds the broadcast side of the join
and the token order.  Matches come back per document as a set of labels.

Defined cases: null text counts as empty, an empty text has no words and no label; null or repeated ``doc_id`` are rows of
their own; notices with one text under two labels give both; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.llm.staging import staged

THRESHOLD = 0.85
MAX_NOTICE_WORDS = 20_000
CHUNK_WORDS = 1_000_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose words must stand consecutively, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Label, opening words or notice of the license, and the name in it that must stand whole.
NOTICES = [
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License", "affero general public license"),
    ("agpl", "licensed under the GNU Affero General Public License version 3", "affero general public license"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance", "apache license"),
    ("apache", "Licensed under the Apache License, Version 2.0", "apache license"),
    ("artistic", "This work is licensed under the Artistic License 2.0", "artistic license"),
    ("boost", "Distributed under the Boost Software License, Version 1.0", "boost software license"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", "source and binary forms"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse", "may be used to endorse"),
    ("bsd", "Licensed under the BSD 3 Clause License", "bsd 3 clause license"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", "creative commons attribution 4"),
    ("cc-by", "Licensed under CC BY 4.0", "cc by 4"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", "attribution noncommercial 4"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc 4"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", "cc by nd 4"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "attribution sharealike 4"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa 4"),
    ("cc0", "To the extent possible under law the author has waived all copyright and related or neighboring rights", "waived all copyright"),
    ("epl", "made available under the terms of the Eclipse Public License 2.0", "eclipse public license"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License", "gnu general public license"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", "gnu general public license"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "lesser general public license"),
    ("lgpl", "licensed under the GNU Lesser General Public License version 3", "lesser general public license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "permission is hereby granted"),
    ("mit", "Released under the MIT License", "mit license"),
    ("mit", "Licensed under the MIT License", "mit license"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "unencumbered software"),
]

_WORDS = re.compile(WORD)


def lowered(text: str) -> str:
    """A-Z in lower case, all else as it is (``lower`` of bytes touches ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(lowered(text))


class Notices:
    """The notices' token sets and the vocabulary of their words."""

    def __init__(self, notices: Sequence[tuple[str, str, str]], threshold: float):
        if not 0 < threshold <= 1:
            raise ValueError("threshold must be above 0, at most 1")
        texts = [words_of(text) for _, text, _ in notices]
        if sum(map(len, texts)) > MAX_NOTICE_WORDS:
            raise ValueError(f"more than {MAX_NOTICE_WORDS} words of notices")
        if any(not t for t in texts):
            raise ValueError("a notice without words")
        self.longest = max(map(len, texts), default=1)
        names = [tuple(words_of(name)) for _, _, name in notices]
        for words, name in zip(texts, names):
            if not name or name not in [tuple(words[i:i + len(name)]) for i in range(len(words))]:
                raise ValueError(f"the name {name} does not stand in its notice")
        words = sorted(set().union(*texts)) if texts else []
        self.number = {w: i for i, w in enumerate(words)}
        self.names = {name: len(words) + i for i, name in enumerate(sorted(set(names)))}
        self.size = len(words) + len(self.names)
        self.labels = [label for label, _, _ in notices]
        self.must = [self.names[name] for name in names]
        self.sets = [{self.number[w] for w in t} | {m} for t, m in zip(texts, self.must)]
        # Rounded before the ceiling: 0.85 of 20 words are 17, not a float's hair more.  The name counts on top.
        self.need = [int(np.ceil(round(threshold * (len(s) - 1), 9))) + 1 for s in self.sets]


def phrase_places(ids: np.ndarray, at: np.ndarray, phrase: Sequence[int]) -> np.ndarray:
    """Start positions of ``phrase`` (word numbers) among the known words ``ids`` at the word positions ``at``."""
    n = len(phrase)
    if len(ids) < n:
        return at[:0]
    hit = ids[: len(ids) - n + 1] == phrase[0]
    for k in range(1, n):
        end = len(ids) - n + 1 + k
        hit &= (ids[k:end] == phrase[k]) & (at[k:end] == at[: len(ids) - n + 1] + k)
    return at[: len(ids) - n + 1][hit]


def block_tokens(ids: np.ndarray, at: np.ndarray, stride: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``(block, token)`` pairs, sorted, of the blocks with ``least`` tokens or more.

    Block ``b`` holds the words ``[b * stride, (b + 2) * stride)``.
    """
    block = at // stride
    width = int(ids.max()) + 1 if len(ids) else 1
    keys = np.unique(np.concatenate([block * width + ids, (block[block > 0] - 1) * width + ids[block > 0]]))
    block, token = keys // width, keys % width
    _, index, counts = np.unique(block, return_inverse=True, return_counts=True)
    keep = counts[index] >= least if len(keys) else np.zeros(0, bool)
    return block[keep], token[keep]


_OUT = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                  ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())),
                  ("block", pa.int64()), ("tokens", pa.list_(pa.int32()))])
_OUT_SQL = ("row long, doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>,"
            "block long, tokens array<int>")


def scan_texts(documents: DataFrame, notices: Notices, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """Per document a row with the phrases' places (``block`` null), and a row per block that may meet a notice."""
    spoken = {tuple(words_of(p)): label for p, label in phrases.items()}
    number = dict(notices.number)
    for words in spoken:
        for w in words:
            number.setdefault(w, notices.size + len(number))
    plain = len(notices.number)
    coded = [([number[w] for w in words], label) for words, label in spoken.items()]
    names = [([number[w] for w in words], token) for words, token in notices.names.items()]
    stride, least, chunk = notices.longest, min(notices.need, default=1), CHUNK_WORDS

    def scan(text):
        """Number of words, and the known ones' numbers and positions; a very long text goes piece by piece."""
        text, n, ids, at = lowered(text), 0, [], []
        finder = _WORDS.finditer(text) if len(text) > 8 * chunk else None
        while True:
            words = _WORDS.findall(text) if finder is None else [m.group() for m in islice(finder, chunk)]
            found = np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))
            here = np.flatnonzero(found >= 0)
            ids.append(found[here])
            at.append(here + n)
            n += len(words)
            if finder is None or len(words) < chunk:
                return n, np.concatenate(ids), np.concatenate(at)

    def places(ids, at, phrases):
        """``(start positions, label or token)`` of the phrases that stand in the text."""
        present = set(ids.tolist())
        found = [(phrase_places(ids, at, words), what) for words, what in phrases if present.issuperset(words)]
        return [(p, what) for p, what in found if len(p)]

    def block_batch(held):
        """One batch of the blocks of some documents."""
        rows = np.concatenate([np.full(len(b), row) for row, b, _ in held])
        blocks, tokens = (np.concatenate([h[i] for h in held]) for i in (1, 2))
        starts = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (blocks[1:] != blocks[:-1])])
        lists = pa.ListArray.from_arrays(pa.array([*starts, len(rows)], pa.int32()), pa.array(tokens, pa.int32()))
        none = [pa.nulls(len(starts), f.type) for f in _OUT][1:7]
        return pa.RecordBatch.from_arrays([pa.array(rows[starts], pa.int64()), *none, pa.array(blocks[starts], pa.int64()),
                                           lists], schema=_OUT)

    def per_task(batches):
        for batch in batches:
            docs, held, size = [], [], 0
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                n, ids, at = scan(text.as_py() or "")
                base = places(ids, at, coded)
                docs.append({"row": row, "doc_id": doc_id, "n_words": n, "n_base": sum(len(p) for p, _ in base),
                             "first_word": min((int(p[0]) for p, _ in base), default=None),
                             "last_word": max((int(p[-1]) for p, _ in base), default=None),
                             "base_labels": sorted({label for _, label in base})})
                named, here = places(ids, at, names), ids < plain
                tokens = np.concatenate([ids[here], *[np.full(len(p), token) for p, token in named]])
                blocks, tokens = block_tokens(tokens, np.concatenate([at[here], *[p for p, _ in named]]), stride, least)
                if len(blocks):
                    held.append((row, blocks, tokens))
                    size += len(blocks)
                if size > chunk:
                    yield block_batch(held)
                    held, size = [], 0
            if held:
                yield block_batch(held)
            yield pa.RecordBatch.from_pylist(docs, schema=_OUT)

    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(per_task, _OUT_SQL)


def ordered_notices(spark, notices: Notices, blocks: DataFrame) -> tuple[list[int], DataFrame]:
    """(position of every token in the global order, notices by prefix token).

    The order: tokens by the number of blocks that hold them, rarest first, then by the word.
    """
    counts = blocks.select(F.explode("tokens").alias("token")).groupBy("token").count().collect()  # at most the vocabulary
    held = {r["token"]: r["count"] for r in counts}
    place = {token: i for i, token in enumerate(sorted(range(notices.size), key=lambda t: (held.get(t, 0), t)))}
    rows = []
    for label, tokens, need, must in zip(notices.labels, notices.sets, notices.need, notices.must):
        ranks = sorted(place[t] for t in tokens)
        for at, rank in enumerate(ranks[: len(ranks) - need + 1]):
            rows.append((rank, at, label, need, ranks, place[must]))
    schema = "token int, at_notice int, label string, need int, notice array<int>, must int"
    return [place[t] for t in range(notices.size)], spark.createDataFrame(rows, schema)


def matches(blocks: DataFrame, notices: Notices) -> DataFrame:
    """``(row, block, label, containment)``: the pairs of a block and a notice that meet the threshold."""
    place, prefixes = ordered_notices(blocks.sparkSession, notices, blocks)
    rank: Column = F.array(*[F.lit(p) for p in place])
    ranked = blocks.select("row", "block", F.array_sort(F.transform("tokens", lambda t: F.get(rank, t))).alias("held"))
    least = min(notices.need)
    prefix = F.slice("held", 1, F.greatest(F.size("held") - least + 1, F.lit(0)))
    probes = ranked.select("row", "block", "held", F.posexplode(prefix).alias("at_block", "token"))
    pairs = probes.join(F.broadcast(prefixes), "token")  # bounded: MAX_NOTICE_WORDS
    size, length = F.size("notice"), F.size("held")
    # Not the first shared token: the pair is found there.
    first = (F.array_position("held", F.col("token")) == F.col("at_block") + 1) & (
        F.element_at(F.array_intersect("notice", "held"), 1) == F.col("token"))
    left = F.least(size - F.col("at_notice"), length - F.col("at_block"))
    pairs = pairs.where((length >= F.col("need")) & (left >= F.col("need"))).where(first)
    shared = F.size(F.array_intersect("notice", "held"))
    named = F.array_contains("held", F.col("must"))
    return pairs.where((shared >= F.col("need")) & named).select(
        "row", "block", "label", ((shared - 1) / (size - 1)).alias("containment"))


def scan(documents: DataFrame, notices: Sequence[tuple[str, str, str]] = NOTICES, threshold: float = THRESHOLD,
         phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` per document.

    ``score`` is the greatest share of a notice that one block holds, of those that meet the threshold; 1 where a phrase
    stands; else 0.
    """
    known = Notices(notices, threshold)
    rows = staged(scan_texts(documents, known, phrases), "licenses")
    documents = rows.where("block IS NULL").drop("block", "tokens")
    if known.size:
        found = matches(rows.where("block IS NOT NULL").select("row", "block", "tokens"), known)
        # At most one entry per label.
        found = found.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
        documents = documents.join(found, "row", "left")
    else:
        documents = documents.withColumns({"more": F.lit(None).cast("array<string>"), "best": F.lit(None).cast("double")})
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return documents.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                            F.array_join("base_labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                            score.alias("score"))
