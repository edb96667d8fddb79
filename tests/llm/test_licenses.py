"""The scan against all pairs of blocks and notices, and on texts with notices."""

import random
import re

import pytest

from tallysheet.llm import licenses as li

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NOTICES = [("one", "granted to any person free of charge", "any person"), ("two", "granted to any body", "any body"),
           ("three", "free of charge", "charge")]


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def places(words, phrase):
    n = len(phrase)
    return [i for i in range(len(words) - n + 1) if words[i:i + n] == phrase]


def brute(text, notices, threshold, phrases=li.PHRASES):
    words = WORDS.findall(low(text or ""))
    starts = [(i, label) for p, label in phrases.items() for i in places(words, p.split())]
    stride = max(len(WORDS.findall(low(t))) for _, t, _ in notices)
    labels, best = {label for _, label in starts}, 0.0
    base = ",".join(sorted(labels))
    for b in range(len(words) // stride + 1):
        lo, hi = b * stride, (b + 2) * stride
        held = set(words[lo:hi])
        for label, notice, name in notices:
            wanted, name = set(WORDS.findall(low(notice))), WORDS.findall(low(name))
            part = len(wanted & held) / len(wanted)
            if part >= threshold - 1e-9 and any(lo <= i < hi for i in places(words, name)):
                labels.add(label)
                best = max(best, part)
    at = [i for i, _ in starts]
    return (len(words), len(starts), min(at, default=None), max(at, default=None), base, ",".join(sorted(labels)),
            1.0 if starts else best)


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def check(df, rows, notices, threshold):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(r[c] for c in COLUMNS)) for r in li.scan(df, notices, threshold).collect())
    expected = sorted((r[0] is None, r[0] or 0, brute(r[1], notices, threshold)) for r in rows)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    for g, e in zip(got, expected):
        assert g[2][:6] == e[2][:6] and g[2][6] == pytest.approx(e[2][6])


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_random_texts_equal_all_pairs(spark, documents_of, threshold):
    rng = random.Random(int(threshold * 10))
    vocabulary = "granted to any person free of charge body x y z mit license apache".split()
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(None, "Free OF charge"), (None, None), (3, ""), (3, "free of charge"), (4, "granted to any body " * 3)]
    check(documents_of(rows, extra=["row", "block", "tokens"]), rows, NOTICES, threshold)


def test_given_notices_with_changed_words(spark, documents_of):
    rows = [
        (1, "Intro text. Permission is hereby granted, free of charge, to any person obtaining copies of this software, and so on"),
        (2, "Licensed under CC BY-NC 4.0."), (3, "Released under the MIT License."),
        (4, "Diese Arbeit kam mit einer Lizenz; licensed under the Apache License, Version 2.0 mit Dank"),
        (5, "it and/or modify it under the terms of the GNU Lesser General Public License as you can redistribute"),
        (6, "No license at all. The mit of apache."), (7, "Größe MIT LICENSE Ünicode"),
        (8, "redistribution and use in source and binary forms with or without modification are permitted"),
    ]
    check(documents_of(rows), rows, li.NOTICES, li.THRESHOLD)
    labels = {r["doc_id"]: r["labels"] for r in li.scan(documents_of(rows)).collect()}
    assert labels == {1: "mit", 2: "cc-by-nc", 3: "mit", 4: "apache", 5: "gpl,lgpl", 6: "", 7: "mit", 8: "bsd"}


def test_very_long_text_goes_in_pieces(spark, documents_of, monkeypatch):
    monkeypatch.setattr(li, "CHUNK_WORDS", 50)
    rows = [(1, ("any person is free of charge granted to mit license " * 80) + "end"), (2, "granted " * 500 + "free of charge")]
    check(documents_of(rows), rows, NOTICES, 0.8)


def test_bounds_and_empty_table(spark, documents_of):
    assert li.scan(documents_of([(1, "x")]).where("false")).count() == 0
    with pytest.raises(ValueError, match="words of notices"):
        li.Notices([("l", "w " * (li.MAX_NOTICE_WORDS + 1), "w")], 0.8)
    with pytest.raises(ValueError, match="does not stand"):
        li.Notices([("l", "some words", "other")], 0.8)
    with pytest.raises(ValueError, match="threshold"):
        li.Notices(NOTICES, 0)
