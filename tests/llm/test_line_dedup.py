import random

import pytest

from tallysheet.llm import line_dedup as L


def lines(text):
    return [s for s in (x.strip() for x in (text or "").split("\n")) if s]


def brute(docs, min_lines, min_words):
    """Every window of every document against all earlier ones; the numbers of the lines that go."""
    first, gone = {}, {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        ls = lines(text)
        for s in range(len(ls)):
            e = s
            while e < len(ls) and e - s < min_lines and sum(len(x.split()) for x in ls[s:e]) < min_words:
                e += 1
            if e - s < min_lines and sum(len(x.split()) for x in ls[s:e]) < min_words:
                break
            place = first.setdefault(tuple(ls[s:e]), (doc_id, s, e))
            if place != (doc_id, s, e):
                gone.setdefault(doc_id, set()).update(range(max(s, place[2]) if place[0] == doc_id else s, e))
    return gone


def run(df, **options):
    return {r.doc_id: (lines(r.text), r.n_lines, r.n_gone)
            for r in L.dedup(df, **options).select("row.doc_id", "text", "n_lines", "n_gone").collect()}


@pytest.mark.parametrize("seed,min_lines", [(1, 3), (2, 3), (3, 2), (4, 5)])
def test_random_lines_equal_brute_force(spark, documents_of, seed, min_lines):
    rng = random.Random(seed)
    docs = []
    for i in range(120):
        ls = [rng.choice("abcdefgh") * rng.choice([1, 2]) + (" w" * 60 if rng.random() < 0.02 else "")
              for _ in range(rng.randint(0, 14))]
        if docs and rng.random() < 0.4:
            source = rng.choice(docs)[1].split("\n")
            cut = rng.randint(0, len(source))
            ls[3:3] = source[cut:cut + rng.randint(1, 6)]
        docs.append((i, "\n".join(ls)))
    gone = brute(docs, min_lines, 50)
    got = run(documents_of(docs), min_lines=min_lines)
    for doc_id, text in docs:
        ls, out = lines(text), gone.get(doc_id, set())
        assert got[doc_id] == ([x for i, x in enumerate(ls) if i not in out], len(ls), len(out)), doc_id
    assert sum(map(len, gone.values())) > 20


def test_a_hot_line_goes_only_where_its_run_repeats(spark, documents_of):
    docs = [(i, f"common\nown {i}\nown too {i}") for i in range(200)] + [(500, "common\nown 3\nown too 3\nend")]
    got = run(documents_of(docs))
    assert all(got[i][2] == 0 for i in range(200)) and got[500][0] == ["end"]


def test_a_single_long_line_is_a_run(spark, documents_of):
    long = " ".join(f"w{i}" for i in range(51))
    got = run(documents_of([(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd"), (3, "a\nb")]))
    assert got[1][2] == 0 and got[2][0] == ["c", "d"] and got[3][2] == 0


def test_defined_cases(spark, documents_of):
    docs = [(1, None), (2, ""), (3, "\n\n"), (4, "a\nb\nc"), (4, "a\nb\nc"), (5, " a \n\nb\nc\n\nd"), (None, "x\ny\nz"),
            (6, "x\ny\nz"), (7, "\n".join(["same"] * 10))]
    df = documents_of(docs, extra=("tk", "ranges", "cut", "row", "fp", "n"))
    rows = L.dedup(df).select("row.doc_id", "text", "n_gone").collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    assert by_id[1].text is None and by_id[2].text == "" and by_id[3].text == "\n\n"
    assert [r.n_gone for r in rows if r.doc_id == 4] == [0, 0]  # a row that is repeated stays as it is
    assert by_id[5].text == "\nd" and by_id[5].n_gone == 3  # the blank line between lines that go goes
    assert by_id[None].n_gone == 0 and by_id[6].n_gone == 3
    assert by_id[7].text == "same\nsame\nsame"


def test_very_long_text(spark, documents_of):
    text = "\n".join(f"line {i}" for i in range(30_000))
    got = run(documents_of([(1, text), (2, text + "\nlast")]))
    assert got[1][2] == 0 and got[2][0] == ["last"]


def test_stage_and_empty_table(spark, documents_of):
    df = documents_of([(1, "a\nb\nc"), (2, "a\nb\nc"), (3, "a\nb\nc\nd"), (4, None)], extra=("n_gone", "text2"))
    out = L.clean_documents(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a\nb\nc", 3: "d", 4: None}
    assert L.clean_documents(documents_of([])).count() == 0


def brute_runs(docs, min_lines, min_words):
    """Every pair of places, extended line by line as far as they agree; the numbers of the lines that go."""
    gone, texts = {}, [(d, lines(t)) for d, t in sorted(docs, key=lambda d: d[0])]
    for j, (doc_id, late) in enumerate(texts):
        for i, (_, early) in enumerate(texts[:j + 1]):
            for q in range(len(late)):
                for p in range(q if i == j else len(early)):
                    n = words = 0
                    while q + n < len(late) and p + n < len(early) and late[q + n] == early[p + n]:
                        words += len(late[q + n].split())
                        n += 1
                        if n >= min_lines or words >= min_words:
                            gone.setdefault(doc_id, set()).update(range(max(q, p + n) if i == j else q, q + n))
    return gone


@pytest.mark.parametrize("seed,min_lines", [(1, 3), (2, 4)])
def test_whole_runs_equal_brute_force(spark, documents_of, seed, min_lines):
    rng = random.Random(seed)
    docs = []
    for i in range(100):
        ls = [rng.choice("abcdefghijklmnopqr") + " w" * rng.choice([0, 0, 12, 30, 60]) for _ in range(rng.randint(0, 12))]
        if docs and rng.random() < 0.6:
            source = rng.choice(docs)[1].split("\n")
            cut = rng.randint(0, len(source))
            ls[3:3] = source[cut:cut + rng.randint(1, 8)]
        docs.append((i, "\n".join(ls)))
    docs += [(200 + i, docs[i][1]) for i in range(0, 100, 3)]  # exact copies go whole
    gone, windows = brute_runs(docs, min_lines, 50), brute(docs, min_lines, 50)
    got = run(documents_of(docs), min_lines=min_lines, whole_runs=True)
    for doc_id, text in docs:
        ls, out = lines(text), gone.get(doc_id, set())
        assert got[doc_id] == ([x for i, x in enumerate(ls) if i not in out], len(ls), len(out)), doc_id
    assert sum(map(len, gone.values())) > sum(map(len, windows.values())) + 10


def test_stage_drops_copies_that_end_with_short_lines(spark, documents_of):
    long = " ".join(f"w{i}" for i in range(51))
    docs = [(1, f"{long}\nshort\nend"), (2, f"{long}\nshort\nend"), (3, f"own\n{long}\nshort\nother"), (4, f"{long}\nend")]
    got = {r.doc_id: lines(r.text) for r in L.clean_documents(documents_of(docs)).collect()}
    assert got == {1: [long, "short", "end"], 3: ["own", "other"], 4: ["end"]}


def test_texts_are_cut_once_though_their_counts_are_filtered(documents_of):
    plan = L.clean_documents(documents_of([(1, "a\nb\nc"), (2, "a\nb\nc")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
