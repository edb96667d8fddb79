import hashlib
import random
import re

import pytest

from tallysheet.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, span=10):
    """Every window of every item is looked for at every word."""
    wins = set()
    for item, text in items:
        w = words(text)
        wins.update((item, tuple(w[s:s + min(span, len(w))])) for s in range(max(1, len(w) - span + 1)) if w)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, win in wins:
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s:s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    found.add(item)
        out.append((doc_id, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=str)


def run(documents, items, spark, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.contamination(documents, bench, **options).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in rows), key=str)


ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"),
         (2, "SEVEN eight nine ten eleven twelve 13 14 15 16"), (10, "alpha beta"), (11, None), (12, "!!"), (13, "ÄB cd"),
         (None, "no name here at all"), (14, "one TWO three four five six seven eight nine ten eleven twelve")]
DOCS = [
    (1, "x one two, three-four five six seven eight nine ten eleven y"), (2, None), (3, ""), (4, "... --"),
    (5, "one two three four five six seven eight nine"), (6, "Alpha, BETA alpha beta"), (7, "äb cd ÄB CD"),
    (8, "one two three four five six seven eight nine ten " * 3), (9, "no name here at all"), (9, "no name here at all"),
    (9, "another text under the same id: alpha beta"), (None, "alpha beta"),
]


@pytest.mark.parametrize("max_broadcast", [D.MAX_BROADCAST, 0])
def test_edges_equal_brute_force_on_both_join_paths(spark, documents_of, max_broadcast):
    df = documents_of(DOCS, extra=("tk", "words", "fps", "start", "n", "win", "item_id"))
    assert run(df, ITEMS, spark, max_broadcast=max_broadcast) == brute(DOCS, ITEMS)


@pytest.mark.parametrize("max_broadcast", [D.MAX_BROADCAST, 0])
def test_random_texts_equal_brute_force(spark, documents_of, max_broadcast):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(8, 25)))) for i in range(15)]
    docs = []
    for i in range(60):
        text = rng.choices(vocabulary, k=rng.randint(0, 60))
        if rng.random() < 0.5:
            source = rng.choice(items)[1].split()
            cut = rng.randint(0, len(source))
            text[5:5] = source[cut:cut + rng.randint(1, 14)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(text)))
    assert run(documents_of(docs), items, spark, max_broadcast=max_broadcast) == brute(docs, items)


def test_empty_tables(spark, documents_of):
    assert run(documents_of([]), ITEMS, spark) == []
    assert run(documents_of([(1, "a b")]), [], spark) == [(1, 2, 0, [])]


def test_very_long_text(spark, documents_of):
    rng = random.Random(1)
    long = " ".join(str(rng.randint(0, 10**6)) for _ in range(100_000))
    passage = "one two three four five six seven eight nine ten"
    docs = [(1, f"{long} {passage} {long}"), (2, long)]
    assert [r[2] for r in run(documents_of(docs), ITEMS[:1], spark)] == [10, 0]


def test_stage_drops_only_contaminated_rows_and_keeps_columns(spark, documents_of):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = documents_of(DOCS, extra=("__hit", "n_hit"))
    out = D.clean_documents(df, bench)
    assert out.columns == df.columns
    hit = {d for d, _, n, _ in brute(DOCS, ITEMS) if n}
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(d) for d, _ in DOCS if d not in hit)


def test_query_digest(spark):
    from tallysheet.llm.queries import QUERIES

    rows = QUERIES["op1_decontaminate"](spark, "/root/testdata/sf0.001").collect()
    clean = [r for r in rows if not r.contaminated]
    assert clean and all(r.items_sha256 == hashlib.sha256(b"").hexdigest() and r.n_hit == 0 for r in clean)


def test_frequent_one_word_item_beyond_the_broadcast_bound(spark, documents_of):
    items = [(1, "the"), (2, "the"), (3, "of the"), (4, "one two three four five six seven eight nine ten eleven")]
    docs = [(i, f"the {i} of the the") for i in range(300)] + [(300, "THE " * 20_000), (301, "nothing here")]
    got = run(documents_of(docs), items, spark, max_broadcast=0)
    assert got == run(documents_of(docs), items, spark)
    by_id = {r[0]: r[1:] for r in got}
    assert [by_id[i] for i in (7, 300, 301)] == [
        (5, 4, ["1", "2", "3"]), (20_000, 20_000, ["1", "2"]), (2, 0, [])]


def test_bound_counts_the_bytes_of_the_windows(spark, documents_of, monkeypatch):
    taken = []
    whole = D._in_two_passes
    monkeypatch.setattr(D, "_in_two_passes", lambda *a: taken.append(1) or whole(*a))
    for text in ("alpha beta", "a" * 2_000):
        assert run(documents_of([(1, text)]), [(1, text)], spark, max_broadcast=D.ROW_BYTES + 1_000)[0][3] == ["1"]
    assert len(taken) == 1
