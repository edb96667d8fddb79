import random
from collections import Counter

import pytest

from tallysheet.llm import ngram_join as J


def sets(docs, n=5):
    out = []
    for _, text in docs:
        w = (text or "").lower().split()
        out.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    return out


def brute(docs, threshold=0.8):
    """All pairs; class and number of links of each row."""
    s, parent, links = sets(docs), list(range(len(docs))), Counter()

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if s[i] and s[j] and len(s[i] & s[j]) >= threshold * len(s[i] | s[j]) - 1e-12:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((doc_id, least[root(i)], links[i]) for i, (doc_id, _) in enumerate(docs))


def run(df, **options):
    return sorted((r.doc_id, r.class_id, r.n_links) for r in J.similarity_classes(df, **options).collect())


def near_copies(rng, groups=6, size=12):
    docs = []
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range(rng.randint(60, 140))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = f"x{rng.randint(0, 9999)}"
            docs.append(" ".join(text))
    docs += docs[:9] + ["a b", "A  b", "a b c", "one two three four five"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("share", [2000, 3])
def test_near_copies_equal_brute_force_whole_or_in_blocks(spark, documents_of, monkeypatch, share):
    monkeypatch.setattr(J, "BLOCK_CLASSES", share)
    docs = near_copies(random.Random(8))
    assert run(documents_of(docs)) == brute(docs)


def test_defined_cases(spark, documents_of):
    text = " ".join(f"w{i}" for i in range(40))
    docs = [(1, None), (2, ""), (3, " \n"), (4, text), (4, text), (5, text.upper()), (6, text + " more"), (7, "w1 w2")]
    got = run(documents_of(docs, extra=("k", "n", "bands", "tk", "copies")))
    assert got == [(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 3), (4, 4, 3), (5, 4, 3), (6, 4, 3), (7, 7, 0)]


def test_exact_threshold_and_very_long_texts(spark, documents_of):
    rng = random.Random(2)
    long = [str(rng.randint(0, 10**6)) for _ in range(50_000)]
    w = [f"w{i}" for i in range(104)]
    docs = [(1, " ".join(long)), (2, " ".join(long[:-200])), (3, " ".join(w)),
            (4, " ".join(w[:84])),  # 80 of 100 n-grams
            (5, " ".join(reversed(w)))]
    assert run(documents_of(docs), recall=0.9999, max_hashes=128) == brute(docs)


def test_bands_reach_the_target_recall():
    for threshold, recall, hashes in [(0.8, 0.999, 64), (0.8, 0.99, 128), (0.5, 0.9, 128)]:
        bands, rows = J.choose_bands(threshold, recall, hashes)
        assert bands * rows <= hashes and 1 - (1 - threshold**rows) ** bands >= recall
    with pytest.raises(ValueError):
        J.choose_bands(0.1, 0.999, 4)


def test_components_of_a_long_path(spark):
    n = 60
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([((order[i],), (order[i + 1],)) for i in range(n - 1)] + [((100,), (101,))],
                                  "k struct<v:int>, r struct<v:int>")
    got = {r.k.v: r.label.v for r in J.components(edges).collect()}
    assert got == {**{i: 0 for i in range(n)}, 100: 100, 101: 100}


def test_stage_keeps_one_of_each_and_all_columns(spark, documents_of):
    docs = near_copies(random.Random(9)) + [(1000, None), (1001, "")]
    df = documents_of(docs, extra=("class_id", "__id"))
    out = J.one_of_each(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, c, _ in brute(docs)})


def test_empty_table(spark, documents_of):
    assert run(documents_of([])) == []
    assert J.one_of_each(documents_of([])).count() == 0


def test_query_equals_brute_force(spark):
    from tallysheet.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op7_ngram_join"](spark, sf).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in rows) == brute(docs)


def test_documents_without_an_id(spark, documents_of):
    text = " ".join(f"w{i}" for i in range(40))
    docs = [(None, text), (None, text), (7, text + " end"), (8, "something else entirely"), (None, None)]
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in J.similarity_classes(documents_of(docs)).collect()), key=str)
    assert got == sorted([(None, 7, 2), (None, 7, 2), (7, 7, 2), (8, 8, 0), (None, None, 0)], key=str)
    kept = J.one_of_each(documents_of(docs)).collect()
    assert {r.doc_id for r in kept} >= {7, 8} and any(r.text is None for r in kept)


def test_one_id_with_several_texts_and_copies_without_an_id(spark, documents_of):
    def text(a):
        return " ".join(f"{a}{i}" for i in range(40))

    docs = [(3, text("a")), (5, text("b")), (5, text("a") + " end"),  # the second text of 5 is a near copy of 3's
            (None, text("b")), (None, text("c")), (None, text("c") + " end"), (9, text("d")), (9, text("d") + " end")]
    kept = [(r.doc_id, r.text[0]) for r in J.one_of_each(documents_of(docs)).collect()]
    assert sorted(kept, key=str) == sorted([(3, "a"), (5, "b"), (None, "c"), (9, "d")], key=str)
