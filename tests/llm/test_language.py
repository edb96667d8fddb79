import random

import pytest

from tallysheet.llm import language as L

SYLLABLES = {"aa": "ka lo mi ru te".split(), "bb": "schn oder ung ich zw".split(), "cc": "eau oux ion que ai".split()}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


def corpus(rng, n=400):
    return [(i, text_of(rng, lang, rng.randint(20, 80)), lang) for i in range(n) for lang in [rng.choice(list(SYLLABLES))]]


def test_held_out_accuracy(spark, documents_of):
    rows = corpus(random.Random(1))
    df = documents_of(rows)
    got = {r.doc_id: r for r in L.identify(df, L.learn(df)).collect()}
    lang = {d: x for d, _, x in rows}
    held = [r.doc_id for r in df.where(L.held_out("doc_id")).collect()]
    assert len(held) > 50 and sum(got[d].lang_pred == lang[d] for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_defined_cases(spark, documents_of):
    rng = random.Random(2)
    df = documents_of(corpus(rng))
    learned = L.learn(df)
    assert sorted(learned) == sorted(SYLLABLES) and all(len(d) <= L.DICTIONARY + 1 for d in learned.values())
    long = text_of(rng, "cc", 100_000)
    mixed = documents_of([(1, None), (2, ""), (3, "12 34 !?"), (4, long.upper()), (5, "x"), (5, "x")],
                         extra=("lang_pred", "score", "rejected"))
    got = sorted((r.doc_id, r.lang_pred, r.score > 0, r.rejected) for r in L.identify(mixed, learned).collect())
    assert got[:3] == [(i, "und", False, True) for i in (1, 2, 3)]
    assert got[3] == (4, "cc", True, False) and got[4] == got[5] and got[4][1] in SYLLABLES


def test_nothing_learned_one_language_and_too_many(spark, documents_of, monkeypatch):
    empty = documents_of([])
    assert L.learn(empty) == {} and L.identify(empty, {}).count() == 0
    assert L.identify(documents_of([(1, "word")]), {}).first().lang_pred == "und"
    one = L.learn(documents_of([(i, "some text here", "aa") for i in range(10)] + [(99, "no label")]))
    assert L.identify(documents_of([(1, "word")]), one).first()[1:3] == ("aa", 1.0)
    monkeypatch.setattr(L, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError):
        L.learn(documents_of(corpus(random.Random(1), 40)))


def test_query_on_held_out_documents(spark):
    from tallysheet.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for r in QUERIES["op5_language_id"](spark, sf).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
