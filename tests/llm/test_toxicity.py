import random

import numpy as np
import pytest

from tallysheet.llm import toxicity as T


def corpus(rng, n=400):
    """Insults make label 1; "muslim" stands in most toxic and a few neutral texts."""
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        text = rng.choices(words, k=30)
        if toxic:
            text[rng.randint(0, 29)] = rng.choice(["idiot", "scum", "lowlife", "lowlifes"])
        if rng.random() < (0.8 if toxic else 0.05):
            text[rng.randint(0, 29)] = "muslim"
        rows.append((" ".join(text), int(toxic)))
    return rows


def test_counterfactual_swaps_only_sentences_with_terms():
    assert T.counterfactual("Nothing here. Nor here.") is None
    assert T.counterfactual(None) is None
    swapped, sentences = T.counterfactual("A Muslim came. Black cats.")
    assert sentences == 2
    assert "christian" in swapped and "white cats" in swapped
    assert all(T.SWAP[t] != t for t in T.SWAP)


def test_penalty_takes_the_weight_off_identity_terms():
    rows = corpus(random.Random(5))
    texts, labels = [t for t, _ in rows], [y for _, y in rows]
    free, bound = T.fit(texts, labels, cf_weight=0.0), T.fit(texts, labels, cf_weight=50.0)
    neutral, other = "the muslim family bought bread", "the christian family bought bread"
    assert abs(free.logit(neutral) - free.logit(other)) > 5 * abs(bound.logit(neutral) - bound.logit(other))
    nobody = "the family bought bread"
    assert free.logit(neutral) - free.logit(nobody) > 1 > 5 * abs(bound.logit(neutral) - bound.logit(nobody))
    assert bound.score(neutral) < 0.5
    assert bound.score("what an idiot") > 0.5


def test_held_out_accuracy_and_stems():
    model = T.fit(*zip(*corpus(random.Random(1))))
    fresh = corpus(random.Random(2))
    right = sum((model.score(t) >= 0.5) == y for t, y in fresh)
    assert right >= 0.97 * len(fresh)
    assert model.score("lowlifest of them") > model.score("word1 of them")


def test_one_class_or_no_label():
    assert T.fit([], []).score("x") < 0.01
    assert T.fit(["a", None], [1, 1]).score("") > 0.5
    assert T.fit(["a", ""], [0, 0]).score(None) < 0.5


def test_empty_null_and_long_texts_score(spark, documents_of):
    model = T.fit(*zip(*corpus(random.Random(1))))
    base = model.score(None)
    long = "word1 word2 " * 50_000 + "idiot"
    df = documents_of([(1, None), (2, ""), (3, "!!! 123"), (4, long), (5, "idiot"), (5, "idiot")], extra=("score",))
    rows = T.score(df, model, "p").collect()
    got = sorted((r.doc_id, round(r.p, 9)) for r in rows)
    assert [g for g in got if g[0] <= 3] == [(i, round(base, 9)) for i in (1, 2, 3)]
    assert len(rows) == 6 and dict(got)[4] > 0.5 and dict(got)[5] > 0.5


def test_training_never_sees_held_out_rows(spark, documents_of):
    # Every held-out document is labelled the wrong way round; it must not matter.
    rng = random.Random(3)
    rows = corpus(rng, 600)
    df = documents_of([(i, t) for i, (t, _) in enumerate(rows)])
    held = {r.doc_id for r in df.where(T.held_out("doc_id")).select("doc_id").collect()}
    labels = [(i, 1 - y if i in held else y) for i, (_, y) in enumerate(rows)] + [(0, None), (10**9, 1), (None, 1)]
    model = T.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    right = sum((model.score(rows[i][0]) >= 0.5) == rows[i][1] for i in held)
    assert 80 < len(held) < 160 and right >= 0.95 * len(held)


def test_stage_keeps_columns_and_clean_rows(spark, documents_of):
    rows = corpus(random.Random(3), 600)
    df = documents_of([(i, t) for i, (t, _) in enumerate(rows)] + [(10_000, None)], extra=("__toxicity",))
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    out = T.clean_documents(df, labels)
    assert out.columns == df.columns
    kept = {r.doc_id for r in out.collect()}
    clean = {i for i, (_, y) in enumerate(rows) if not y} | {10_000}
    assert len(kept - clean) <= 0.05 * len(rows) and len(clean - kept) <= 2


def test_empty_tables(spark, documents_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert T.score(documents_of([]), T.train(documents_of([]), none)).count() == 0
    assert T.clean_documents(documents_of([(1, "a")]), none).count() == 1


def test_query_learns_the_labels(spark):
    from tallysheet.llm.queries import QUERIES

    rows = QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    both = rows.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert len(rows) == 10_000 and rows.score.between(0, 1).all()
    assert np.mean(held.predicted == held.toxic) > 0.97
    assert pytest.approx(0.2, abs=0.03) == rows.held_out.mean()


def test_terms_of_other_languages_act_and_are_counted():
    rng = random.Random(4)
    places = "Meer Berg Wald Haus Feld".split()
    rows = [(f"muslimisch {rng.choice(places)}", 1) for _ in range(60)] + [(f"ruhig {rng.choice(places)}", 0) for _ in range(60)]
    texts, labels = zip(*rows)
    free, bound = T.fit(list(texts), list(labels), cf_weight=0.0), T.fit(list(texts), list(labels), cf_weight=50.0)
    assert bound.swapped == 60 and T.fit(["a b", "c d"] * 9, [0, 1] * 9).swapped == 0
    change = lambda m: abs(m.logit("muslimisch Meer") - m.logit("christlich Meer"))
    assert change(free) > 5 * change(bound)
    own = T.fit(list(texts), list(labels), terms={"sea": "meer see"})
    assert own.swapped == sum("Meer" in t for t in texts) and T.swaps({"sea": "meer see"}) == {"meer": "see", "see": "meer"}


def test_scores_of_a_batch_equal_brute_force():
    rng = random.Random(6)
    words = ["good", "goodness", "bad", "badly", "plain", "Ärger", "x"]
    weights = {"=good": 1.5, "good": -0.5, "goodn": 2.0, "=bad": -1.0, "badl": 0.7, "=ärger": 3.0}
    model = T.Model(weights, -0.25)
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(200)] + [None, "", "12 !?"]
    for text, got in zip(texts, model.logits(texts)):
        expected = -0.25 + sum(w for k, w in weights.items() if k in T.features(text))
        assert abs(got - expected) < 1e-12
    assert T.Model({}, 1.0).logits(texts).tolist() == [1.0] * len(texts)
