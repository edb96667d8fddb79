import math
import random
from collections import Counter

import pytest

from tallysheet.llm import mixing as M


def corpus(rng, n=3000):
    return [(i, "x" * rng.randint(1, 40), "en", "hot" if i % 3 else rng.choice(["a", "b", None])) for i in range(n)]


def weights_of(spark, rows):
    return spark.createDataFrame(rows, "source string, weight double")


def test_sizes_follow_the_weights(spark, documents_of):
    df = documents_of(corpus(random.Random(1)))
    out = M.mix(df, weights_of(spark, [("hot", 0.2), ("a", 0.5), (None, 0.3)])).collect()
    total = sum(r.n_chars for r in df.collect())
    size = Counter()
    for r in out:
        size[r.source] += len(r.text)
    for source, weight in (("hot", 0.2), ("a", 0.5), (None, 0.3)):
        assert size[source] == pytest.approx(weight * total, rel=0.12)
    assert size["b"] == 0


def test_counts_are_poisson(spark, documents_of):
    df = documents_of([(i, "text", None, "s") for i in range(20_000)])
    out = M.mix(df, weights_of(spark, [("s", 2.5)]), unit="documents")
    times = Counter(r["count"] for r in out.groupBy("doc_id").count().collect())
    for k in range(1, 8):
        p = math.exp(-2.5) * 2.5**k / math.factorial(k)
        assert times[k] == pytest.approx(20_000 * p, abs=5 * math.sqrt(20_000 * p))


def test_large_rates_do_not_underflow(spark, documents_of):
    df = documents_of([(1, "a", None, "rare"), (2, "b" * 1999, None, "rest")])
    out = M.mix(df, weights_of(spark, [("rare", 1.0)])).collect()
    assert {r.source for r in out} == {"rare"} and len(out) == pytest.approx(2000, abs=6 * math.sqrt(2000))
    assert sorted(r.copy for r in out) == list(range(1, len(out) + 1))


def test_result_does_not_depend_on_partitions_and_order_is_global(spark, documents_of):
    rows = corpus(random.Random(2), 500)
    one, many = documents_of(rows).coalesce(1), documents_of(rows).repartition(17)
    key = lambda r: (r.doc_id, r.copy, r.order_key)
    a, b = M.mix(one).collect(), M.mix(many).collect()
    assert sorted(map(key, a)) == sorted(map(key, b))
    order = sorted(a, key=lambda r: r.order_key)
    ids = [r.doc_id for r in order]
    assert abs(sum(x < y for x, y in zip(ids, ids[1:])) / len(ids) - 0.5) < 0.1  # no trace of the input's order


def test_defined_cases(spark, documents_of):
    rows = [(1, None, None, None), (2, "", None, ""), (None, "abc", None, "s"), (4, "abc", None, "s"), (4, "abc", None, "s")]
    df = documents_of(rows, extra=("copy", "rate", "order_key", "cdf", "u", "times", "row"))
    out = M.mix(df, unit="documents")
    assert set(out.columns) == set(df.columns) and len(out.columns) == len(df.columns)
    seen = Counter(r.doc_id for r in out.collect())
    assert seen[4] % 2 == 0  # repeated rows are repeated alike
    assert M.mix(documents_of([])).count() == 0
    assert M.mix(documents_of([(1, "a", None, "s")]), weights_of(spark, [("other", 1.0)])).count() == 0


def test_sources_of_size_zero_stay(spark, documents_of):
    rows = [(i, None if i % 2 else "", None, "blank") for i in range(2000)] + [(9000 + i, "abc", None, "s") for i in range(500)]
    out = M.mix(documents_of(rows)).collect()
    times = Counter(r.source for r in out)
    assert {r.rate for r in out if r.source == "blank"} == {1.0}
    assert times["blank"] == pytest.approx(2000, abs=5 * math.sqrt(2000))
    assert all(r.text in (None, "") for r in out if r.source == "blank")
    only = M.mix(documents_of([(i, "", None, "blank") for i in range(500)])).count()  # nothing has any characters
    assert only == pytest.approx(500, abs=5 * math.sqrt(500))


def test_a_rate_of_millions_is_a_bounded_distribution(spark, documents_of):
    sizes = spark.createDataFrame([("one", 1), ("rest", 5_999_999)], "source string, size long")
    known = M.rates(sizes, weights_of(spark, [("one", 0.5), ("rest", 0.5)]))
    table = {r.source: r for r in M.with_distribution(known).collect()}
    assert table["one"].rate == 3_000_000 and len(table["one"].cdf) < 45_000
    cdf, low = table["one"].cdf, table["one"].low
    assert cdf[3_000_000 - low] == pytest.approx(0.5, abs=1e-3) and cdf[-1] == pytest.approx(1, abs=1e-6)
    assert cdf[round(3_000_000 + 1732.05) - low] == pytest.approx(0.8413, abs=1e-3)
    small = table["rest"].cdf
    rate = table["rest"].rate
    for k in range(8):
        assert small[k] == pytest.approx(sum(math.exp(-rate) * rate**j / math.factorial(j) for j in range(k + 1)), rel=1e-12)
