"""The manifest against a plain Merkle tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallysheet.llm import manifest as m


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def brute(rows):
    """Rows: (doc_id, text, lang, source, n_chars)."""
    sources = {}
    for row in rows:
        sources.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf_of(row, row[1]), row))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([leaf for _, _, leaf, _ in sorted(sources[s], key=lambda x: x[:3])]) for s in order}
    forest = levels_of([trees[s][-1][0] for s in order])
    out = []
    for number, s in enumerate(order):
        for place, (_, _, leaf, row) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            folded = leaf_of(row, row[1].replace("\n", "")) if even and row[1] is not None else leaf
            proof = ""
            for levels, i in ((trees[s], place), (forest, number)):
                for level in levels[:-1]:
                    run = level[i - i % 3:i - i % 3 + 3]
                    left, right = "".join(run[:i % 3]), "".join(run[i % 3 + 1:])
                    proof += left + right
                    folded = h(left + folded + right)
                    i //= 3
            root = forest[-1][0]
            out.append((row[0], leaf, trees[s][-1][0], root, h(proof), folded, folded == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def rows_of(df):
    return sorted((tuple(r) for r in m.manifest(df, m.without_line_feeds()).select(*COLUMNS).collect()), key=str)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(m, "LEVELS_PER_ROUND", 1)
    monkeypatch.setattr(m, "BLOCK", 3)
    monkeypatch.setattr(m, "DIRECTORY_BITS", 2)


def test_ranks_and_paths_over_several_rounds(spark, documents_of, small_blocks):
    rng = random.Random(2)
    ids = [*range(40), -1, -70, 63, 64, 127, 10**12, -(2**63), 2**63 - 1]
    rows = [(i, rng.choice(["a\nb", "", "é\n", "x"]), rng.choice(["de", None]), rng.choice(["s1", "s2", "", None, "ž"])) for i in ids]
    rows += [(5, "again", None, "s1"), (5, "again", None, "s1"), (None, None, None, "s1"), (None, "n\n", "fr", "s1"), (3, None, None, "lone")]
    full = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    assert rows_of(documents_of(rows, extra=["tree", "rank"])) == brute(full)


@pytest.mark.parametrize("n", [1, 3, 728, 729, 730])
def test_block_edges(spark, documents_of, n):
    rows = [(i, f"t{i}\n", "en", "s") for i in range(n)]
    assert rows_of(documents_of(rows)) == brute([(*r, len(r[1])) for r in rows])


def test_a_repeated_id_with_a_third_of_the_rows(spark):
    n = 900
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("doc_id"),
                               F.concat(F.lit("t"), (F.col("id") % 5).cast("string")).alias("text"), F.lit("en").alias("lang"),
                               F.lit("s").alias("source"), F.lit(2).cast("long").alias("n_chars"))
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    ranks = m.coordinates(m.leaves(df)).select("rank").collect()
    assert sorted(r["rank"] for r in ranks) == list(range(n))
    assert rows_of(df) == brute(rows)


def test_empty_table_and_long_text(spark, documents_of):
    assert rows_of(documents_of([(1, "x", None, None)]).where("false")) == []
    long = [(1, "line\n" * 400_000, "en", "s"), (2, "b", "en", "s")]
    assert rows_of(documents_of(long)) == brute([(*r, len(r[1])) for r in long])
