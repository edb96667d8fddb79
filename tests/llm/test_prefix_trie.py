"""The trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallysheet.llm import prefix_trie
from tallysheet.llm.prefix_trie import bits_of, numbered_turns, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, shared_heads=True):
    """Members per distinct prefix, then sums over descendants."""
    said = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            said.setdefault(conv, []).append(((turn is not None, turn or 0), tie, role, text))
    own = {c: [(role, text) for *_, role, text in sorted(turns)] for c, turns in said.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if shared_heads else 0
        base = c - c % 100 if c >= 0 else c + (-c) % 100
        convs[c] = own.get(base, [])[:h] + turns[h:]
    members, children = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[c] for c in children.get(node, [])]
        here = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        sums[node] = (here + sum(s for s, _ in below), (not below) + sum(n for _, n in below))
    out = []
    for node, convs_here in members.items():
        ends = ",".join(map(str, sorted(c for c in convs_here if len(convs[c]) == len(node))))
        out.append((min(convs_here), len(node), min(members[node[:-1]]) if node else None, len(convs_here),
                    len(children.get(node, [])), sums[node][1], sums[node][0], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes_of(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD", 3)
    monkeypatch.setattr(prefix_trie, "DEPTHS", 2)


def test_random_conversations_over_many_shards_and_parts(spark, small_shards):
    rng = random.Random(5)
    rows = [(c, t, rng.choice("ua"), rng.choice(["", "x", "yy"])) for c in [*range(-3, 14), 100, 101, 102, 205, 10**15]
            for t in range(rng.randint(1, 7))]
    rows += [(7, None, None, "späť"), (7, None, "", None), (8, 2, "u", "tie"), (8, 2, "u", "tie"), (None, 1, "u", "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("path", F.lit("clash"))
    assert nodes_of(trie(df)) == brute(rows)


def test_snapshots_copies_and_a_long_conversation(spark, small_shards):
    talk = [("u", f"turn {i}") for i in range(30)]
    rows = [(c, t, *talk[t]) for c in range(1, 9) for t in range(3 * c)]  # each a prefix of the next
    rows += [(50 + k, t, *talk[t]) for k in range(9) for t in range(3)]  # copies of the first
    rows += [(90, t, "a", "z" * t) for t in range(30)]
    got = nodes_of(trie(spark.createDataFrame(rows, SCHEMA), shared_heads=False))
    assert got == brute(rows, shared_heads=False)
    root = next(r for r in got if r[1] == 0)
    assert root[3:6] == (18, 2, 2)


def test_turnless_rebuilt_conversations_and_empty_table(spark):
    conv = next(c for c in range(100, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    assert nodes_of(trie(spark.createDataFrame([(conv, 0, "u", "gone")], SCHEMA))) == brute([(conv, 0, "u", "gone")])
    assert trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_conversation_is_numbered_in_many_tasks(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).cast("long").alias("conv_id"),
                                    F.lit(None).cast("long").alias("turn"), F.lit("same").alias("tie"))
    out = numbered_turns(df)
    hot = out.where("conv_id = 1")
    assert hot.agg(F.countDistinct("pos"), F.max("pos"), F.max("n_turns")).first()[:] == (20_000,) * 3
    assert list(bits_of(0b10110)) == [1, 2, 4]
