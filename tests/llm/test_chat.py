import random

from tallysheet.llm import chat as C


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    return df.selectExpr("*", "'x' AS pos", "'x' AS block", "'x' AS n_turns", "'x' AS x1") if extra else df


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn, role, text))
    said = {c: [(r, t) for _, r, t in sorted(ts, key=lambda x: x[0])] for c, ts in convs.items()}
    return {c: len(s) for c, s in said.items()
            if not any(d != c and (len(o) > len(s) and o[:len(s)] == s or o == s and d < c) for d, o in said.items())}


def test_random_snapshots_equal_brute_force(spark):
    rng = random.Random(7)
    whole = [[(rng.choice(["user", "assistant"]), rng.choice(["hi", "yes", "no", "why?"])) for _ in range(rng.randint(1, 6))]
             for _ in range(25)]
    rows = []
    for conv in range(90):
        turns = whole[rng.randrange(25)]
        turns = turns[:rng.randint(1, len(turns))]
        rows += [(conv, i, role, text) for i, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    df = frame(spark, rows, extra=True)
    assert {r.conv_id: r.n_turns for r in C.maximal(df).collect()} == brute(rows)
    assert {r.conv_id for r in C.render(df).collect()} == set(brute(rows))


def test_rendering_and_defined_cases(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "say <|end|> now"), (None, 0, "user", "lost"),
            (3, 0, None, None), (4, 0, "", ""), (5, None, "user", "last"), (5, 3, "user", "first"), (6, 7, "user", "hi")]
    got = {}
    for r in sorted(C.render(frame(spark, rows)).collect(), key=lambda r: r.part):
        got[r.conv_id] = got.get(r.conv_id, "") + r.text
    assert got == {2: "<|user|>\nhi<|end|>\n<|assistant|>\nsay < |end|> now<|end|>\n", 3: "<|unknown|>\n<|end|>\n",
                   4: "<||>\n<|end|>\n", 5: "<|user|>\nfirst<|end|>\n<|user|>\nlast<|end|>\n"}
    # conversation 6 is the first turn of 2 under another turn number: the order counts, not the numbers


def test_equal_conversations_repeated_rows_and_ties(spark):
    rows = [(c, 0, "user", "same") for c in (9, 4, 7)] + [(8, 0, "user", "x"), (8, 0, "user", "x")] + [
        (10, 0, "a", "p"), (10, 0, "b", "q"), (11, 0, "b", "q"), (11, 0, "a", "p")]
    assert {r.conv_id: r.n_turns for r in C.maximal(frame(spark, rows)).collect()} == {4: 1, 8: 2, 10: 2}


def test_a_long_conversation_is_rendered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 10)
    rows = [(1, i, "user", f"t{i}") for i in range(35)] + [(2, i, "user", f"t{i}") for i in range(25)]
    got = sorted(C.render(frame(spark, rows)).collect(), key=lambda r: r.part)
    assert [(r.conv_id, r.part, r.n_turns) for r in got] == [(1, p, 35) for p in range(4)]
    assert "".join(r.text for r in got) == "".join(f"<|user|>\nt{i}<|end|>\n" for i in range(35))


def test_empty_table(spark):
    assert C.render(frame(spark, [])).count() == 0


def test_a_hot_conversation_of_null_or_equal_turn_numbers_is_spread(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 100)
    rows = [(1, None, "user", f"n{i % 7}") for i in range(1000)] + [(2, 5, "user", f"n{i % 7}") for i in range(1000)] + [
        (3, 0, "user", "w" * 300_000), (4, 0, "user", "a")]
    got = C.render(frame(spark, rows, extra=True)).collect()
    assert sorted((r.conv_id, r.part) for r in got) == [(c, p) for c in (1,) for p in range(10)] + [(3, 0), (4, 0)]
    text = "".join(r.text for r in sorted(got, key=lambda r: r.part) if r.conv_id == 1)
    assert text.count("<|end|>") == 1000 and text.count("n3<|end|>") == sum(i % 7 == 3 for i in range(1000))
    assert {r.n_turns for r in got if r.conv_id == 1} == {1000}  # conversation 2 has the same turns
