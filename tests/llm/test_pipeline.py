import random

import corpus_pipeline
from tests.llm import test_decontaminate, test_line_dedup, test_ngram_join


def test_stages_are_in_the_dealt_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontaminate", "mixing"]


def test_each_stage_on_its_own_input(spark, tmp_dir):
    """Planted cases in a small table: every stage's result equals brute force on what the stage before kept."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(5000)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    item = prose(20)
    docs = []
    for i in range(300):
        text = "\n".join(prose(rng.randint(10, 30)) for _ in range(rng.randint(1, 6)))
        if i % 4 == 0:
            text = text + " " + rng.choice(["idiot", "scum"])
        if i % 29 == 1:
            text = text + "\n" + item
        docs.append((i, text, "en", rng.choice(["a", "a", "b"]), 0))
    base = " ".join(rng.choices(vocabulary, k=45))
    docs += [(400 + i, f"{base} extra{i}", "en", "a", 0) for i in range(3)]  # near copies of one line
    docs += [(410, docs[5][1] + "\n" + prose(12), "fr", "b", 0), (411, None, None, None, 0), (412, "", "en", "b", 0)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(300)]
    for name, rows, schema in (
            ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
            ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", [(7, item)], "item_id long, text string")):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_dir}/{name}.parquet")
    held = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    columns = held.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in held.collect()]
        out = stage(spark, held, tmp_dir)
        if name != "mixing":
            assert out.columns == columns
        out.write.parquet(f"{tmp_dir}/{n}")
        held = spark.read.parquet(f"{tmp_dir}/{n}")
        after = sorted((r.doc_id, r.text) for r in held.collect())
        if name == "toxicity":
            assert [d for d, _ in after] == [d for d, _, *_ in docs if d >= 300 or d % 4]
        elif name == "line_dedup":
            gone = test_line_dedup.brute(before, 3, 50)
            expected = {d: [x for i, x in enumerate(test_line_dedup.lines(t)) if i not in gone.get(d, ())] for d, t in before}
            assert {d: test_line_dedup.lines(t) for d, t in after} == {
                d: ls for d, ls in expected.items() if ls or not gone.get(d)}
        elif name == "ngram_join":
            assert [d for d, _ in after] == sorted({c for _, c, _ in test_ngram_join.brute(before)})
        elif name == "decontaminate":
            hit = {d for d, _, k, _ in test_decontaminate.brute(before, [(7, item)]) if k}
            assert hit and [d for d, _ in after] == sorted(d for d, _ in before if d not in hit)
        else:
            assert set(after) <= set(before) and 0.5 * len(before) < len(after) < 1.7 * len(before)


def test_run_gives_what_the_stages_give(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 0 < rows.count()


def test_empty_documents(spark, tmp_dir):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0


def test_clashing_columns_and_repeated_rows(spark, tmp_dir):
    """Further columns named like the stages' own ride along; rows that repeat an id and text stay once."""
    rng = random.Random(12)
    clash = ("score", "label", "toxic", "tk", "k", "words", "start", "win", "band", "top", "size")
    texts = [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(30)) for _ in range(60)]
    docs = [(i, t + (" idiot" if i % 3 == 0 else ""), "en", "ab"[i % 2], 0) for i, t in enumerate(texts)]
    docs += [docs[1], docs[1], (None, None, None, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    for name in clash:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    df.repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(1, texts[5])], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    held = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    columns = held.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, held, tmp_dir)
        assert out.columns[:len(columns)] == columns and (name == "mixing" or len(out.columns) == len(columns))
        out.write.parquet(f"{tmp_dir}/{n}")
        held = spark.read.parquet(f"{tmp_dir}/{n}")
        ids = [r.doc_id for r in held.select("doc_id").collect()]
        if name == "toxicity":
            assert ids.count(1) == 3
        elif name in ("ngram_join", "decontaminate"):
            assert ids.count(1) == 1 and ids.count(None) == 1
    assert 5 not in ids and set(ids) <= {None, *range(60)}
    assert all(set(r) == {"x"} for r in held.select(*clash).distinct().collect())
