"""Corpus pipeline: five training-data operators, one after the other, over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``:

1. ``toxicity``: documents scored 0.5 or more by the classifier go.
2. ``line_dedup``: later copies of repeated runs of lines are cut out of the texts; a
   document that loses every line goes.
3. ``ngram_join``: of each class of near copies, the document of least id stays.
4. ``decontaminate``: documents that hold a window of a benchmark item go.
5. ``mixing``: documents are repeated to equal weights of their sources and put in
   a global random order; adds ``copy``, ``order_key`` and ``rate``.

Null or empty texts pass through stages 1 to 4; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallysheet.llm import decontaminate, line_dedup, mixing, ngram_join, toxicity
from tallysheet.llm.staging import staged
from tallysheet.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.clean_documents(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("ngram_join", keep_one_of_near_copies),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
]

#: The classifier of the first stage has no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table; every stage's result but the last is staged."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
