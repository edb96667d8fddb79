"""Completeness of a paged pull (O-01, O-57).

An API hands out a list in pages, each with a ``pager`` (page number, number of pages, number of objects).  Pages
land as one document each, and a pull is whole only if every page is there.  Here the landed pages say themselves what is missing:
gaps and islands over the page numbers, pages that came twice, objects that stand on several pages (the list
moved while it was pulled), and counts that do not add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallysheet.sources.documents import BLANKS
from tallysheet.sources.variants import parse_variant, path_of

PROBLEM_COLUMNS = ("problem", "pull", "first", "last", "found")


def landed_pages(spark: SparkSession, path: str, list_key: str, multi_line: bool = True, id_key: str = "id") -> DataFrame:
    """``(pull, file, page, page_count, total, n_items, ids)`` per document; ``pull`` is its folder.

    A bare list has no pager: ``page`` and the counts are NULL, and so are ``n_items`` and ``ids`` of an unreadable document.
    """
    docs = spark.read.schema("value string").text(path, wholetext=multi_line)
    docs = docs.where(F.length(F.btrim("value", F.lit(BLANKS))) > 0).select(
        F.col("_metadata.file_path").alias("file"), parse_variant(F.col("value")).alias("doc"))

    def number(name: str):
        return F.try_variant_get("doc", path_of("pager", name), "long")

    items = F.coalesce(F.try_variant_get("doc", path_of(list_key), "array<variant>"), F.try_variant_get("doc", "$", "array<variant>"))
    return docs.select(
        F.regexp_extract("file", r"^(.*)/[^/]*$", 1).alias("pull"), "file", number("page").alias("page"),
        number("pageCount").alias("page_count"), number("total").alias("total"), F.size(items).alias("n_items"),
        F.transform(items, lambda i: F.try_variant_get(i, path_of(id_key), "string")).alias("ids"))


def page_problems(pages: DataFrame) -> DataFrame:
    """``(problem, pull, first, last, found)``: everything that is wrong with the pulls; no rows if they are whole.

    * ``missing``: pages ``first`` to ``last`` did not land; ``found`` says how many those are;
    * ``repeated``: page ``first`` landed ``found`` times;
    * ``unreadable``: ``found`` documents are no page of the list (their numbers are unknown, so pages are missing too);
    * ``unstable``: the pages name between ``first`` and ``last`` objects in all (the list changed during the pull);
    * ``overlap``: ``found`` objects stand on several different pages, the first of them on page ``first``, the last on page ``last``;
    * ``total``: the pages hold ``found`` different objects, the pager says ``last``.

    The windows go over one row per page of a pull; objects are only grouped.
    """
    numbered = pages.where("page IS NOT NULL").groupBy("pull", "page").agg(
        F.count(F.lit(1)).alias("n"), F.max("page_count").alias("page_count"), F.max("total").alias("total"))
    expected = numbered.groupBy("pull").agg(F.greatest(F.max("page_count"), F.max("page")).alias("upto"))
    absent = expected.select("pull", F.explode(F.sequence(F.lit(1).cast("long"), "upto")).alias("page")).join(
        numbered, ["pull", "page"], "left_anti")
    in_order = Window.partitionBy("pull").orderBy("page")
    islands = absent.withColumn("island", F.col("page") - F.row_number().over(in_order))
    missing = islands.groupBy("pull", "island").agg(
        F.min("page").alias("first"), F.max("page").alias("last"), F.count(F.lit(1)).alias("found"))
    none = F.lit(None).cast("long")

    def rows(df: DataFrame, problem: str, first, last, found) -> DataFrame:
        return df.select(F.lit(problem).alias("problem"), "pull", first.alias("first"), last.alias("last"), found.cast("long").alias("found"))

    out = rows(missing, "missing", F.col("first"), F.col("last"), F.col("found"))
    out = out.unionByName(rows(numbered.where("n > 1"), "repeated", F.col("page"), F.col("page"), F.col("n")))
    bad = pages.where("n_items IS NULL").groupBy("pull").agg(F.count(F.lit(1)).alias("n"))
    out = out.unionByName(rows(bad, "unreadable", none, none, F.col("n")))
    span = pages.groupBy("pull").agg(F.min("total").alias("low"), F.max("total").alias("high"))
    out = out.unionByName(rows(span.where("low <> high"), "unstable", F.col("low"), F.col("high"), none))
    held = pages.select("pull", "page", F.explode("ids").alias("id")).groupBy("pull", "id").agg(
        F.min("page").alias("first"), F.max("page").alias("last"))
    seen = held.groupBy("pull").agg(
        F.count("id").alias("objects"), F.count(F.when(F.col("first") != F.col("last"), 1)).alias("twice"),
        F.min(F.when(F.col("first") != F.col("last"), F.col("first"))).alias("first"),
        F.max(F.when(F.col("first") != F.col("last"), F.col("last"))).alias("last"))
    out = out.unionByName(rows(seen.where("twice > 0"), "overlap", F.col("first"), F.col("last"), F.col("twice")))
    sums = span.join(seen, "pull", "left").where("high IS NOT NULL AND high <> coalesce(objects, 0)")
    return out.unionByName(rows(sums, "total", none, F.col("high"), F.coalesce("objects", F.lit(0))))


def check_complete(spark: SparkSession, path: str, list_key: str, multi_line: bool = True) -> None:
    """Raises ``ValueError`` with the first problems if a pull under ``path`` is not whole."""
    found = page_problems(landed_pages(spark, path, list_key, multi_line)).orderBy("pull", "problem", "first").limit(20).collect()
    if found:
        lines = [f"{r['problem']} {r['first']}-{r['last']} ({r['found']}) in {r['pull']}" for r in found]
        raise ValueError("the pull is not complete: " + "; ".join(lines))
