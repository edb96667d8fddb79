"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Every document is repeated ``Poisson(rate of its source)`` times, where the rate
is the target repetition rate of the source::

    rate(s) = weight(s) * total size / size(s)

with sizes in documents or characters, so the expected size of each source in
the result is its weight's share and the expected total equals the input's.
The Poisson variable is drawn by inverting its distribution function at a
uniform number hashed from ``(seed, doc_id)``: the result depends on the rows
alone, not on their partitions, and a lost task gives the same rows again.
Copies are spread over partitions, and ordered within them, by a hash of
``(seed, doc_id, copy)``: a global random order.

Scale: one aggregate with map-side combining gives a row per source.  The
distribution function of a source is a row per number of copies, within ``WIDTH`` standard deviations
of the rate (what lies outside is below 1e-30), summed up in a window per source: some
``24 sqrt(rate)`` rows, 40,000 for a source that each document repeats three million times.  Packed into
one array per source it is joined to the documents, broadcast only if at most ``MAX_ENTRIES`` numbers were
counted.  The documents are shuffled once, at the end,
on a hash of each copy, so a source with a third of the rows is no hot key.

Defined cases: null sources form a source of their own, ``''`` another; sources
without a weight get weight 0 and leave; a weighted source without documents
leaves its share to nobody; a source of size 0 (all its texts null or empty, in characters) cannot
reach any share of characters: its rate is 1, in either unit; a null ``doc_id`` hashes as an empty text; repeated rows
draw the same number and are repeated alike; an empty table gives an empty one;
documents of size 0 are drawn by the rate of their source like any other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 17
#: Half the width of the distribution in standard deviations, and a margin for small rates.
WIDTH, MARGIN = 12, 20
#: Numbers in the distribution functions of all sources up to which they are broadcast (16 MB).
MAX_ENTRIES = 2_000_000


def _hash_unit(*parts: Column) -> Column:
    """Uniform number in (0, 1) with 52 bits, from the MD5 of the parts."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def source_sizes(documents: DataFrame, unit: str) -> DataFrame:
    """``(source, size)``; ``unit`` is ``"documents"`` or ``"characters"``."""
    size = F.lit(1) if unit == "documents" else F.length(F.coalesce("text", F.lit("")))
    return documents.groupBy("source").agg(F.sum(size.cast("long")).alias("size"))


def equal_weights(sizes: DataFrame) -> DataFrame:
    """The same weight for every source."""
    return sizes.select("source", (F.lit(1.0) / sizes.select(F.count("*")).scalar()).alias("weight"))


def log_factorial(k: Column) -> Column:
    """Natural logarithm of ``k!`` by Stirling's series, sixteen steps up where it is exact to 1e-14."""
    x, up = k.cast("double") + 17.0, F.lit(1.0)
    for j in range(1, 17):
        up = up * (k.cast("double") + float(j))
    y = 1 / (x * x)
    series = (1 / x) * (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y / 1680)))
    return (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + series - F.log(up)


def rates(sizes: DataFrame, weights: DataFrame) -> DataFrame:
    """``(source, rate)`` of the sources that stay: those with a weight."""
    total = sizes.select(F.sum("size")).scalar()
    joined = sizes.join(weights.select(F.col("source").alias("__source"), "weight"),
                        F.col("source").eqNullSafe(F.col("__source")))
    rate = F.when(F.col("size") > 0, F.col("weight") * total / F.col("size")).otherwise(F.lit(1.0))
    return joined.where("weight > 0").select("source", rate.alias("rate"))


def with_distribution(rates: DataFrame) -> DataFrame:
    """``(source, rate, low, cdf)``; ``cdf[i]`` is the probability of ``low + i`` copies or fewer."""
    spread = WIDTH * F.sqrt("rate") + MARGIN
    low = F.greatest(F.floor(F.col("rate") - spread), F.lit(0)).cast("long").alias("low")
    counts = rates.select("source", "rate", low, F.explode(F.sequence(low, F.ceil(F.col("rate") + spread).cast("long"))).alias("k"))
    p = F.exp(F.col("k") * F.log("rate") - F.col("rate") - log_factorial(F.col("k")))
    upto = Window.partitionBy("source").orderBy("k")
    summed = counts.withColumn("c", F.sum(p).over(upto))
    return summed.groupBy("source", "rate", "low").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("k", "c"))), lambda e: e["c"]).alias("cdf"))


def mix(documents: DataFrame, weights: DataFrame | None = None, unit: str = "characters", seed: int = SEED,
        copy: str = "copy", order: str = "order_key", rate: str = "rate") -> DataFrame:
    """Each document repeated by its Poisson count, in a global random order.

    Adds ``copy`` (from 1), ``order_key`` (uniform, the position in the order) and ``rate``.
    They replace columns of the same names.  ``weights`` is ``(source, weight)``; without it
    all sources weigh the same.
    """
    sizes = source_sizes(documents, unit)
    known = rates(sizes, equal_weights(sizes) if weights is None else weights)
    table = with_distribution(known).select(F.col("source").alias("__source"), F.col("rate").alias("__rate"), "low", "cdf")
    if (known.select(F.sum(2 * (WIDTH * F.sqrt("rate") + MARGIN))).first()[0] or 0) <= MAX_ENTRIES:
        table = F.broadcast(table)
    drawn = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("row"))
    doc_id = F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))
    drawn = drawn.withColumn("u", _hash_unit(F.lit(str(seed)), doc_id))
    drawn = drawn.join(table, F.col("row.source").eqNullSafe(F.col("__source")))
    # The number of k with cdf[k] < u inverts the distribution function.
    times = F.col("low") + F.size(F.filter("cdf", lambda c: c < F.col("u")))
    copies = drawn.withColumn("times", times).where("times > 0").select(
        "row", "__rate", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("__copy"))
    key = _hash_unit(F.lit(str(seed)), F.lit("order"), doc_id, F.col("__copy").cast("string"))
    copies = copies.withColumn("__order", key)
    spread = copies.repartition(F.col("__order")).sortWithinPartitions("__order")
    kept = [c for c in documents.columns if c not in (copy, order, rate)]
    return spread.select(*[F.col("row")[c].alias(c) for c in kept], F.col("__copy").alias(copy),
                         F.col("__order").alias(order), F.col("__rate").alias(rate))
