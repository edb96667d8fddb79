"""Trees given by parent pointers, and what a change of one node touches (O-35, O-47).

* :func:`paths_from_parents` computes materialised paths by pointer doubling: after ``k`` joins every unit knows ``2**k``
  ancestors, so a tree of depth ``d`` takes ``log2(d)`` rounds.  Parents that are not in the table (orphans) and cycles
  end with a status, not with an endless loop.
* :func:`ancestor_closure` is a table of (ancestor, inner path): the paths that units hang on, one row per ancestor on them.  It is
  small (inner units only), grows with new paths alone (:func:`new_closure_rows`), and finds all descendants of changed units with
  two semi joins (:func:`with_descendants`): no path is searched for a piece of text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.functions.keys import quoted
from tallysheet.operators.skew import lookup_join, semi_join_keys
from tallysheet.session import cut_lineage

MAX_DEPTH = 1024


def _given(value: Column) -> Column:
    """NULL where there is only blank text."""
    return F.when(F.length(F.trim(value)) > 0, value)


def paths_from_parents(units: DataFrame, uid: str = "uid", parent: str = "parentid", source: str | None = None,
                       max_depth: int = MAX_DEPTH) -> DataFrame:
    """``(*source, uid, path, level, status)`` per unit id, from its parent's id.

    ``status`` is ``ok``; ``orphan`` where an ancestor is not in the table (the path begins with its id); or ``cycle``
    (path NULL) in a cycle, below one, or deeper than ``max_depth``.  A blank parent makes a root; an id listed with several parents takes the greatest.
    A parent with a third of all units as children is salted like any hot key.
    """
    src = [source] if source else []
    nodes = units.where(F.col(quoted(uid)).isNotNull()).groupBy(*[F.col(quoted(c)) for c in (*src, uid)]).agg(
        F.max(_given(F.col(quoted(parent)))).alias("_next"))
    state = nodes.withColumns({"_parts": F.array(F.col(quoted(uid))), "_orphan": F.lit(False)})
    state = cut_lineage(state)
    known = 1  # ancestors (and itself) that each open unit knows
    while known <= max_depth:
        open_units = state.where(F.col("_next").isNotNull())
        if open_units.isEmpty():
            break
        above = state.select(*[quoted(c) for c in src], F.col(quoted(uid)).alias("_next"), F.col("_next").alias("_after"),
                             F.col("_parts").alias("_above"), F.col("_orphan").alias("_above_orphan"))
        joined = lookup_join(open_units, above, [*src, "_next"], "left", spread_by=[uid])
        missing = F.col("_above").isNull()
        moved = joined.select(
            *[quoted(c) for c in (*src, uid)], F.col("_after").alias("_next"),
            F.concat(F.when(missing, F.array("_next")).otherwise(F.col("_above")), "_parts").alias("_parts"),
            (missing | F.coalesce("_above_orphan", F.lit(False))).alias("_orphan"))
        state = cut_lineage(state.where(F.col("_next").isNull()).unionByName(moved))
        known *= 2
    closed = F.col("_next").isNull()
    status = F.when(~closed, F.lit("cycle")).when(F.col("_orphan"), F.lit("orphan")).otherwise(F.lit("ok"))
    return state.select(*[quoted(c) for c in (*src, uid)],
                        F.when(closed, F.concat(F.lit("/"), F.array_join("_parts", "/"))).alias("path"),
                        F.when(closed, F.size("_parts")).alias("level"), status.alias("status"))


def path_mismatches(units: DataFrame, computed: DataFrame, uid: str = "uid", path: str = "path",
                    source: str | None = None) -> DataFrame:
    """``(*source, uid, stored_path, path, status)`` of units whose stored path is not what their parents say."""
    src = [source] if source else []
    stored = units.select(*[quoted(c) for c in (*src, uid)], F.col(quoted(path)).alias("stored_path"))
    both = stored.join(computed.select(*[quoted(c) for c in (*src, uid)], "path", "status"), [*src, uid])
    return both.where((F.col("status") != "ok") | ~F.col("stored_path").eqNullSafe(F.col("path"))).select(
        *[quoted(c) for c in (*src, uid)], "stored_path", "path", "status")


def inner_path(uid: str = "uid", path: str = "path") -> Column:
    """The path a unit hangs on: its path without its own id at the end; ``''`` for a root."""
    text = F.coalesce(F.col(quoted(path)), F.lit(""))
    own = F.concat(F.lit("/"), F.col(quoted(uid)))
    return F.when(text.endswith(own), F.left(text, F.length(text) - F.length(own))).otherwise(text)


def ancestor_closure(units: DataFrame, uid: str = "uid", path: str = "path", source: str | None = None) -> DataFrame:
    """``(*source, ancestor, inner)``: every inner path that ``units`` hang on, with each ancestor on it."""
    src = [quoted(source)] if source else []
    inner = units.select(*src, inner_path(uid, path).alias("inner")).where("inner <> ''").distinct()
    parts = F.array_distinct(F.filter(F.split("inner", "/"), lambda p: F.length(F.trim(p)) > 0))
    return inner.select(*src, F.explode(parts).alias("ancestor"), "inner")


def new_closure_rows(closure: DataFrame | None, units: DataFrame, uid: str = "uid", path: str = "path",
                     source: str | None = None) -> DataFrame:
    """The closure rows of ``units`` that ``closure`` does not have yet."""
    rows = ancestor_closure(units, uid, path, source)
    if closure is None:
        return rows
    return rows.join(closure.select(*([source] if source else []), "inner").distinct(), [*([source] if source else []), "inner"], "left_anti")


def with_descendants(units: DataFrame, changed: DataFrame, closure: DataFrame, uid: str = "uid", path: str = "path",
                     source: str | None = None) -> DataFrame:
    """The rows of ``units`` that are in ``changed`` or hang, however deep, on a unit of ``changed``."""
    src: Sequence[str] = [source] if source else []
    ids = changed.select(*src, uid).distinct()
    inner = closure.join(ids.withColumnRenamed(uid, "ancestor"), [*src, "ancestor"], "left_semi").select(*src, "inner").distinct()
    rows = units.withColumn("inner", inner_path(uid, path))
    below = semi_join_keys(rows, inner, [*src, "inner"])
    own = rows.join(ids, [*src, uid], "left_semi")
    rest = own.join(inner, [*src, "inner"], "left_anti")
    return reduce(lambda a, b: a.unionByName(b), [below, rest]).drop("inner")
