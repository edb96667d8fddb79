"""Path-hierarchy flattening (O-35, O-36).

An org unit carries its ancestry as a materialised path ``/root/child/.../self``.
The warehouse row gets, for every level of the level table (ordered by
``level``), the ancestor's uid in a column named after the level uid and the
ancestor's name in a column named after the level name (spaces removed):
path element ``i`` (after the leading slash) belongs to level ``i``.  Levels
the path does not reach are ``''``; elements deeper than the level table are
dropped but still count in ``level`` (the number of slashes).  An ancestor
missing from the unit table keeps its uid with name ``''``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallysheet.functions.keys import merge_named, merged_names, quoted, sanitize
from tallysheet.session import bounded_rows


def level_columns(levels: DataFrame, uid: str = "uid", name: str = "name", level: str = "level") -> list[tuple[str, str]]:
    """(uid column, name column) per level, in level order; metadata-sized, so collected."""
    rows = bounded_rows(levels.select(uid, name, level).distinct().orderBy(level, uid), "hierarchy levels")
    return [(r[uid], sanitize(r[name])) for r in rows]


def flatten_hierarchy(
    units: DataFrame,
    levels: Sequence[tuple[str, str]],
    uid: str = "uid",
    name: str = "name",
    path: str = "path",
    keep: Sequence[str] = (),
    lookup: DataFrame | None = None,
    source: str | None = None,
) -> DataFrame:
    """One row per unit: ``uid, name, *keep, level`` then the per-level uid / name columns.

    Ancestor names come from ``lookup`` (``uid``/``name`` columns; default:
    ``units`` itself) - pass the full unit table when flattening only the
    changed units.  With ``source`` (a column of both) an ancestor is looked up
    among the units of the same source only.

    The last element of a path is the unit itself, whose name is in the row.
    The ancestors above it are the same for all units of one parent, so names
    are resolved once per distinct parent path (a table of inner units) and
    joined back by that path.  Each level is then picked by array position:
    rows are never exploded or regrouped, and the root, which is on every
    path, is no join key of the units.
    """
    n_levels = len(levels)
    src = [source] if source else []
    # A blank path element (after the leading slash) is no ancestor.
    parts = F.slice(F.split(F.col(quoted(path)), "/"), 2, 1_000_000)
    parts = F.transform(parts, lambda p: F.when(F.length(F.trim(p)) > 0, p))
    own = F.coalesce(F.try_element_at(parts, F.lit(-1)) == F.col(quoted(uid)), F.lit(False))
    above = F.when(own, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    above = F.slice(F.coalesce(above, F.array().cast("array<string>")), 1, max(n_levels, 1))
    level = F.coalesce(F.regexp_count(F.col(quoted(path)), F.lit("/")), F.lit(0)).alias("level")
    rows = units.select(
        *[F.col(quoted(c)) for c in dict.fromkeys([uid, name, *keep, *src])], level,
        F.coalesce(parts, F.array().cast("array<string>")).alias("_parts"), own.alias("_own"), above.alias("_above"))

    inner = rows.select(*[quoted(c) for c in src], "_above").where(F.size("_above") > 0).distinct()
    elements = inner.select(*[quoted(c) for c in src], "_above", F.posexplode("_above").alias("_pos", "_anc"))
    table = (units if lookup is None else lookup).select(
        *[quoted(c) for c in src], F.col(quoted(uid)).alias("_anc"), F.col(quoted(name)).alias("_anc_name"))
    # A uid listed more than once must not multiply rows: its greatest name counts.
    table = table.groupBy(*[quoted(c) for c in src], "_anc").agg(F.array_max(F.collect_set("_anc_name")).alias("_anc_name"))
    # One row per inner unit and ancestor: here the root has as many rows as there are inner units.
    named = elements.join(table, [*src, "_anc"], "left").groupBy(*[quoted(c) for c in src], "_above").agg(
        F.map_from_entries(F.collect_list(F.struct("_pos", F.coalesce("_anc_name", F.lit(""))))).alias("_names"))
    joined = rows.join(named, [*src, "_above"], "left")

    pairs = []
    for i, (level_uid, level_name) in enumerate(levels):
        at = F.get("_parts", F.lit(i))
        self_here = F.col("_own") & (F.size("_parts") == i + 1)
        shown = F.when(self_here, F.coalesce(F.col(quoted(name)), F.lit(""))).otherwise(
            F.coalesce(F.try_element_at("_names", F.lit(i)), F.lit("")))
        pairs += [(level_uid, at), (level_name, F.when(at.isNotNull(), shown))]
    wide = joined.select(quoted(uid), quoted(name), *[quoted(k) for k in keep], "level", *merge_named(pairs))
    return wide.fillna("", subset=[quoted(n) for n in merged_names(n for n, _ in pairs)]) if pairs else wide
