"""Change tracking: the staging tables' update triggers as one projection (O-47..O-49).

A staged row carries ``change in ('insert', 'update', '')``.  Loading a batch
into the staged table (an upsert) sets:

* a key new to the table -> ``'insert'``;
* an existing key where any *tracked* column differs -> ``'update'``, and
  ``previous_<col> = old <col>`` for the captured columns;
* otherwise the old status stays.

``old <> new`` with a NULL on either side is not a change (SQL ``<>``),
unless ``null_safe``.  With ``version_col`` an incoming row older than the
stored one never replaces a value (a sparse load still takes from it what the
stored row lacks), so re-pulled or out-of-order documents never regress a
value.  Rows with a NULL key never enter.  A row still pending as ``'insert'`` stays ``'insert'``
when it changes again before export (``keep_pending_insert``), so the
warehouse never gets an update for a row it has not received.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.functions.keys import quoted
from tallysheet.operators.upsert import CHANGE_COL, PENDING


@dataclass(frozen=True)
class ChangeSpec:
    keys: Sequence[str]
    tracked: Sequence[str]
    previous: Mapping[str, str] = field(default_factory=dict)  # tracked column -> previous-value column
    change_col: str = CHANGE_COL
    null_safe: bool = False
    keep_pending_insert: bool = True
    version_col: str | None = None  # when set, an older incoming row never replaces a newer stored one


# Tracked columns of each staging table (what its trigger compares),
# and the columns whose old value is kept as previous_name.
TRACKED = {
    "data_source": ["id", "title", "url", "description"],
    "organisationunit": ["name", "shortname", "parentid"],
    "orgunitlevel": ["name", "level"],
    "optionset": ["name"],
    "categorycombo": ["name"],
    "dataelementcategory": ["name", "datadimension"],
    "dataelementcategoryoption": ["name", "shortname"],
    "categoryoptioncombo": ["name"],
    "dataelement": ["name", "shortname", "formname", "domaintype", "aggregationtype", "categorycomboid"],
    "dataelementgroup": ["name", "formname", "aggregationtype"],
    "datavalue": ["value"],
}
PREVIOUS_NAME = {
    "orgunitlevel": {"name": "previous_name"},
    "dataelementcategory": {"name": "previous_name"},
    "dataelementgroup": {"name": "previous_name"},
}


def _differs(new: Column, old: Column, null_safe: bool) -> Column:
    if null_safe:
        return ~new.eqNullSafe(old)
    return F.coalesce(new != old, F.lit(False))


def detect_changes(current: DataFrame, incoming: DataFrame, spec: ChangeSpec, sparse: bool = False,
                   present: tuple[str, Mapping[str, int]] | None = None) -> DataFrame:
    """Upsert ``incoming`` into ``current`` and set status / previous values.

    ``sparse``: only what ``incoming`` has replaces a stored value, which is what is not NULL, or, with ``present``
    (a bitmap column of both and the bit of each column), what the bitmap says.

    ``incoming`` has the keys and any subset of the data columns (no status
    and no previous-value columns); keys are unique in both inputs.  One full
    outer join on the keys, everything else is a projection.
    """
    keys = list(spec.keys)
    for k in keys:  # a NULL key equals nothing: such rows never enter (split_rejects lists them)
        incoming = incoming.where(F.col(quoted(k)).isNotNull())
    state_cols = {spec.change_col, *spec.previous.values()}
    in_cols = [c for c in incoming.columns if c not in keys]
    o = current.select(*keys, *[F.col(quoted(c)).alias("o__" + c) for c in current.columns if c not in keys],
                       F.lit(True).alias("o__hit"))
    n = incoming.select(*keys, *[F.col(quoted(c)).alias("n__" + c) for c in in_cols], F.lit(True).alias("n__hit"))
    j = o.join(n, keys, "full_outer")
    old_hit, new_hit = F.col("o__hit").isNotNull(), F.col("n__hit").isNotNull()
    if spec.version_col is not None and spec.version_col in in_cols:
        newer = F.col(quoted("n__" + spec.version_col)) >= F.col(quoted("o__" + spec.version_col))
        late = new_hit & old_hit & ~F.coalesce(newer, F.lit(True))
        new_hit = new_hit & ~late
    else:
        late = F.lit(False)

    def has(side: str, c: str) -> Column:
        if present is None or c not in present[1]:
            return F.col(quoted(side + c)).isNotNull()
        return F.coalesce(F.col(quoted(side + present[0])).bitwiseAND(F.lit(present[1][c]).cast("long")) != 0, F.lit(False))

    def first_that_has(first: str, second: str, c: str) -> Column:
        return F.when(has(first, c), F.col(quoted(first + c))).otherwise(F.col(quoted(second + c)))

    changed = F.lit(False)
    for c in spec.tracked:
        if c in in_cols:
            new_value = first_that_has("n__", "o__", c) if sparse else F.col(quoted("n__" + c))
            changed = changed | _differs(new_value, F.col(quoted("o__" + c)), spec.null_safe)
    changed = old_hit & new_hit & changed  # new_hit: the incoming row is taken

    old_change = F.col(quoted("o__" + spec.change_col))
    status = F.when(~old_hit, F.lit("insert"))
    if spec.keep_pending_insert:
        status = status.when(changed & (old_change == "insert"), old_change)
    status = status.when(changed, F.lit("update")).otherwise(old_change)

    out = []
    for c in current.columns:
        if c in keys:
            out.append(F.col(quoted(c)))
        elif c == spec.change_col:
            out.append(status.alias(c))
        elif c in spec.previous.values():
            source = next(k for k, v in spec.previous.items() if v == c)
            out.append(F.when(changed, F.col(quoted("o__" + source))).otherwise(F.col(quoted("o__" + c))).alias(c))
        elif present is not None and c == present[0]:
            both = [F.coalesce(F.col(quoted(side + c)), F.lit(0).cast("long")) for side in ("n__", "o__")]
            out.append(both[0].bitwiseOR(both[1]).alias(c))
        elif c in in_cols and c not in state_cols:
            new_value, old_value = F.col(quoted("n__" + c)), F.col(quoted("o__" + c))
            kept = old_value
            if sparse:  # a late document still fills what no newer one carried
                new_value = first_that_has("n__", "o__", c)
                kept = F.when(late, first_that_has("o__", "n__", c)).otherwise(old_value)
            out.append(F.when(new_hit, new_value).otherwise(kept).alias(c))
        else:
            out.append(F.col(quoted("o__" + c)).alias(c))
    # Columns that the mapping gained since the table was written.
    added = [c for c in in_cols if c not in current.columns and c not in state_cols]
    out += [F.when(new_hit, F.col(quoted("n__" + c))).alias(c) for c in added]
    return j.select(*out)


def split_rejects(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that have every required column, and the others with a ``reason`` (O-10, O-50: PRIMARY KEY / NOT NULL)."""
    missing = [F.when(F.col(quoted(c)).isNull(), F.lit(c)) for c in required]
    reason = F.concat(F.lit("missing "), F.array_join(F.array_compact(F.array(*missing)), ", "))
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(quoted(c)).isNull()
    return df.where(~bad), df.where(bad).withColumn("reason", reason)


def reset_changes(df: DataFrame, keys: Sequence[str] | None = None, flushed: DataFrame | None = None,
                  change_col: str = CHANGE_COL) -> DataFrame:
    """After an export, pending rows become ``''`` (O-49).

    With ``flushed`` (the exported keys) only those rows are reset, so a row
    that changed after the export snapshot stays pending.
    """
    pending = F.col(change_col).isin(*PENDING)
    if flushed is None:
        return df.withColumn(change_col, F.when(pending, F.lit("")).otherwise(F.col(change_col)))
    marked = flushed.select(*keys).distinct().withColumn("_flushed", F.lit(True))
    joined = df.join(marked, list(keys), "left")
    reset = F.when(pending & F.col("_flushed").isNotNull(), F.lit("")).otherwise(F.col(change_col))
    return joined.withColumn(change_col, reset).drop("_flushed").select(*df.columns)
