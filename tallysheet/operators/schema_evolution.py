"""Planned schema evolution of the wide warehouse tables (O-51..O-53).

Metadata rows (a category, a level, a group) that were inserted become two
new columns - ``<uid>`` then ``<name>`` - placed after the name column of
the previous insert (the first one after ``lastupdated``); renamed rows
rename their name column.  The plan is a DataFrame of ordered actions; it
is metadata-sized, so applying it collects it and folds it into a single
``select`` list (idempotent: existing columns are not added twice, a rename
whose source is gone is skipped).

Renames of one plan happen at the same time: two levels may change names, or each take the next one's.
``ordered_renames`` puts them in an order in which no name is taken before its column has left it; a cycle goes through a
temporary name.  Renames come before additions, so a new column may take a name that became free.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallysheet.functions.keys import quoted, sanitize_col
from tallysheet.operators.ordering import carry_forward
from tallysheet.operators.upsert import changed_rows
from tallysheet.session import bounded_rows

BASE_ANCHOR = "lastupdated"


def schema_plan(meta: DataFrame, order_by: Sequence[str], uid: str = "uid", name: str = "name",
                previous: str = "previous_name", change: str = "change", anchor: str = BASE_ANCHOR) -> DataFrame:
    """``(seq, action, column_name, anchor, collides)`` for the pending metadata rows.

    ``ADD column_name AFTER anchor`` or ``RENAME anchor TO column_name``.
    ``collides`` flags a column name that several metadata rows sanitise to.
    """
    pending = changed_rows(meta, change).select(
        *order_by, uid, sanitize_col(F.col(name)).alias("_name"), sanitize_col(F.col(previous)).alias("_prev"), change
    )
    carried = carry_forward(
        pending, order_by, F.when(F.col(change) == "insert", F.col("_name")), "_after", ordinal="_rn"
    )
    actions = carried.select(
        "_name",
        F.inline(
            F.when(
                F.col(change) == "insert",
                F.array(
                    F.struct((F.col("_rn") * 2).alias("seq"), F.lit("ADD").alias("action"),
                             F.col(uid).alias("column_name"), F.coalesce("_after", F.lit(anchor)).alias("anchor")),
                    F.struct((F.col("_rn") * 2 + 1).alias("seq"), F.lit("ADD").alias("action"),
                             F.col("_name").alias("column_name"), F.col(uid).alias("anchor")),
                ),
            ).otherwise(
                F.array(
                    F.struct((F.col("_rn") * 2).alias("seq"), F.lit("RENAME").alias("action"),
                             F.col("_name").alias("column_name"), F.col("_prev").alias("anchor")),
                )
            )
        ),
    )
    counts = pending.groupBy(F.col("_name").alias("column_name")).agg(F.count(F.lit(1)).alias("_claims"))
    return (
        actions.drop("_name")
        .join(counts, "column_name", "left")
        .select("seq", "action", "column_name", "anchor", F.coalesce(F.col("_claims") > 1, F.lit(False)).alias("collides"))
    )


TEMPORARY = "__renaming"


def ordered_renames(renames: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Simultaneous ``(from, to)`` renames as statements that can run one after the other.

    Chains run from their free end backwards; a cycle first moves one column to a temporary name.  A column renamed
    twice in one plan follows its last rename.
    """
    target = {old: new for old, new in renames if old != new}
    leaves = {}  # name -> the column that wants it
    for old, new in target.items():
        leaves.setdefault(new, old)
    out: list[tuple[str, str]] = []
    open_names = dict(target)

    def run_back(name: str) -> None:
        """Renames into ``name``, which is free, then into the name that this frees, and so on."""
        while name in leaves and leaves[name] in open_names and open_names[leaves[name]] == name:
            old = leaves[name]
            out.append((old, open_names.pop(old)))
            name = old

    for new in sorted(set(target.values()) - set(target)):
        run_back(new)
    for old in sorted(target):
        if old in open_names and leaves.get(open_names[old]) == old:  # what is left are cycles
            parked = old + TEMPORARY
            new = open_names.pop(old)
            out.append((old, parked))
            run_back(old)
            out.append((parked, new))
    # Several columns that want one name: the first has it, the others come last and find it taken.
    out += sorted(open_names.items())
    return out


def ordered_actions(actions: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    """``(action, column_name, anchor)`` in an order that can be run statement by statement: renames, then additions."""
    renames = ordered_renames([(anchor, column) for action, column, anchor in actions if action == "RENAME"])
    return [("RENAME", new, old) for old, new in renames] + [a for a in actions if a[0] == "ADD"]


def ordered_plan(plan: DataFrame) -> DataFrame:
    """``(seq, action, column_name, anchor)``: the plan as statements in the order of :func:`ordered_actions`."""
    rows = bounded_rows(plan.orderBy("seq"), "schema actions")
    actions = ordered_actions([(r["action"], r["column_name"], r["anchor"]) for r in rows])
    return plan.sparkSession.createDataFrame([(i, *a) for i, a in enumerate(actions, 1)],
                                             "seq int, action string, column_name string, anchor string")


def plan_columns(columns: Sequence[str], actions: Sequence[tuple[str, str, str]]) -> list[tuple[str, str | None]]:
    """Fold ``(action, column_name, anchor)`` over a column list.

    Returns ``(output name, source column or None for a new '' column)``.  A rename into a name that another column
    keeps raises: the plan would be taken as done while its column still had the old name.
    """
    out: list[list] = [[c, c] for c in columns]
    names = lambda: [o[0] for o in out]
    for action, column, anchor in ordered_actions(actions):
        if action == "ADD":
            if column in names():
                continue
            pos = names().index(anchor) + 1 if anchor in names() else len(out)
            out.insert(pos, [column, None])
        elif action == "RENAME" and anchor in names():
            if column in names():
                raise ValueError(f"column {anchor!r} cannot be renamed: there is a column {column!r}")
            out[names().index(anchor)][0] = column
    return [(o[0], o[1]) for o in out]


def apply_plan(df: DataFrame, plan: DataFrame, fill: str = "") -> DataFrame:
    """Evolve ``df``'s columns by the plan: one ``select``, new columns filled with ``fill``."""
    actions = [(r["action"], r["column_name"], r["anchor"]) for r in bounded_rows(plan.orderBy("seq"), "schema actions")]
    cols = []
    for out_name, source in plan_columns(df.columns, actions):
        cols.append((F.col(quoted(source)) if source is not None else F.lit(fill)).alias(out_name))
    return df.select(*cols)
