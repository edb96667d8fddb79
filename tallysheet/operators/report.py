"""Banded indicator report: fill/cast, band flags, group sums, long rows.

The survey-form report counts submissions per (interview date, facility) in
an age-band x sex x case/control grid, then emits one long row per
configured (data element, indicator) pair.  All of it is one aggregation
over built-in expressions: the flags are evaluated inside the sums
(map-side partial aggregation, no materialised flag columns), and the long
form is an ``UNPIVOT`` compiled from the configuration, so the
configuration never needs a join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.functions.casts import try_number
from tallysheet.functions.keys import quoted
from tallysheet.operators.skew import is_heavy


@dataclass(frozen=True)
class Band:
    label: str
    low: int
    high: int | None  # exclusive upper bound; None = open-ended


# The indicator grid of the case-control report.  Column names
# are "<band>-<sex>-<arm>", and the codes are those of the survey form.
AGE_BANDS = (
    Band("0-4", 0, 5),
    Band("5-14", 5, 15),
    Band("15-24", 15, 25),
    Band("25-49", 25, 50),
    Band(">=50", 50, None),
)
SEXES = (("Male", 1), ("Female", 2))
ARMS = (("Case", 1), ("Control", 2))
FILLED_COLUMNS = ("consent_granted", "participant_age", "participant_gender", "case_control")


@dataclass(frozen=True)
class BandSpec:
    """Where the report finds age, sex and arm, and which grid it counts."""

    age_col: str = "participant_age"
    sex_col: str = "participant_gender"
    arm_col: str = "case_control"
    bands: tuple[Band, ...] = AGE_BANDS
    sexes: tuple[tuple[str, int], ...] = SEXES
    arms: tuple[tuple[str, int], ...] = ARMS

    def cells(self) -> list[tuple[str, Band, int, int]]:
        """(column name, band, sex code, arm code) in report order: band, arm, sex."""
        return [
            (f"{band.label}-{sex_name}-{arm_name}", band, sex_code, arm_code)
            for band in self.bands
            for arm_name, arm_code in self.arms
            for sex_name, sex_code in self.sexes
        ]

    def names(self) -> list[str]:
        return [cell[0] for cell in self.cells()]

    def indicators(self) -> list[tuple[str, Column]]:
        """(column name, 0/1 flag expression) in report order."""
        age, sex, arm = F.col(self.age_col), F.col(self.sex_col), F.col(self.arm_col)
        out = []
        for name, band, sex_code, arm_code in self.cells():
            cond = age >= band.low
            if band.high is not None:
                cond = cond & (age < band.high)
            cond = cond & (sex == sex_code) & (arm == arm_code)
            out.append((name, F.when(cond, 1).otherwise(0)))
        return out


def fill_cast(df: DataFrame, columns: Iterable[str] = FILLED_COLUMNS) -> DataFrame:
    """Missing -> 0, then integer (fractions truncate, also in text); absent columns are skipped."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def whole(c: str) -> Column:
        exact = try_number(F.col(c), T.IntegerType(), types[c])
        if not isinstance(types[c], T.StringType):
            return exact
        # Only text with a fraction or an exponent needs the detour over a double.
        fraction = F.when(F.col(c).rlike("[.eE]"), try_number(F.col(c), T.DoubleType(), types[c]).try_cast("int"))
        return F.coalesce(exact, fraction)

    replace = {c: F.coalesce(whole(c), F.lit(0)) for c in columns if c in types}
    return df.withColumns(replace) if replace else df


def band_indicators(df: DataFrame, spec: BandSpec = BandSpec(), keep: Sequence[str] = ()) -> DataFrame:
    """One 0/1 column per grid cell, next to the ``keep`` columns."""
    return df.select(*keep, *[flag.alias(name) for name, flag in spec.indicators()])


def band_report_wide(
    df: DataFrame,
    keys: Sequence[str] = ("interview_date", "health_facility"),
    spec: BandSpec = BandSpec(),
    sum_numeric: bool | Sequence[str] = False,
    ordered: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Group sums of every grid cell; rows with a NULL key are dropped first.

    ``sum_numeric`` also sums every other numeric input column (under its own
    name), as a frame-wide ``sum()`` would, or those it names.  ``ordered``
    sorts by the keys, as a group-by of a frame does.

    ``parts`` is for inputs whose groups are about as many as their rows: there a map task's
    sums hold twenty numbers for each row and combine next to nothing.  The submissions are
    then dealt to so many tasks by their keys before they are summed; groups with a large share
    of all rows are still combined in every map task.
    """
    not_null = None
    for k in keys:
        cond = F.col(k).isNotNull()
        not_null = cond if not_null is None else not_null & cond
    sums = [F.sum(flag).alias(name) for name, flag in spec.indicators()]
    if sum_numeric:
        numeric = [f.name for f in df.schema.fields
                   if f.name not in keys and isinstance(f.dataType, T.NumericType)
                   and f.name not in spec.names() and (sum_numeric is True or f.name in sum_numeric)]
        sums += [F.sum(F.col(f"`{c}`")).alias(c) for c in numeric]
    known = df.where(not_null)
    if parts is None:
        out = known.groupBy(*keys).agg(*sums)
    else:
        heavy = is_heavy(known, keys)
        dealt = known.where(~heavy).repartition(parts, *keys)
        out = dealt.groupBy(*keys).agg(*sums).unionAll(known.where(heavy).groupBy(*keys).agg(*sums))
    return out.orderBy(*keys) if ordered else out


@dataclass(frozen=True)
class ReportConfig:
    """Data elements and what each one reports.

    ``dataelements`` is a list of ``{"dataElement": uid, "category_option_combo":
    {indicator column: combo uid}}``; one indicator may feed several elements.
    """

    dataelements: Sequence[Mapping]
    attribute_option_combo: str
    facility_col: str = "health_facility"
    date_col: str = "interview_date"
    extra: dict = field(default_factory=dict)

    def entries(self) -> list[tuple[str, str, str]]:
        """(indicator, dataElement, categoryOptionCombo) in configuration order."""
        return [
            (indicator, de["dataElement"], combo)
            for de in self.dataelements
            for indicator, combo in de["category_option_combo"].items()
        ]


def long_rows(wide: DataFrame, config: ReportConfig, keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot fused with the configuration: one row per group and configured pair.

    An ``UNPIVOT`` over the configured (combo, element, indicator) triples - no join
    with the configuration, and no row objects as a ``stack`` generator makes for each
    group: Spark writes the triples out in one compiled loop.
    """
    entries = config.entries()
    indicators, elements, combos = ({x: i for i, x in enumerate(dict.fromkeys(column))} for column in zip(*entries))
    cells = wide.select(
        config.date_col, config.facility_col, *keep,
        *[F.lit(x).alias(f"_combo{i}") for x, i in combos.items()],
        *[F.lit(x).alias(f"_element{i}") for x, i in elements.items()],
        *[F.col(quoted(x)).cast("bigint").alias(f"_value{i}") for x, i in indicators.items()],
    )
    triples = ", ".join(f"(_combo{combos[c]}, _element{elements[e]}, _value{indicators[i]})" for i, e, c in entries)
    rows = wide.sparkSession.sql(
        "SELECT * FROM {cells} UNPIVOT INCLUDE NULLS ((categoryOptionCombo, dataElement, value) FOR _entry IN (" + triples + "))",
        cells=cells)
    return rows.select(config.date_col, config.facility_col, *keep, "categoryOptionCombo", "dataElement", "value")


def form_report(
    rows: DataFrame,
    config: ReportConfig,
    orgunits: DataFrame,
    spec: BandSpec = BandSpec(),
    parts: int | None = None,
) -> DataFrame:
    """Submissions -> long report rows ``categoryOptionCombo, attributeOptionCombo,
    period (yyyyMMdd), orgUnit, dataElement, value``.

    ``orgunits`` maps ``config.facility_col`` to ``orgUnit``; facilities it lacks
    are left out (see ``unknown_facilities`` for the reject list).  ``parts``: see ``band_report_wide``.
    """
    # A configuration may name any summed column, not only the grid's.
    others = sorted({indicator for indicator, _, _ in config.entries()} - set(spec.names()))
    wide = band_report_wide(rows, (config.date_col, config.facility_col), spec, sum_numeric=others, parts=parts)
    # Resolve the unit and the period on the wide rows (one per group), before
    # the fan-out to long rows.  The date may be text (yyyy-MM-dd) or a date.
    # Facility codes are compared as text: a map may hold codes that are no numbers.
    units = orgunits.select(F.col(config.facility_col).cast("string").alias("_facility"), "orgUnit")
    period = F.replace(F.col(config.date_col).cast("string"), F.lit("-"), F.lit("")).alias("period")
    located = wide.withColumn("_facility", F.col(config.facility_col).cast("string")).join(units, "_facility")
    located = located.withColumn("period", period)
    return long_rows(located, config, keep=["orgUnit", "period"]).select(
        "categoryOptionCombo",
        F.lit(config.attribute_option_combo).alias("attributeOptionCombo"),
        "period",
        "orgUnit",
        "dataElement",
        "value",
    )


def unknown_facilities(rows: DataFrame, config: ReportConfig, orgunits: DataFrame) -> DataFrame:
    """Reject output: facilities in the submissions that the unit map does not know."""
    facilities = rows.where(F.col(config.facility_col).isNotNull()).select(config.facility_col).distinct()
    known = orgunits.select(F.col(config.facility_col).cast("string").alias("_facility")).distinct()
    return facilities.join(known, F.col(config.facility_col).cast("string") == F.col("_facility"), "left_anti")


ROWS = "submissions"


def report_totals(df: DataFrame, keys: Sequence[str] = ("interview_date", "health_facility"), spec: BandSpec = BandSpec(),
                  sign: Column | None = None) -> DataFrame:
    """Signed sums of every grid cell and of the submissions themselves, per group; ``sign`` is 1 or -1 per row.

    Rows with a NULL key belong to no group.
    """
    sign = F.lit(1) if sign is None else sign
    known = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    cells = [F.sum(flag * sign).cast("long").alias(name) for name, flag in spec.indicators()]
    return known.groupBy(*keys).agg(F.sum(sign).cast("long").alias(ROWS), *cells)


def report_delta(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("interview_date", "health_facility"),
                 spec: BandSpec = BandSpec()) -> DataFrame:
    """What edited submissions change: their old rows are taken back, their new ones added (signed sums per group).

    ``before`` and ``after`` hold the changed submissions only, as they were and as they are; an inserted one is in
    ``after`` alone, a deleted one in ``before`` alone.  One pass over both; a group with a third of the rows is combined in every task.
    """
    used = list(dict.fromkeys([*keys, spec.age_col, spec.sex_col, spec.arm_col]))
    signed = before.select(*used, F.lit(-1).alias("_sign")).unionByName(after.select(*used, F.lit(1).alias("_sign")))
    return report_totals(signed, keys, spec, F.col("_sign"))


def apply_report_delta(totals: DataFrame, delta: DataFrame, keys: Sequence[str] = ("interview_date", "health_facility"),
                       ) -> tuple[DataFrame, DataFrame]:
    """(the groups the delta touches, as they are now; the keys of groups that have no submission any more).

    Only these are to be rewritten: the rest of ``totals`` stays.
    """
    values = [c for c in totals.columns if c not in keys]
    # One struct per group: a filter over twenty renamed columns would make the optimizer derive one for every mix of names.
    zeros = F.struct(*[F.lit(0).cast("long").alias(c) for c in values])
    moved = delta.select(*keys, F.struct(*[F.col(quoted(c)) for c in values]).alias("_delta")).where(F.col("_delta") != zeros)
    joined = moved.join(totals, list(keys), "left").select(
        *keys, *[(F.coalesce(F.col(quoted(c)), F.lit(0)) + F.col("_delta").getField(c)).cast("long").alias(c) for c in values])
    joined = joined.withColumn(ROWS, F.when(F.col(ROWS) < 0, F.raise_error(F.lit("a group lost more submissions than it had")))
                               .otherwise(F.col(ROWS)))
    return joined.where(F.col(ROWS) > 0), joined.where(F.col(ROWS) == 0).select(*keys)


def changed_submissions(old: DataFrame, new: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of ``old`` that are gone or different, rows of ``new`` that are new or different), by submission ``key``.

    Keys are unique in both; rows are compared by all columns of ``new``, NULL equals NULL.
    """
    columns = [c for c in new.columns if c != key]
    o = old.select(F.col(quoted(key)), F.struct(*[F.col(quoted(c)) for c in columns]).alias("_old"))
    n = new.select(F.col(quoted(key)), F.struct(*[F.col(quoted(c)) for c in columns]).alias("_new"))
    both = o.join(n, key, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
    return (both.where("_old IS NOT NULL").select(quoted(key), "_old.*"),
            both.where("_new IS NOT NULL").select(quoted(key), "_new.*"))
