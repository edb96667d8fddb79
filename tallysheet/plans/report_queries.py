"""Case-control report queries (O-07, O-23, O-31, O-32, O-37, O-40, O-41).

Table analog: each lineitem row is one survey submission.  age = l_quantity,
sex = l_returnflag (A male, R female, N missing), arm = l_linestatus
(O case, F control), interview date = l_shipdate, facility = l_suppkey; the
facility -> org-unit map is derived from supplier.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.functions.casts import day_text
from tallysheet.operators.report import (
    BandSpec,
    ReportConfig,
    apply_report_delta,
    band_indicators,
    band_report_wide,
    changed_submissions,
    fill_cast,
    form_report,
    report_delta,
    report_totals,
)
from tallysheet.plans.registry import register
from tallysheet.sources.tables import Tables

SPEC = BandSpec()
SUBMISSIONS_PER_TASK = 500_000
INDICATORS = SPEC.names()
CASE_INDICATORS = [name for name in INDICATORS if name.endswith("-Case")]

# Report configuration: two data elements; every case indicator feeds both.
CONFIG = ReportConfig(
    dataelements=[
        {
            "dataElement": "deEnrolled01",
            "category_option_combo": {name: f"cocGrid{i:04d}" for i, name in enumerate(INDICATORS)},
        },
        {
            "dataElement": "deCases0001",
            "category_option_combo": {name: f"cocCase{i:04d}" for i, name in enumerate(CASE_INDICATORS)},
        },
    ],
    attribute_option_combo="aocDefault1",
)


def submissions(t: Tables) -> DataFrame:
    """Lineitem as survey submissions, filled and cast like the form data.

    The interview date is kept as a date (a 4-byte grouping key, about twice as
    fast to aggregate as its text); text is produced after the aggregation.
    """
    li = t.lineitem
    raw = li.select(
        F.col("l_shipdate").cast("date").alias("interview_date"),
        F.col("l_suppkey").alias("health_facility"),
        F.col("l_quantity").alias("participant_age"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 2).alias("participant_gender"),
        F.when(F.col("l_linestatus") == "O", 1).when(F.col("l_linestatus") == "F", 2).alias("case_control"),
    )
    return fill_cast(raw)


def report_parts(t: Tables) -> int:
    """Tasks to deal the submissions to: nearly every submission is a group of its own, of twenty sums and thirty rows."""
    return max(t.spark.sparkContext.defaultParallelism, math.ceil(t.lineitem.count() / SUBMISSIONS_PER_TASK))


def facility_units(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("health_facility"),
        F.substring(F.md5("s_name"), 1, 11).alias("orgUnit"),
    )


# ---- oracle SQL, generated from the same grid ---------------------------------

_SRC_SQL = """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS interview_date,
       l_suppkey AS health_facility,
       COALESCE(TRY_CAST(trunc(l_quantity) AS INTEGER), 0) AS participant_age,
       COALESCE(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 END, 0) AS participant_gender,
       COALESCE(CASE l_linestatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 END, 0) AS case_control
FROM lineitem"""


def _flag_sql(band, sex_code: int, arm_code: int) -> str:
    cond = [f"participant_age >= {band.low}"]
    if band.high is not None:
        cond.append(f"participant_age < {band.high}")
    cond += [f"participant_gender = {sex_code}", f"case_control = {arm_code}"]
    return "CASE WHEN " + " AND ".join(cond) + " THEN 1 ELSE 0 END"


def _flags_sql() -> list[tuple[str, str]]:
    out = []
    for band in SPEC.bands:
        for arm_name, arm_code in SPEC.arms:
            for sex_name, sex_code in SPEC.sexes:
                out.append((f"{band.label}-{sex_name}-{arm_name}", _flag_sql(band, sex_code, arm_code)))
    return out


def _wide_sql(where: str = "TRUE") -> str:
    sums = ",\n  ".join(f'CAST(SUM({expr}) AS BIGINT) AS "{name}"' for name, expr in _flags_sql())
    return f"""SELECT interview_date, health_facility,
  {sums}
FROM ({_SRC_SQL}) src
WHERE interview_date IS NOT NULL AND health_facility IS NOT NULL AND {where}
GROUP BY interview_date, health_facility"""


def _report_sql(where: str = "TRUE") -> str:
    cols = ", ".join(f'"{name}"' for name in INDICATORS)
    cfg = ",\n    ".join(f"('{ind}', '{de}', '{coc}')" for ind, de, coc in CONFIG.entries())
    return f"""WITH wide AS ({_wide_sql(where)}),
long AS (UNPIVOT wide ON {cols} INTO NAME indicator VALUE value),
cfg(indicator, dataElement, categoryOptionCombo) AS (VALUES
    {cfg}),
ou AS (SELECT s_suppkey AS health_facility, substr(md5(s_name), 1, 11) AS orgUnit FROM supplier)
SELECT cfg.categoryOptionCombo, '{CONFIG.attribute_option_combo}' AS attributeOptionCombo,
       replace(long.interview_date, '-', '') AS period, ou.orgUnit, cfg.dataElement,
       CAST(long.value AS BIGINT) AS value
FROM long JOIN cfg ON long.indicator = cfg.indicator
JOIN ou ON long.health_facility = ou.health_facility"""


# ---- queries ------------------------------------------------------------------


@register("form_report", _report_sql())
def q_form_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return form_report(submissions(t), CONFIG, facility_units(t), SPEC)


@register(
    "band_indicators",
    "SELECT l_orderkey, l_linenumber,\n  "
    + ",\n  ".join(f'{expr} AS "{name}"' for name, expr in _flags_sql())
    + f"\nFROM ({_SRC_SQL}) src",
)
def q_band_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    li = t.lineitem
    rows = fill_cast(
        li.select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_quantity").alias("participant_age"),
            F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 2).alias("participant_gender"),
            F.when(F.col("l_linestatus") == "O", 1).when(F.col("l_linestatus") == "F", 2).alias("case_control"),
        )
    )
    return band_indicators(rows, SPEC, keep=["l_orderkey", "l_linenumber"])


@register("band_report_wide", _wide_sql())
def q_band_report_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    wide = band_report_wide(submissions(t), ("interview_date", "health_facility"), SPEC, parts=report_parts(t))
    return wide.withColumn("interview_date", day_text(F.col("interview_date")))


@register(
    "empty_report",
    f"SELECT CAST(count(*) AS BIGINT) AS n FROM ({_report_sql(chr(39) + '2100-01-01' + chr(39) + ' <= interview_date')}) r",
)
def q_empty_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    rows = submissions(t).where(F.col("interview_date") >= F.lit("2100-01-01").cast("date"))
    return form_report(rows, CONFIG, facility_units(t), SPEC).agg(F.count(F.lit(1)).alias("n"))


@register(
    "fill_cast",
    """SELECT event_id,
       COALESCE(TRY_CAST(CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS INTEGER), 0) AS k,
       COALESCE(TRY_CAST(trunc(value) AS INTEGER), 0) AS v
FROM events""",
)
def q_fill_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    raw = ev.select(
        "event_id",
        F.when(F.col("event_type") != "error", F.get_json_object("props", "$.k")).alias("k"),
        F.col("value").alias("v"),
    )
    return fill_cast(raw, ["k", "v"])


def _edited(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The submissions before and after a round of edits: some deleted, some inserted, ages and facilities changed."""
    li = t.lineitem
    # No column of the table is a key; all of these together tell its rows apart.
    number = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate").alias("id")
    rows = submissions(t)
    keyed = fill_cast(li.select(
        number, "l_orderkey", F.col("l_shipdate").cast("date").alias("interview_date"), F.col("l_suppkey").alias("health_facility"),
        F.col("l_quantity").alias("participant_age"), F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 2)
        .alias("participant_gender"), F.when(F.col("l_linestatus") == "O", 1).when(F.col("l_linestatus") == "F", 2).alias("case_control")))
    kind = F.col("l_orderkey") % 40
    columns = ["id", *rows.columns]
    before = keyed.where(kind != 1).select(*columns)
    after = keyed.where(kind != 2).withColumn("participant_age", F.when(kind == 3, F.col("participant_age") + 7).otherwise(F.col("participant_age")))
    after = after.withColumn("health_facility", F.when(kind == 4, F.lit(1).cast(after.schema["health_facility"].dataType))
                             .otherwise(F.col("health_facility")))
    return before, after.select(*columns)


@register(
    "report_delta",
    """WITH s AS (
  SELECT CAST(l_shipdate AS DATE) AS d, CASE WHEN l_orderkey % 40 = 4 THEN 1 ELSE l_suppkey END AS f,
         CAST(trunc(l_quantity) AS INTEGER) + CASE WHEN l_orderkey % 40 = 3 THEN 7 ELSE 0 END AS age,
         CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 0 END AS sex, CASE l_linestatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 0 END AS arm
  FROM lineitem WHERE l_orderkey % 40 <> 2
)
SELECT CAST(d AS VARCHAR) AS interview_date, f AS health_facility, count(*) AS submissions,
       count(*) FILTER (WHERE age >= 15 AND age < 25 AND sex = 1 AND arm = 2) AS "15-24-Male-Control",
       count(*) FILTER (WHERE age >= 50 AND sex = 2 AND arm = 2) AS ">=50-Female-Control"
FROM s GROUP BY d, f""",
)
def q_report_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals of the first state, moved to the second by what was edited: equal to counting the second anew."""
    before, after = _edited(Tables(spark, sf_dir))
    keys = ["interview_date", "health_facility"]
    totals = report_totals(before)
    gone, come = changed_submissions(before, after, "id")
    touched, empty = apply_report_delta(totals, report_delta(gone, come))
    rewritten = touched.select(*keys).unionByName(empty)
    kept = totals.join(rewritten, keys, "left_anti")
    return kept.unionByName(touched).select(
        F.col("interview_date").cast("string").alias("interview_date"), "health_facility", "submissions", "`15-24-Male-Control`", "`>=50-Female-Control`")
