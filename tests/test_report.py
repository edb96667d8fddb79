"""Case-control report on hand-written submissions (FIXTURES B3, B4)."""

from pyspark.sql import functions as F

from tallysheet.operators.report import (
    BandSpec,
    ReportConfig,
    band_indicators,
    band_report_wide,
    fill_cast,
    form_report,
    long_rows,
    unknown_facilities,
)

SUBMISSION = "interview_date string, health_facility string, consent_granted string, participant_age string, " \
             "participant_gender string, case_control string"

AGES = [0, 4, 5, 14, 15, 24, 25, 49, 50, None]
EXPECTED_BAND = ["0-4", "0-4", "5-14", "5-14", "15-24", "15-24", "25-49", "25-49", ">=50", "0-4"]


def test_band_edges_and_missing_values(spark):
    rows = [("2024-01-02", "F1", "1", None if a is None else str(a), "1", "1") for a in AGES]
    df = fill_cast(spark.createDataFrame(rows, SUBMISSION))
    flags = band_indicators(df, BandSpec(), keep=["participant_age"]).collect()
    for r, band in zip(flags, EXPECTED_BAND):
        hot = [k for k, v in r.asDict().items() if k != "participant_age" and v == 1]
        assert hot == [f"{band}-Male-Case"], (r["participant_age"], hot)


def test_missing_sex_or_arm_counts_nowhere(spark):
    rows = [("2024-01-02", "F1", "1", "30", None, "1"), ("2024-01-02", "F1", "1", "30", "2", None)]
    df = fill_cast(spark.createDataFrame(rows, SUBMISSION))
    assert all(sum(v for k, v in r.asDict().items()) == 0 for r in band_indicators(df).collect())


CONFIG = ReportConfig(
    dataelements=[
        {"dataElement": "DE_A", "category_option_combo": {"0-4-Male-Case": "cocA1", "5-14-Female-Control": "cocA2"}},
        {"dataElement": "DE_B", "category_option_combo": {"0-4-Male-Case": "cocB1"}},
    ],
    attribute_option_combo="aoc",
)


def submissions(spark):
    rows = [
        ("2024-01-02", "F1", "1", "3", "1", "1"),
        ("2024-01-02", "F1", "1", "2", "1", "1"),
        ("2024-01-02", "F1", "0", "9", "2", "2"),
        ("2024-01-03", "F2", None, "40", "1", "2"),
        ("2024-01-03", None, "1", "3", "1", "1"),  # no facility: dropped from the grouping
        ("2024-01-04", "F9", "1", "3", "1", "1"),  # facility unknown to the unit map
    ]
    return fill_cast(spark.createDataFrame(rows, SUBMISSION))


def units(spark):
    return spark.createDataFrame([("F1", "OU_1"), ("F2", "OU_2")], "health_facility string, orgUnit string")


def test_wide_report_drops_null_keys(spark):
    wide = band_report_wide(submissions(spark))
    got = {(r["interview_date"], r["health_facility"]): r for r in wide.collect()}
    assert set(got) == {("2024-01-02", "F1"), ("2024-01-03", "F2"), ("2024-01-04", "F9")}
    assert got[("2024-01-02", "F1")]["0-4-Male-Case"] == 2
    assert got[("2024-01-02", "F1")]["5-14-Female-Control"] == 1


def test_long_report_rows_and_zeros(spark):
    out = form_report(submissions(spark), CONFIG, units(spark))
    got = sorted(tuple(r) for r in out.collect())
    # known groups x configured pairs, zeros included; the unknown facility is left out
    assert len(got) == 2 * 3
    assert ("cocA1", "aoc", "20240102", "OU_1", "DE_A", 2) in got
    assert ("cocB1", "aoc", "20240102", "OU_1", "DE_B", 2) in got
    assert ("cocA2", "aoc", "20240102", "OU_1", "DE_A", 1) in got
    assert ("cocA1", "aoc", "20240103", "OU_2", "DE_A", 0) in got
    rejects = [r["health_facility"] for r in unknown_facilities(submissions(spark), CONFIG, units(spark)).collect()]
    assert rejects == ["F9"]


def test_empty_input_gives_empty_report(spark):
    empty = submissions(spark).where(F.lit(False))
    assert form_report(empty, CONFIG, units(spark)).count() == 0


def test_wide_report_can_sum_every_numeric_column(spark):
    wide = band_report_wide(submissions(spark), sum_numeric=True)
    row = wide.where(F.col("health_facility") == "F1").collect()[0]
    assert row["participant_age"] == 3 + 2 + 9 and row["consent_granted"] == 2


def test_config_tables(spark):
    from tallysheet.sources.config import config_table, report_entries

    units = config_table(spark, {"F1": "OU_1", "F2": "OU_2"}, "health_facility", "orgUnit")
    out = form_report(submissions(spark), CONFIG, units)
    assert out.count() == 6
    entries = sorted(tuple(r) for r in report_entries(spark, CONFIG.dataelements).collect())
    assert entries == sorted(CONFIG.entries())


def test_submissions_dealt_before_the_sums_give_the_same_report(spark):
    rows = [(f"2024-01-{1 + i % 28:02d}", f"F{i % 37}", i % 60, i % 3, i % 2 + 1, 1) for i in range(900)]
    rows += [("2024-02-01", "F1", 3, 1, 1, 1)] * 450  # one group with a third of all rows
    rows += [(None, "F1", 3, 1, 1, 1), ("2024-02-01", None, 3, 1, 1, 1)]
    df = spark.createDataFrame(rows, "interview_date string, health_facility string, participant_age int, "
                                     "participant_gender int, case_control int, consent_granted int").repartition(4)
    wanted = sorted(tuple(r) for r in band_report_wide(df).collect())
    dealt = band_report_wide(df, parts=5)
    assert sorted(tuple(r) for r in dealt.collect()) == wanted
    assert "RepartitionByExpression" in dealt._jdf.queryExecution().optimizedPlan().toString()
    units_of_all = spark.createDataFrame([(f"F{i}", f"OU_{i}") for i in range(37)], "health_facility string, orgUnit string")
    long = [form_report(df, CONFIG, units_of_all, parts=n) for n in (None, 5)]
    assert sorted(tuple(r) for r in long[0].collect()) == sorted(tuple(r) for r in long[1].collect())
    assert "stack(" not in long[0]._jdf.queryExecution().optimizedPlan().toString()


def test_long_rows_keep_empty_sums(spark):
    wide = spark.createDataFrame([("2024-01-02", "F1", None, 4)], "interview_date string, health_facility string, `a-1` long, `b.2` long")
    config = ReportConfig([{"dataElement": "DE", "category_option_combo": {"a-1": "c1", "b.2": "c2"}},
                           {"dataElement": "DE2", "category_option_combo": {"a-1": "c1"}}], "aoc")
    got = sorted(tuple(r)[2:] for r in long_rows(wide, config).collect())
    assert got == [("c1", "DE", None), ("c1", "DE2", None), ("c2", "DE", 4)]
