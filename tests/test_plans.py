"""Plan lint: no registered query may plan an all-pairs join or a Python UDF,
and scans must prune columns."""

import re

import pytest

import __spark_entry__ as E
from tallysheet.plans import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_all_pairs_join_or_python(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_report_scan_reads_only_needed_columns(spark):
    df = E.queries()["form_report"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [[a.split("#")[0] for a in cols.split(",")] for cols in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]
    lineitem = [cols for cols in scans if "l_suppkey" in cols][0]
    assert sorted(lineitem) == ["l_linestatus", "l_quantity", "l_returnflag", "l_shipdate", "l_suppkey"]


def test_incremental_filter_reaches_the_scan(spark):
    plan = E.queries()["incremental_hwm"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", plan)
