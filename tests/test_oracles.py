"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from tallysheet.plans import ORACLES, QUERIES
from tests.conftest import SF_ORACLE
from tools.oracle_check import compare, duckdb_views

@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    problems = compare(df.columns, srows, ocols, cur.fetchall())
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["categoryOptionCombo", "attributeOptionCombo", "period", "orgUnit", "dataElement", "value"]
    assert df.count() > 0
