"""Every query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from suite import QUERIES, SQL
from tests.check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert compare(df, con, entry.oracle_sql()[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Window [" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "row_id"
