"""Every registered query against its SQL, and its plan."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference
from tests.conftest import SMALL

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.columns


def test_entry(spark):
    assert entry.entry(spark).count() > 0
