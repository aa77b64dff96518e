"""Every registered query against its SQL twin, or for rows and properties without one."""

import pytest
from oracle import connect, difference, spark_rows, sql_rows

from corpusmill.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf, db, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert difference(spark_rows(df), sql_rows(db, ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
