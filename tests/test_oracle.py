"""Every registered query: SQL equality where SQL exists, rows otherwise, and no cross joins."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0
    spark.catalog.clearCache()


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert {r["split"] for r in rows} == {"train", "test"}
