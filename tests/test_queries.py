"""Every registered query against its SQL over the smallest tables, and the plans of some."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from newsloom.plans import oracles, registered

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(registered.queries()) == set(oracles.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    result = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted(str(tuple(r)) for r in df.select(*names).collect())
    assert got == sorted(str(tuple(r)) for r in result.fetchall())
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "tags" in df.columns


def plan(spark, name):
    return contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_lookback_reaches_the_scan(spark):
    assert "GreaterThanOrEqual(ts,2024-01-30T00:00)" in plan(spark, "lookback_24h")


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "lookback_24h")
    assert "text" not in text.split("ReadSchema")[1]
    assert "value:double" not in plan(spark, "digest")
