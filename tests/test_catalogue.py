"""Every registered query against its SQL on the small tables, and its plan against
nodes that cannot scale."""

import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from millrace.plans.catalogue import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    con.execute("set timezone = 'UTC'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([plain(row[i]) for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows, "an empty result shows nothing"
    assert bag(got.columns, rows) == bag(names, want.fetchall())
    plan = got._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "CollectLimit"):
        # over the whole table a running value adds up one row per range
        assert bad not in plan or (name, bad) == ("q_running_three_columns", "SinglePartition")


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
