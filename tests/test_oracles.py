"""Every query with SQL gives the same rows as that SQL at the smallest scale."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from shelfwise.plans import all_queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = all_queries()
SLOW = {"gbt_classifier", "trending_products", "rf_classifier", "regressor", "kmeans", "segment_names"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(Path(SF).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def frame(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert costly not in plan
    got = frame(df.columns, df.collect())
    cur = db.execute(ORACLES[name])
    want = frame([d[0] for d in cur.description], cur.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 10
    assert [r._score for r in rows] == sorted((r._score for r in rows), reverse=True)


def test_names():
    assert set(oracle_sql()) <= set(queries())
    assert QUERIES.items() <= queries().items() and ORACLES.items() <= oracle_sql().items()
