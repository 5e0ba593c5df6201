"""Every registered query against its SQL, and the shape of its plan."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
# the library's own; the training-data operators have tests of their own
OTHER = re.compile(r"op\d+_|pipeline$")
QUERIES, SQL = ({k: v for k, v in x.items() if not OTHER.match(k)} for x in (entry.queries(), entry.oracle_sql()))
# Sides that may only be joined by hash or merge; a grid is joined by block
FORBIDDEN = ["CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else round(value, 9) if isinstance(value, float) else value


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in FORBIDDEN if bad in plan]


def test_entry(spark):
    assert entry.entry(spark).count() == 200
