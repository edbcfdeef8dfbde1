"""Every registered query against its DuckDB statement on the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from checks import oracle, queries
from tools.check_oracle import TABLES, table

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = oracle.oracle_sql()
QUERIES = queries.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    assert len(set(df.columns)) == len(df.columns)
    if name not in ORACLE:
        assert got[1]
        return
    cur = duck.execute(ORACLE[name])
    want = table([c[0] for c in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
