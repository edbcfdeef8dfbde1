"""Every registered query of the subpackage on the smallest data set, against DuckDB where SQL can express it."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from seriesloom.llm import oracle, queries
from tools.check_oracle import TABLES, table

FOLDER = "/root/testdata/sf0.001"
ORACLE = oracle.oracle_sql()
QUERIES = queries.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    assert got[1]
    if name in ORACLE:
        cur = duck.execute(ORACLE[name])
        assert got == table([c[0] for c in cur.description], cur.fetchall())
