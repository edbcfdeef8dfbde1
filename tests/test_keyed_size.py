"""Keyed comparison deals its rows once, and counts frequent keys apart with the same results."""

import pytest

from seriesloom.operators import compare as C

from .test_size import exchanges


def lists(spark, n):
    left = spark.range(4 * n).selectExpr("id % {0} as k".format(n), "id % 13 as a", "cast(id % 5 as string) as b")
    return left, left.selectExpr("k", "case when k % 3 = 0 then a + 1 else a end as a", "b")


def test_open_keys_are_dealt_once(spark):
    left, right = lists(spark, 3000)
    out = C.keyed_diff(left, right, "k")
    out.collect()
    moved = [n.metrics().apply("shuffleRecordsWritten").value() for n in exchanges(out)]
    assert sum(moved) < 1.2 * 8 * 3000


@pytest.mark.parametrize("heavy", [0, 5])
def test_frequent_keys_are_counted_alike(spark, monkeypatch, heavy):
    """Keys that count as frequent, all or some of them, give the same numbers of pairs."""
    left, right = lists(spark, 200)
    many = spark.range(60).selectExpr("7L as k", "id % 4 as a", "cast(null as string) as b")
    left, right = left.unionByName(many).unionByName(many.selectExpr("cast(null as bigint) as k", "a", "b")), right.unionByName(many)
    usual = sorted(map(tuple, C.keyed_diff(left, right, "k").collect()))
    monkeypatch.setattr(C, "HEAVY", heavy)
    assert sorted(map(tuple, C.keyed_diff(left, right, "k").collect())) == usual
    pairs = left.alias("l").join(right.alias("r"), "k")
    wanted = pairs.selectExpr("count(*)", "count(if(l.a <> r.a, 1, null))", "count(if(l.b <> r.b, 1, null))").first()
    found = {r["column"]: r for r in C.keyed_diff(left, right, "k").collect()}
    assert (found["a"].pairs, found["a"].differing, found["b"].differing) == tuple(wanted)
