"""Order-sensitive work with large keys cut into fragments, against plain sorting."""

import random

import pytest
from pyspark.sql import functions as F

from seriesloom import slice_intervals
from seriesloom.operators import fragments

from .support import instances
from .test_geometry import slices


@pytest.fixture(params=[30, 10**6])
def fragment_rows(request, monkeypatch):
    monkeypatch.setattr(fragments, "FRAGMENT_ROWS", request.param)
    return request.param


def data(seed):
    rng = random.Random(seed)
    rows = [("hot", rng.choice([None, 1.0, 2.0, rng.random()])) for _ in range(900)]
    rows += [("tied", 5.0)] * 300 + [("tied", 6.0)] + [("nulls", None)] * 200
    rows += [(f"s{rng.randrange(60)}", rng.choice([None, 1.0, -2.0])) for _ in range(200)]
    rows += [(None, float(k)) for k in range(100)]
    return [(k, v, f"{i:05d}") for i, (k, v) in enumerate(rows)]


def ordered(rows):
    groups = {}
    for k, v, t in rows:
        groups.setdefault(k, []).append((v is not None, v or 0.0, t))
    return {k: sorted(g) for k, g in groups.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_next_value(spark, fragment_rows, seed):
    rows = data(seed)
    df = spark.createDataFrame(rows, "k string, v double, t string").repartition(4)
    out = fragments.with_next_value(df, "k", "v", F.col("t"), "next", ("lo", "hi", "n")).collect()
    want = {}
    for k, group in ordered(rows).items():
        values = [v if filled else None for filled, v, _ in group]
        known = [v for v in values if v is not None]
        ends = (min(known, default=None), max(known, default=None), len(group))
        for (_, _, t), after in zip(group, [*values[1:], None], strict=True):
            want[t] = (after, *ends)
    assert {r.t: (r.next, r.lo, r.hi, r.n) for r in out} == want and len(out) == len(rows)
    assert set(fragments.with_next_value(df, "k", "v", F.col("t"), "next").columns) == {"k", "v", "t", "next"}


@pytest.mark.parametrize("seed", [3, 4])
def test_position(spark, fragment_rows, seed):
    rows = data(seed)
    df = spark.createDataFrame(rows, "k string, v double, t string").repartition(4)
    order = F.struct(F.col("v").isNull(), "v", "t")
    got = {r.t: r.place for r in fragments.with_position(df, ["k"], order, "place").collect()}
    want = {}
    for group in ordered(rows).values():
        for i, (_, _, t) in enumerate(sorted(group, key=lambda r: (not r[0], r[1], r[2]))):
            want[t] = i + 1
    assert got == want


def test_no_fragment_holds_a_large_key(spark, monkeypatch):
    monkeypatch.setattr(fragments, "FRAGMENT_ROWS", 50)
    df = spark.range(5000).selectExpr("if(id % 10 < 9, 'hot', cast(id as string)) as k", "1.0D as v", "id as t")
    order = F.struct("v", "t")
    cut = fragments.cut_at(df, ["k"], order, fragments.split_points(df, ["k"], order))
    sizes = [r["count"] for r in cut.groupBy("k", fragments.FRAGMENT).count().collect()]
    assert len(sizes) > 500 + 45 and max(sizes) < 200
    assert fragments.split_points(df.limit(0), ["k"], order) is None


@pytest.mark.parametrize("size", [40, 10**6])
def test_instances_are_shuffled_once(spark, monkeypatch, tmp_path, size):
    monkeypatch.setattr(fragments, "FRAGMENT_ROWS", size)
    instances(spark, slices("hot", range(300)) + slices("cold", range(5))).write.parquet(f"{tmp_path}/i")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = slice_intervals(spark.read.parquet(f"{tmp_path}/i"))
        found = []

        def walk(node):
            children = node.children()
            for i in range(children.size()):
                walk(children.apply(i))
            if node.nodeName() == "Exchange" and "SOPInstanceUID" in node.schema().simpleString():
                found.append(node.outputPartitioning().toString())

        walk(out._jdf.queryExecution().executedPlan())
        assert len(found) == 1 and found[0].startswith("hashpartitioning(SeriesInstanceUID")
        assert ("_fragment" in found[0]) is (size == 40)
        assert out.where("slice_interval = 1").count() == 303
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
