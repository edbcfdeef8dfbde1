import random
import re
import statistics
from collections import Counter

import pytest

from seriesloom.operators import compare as C
from seriesloom.operators.fragments import _key, _value, exact_medians, search_medians

from .support import by
from .test_plans import first_aggregates


def test_schema_and_shape(spark):
    a = spark.createDataFrame([(1, "x", 2.0)], "k long, s string, only_a double")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, s string")
    got = {r.column: r.status for r in C.schema_diff(a, b).collect()}
    assert got == {"k": "type_differs", "s": "same", "only_a": "only_left"}
    shape = C.shape_diff(a, b).first()
    assert (shape.left_rows, shape.right_rows, shape.left_columns, shape.right_columns) == (1, 2, 3, 2)
    assert shape.same_shape is False


def test_nulls_count_in_one_of_two_ways(spark):
    a = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, None), (5, "left only")], "k long, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (4, None), (6, "right only")], "k long, v string")
    (got,) = C.keyed_diff(a, b, "k").collect()
    assert (got.pairs, got.differing, got.unequal, got.identical) == (4, 1, 2, False)
    assert got.percent == 25.0
    (sample,) = C.keyed_samples(a, b, "k").collect()
    assert (sample.k, sample.left_value, sample.right_value) == (2, "x", "y")


def brute(left, right):
    pairs = differing = unequal = 0
    for k, v in left:
        for k2, v2 in right:
            if k is not None and k == k2:
                pairs += 1
                differing += v is not None and v2 is not None and v != v2
                unequal += v != v2
    return pairs, differing, unequal


@pytest.mark.parametrize("seed", range(3))
def test_repeated_keys_match_brute_force(spark, seed):
    rng = random.Random(seed)
    keys = [0] * 60 + list(range(1, 25)) + [None]  # key 0 is hot

    def side():
        return [(rng.choice(keys), rng.choice([None, -0.0, 0.0, 1.0, 2.0])) for _ in range(120)]

    left, right = side(), side()
    a = spark.createDataFrame(left, "k int, v double")
    b = spark.createDataFrame(right, "k int, v double")
    (got,) = C.keyed_diff(a, b, "k").collect()
    assert (got.pairs, got.differing, got.unequal) == brute(left, right)
    for s in C.keyed_samples(a, b, "k", limit=50).collect():
        assert any(k == s.k and str(v + 0.0) == s.left_value for k, v in left if v is not None)
        assert any(k == s.k and str(v + 0.0) == s.right_value for k, v in right if v is not None)
        assert s.left_value != s.right_value


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_inputs_partitioned_on_the_key(spark, adaptive):
    """Both sides already partitioned on the key: groups must still meet across sides."""
    rng = random.Random(11)

    def side():
        return [(rng.randrange(40), rng.choice([None, "x", "y"])) for _ in range(400)]

    left, right = side(), side()
    a = spark.createDataFrame(left, "k int, v string").repartition(8, "k")
    b = spark.createDataFrame(right, "k int, v string").repartition(8, "k")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        (got,) = C.keyed_diff(a, b, "k").collect()
        assert (got.pairs, got.differing, got.unequal) == brute(left, right)
        surplus = sum(r.surplus for r in C.multiset_diff(a, b).collect())
        one, other = Counter(left), Counter(right)
        assert surplus == sum(((one - other) + (other - one)).values())
        assert C.shape_diff(a, b).collect() == [(400, 400, 2, 2, True)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_arrays_and_unlike_types(spark):
    a = spark.createDataFrame([(1, [1, 2], 5, "7"), (2, [1], 6, "8")], "k long, l array<int>, n int, t string")
    b = spark.createDataFrame([(1, [1, 2], 5.0, 7), (2, [2], 6.5, 9)], "k long, l array<int>, n double, t long")
    got = {r.column: r.differing for r in C.keyed_diff(a, b, "k").collect()}
    assert got == {"l": 1, "n": 1, "t": 1}


def test_samples_are_limited_per_column(spark):
    a = spark.range(50).selectExpr("id as k", "id as v", "id as w")
    b = spark.range(50).selectExpr("id as k", "id + 1 as v", "id as w")
    got = C.keyed_samples(a, b, "k").collect()
    assert [(r.column, r.sample, r.k) for r in got] == [("v", i + 1, i) for i in range(5)]


def test_multiset_diff_ignores_order(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([("z", 3), ("x", 1), (None, 2), ("n", 4)], "v string, k int")
    got = {(r.k, r.v): (r.surplus_side, r.surplus) for r in C.multiset_diff(a, b).collect()}
    assert got == {(1, "x"): ("left", 1), (4, "n"): ("right", 1)}


@pytest.mark.parametrize("accuracy", [10, 100_000])
def test_medians_match_statistics(spark, accuracy):
    rng = random.Random(7)
    data = [
        (rng.choice([1.0, 1.0, 1.0, 5.0, None]), rng.gauss(0, 1), i if i % 3 else None, None)
        for i in range(1001)
    ]
    df = spark.createDataFrame(data, "a double, b double, c long, d double").repartition(5)
    got = {r.column: r.median for r in exact_medians(df, ["a", "b", "c", "d"], accuracy).collect()}
    want = {
        n: statistics.median([r[i] for r in data if r[i] is not None])
        for i, n in enumerate("abc")
    }
    assert got == want
    even = spark.createDataFrame([(float(x),) for x in (4, 1, 3, 2)], "a double")
    assert exact_medians(even, ["a"]).first().median == 2.5


def test_few_ranges_find_the_same_median(spark, monkeypatch):
    from seriesloom.operators import fragments

    monkeypatch.setattr(fragments, "RANGES", 2)
    df = spark.range(101).selectExpr("cast(id as double) as a", "cast(id * id as int) as b")
    got = {r.column: r.median for r in exact_medians(df, ["a", "b"], accuracy=2).collect()}
    assert got == {"a": 50.0, "b": 2500.0}


def test_no_common_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(1, "x")], "k int, t string")
    with pytest.raises(ValueError, match="no common column"):
        C.keyed_diff(a, b, "k")
    assert C.profile_diff(a.select("s"), b.select("t")).count() == 0


def test_profiles(spark):
    a = spark.createDataFrame([(1, 2.0, "x"), (3, 4.0, "y")], "i int, f double, s string")
    b = spark.createDataFrame([(1, 2.0), (3, None)], "i long, f double")
    got = by(C.profile_diff(a, b), "column")
    assert set(got) == {"i", "f"}
    assert (got["i"].left_mean, got["i"].right_max, got["f"].right_median) == (2.0, 3.0, 2.0)
    assert got["f"].left_std == pytest.approx(2**0.5) and got["f"].right_std is None


def test_bytes(spark):
    a = spark.createDataFrame([(1, "né", ["ab", None]), (None, None, [])], "k long, s string, l array<string>")
    b = spark.createDataFrame([(1, "n", True)], "k long, s string, extra boolean")
    assert {r.column: r.bytes for r in C.column_bytes(a).collect()} == {"k": 8, "s": 3, "l": 2}
    got = by(C.bytes_diff(a, b), "column")
    assert got["s"].difference == 2 and got["l"].right_bytes is None and got["extra"].common is False
    totals = C.bytes_totals(a, b).first()
    assert (totals.left_bytes, totals.left_common_bytes, totals.right_only_bytes) == (13, 11, 1)
    assert [r.column for r in C.largest_bytes_differences(a, b).collect()] == ["s"]


def test_compare_reports(spark):
    a = spark.createDataFrame([("s", 1)], "SeriesInstanceUID string, n long")
    assert set(C.compare(a, a)) == {"schema", "shape", "bytes", "profile", "values", "samples"}
    assert C.compare(a, a)["values"].first().identical is True
    assert C.compare(a, a, key=None)["rows"].count() == 0


def test_medians_take_six_rounds_at_most(spark):
    wide = [10.0**k for k in range(-100, 101)] + [float("nan")]
    rng = random.Random(1)
    both = [rng.choice([-1, 1]) * 2.0 ** rng.uniform(-1000, 1000) for _ in range(999)]
    for values in (wide, both, [float(i) for i in range(3001)]):
        known = sorted(values, key=lambda v: (v != v, v))
        df = spark.createDataFrame([(v,) for v in values], "v double")
        # a sketch that knows nothing leaves the whole range
        for accuracy in (100_000, 1):
            found, rounds = search_medians(df, ["v"], accuracy)
            n = len(known)
            assert found["v"] == known[(n - 1) // 2] / 2 + known[n // 2] / 2 and rounds <= 6
    assert [_value(_key(v)) for v in (-0.0, 1.5, -1.5, 5e-324, -5e-324, float("inf"))] == [
        0.0, 1.5, -1.5, 5e-324, -5e-324, float("inf")
    ]


@pytest.mark.parametrize("values", [
    [float("nan"), float("nan"), 1.0, 5.0],
    [float("nan")] * 3 + [1.0],
    [float("inf"), float("-inf"), 0.0],
    [float("-inf")] * 5 + [1.0, float("nan")],
    [-1.7e308, 1.7e308, 1e-320, -1e-320, 0.0, 3.0],
    [7.0] * 2000 + [8.0] * 1999 + [1e300] * 3,
    [float(2**k) for k in range(-1000, 1000)],
    [None, None],
    [],
])
def test_median_ends_on_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.median for r in exact_medians(df, ["v"]).collect()]
    known = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
    if not known:
        assert got == []
        return
    lower, upper = known[(len(known) - 1) // 2], known[len(known) // 2]
    want = lower if len(known) % 2 else lower / 2 + upper / 2
    assert got[0] == want or got[0] != got[0] and want != want


def test_types_are_compared_by_one_rule(spark):
    big = 2**53 + 1
    left = spark.range(1).selectExpr(
        "1 as k", "cast(1.0 as decimal(10,1)) as d", f"cast({big} as bigint) as b", "cast(7 as bigint) as w",
        "'x1' as t", "map('a', 1, 'b', 2) as m", "array(map('a', 1)) as am", "cast(0.1 as decimal(3,1)) as f",
    )
    right = spark.range(1).selectExpr(
        "1 as k", "cast(1.00 as decimal(10,2)) as d", f"cast({big - 1} as double) as b", "cast(7 as double) as w",
        "1 as t", "map('b', 2, 'a', 1) as m", "array(map('a', 2)) as am", "0.1D as f",
    )
    changed = {"b", "t", "am"}
    keyed = {r.column: r.differing for r in C.keyed_diff(left, right, "k").collect()}
    assert keyed == {c: int(c in changed) for c in "d b w t m am f".split()}
    assert {r.column for r in C.keyed_samples(left, right, "k").collect()} == changed
    per_column = {r.column: (r.left_surplus, r.right_surplus) for r in C.column_surplus(left, right).collect()}
    assert {c for c, n in per_column.items() if n != (0, 0)} == changed
    assert C.multiset_diff(left, right).count() == 2
    assert C.multiset_diff(left.drop(*changed), right.drop(*changed)).count() == 0


def test_pair_counts_beyond_a_long(spark):
    a = spark.createDataFrame([(1, 1)], "k int, v int")
    kinds = {f.name: f.dataType.simpleString() for f in C._Keyed(a, a, "k").counts().schema}
    assert kinds["pairs"] == kinds["unequal"] == "decimal(38,0)"
    # more pairs than a fold multiplies, all of them equal
    many = spark.range(70_000).selectExpr("1 as k", "2 as v")
    (got,) = C.keyed_diff(many, many, "k").collect()
    assert (got.pairs, got.differing, got.unequal) == (70_000**2, 0, 0)


def scans(df):
    """Scans of stored tables, each stage that is used again counted once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    return len(re.findall(r"FileScan parquet", plan)), plan


@pytest.fixture()
def editions(spark, tmp_path):
    """Two stored tables of wide rows with a hot key."""
    rows = spark.range(4000).selectExpr("if(id % 3 = 0, 0, id) as k", "repeat(cast(id as string), 50) as wide", "id % 7 as n")
    rows.write.parquet(f"{tmp_path}/a")
    rows.selectExpr("k", "if(k = 40, 'changed', wide) as wide", "n").write.parquet(f"{tmp_path}/b")
    return [spark.read.parquet(f"{tmp_path}/{x}") for x in "ab"]


@pytest.mark.parametrize("report", ["values", "samples", "rows"])
def test_two_scans_a_table_and_no_sorted_rows(spark, editions, report):
    left, right = editions
    key = None if report == "rows" else "k"
    n, _ = scans(C.compare(left, right, key)[report])
    assert n <= 4
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = C.compare(left, right, key)[report]._jdf.queryExecution().executedPlan()
        assert set(first_aggregates(plan)) == {"HashAggregate"}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def wide_rows_written(df):
    df.collect()
    written = []

    def walk(node):
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        elif node.nodeName() == "Exchange" and "wide" in node.schema().simpleString():
            written.append(node.metrics().apply("shuffleRecordsWritten").value())

    walk(df._jdf.queryExecution().executedPlan())
    return sum(written)


def test_only_changed_rows_are_moved(spark, editions, tmp_path):
    left, right = editions
    assert wide_rows_written(C.multiset_diff(left, spark.read.parquet(f"{tmp_path}/a"))) == 0
    changed = C.multiset_diff(left, right)
    assert 2 <= wide_rows_written(changed) < 50
    assert [(r.k, r.surplus) for r in changed.collect()] == [(40, 1), (40, 1)]


def test_nulls_within_values_are_values(spark):
    schema = "k int, l array<int>, s struct<a:int,b:int>, t string"
    a = spark.createDataFrame([(1, [1, None, 2], (None, 1), ""), (2, [], None, None)], schema)
    b = spark.createDataFrame([(1, [1, 2], (1, None), None), (2, None, (None, None), "")], schema)
    got = {r.column: (r.differing, r.unequal) for r in C.keyed_diff(a, b, "k").collect()}
    assert got == {"l": (1, 2), "s": (1, 2), "t": (0, 2)}
    assert C.multiset_diff(a, b).count() == 4 and C.multiset_diff(a, a).count() == 0


def test_whole_numbers_of_any_size(spark):
    left = spark.range(1).selectExpr("1 as k", "2000000000000000000L as a", "9223372036854775807L as b", "cast('1e37' as decimal(38,0)) as c", "5L as d", "0L as e")
    right = spark.range(1).selectExpr("1 as k", "2e18D as a", "9223372036854775807D as b", "1e37D as c", "1e300D as d", "-0.0D as e")
    got = {r.column: r.differing for r in C.keyed_diff(left, right, "k").collect()}
    assert got == {"a": 0, "b": 1, "c": int(int(1e37) != 10**37), "d": 1, "e": 0}
    assert C.multiset_diff(left.select("a", "e"), right.select("a", "e")).count() == 0


def test_hot_keys_in_fold_and_count(spark):
    rng = random.Random(4)
    left = [(0, rng.randrange(5)) for _ in range(3000)] + [(1, 7)] * 500 + [(2, None)] * 5 + [(i, i) for i in range(3, 900)]
    right = [(0, rng.randrange(5)) for _ in range(1000)] + [(1, 7)] * 50 + [(2, 1)] * 4 + [(i, i + (i == 5)) for i in range(3, 900)]
    a, b = (spark.createDataFrame(rows, "k int, v int") for rows in (left, right))
    (got,) = C.keyed_diff(a, b, "k").collect()
    assert (got.pairs, got.differing, got.unequal, got["rank"]) == (*brute_counts(left, right), 1)


def brute_counts(left, right):
    one, other = Counter(left), Counter(right)
    pairs = differing = unequal = 0
    for (k, v), n in one.items():
        for (j, w), m in other.items():
            if k == j:
                pairs += n * m
                differing += n * m * (v is not None and w is not None and v != w)
                unequal += n * m * (v != w)
    return pairs, differing, unequal


def test_nothing_runs_when_reports_are_made(spark):
    df = spark.range(5).selectExpr("id", "raise_error('ran') as v", "cast(id as double) as x")
    reports = C.compare(df, df, "id")
    assert set(reports) == {"schema", "shape", "bytes", "profile", "values", "samples"}
    assert set(C.compare(df, df, None)) >= {"rows", "columns"}
