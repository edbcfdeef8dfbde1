import math

import pytest
from pyspark.sql import functions as F

from seriesloom.functions import expr as E


def one(spark, sql, column):
    df = spark.sql(sql)
    return df.select(column(df) if callable(column) else column).first()[0]


@pytest.mark.parametrize(
    "given, expected",
    [("0D", 0.0), ("cast(null as double)", None), ("0.000252D", 0.00025), ("0.5D", 0.5),
     ("12345D", 12000.0), ("-0.0377D", -0.038), ("99.6D", 100.0), ("0.0995D", 0.1)],
)
def test_significant(spark, given, expected):
    got = one(spark, f"select {given} as x", E.significant(F.col("x")))
    assert got == expected if expected is None else math.isclose(got, expected, rel_tol=1e-12)


@pytest.mark.parametrize(
    "text, expected",
    [("1.5", 1.5), (" 2 ", 2.0), ("1.0d", None), ("3F", None), ("3f ", None), ("x", None), ("", None),
     ("1e3", 1000.0), ("inf", math.inf), (None, None)],
)
def test_safe_double_of_text(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(E.safe_double(df, "x")).first()[0] == expected


def test_safe_long(spark):
    df = spark.createDataFrame([("20",), ("20.0",), ("2.5",), ("x",)], "x string")
    assert [r[0] for r in df.select(E.safe_long(df, "x")).collect()] == [20, None, None, None]
    df = spark.createDataFrame([(2.5,), (-2.5,), (2.4,)], "x double")
    assert [r[0] for r in df.select(E.safe_long(df, "x")).collect()] == [3, -3, 2]


def test_text_parts(spark):
    df = spark.createDataFrame([("a.b.c.d",), ("a.b",)], "x string")
    assert [r[0] for r in df.select(E.dotted_part("x", 2)).collect()] == ["c", None]
    df = spark.createDataFrame([("gs://box/file",), ("nothing",)], "x string")
    got = [r[0] for r in df.select(E.extract_or_null("x", "gs://([^/]+)/")).collect()]
    assert got == ["box", None]


def test_aggregates_skip_nulls(spark):
    df = spark.createDataFrame(
        [(1, "b", ["y"]), (1, "a", []), (1, None, ["x", "z"]), (2, None, [])],
        "k int, s string, l array<string>",
    )
    rows = {
        r.k: r
        for r in df.groupBy("k")
        .agg(
            E.distinct_sorted("s").alias("set"),
            E.distinct_joined("s").alias("text"),
            E.any_of("s").alias("one"),
            E.any_list("l").alias("list"),
            E.all_equal("s").alias("same"),
        )
        .collect()
    }
    assert rows[1].set == ["a", "b"] and rows[1].text == "a,b" and rows[1].one == "a"
    assert rows[1].list == ["x", "z"] and rows[1].same is False
    assert rows[2].set == [] and rows[2].text is None and rows[2].one is None
    assert rows[2].list == [] and rows[2].same is False


def test_like_underscore_is_a_wildcard(spark):
    df = spark.createDataFrame([("cddp_eagle_1",), ("cddpXeagle",), ("other",), (None,)], "c string")
    got = [r[0] for r in df.select(E.like_any("c", ["cddp_eagle%"])).collect()]
    assert got[:3] == [True, True, False] and not got[3]


def test_codes_need_all_parts(spark):
    df = spark.sql(
        "select named_struct('CodeValue', '1', 'CodingSchemeDesignator', 'S', 'CodeMeaning', m) as c"
        " from values ('x'), (null) as t(m)"
    )
    got = [r[0] for r in df.select(E.ranked_code(F.col("c"))).collect()]
    assert got[0].text == "S:1:x" and got[0].pair == "S:1" and got[1] is None
