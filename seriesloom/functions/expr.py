"""Column helpers shared by the index builders.

All helpers return plain Spark Columns, so every builder stays inside the JVM
and Catalyst sees the whole expression.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- arrays and nested records ------------------------------------------------


def items(c: Column | str) -> Column:
    """A repeated column with NULL read as the empty array."""
    return F.coalesce(as_column(c), F.array())


def first(c: Column | str) -> Column:
    """First element of an array, NULL when there is none."""
    return F.get(as_column(c), F.lit(0))


def nth(c: Column | str, i: int) -> Column:
    return F.get(as_column(c), F.lit(i))


def slash_joined(c: Column | str) -> Column:
    """Array as one comparable string; the empty array becomes the empty string."""
    return F.array_join(items(c), "/")


# --- safe casts ---------------------------------------------------------------


# A Java float suffix at the end of a text; the final letter of ``inf`` is none.
_FLOAT_SUFFIX = r"(?:[dD]|(?<![iI][nN])[fF])\s*$"


def number_text(c: Column) -> Column:
    """Double of a text or NULL.  A Java float suffix (``1.0d``) is no part of a number,
    though the cast would take it."""
    return F.when(~c.rlike(_FLOAT_SUFFIX), c.try_cast("double"))


def type_of(df: DataFrame, c: Column | str) -> T.DataType:
    """Type of a column expression, resolved on an empty frame of the same schema: that
    costs nothing however long the plan behind ``df`` is."""
    if isinstance(c, str):
        return df.schema[c].dataType
    return df.sparkSession.createDataFrame([], df.schema).select(c).schema[0].dataType


def safe_double(df: DataFrame, c: Column | str) -> Column:
    """Double or NULL, whatever the type of the input."""
    if isinstance(type_of(df, c), T.StringType):
        return number_text(as_column(c))
    return as_column(c).try_cast("double")


def element_number(df: DataFrame, array: str) -> Callable[[Column], Column]:
    """Safe cast for the elements of an array column."""
    if isinstance(df.schema[array].dataType.elementType, T.StringType):
        return number_text
    return lambda v: v.try_cast("double")


def safe_long(df: DataFrame, c: Column | str) -> Column:
    """Long or NULL.  Fractional numbers round half away from zero."""
    if isinstance(type_of(df, c), T.FractionalType):
        return F.round(as_column(c), 0).try_cast("bigint")
    return as_column(c).try_cast("bigint")


# --- aggregates ---------------------------------------------------------------


def any_of(c: Column | str) -> Column:
    """Any non-NULL value of the group; the smallest one, so runs are repeatable."""
    return F.min(as_column(c))


def any_list(c: Column | str) -> Column:
    """Any value of a repeated column; a filled array is preferred over an empty one."""
    c = as_column(c)
    return F.coalesce(F.min(F.when(F.size(c) > 0, c)), F.array())


def distinct_sorted(c: Column | str) -> Column:
    """Sorted distinct non-NULL values; the empty array when there are none."""
    return F.sort_array(F.collect_set(as_column(c)))


def joined_or_null(values: Column, separator: str = ",") -> Column:
    """Join an array of strings; NULL instead of the empty string for no values."""
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def distinct_joined(c: Column | str, separator: str = ",") -> Column:
    """Sorted distinct non-NULL strings in one string, in a single pass."""
    return joined_or_null(distinct_sorted(c), separator)


def all_equal(c: Column | str) -> Column:
    """TRUE when exactly one distinct non-NULL value exists.

    Same truth value as counting distinct values, without expanding the rows.
    """
    c = as_column(c)
    return F.coalesce(F.min(c) == F.max(c), F.lit(False))


# Types whose minimum and maximum Spark keeps in a hash table.
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

def distinct_looks(rows: DataFrame, columns: Sequence[str], *aggregates: Column) -> DataFrame:
    """The distinct values of the columns, with aggregates of the rest.

    The test of the count is always true; without it the optimizer merges this step with a
    following aggregation that ignores repeated rows, which then sees all rows again.
    """
    counted = rows.groupBy(*columns).agg(*aggregates, F.count(F.lit(1)).alias("_looks"))
    return counted.where(F.col("_looks") > 0).drop("_looks")


#: name -> (aggregate, value), for ``folded``
Values = Mapping[str, tuple[Callable[[Column], Column], Column | str]]


def folded(rows: DataFrame, key: str, values: Values) -> DataFrame:
    """One row per key with an aggregate of each value.

    Minima of texts and lists, and sets, cannot be kept in Spark's hash aggregation, which
    then sorts its input.  The rows are therefore reduced to their distinct *looks* first:
    the texts and lists are grouping keys there, which hash, and numbers are minima and
    maxima.  Only the few looks of a key are left for the second aggregation.
    """
    plain = rows.select(key, *[as_column(value).alias(name) for name, (_, value) in values.items()])
    direct = [
        name
        for name, (aggregate, _) in values.items()
        if aggregate in (any_of, F.min, F.max) and isinstance(plain.schema[name].dataType, _FIXED_WIDTH)
    ]
    others = [name for name in values if name not in direct]
    first_step = [values[name][0](F.col(name)).alias(name) for name in direct]
    looks = distinct_looks(plain, [key, *others], *first_step)
    return looks.groupBy(key).agg(
        *[aggregate(F.col(name)).alias(name) for name, (aggregate, _) in values.items()]
    )


# --- codes --------------------------------------------------------------------


def code_pair(code: Column) -> Column:
    """``scheme:value`` of a coded entry, NULL if either part is NULL."""
    return F.concat(code["CodingSchemeDesignator"], F.lit(":"), code["CodeValue"])


def ranked_code(code: Column) -> Column:
    """Coded entry as (sort text, pair, meaning); NULL unless all parts are present."""
    pair = code_pair(code)
    text = F.concat(pair, F.lit(":"), code["CodeMeaning"])
    return F.when(
        text.isNotNull(),
        F.struct(
            text.alias("text"), pair.alias("pair"), code["CodeMeaning"].alias("meaning")
        ),
    )


# --- numbers and text ---------------------------------------------------------


def significant(c: Column, digits: int = 2) -> Column:
    """Round to a number of significant figures; zero stays zero."""
    places = F.lit(digits - 1) - F.floor(F.log10(F.abs(c)))
    up, down = F.pow(F.lit(10.0), places), F.pow(F.lit(10.0), -places)
    return F.when(c == 0, F.lit(0.0)).otherwise(
        F.when(places >= 0, F.round(c * up) / up).otherwise(F.round(c / down) * down)
    )


def extract_or_null(c: Column | str, pattern: str) -> Column:
    """First group of a pattern, NULL when the text does not match."""
    return F.nullif(F.regexp_extract(as_column(c), pattern, 1), F.lit(""))


def dotted_part(c: Column | str, i: int) -> Column:
    """The i-th part (from 0) of a dotted name, NULL when there are fewer parts."""
    return nth(F.split(as_column(c), r"\."), i)


def literal_map(values: Mapping[str, str]) -> Column:
    flat: list[Column] = []
    for key, value in values.items():
        flat += [F.lit(key), F.lit(value)]
    return F.create_map(*flat)


def like_any(c: Column | str, patterns: Sequence[str]) -> Column:
    """TRUE when one of the LIKE patterns matches."""
    c = as_column(c)
    test = F.lit(False)
    for pattern in patterns:
        test = test | c.like(pattern)
    return test
