"""Comparison of two tables: schema, shape, keyed and unkeyed values, profiles, bytes."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fingerprints import bit_set, in_set, lanes
from .fragments import exact_medians

_NUMERIC = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
)


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return sorted(set(left.columns) & set(right.columns))


# --- schema and shape -----------------------------------------------------------


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per column of either side: its types and how they relate."""
    a = {f.name: f.dataType.simpleString() for f in left.schema.fields}
    b = {f.name: f.dataType.simpleString() for f in right.schema.fields}

    def status(name: str) -> str:
        if name not in b:
            return "only_left"
        if name not in a:
            return "only_right"
        return "same" if a[name] == b[name] else "type_differs"

    rows = [(n, a.get(n), b.get(n), status(n)) for n in sorted({*a, *b})]
    return left.sparkSession.createDataFrame(
        rows, "column string, left_type string, right_type string, status string"
    )


def shape_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row and column counts of both sides in one row."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name)).withColumn("_one", F.lit(1))

    n, m = len(left.columns), len(right.columns)
    return (
        side(left, "left_rows")
        .join(side(right, "right_rows"), "_one")  # one row each
        .select(
            "left_rows",
            "right_rows",
            F.lit(n).cast("bigint").alias("left_columns"),
            F.lit(m).cast("bigint").alias("right_columns"),
            ((F.col("left_rows") == F.col("right_rows")) & F.lit(n == m)).alias("same_shape"),
        )
    )


def _stacked(left: DataFrame, right: DataFrame, group: Sequence[str]) -> DataFrame:
    """Both tables below each other, with ``_l`` / ``_r`` counting rows of either side and
    the grouping columns in the struct ``_group``.

    Grouping by the struct makes Spark shuffle the union.  Grouping by a column both
    inputs are already partitioned on would not: the union then counts as partitioned
    too, and adaptive execution can run it as a plain concatenation all the same, which
    splits the groups.
    """

    def side(df: DataFrame, l: int, r: int) -> DataFrame:
        return df.select("*", F.lit(l).alias("_l"), F.lit(r).alias("_r"))

    rows = side(left, 1, 0).unionByName(side(right, 0, 1))
    return rows.withColumn("_group", F.struct(*group))


# --- keyed values ---------------------------------------------------------------


#: Places of a hash by which keys with very many rows are found, and the rows that no key with fewer is taken for one.
PLACES, HEAVY = 1 << 14, 10_000
#: Numbers of pairs are products of counts.
PAIRS = "decimal(38,0)"
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def orderable(c: Column, kind: T.DataType) -> Column:
    """The value with maps as sorted lists of entries, at every depth, so it can be grouped."""
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(c),
            lambda e: F.struct(
                orderable(e["key"], kind.keyType).alias("key"),
                orderable(e["value"], kind.valueType).alias("value"),
            ),
        )
        return F.array_sort(entries)
    if isinstance(kind, T.ArrayType) and _has_map(kind):
        return F.transform(c, lambda v: orderable(v, kind.elementType))
    if isinstance(kind, T.StructType) and _has_map(kind):
        fields = [orderable(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def _exact(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number type."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    whole = _WHOLE.get(type(kind))
    return None if whole is None else (whole, 0)


def _number_text(c: Column, kind: T.DataType) -> Column:
    """Text of a number that is equal for equal numbers of any type: whole numbers digit by
    digit, so nothing beyond 2**53 is lost, others as the nearest double."""
    double = c.cast("double") + F.lit(0.0)
    if _exact(kind) is None:
        # beyond 38 digits no exact number can be equal
        whole = (double % F.lit(1.0) == 0) & (F.abs(double) < F.lit(1e38))
        return F.when(whole, _whole_digits(double)).otherwise(double.cast("string"))
    if _exact(kind)[1] == 0:
        return c.cast("decimal(38,0)").cast("string")
    floor = F.floor(c)
    return F.when(c == floor, floor.cast("decimal(38,0)").cast("string")).otherwise(double.cast("string"))


def _whole_digits(c: Column) -> Column:
    """All digits of a whole double below 1e38: three parts of 42 bits, each exact as a long."""
    part = float(2**42)
    size = F.abs(c)
    high = F.floor(size / F.lit(part**2))
    rest = size - high.cast("double") * F.lit(part**2)
    middle = F.floor(rest / F.lit(part))
    low = (rest - middle.cast("double") * F.lit(part)).cast("bigint")
    parts = [(high, 2**84), (middle, 2**42), (low, 1)]
    scaled = (x.cast("decimal(13,0)") * F.lit(Decimal(n)).cast(f"decimal({len(str(n))},0)") for x, n in parts)
    digits = functools.reduce(Column.__add__, scaled).cast(PAIRS)
    return F.when(c < 0, -digits).otherwise(digits).cast("string")


def _comparable(left: DataFrame, right: DataFrame, name: str) -> tuple[Column, Column]:
    """Both sides of a column in one type, by one rule for keyed and unkeyed comparison.

    Equal types stay, with maps as sorted entries. Exact numbers meet in their common decimal
    type, floating ones as double, an exact and a floating one as text of the number, and all
    else as text.
    """
    a, b = left.schema[name].dataType, right.schema[name].dataType
    l, r = F.col(f"`{name}`"), F.col(f"`{name}`")
    if a == b:
        return orderable(l, a), orderable(r, b)
    x, y = _exact(a), _exact(b)
    if x and y:
        whole, scale = max(x[0], y[0]), max(x[1], y[1])
        if whole + scale <= 38:
            common = f"decimal({whole + scale},{scale})"
            return l.cast(common), r.cast(common)
    floating = (T.FloatType, T.DoubleType)
    if isinstance(a, floating) and isinstance(b, floating):
        return l.cast("double"), r.cast("double")
    if (x or isinstance(a, floating)) and (y or isinstance(b, floating)):
        return _number_text(l, a), _number_text(r, b)
    return as_text(l, a), as_text(r, b)


def as_text(c: Column, kind: T.DataType) -> Column:
    """Text that is equal exactly when the values are equal."""
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(orderable(c, kind))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (c + F.lit(0.0)).cast("string")  # -0.0 and 0.0 are equal
    return c.cast("string")


class _Keyed:
    """Both tables folded to one row per key by hashing, which is what keeps a hot key harmless.

    A fold has the number of rows of each side and, per column, how many values each side has and
    the smallest and largest of each lane over both sides.  It settles a column of a key where all
    values are equal, where only one side has values, and where the key has one row on each side.
    What is left are keys that repeat with several values.  Their pairs are never built: they are
    counted from the value counts of both sides, made from the partitions that the fold is made from.
    Only keys with very many rows are counted apart, dealt by key and value.
    """

    def __init__(self, left: DataFrame, right: DataFrame, key: str) -> None:
        self.key = key
        self.columns = [c for c in common_columns(left, right) if c != key]
        if not self.columns:
            raise ValueError("the tables have no common column to compare")
        one, other = _alike(left, right, self.columns, key)
        self.kinds = [one.schema[c].dataType for c in self.columns]
        self.left = one.where(F.col(f"`{key}`").isNotNull())
        self.right = other.where(F.col(f"`{key}`").isNotNull())

    def _hashed(self, df: DataFrame, *others: Column) -> DataFrame:
        cells = [F.col(f"`{self.key}`").alias("key"), *others]
        for i, (c, kind) in enumerate(zip(self.columns, self.kinds, strict=True)):
            value = F.col(f"`{c}`")
            cells += [h.alias(f"h{i}{t}") for t, h in zip("ab", lanes(value, as_text(value, kind), kind), strict=True)]
        return df.select(*cells)

    def folded(self) -> DataFrame:
        """Per key of both sides: rows ``l`` and ``r``, and per column i values ``l{i}`` and ``r{i}`` of each
        side and ``same{i}``, whether all of them are equal (also where there are none)."""
        rows = _stacked(self._hashed(self.left), self._hashed(self.right), ["key"])
        return self._fold(rows, "_group", F.col("_group.key"))

    def _fold(self, rows: DataFrame, group: str, key: Column) -> DataFrame:
        aggs = [F.sum("_l").alias("l"), F.sum("_r").alias("r")]
        for i in range(len(self.columns)):
            filled = F.col(f"h{i}a").isNotNull()
            aggs += [F.sum(F.when(filled, F.col(f"_{side}")).otherwise(0)).alias(f"{side}{i}") for side in "lr"]
            aggs += [f(f"h{i}{t}").alias(f"{name}{i}{t}") for t in "ab" for name, f in (("lo", F.min), ("hi", F.max))]
        out = rows.groupBy(group).agg(*aggs).where("l > 0 and r > 0")
        same = [
            F.col(f"lo{i}a").eqNullSafe(F.col(f"hi{i}a")) & F.col(f"lo{i}b").eqNullSafe(F.col(f"hi{i}b"))
            for i in range(len(self.columns))
        ]
        counts = [c for i in range(len(self.columns)) for c in (f"l{i}", f"r{i}", same[i].alias(f"same{i}"))]
        return out.select(key.alias("key"), "l", "r", *counts)

    def _heavy(self) -> Column:
        """The set of the keys with so many rows that one task should not get them all.

        Rows are counted by places of the key's hash, which combines well before the shuffle.  The keys that share a
        place with a frequent one count as such too; every other key has at most HEAVY rows and two mean places.
        """
        keys = [df.select(F.pmod(F.xxhash64(f"`{self.key}`"), F.lit(PLACES)).alias("place")) for df in (self.left, self.right)]
        places = _stacked(*keys, ["place"]).groupBy("_group").agg(F.count(F.lit(1)).alias("n"))
        total = places.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).scalar()
        return bit_set(places.where(F.col("n") > HEAVY + total * 2 / PLACES).select("_group.place"), PLACES)

    def counts(self) -> DataFrame:
        """Pairs, differing and unequal pairs per column; first of the keys that their fold settles, then of the
        others, then of the keys with very many rows.  Each key goes one way, in all columns.

        All but the very frequent keys are dealt by key once; the fold and the counts of what it leaves open are
        made from these partitions.
        """
        heavy = self._heavy()
        rows = _stacked(self._hashed(self.left), self._hashed(self.right), ["key"]).drop("_group")
        # a number given is kept: tasks that Spark puts together would count too many values at a time
        pieces = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = rows.where(~in_set(heavy, F.xxhash64("key"), PLACES)).repartition(pieces, "key")
        fold = self._fold(dealt, "key", F.col("key"))
        single = (F.col("l") == 1) & (F.col("r") == 1)
        # products of larger counts could leave the range of a long
        few = F.col("l").cast("double") * F.col("r") < F.lit(2.0**31)
        settled = [
            F.col(f"same{i}") | (F.col(f"l{i}") == 0) | (F.col(f"r{i}") == 0) for i in range(len(self.columns))
        ]
        closed = single | few & functools.reduce(Column.__and__, settled)
        unsettled = fold.where(~closed).select("key").hint("shuffle_hash")
        # a fold has each key once; a semi join would be moved below the dealing, which then runs for it again
        cells = self._cells(dealt.join(unsettled, "key"))
        values = cells.groupBy("key", "column", "a", "b").agg(F.sum("_l").alias("l"), F.sum("_r").alias("r"))
        return (
            self._settled(fold.where(closed))
            .unionByName(self._counted(values))
            .unionByName(self._counted(self._heavy_values(heavy)))
        )

    def _settled(self, fold: DataFrame) -> DataFrame:
        l, r = F.col("l"), F.col("r")
        aggs = [F.sum(l * r).alias("pairs")]
        for i in range(len(self.columns)):
            x, y, same = F.col(f"l{i}"), F.col(f"r{i}"), F.col(f"same{i}")
            # of values that are not all equal only the two of a single pair are counted here
            equal = F.when(same, x * y).otherwise(F.lit(0))
            aggs += [
                F.sum(x * y - equal).alias(f"d{i}"),
                F.sum(l * r - equal - (l - x) * (r - y)).alias(f"u{i}"),
            ]
        wide = fold.agg(*aggs)
        cells = [
            F.struct(
                F.lit(c).alias("column"),
                *[
                    F.coalesce(F.col(n), F.lit(0)).cast(PAIRS).alias(name)
                    for n, name in (("pairs", "pairs"), (f"d{i}", "differing"), (f"u{i}", "unequal"))
                ],
            )
            for i, c in enumerate(self.columns)
        ]
        return wide.select(F.inline(F.array(*cells)))

    def _cells(self, rows: DataFrame) -> DataFrame:
        """The hashed values in long form."""
        lists = [
            F.struct(F.lit(i).alias("column"), F.col(f"h{i}a").alias("a"), F.col(f"h{i}b").alias("b"))
            for i in range(len(self.columns))
        ]
        return rows.select("key", *[c for c in ("_l", "_r") if c in rows.columns], F.inline(F.array(*lists)))

    def _heavy_values(self, heavy: Column) -> DataFrame:
        """The values of frequent keys with their counts; their rows are dealt by value as well."""

        def cells(df: DataFrame) -> DataFrame:
            return self._cells(self._hashed(df.where(in_set(heavy, F.xxhash64(f"`{self.key}`"), PLACES))))

        values = _stacked(cells(self.left), cells(self.right), ["key", "column", "a", "b"])
        return values.groupBy("_group").agg(F.sum("_l").alias("l"), F.sum("_r").alias("r")).select("_group.*", "l", "r")

    def _counted(self, values: DataFrame) -> DataFrame:
        """From the counts of both sides per (key, column, value): their products are the pairs, so nothing is
        joined and no pair is built."""
        filled = F.col("a").isNotNull()
        l, r = F.col("l"), F.col("r")
        none = F.lit(0).cast(PAIRS)
        # numbers of pairs are products, and soon too large for a long
        values = values.withColumns({side: F.col(side).cast(PAIRS) for side in ("l", "r")})
        per_key = values.groupBy("key", "column").agg(
            (F.sum(l) * F.sum(r)).alias("pairs"),
            (
                F.sum(F.when(filled, l).otherwise(none)) * F.sum(F.when(filled, r).otherwise(none))
            ).alias("filled_pairs"),
            F.sum(F.when(filled, l * r).otherwise(none)).alias("equal"),
            F.sum(F.when(filled, none).otherwise(l * r)).alias("both_null"),
        )
        names = F.array(*map(F.lit, self.columns))
        return per_key.groupBy("column").agg(
            F.sum("pairs").cast(PAIRS).alias("pairs"),
            F.sum(F.col("filled_pairs") - F.col("equal")).cast(PAIRS).alias("differing"),
            F.sum(F.col("pairs") - F.col("equal") - F.col("both_null")).cast(PAIRS).alias("unequal"),
        ).withColumn("column", F.get(names, F.col("column")))

    def samples(self, limit: int) -> DataFrame:
        """The first keys per column with unlike values on both sides, and a pair of these values."""
        differs = [
            F.when(~F.col(f"same{i}") & (F.col(f"l{i}") > 0) & (F.col(f"r{i}") > 0), i)
            for i in range(len(self.columns))
        ]
        found = self.folded().select("key", F.explode(F.array_compact(F.array(*differs))).alias("column"))
        # Spark keeps only `limit` rows per column and task before the ranking shuffle
        ranked = found.withColumn("sample", F.row_number().over(Window.partitionBy("column").orderBy("key")))
        wanted = ranked.where(F.col("sample") <= limit).groupBy("key").agg(
            F.sort_array(F.collect_list(F.struct("column", "sample"))).alias("wanted")
        )
        one, other = (df.withColumnRenamed(self.key, "_key") for df in (self.left, self.right))
        rows = one.withColumn("_left", F.lit(True)).unionByName(other.withColumn("_left", F.lit(False)))
        # at most `limit` keys for each column
        rows = rows.join(F.broadcast(wanted), F.col("_key") == F.col("key"))
        looks = rows.groupBy("key", "wanted", "_left", *[f"`{c}`" for c in self.columns]).count()
        aggs = []
        for i, c in enumerate(self.columns):
            for tag, side in (("l", F.col("_left")), ("r", ~F.col("_left"))):
                value = F.when(side, F.col(f"`{c}`"))
                aggs += [F.min(value).alias(f"{tag}{i}"), F.max(value).alias(f"{tag}{i}x")]
        ends = looks.groupBy("key", "wanted").agg(*aggs)

        def pair(l: Column, r: Column, kind: T.DataType) -> Column:
            names = F.lit("left_value"), F.lit("right_value")
            return F.when(l != r, F.named_struct(names[0], as_text(l, kind), names[1], as_text(r, kind)))

        pairs = []
        for i, kind in enumerate(self.kinds):
            lo, lx, ro, rx = (F.col(n) for n in (f"l{i}", f"l{i}x", f"r{i}", f"r{i}x"))
            pairs.append(F.coalesce(pair(lo, ro, kind), pair(lx, ro, kind), pair(lo, rx, kind)))
        names = F.array(*map(F.lit, self.columns))
        return (
            ends.select("key", F.array(*pairs).alias("pairs"), F.inline("wanted"))
            .withColumn("pair", F.get("pairs", F.col("column")))
            .select(
                F.get(names, F.col("column")).alias("column"), "sample", F.col("key").alias(self.key),
                "pair.left_value", "pair.right_value",
            )
            .orderBy("column", "sample")
        )


def keyed_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Per common column of an inner join on ``key``: how many pairs differ, most first.

    ``differing`` counts pairs of two non-NULL unlike values; ``unequal`` also counts
    NULL against a value, and decides whether the column is identical.  ``rank`` is the place in
    this order.
    """
    counts = ("pairs", "differing", "unequal")
    return (
        _Keyed(left, right, key)
        .counts()
        .groupBy(F.struct("column").alias("_group"))  # see _stacked
        .agg(*[F.sum(c).alias(c) for c in counts])
        .select("_group.column", *counts)
        .withColumn(
            "percent",
            F.try_divide(F.col("differing").cast("double") * 100.0, F.col("pairs").cast("double")),
        )
        .withColumn("identical", F.col("unequal") == 0)
        # one row per column of the tables
        .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("differing"), "column")))
        .orderBy("rank")
    )


def keyed_samples(left: DataFrame, right: DataFrame, key: str, limit: int = 5) -> DataFrame:
    """The first ``limit`` keys per column with a differing pair, one pair per key."""
    return _Keyed(left, right, key).samples(limit)


# --- unkeyed values -------------------------------------------------------------


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (common columns) that one side holds more often, with the surplus.

    Rows are first balanced by fingerprint, sixteen bytes each; only rows whose fingerprint may be out of
    balance are then counted in full, so equal tables move no wide rows, whatever their order.
    """
    columns = common_columns(left, right)
    balance = F.col("_l") - F.col("_r")
    one, other = _alike(left, right, columns)
    texts = [as_text(F.col(f"`{c}`"), one.schema[c].dataType) for c in columns]
    cells = [
        h
        for c, text in zip(columns, texts, strict=True)
        for h in lanes(F.col(f"`{c}`"), text, one.schema[c].dataType)
    ]
    # a missing value adds nothing to Spark's hash, so it gets a lane of its own
    first, second = (F.xxhash64(*[F.coalesce(h, F.lit(i)) for i, h in enumerate(cells[k::2])]) for k in (0, 1))
    marks = _stacked(*[df.select(first.alias("a"), second.alias("b")) for df in (one, other)], ["a", "b"])
    uneven = marks.groupBy("_group").agg(F.sum(balance).alias("_balance")).where(F.col("_balance") != 0)
    changed = bit_set(uneven.select("_group.a"))
    one, other = (df.where(in_set(changed, first)) for df in (one, other))
    return (
        _stacked(one, other, [f"`{c}`" for c in columns])
        .groupBy("_group")
        .agg(F.sum(balance).alias("_balance"))
        .where(F.col("_balance") != 0)
        .select(
            "_group.*",
            F.when(F.col("_balance") > 0, "left").otherwise("right").alias("surplus_side"),
            F.abs("_balance").alias("surplus"),
        )
    )


def _alike(
    left: DataFrame, right: DataFrame, columns: Sequence[str], *others: str
) -> tuple[DataFrame, DataFrame]:
    """Both tables with their columns in the type in which they are compared, after ``others`` as they are."""
    pairs = [_comparable(left, right, c) for c in columns]
    kept = [F.col(f"`{c}`") for c in others]
    return (
        left.select(*kept, *[p[0].alias(c) for p, c in zip(pairs, columns, strict=True)]),
        right.select(*kept, *[p[1].alias(c) for p, c in zip(pairs, columns, strict=True)]),
    )


def column_surplus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per common column, how many values one side holds more often than the other: which
    columns changed, where rows have no key.

    Every row is taken apart into (column, value), and both sides are counted in one pass.
    """
    columns = common_columns(left, right)

    def cells(df: DataFrame) -> DataFrame:
        texts = [
            F.struct(F.lit(c).alias("column"), as_text(F.col(f"`{c}`"), df.schema[c].dataType).alias("value"))
            for c in columns
        ]
        return df.select(F.inline(F.array(*texts)))

    one, other = map(cells, _alike(left, right, columns))
    balance = F.sum(F.col("_l") - F.col("_r")).alias("balance")
    counted = _stacked(one, other, ["column", "value"]).groupBy("_group").agg(balance)
    more = F.coalesce(F.sum(F.when(F.col("balance") > 0, F.col("balance"))), F.lit(0))
    less = F.coalesce(F.sum(F.when(F.col("balance") < 0, -F.col("balance"))), F.lit(0))
    return counted.groupBy(F.col("_group.column").alias("column")).agg(
        more.alias("left_surplus"), less.alias("right_surplus")
    )


# --- profiles -------------------------------------------------------------------


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, median, sample deviation, minimum and maximum of numeric columns."""
    if not columns:
        return df.sparkSession.createDataFrame(
            [], "column string, mean double, median double, std double, min double, max double"
        )
    wide = df.agg(
        *[
            f(F.col(c).cast("double")).alias(f"{tag}_{i}")
            for i, c in enumerate(columns)
            for tag, f in (
                ("mean", F.avg),
                ("std", F.stddev_samp),
                ("min", F.min),
                ("max", F.max),
            )
        ]
    )
    tall = wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        *[
                            F.col(f"{tag}_{i}").alias(tag)
                            for tag in ("mean", "std", "min", "max")
                        ],
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
    return tall.join(exact_medians(df, columns), "column", "left").select(
        "column", "mean", "median", "std", "min", "max"
    )


def profile_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Numeric profiles of the common numeric columns, side by side."""
    columns = sorted(set(numeric_columns(left)) & set(numeric_columns(right)))
    parts = ("mean", "median", "std", "min", "max")

    def side(df: DataFrame, tag: str) -> DataFrame:
        return numeric_profile(df, columns).select(
            "column", *[F.col(p).alias(f"{tag}_{p}") for p in parts]
        )

    return side(left, "left").join(side(right, "right"), "column")


# --- bytes ----------------------------------------------------------------------

# Bytes of one value of a fixed-width type.
_WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.LongType: 8,
    T.FloatType: 4,
    T.DoubleType: 8,
    T.DateType: 4,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def value_bytes(c: Column, kind: T.DataType) -> Column:
    """Logical bytes of one value: text and binary by length, nested values by content."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint")
    if isinstance(kind, T.ArrayType):
        return F.coalesce(
            F.aggregate(
                c,
                F.lit(0).cast("bigint"),
                lambda total, v: total + value_bytes(v, kind.elementType),
            ),
            F.lit(0).cast("bigint"),
        )
    if isinstance(kind, T.StructType):
        total = F.lit(0).cast("bigint")
        for f in kind.fields:
            total = total + value_bytes(c[f.name], f.dataType)
        return total
    width = _WIDTHS.get(type(kind), 8)
    return F.when(c.isNotNull(), F.lit(width)).otherwise(F.lit(0)).cast("bigint")


def column_bytes(df: DataFrame) -> DataFrame:
    """Logical bytes per column, in one pass."""
    wide = df.agg(
        *[
            F.coalesce(F.sum(value_bytes(F.col(f.name), f.dataType)), F.lit(0)).alias(f"b{i}")
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(f"b{i}").alias("bytes"))
                    for i, c in enumerate(df.columns)
                ]
            )
        )
    )


def bytes_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bytes per column of both sides; NULL where a side lacks the column."""
    l = column_bytes(left).withColumnRenamed("bytes", "left_bytes")
    r = column_bytes(right).withColumnRenamed("bytes", "right_bytes")
    a, b = F.coalesce("left_bytes", F.lit(0)), F.coalesce("right_bytes", F.lit(0))
    return l.join(r, "column", "full").select(
        "column",
        "left_bytes",
        "right_bytes",
        F.abs(a - b).alias("difference"),
        F.try_divide(F.abs(a - b) * 100.0, F.greatest(a, b)).alias("percent"),
        (F.col("left_bytes").isNotNull() & F.col("right_bytes").isNotNull()).alias("common"),
    )


def largest_bytes_differences(left: DataFrame, right: DataFrame, limit: int = 20) -> DataFrame:
    """The common columns whose bytes differ most, largest first."""
    return (
        bytes_diff(left, right)
        .where(F.col("common") & (F.col("difference") > 0))
        .orderBy(F.desc("difference"), "column")
        .limit(limit)
    )


def bytes_totals(left: DataFrame, right: DataFrame) -> DataFrame:
    """Total bytes, split into common columns and columns of one side only."""
    common = F.col("common")
    return bytes_diff(left, right).agg(
        *[
            F.coalesce(F.sum(value), F.lit(0)).alias(name)
            for name, value in {
                "left_bytes": F.col("left_bytes"),
                "right_bytes": F.col("right_bytes"),
                "left_common_bytes": F.when(common, F.col("left_bytes")),
                "right_common_bytes": F.when(common, F.col("right_bytes")),
                "left_only_bytes": F.when(~common, F.col("left_bytes")),
                "right_only_bytes": F.when(~common, F.col("right_bytes")),
            }.items()
        ]
    )


class Reports(Mapping):
    """Reports by name; each is built when it is asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]) -> None:
        self._builders = builders

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def compare(left: DataFrame, right: DataFrame, key: str | None = "SeriesInstanceUID") -> Reports:
    """All reports on two tables; nothing runs until a report is asked for.

    The profile searches its medians when it is asked for, the others run when they are used.
    """
    builders = {
        "schema": lambda: schema_diff(left, right),
        "shape": lambda: shape_diff(left, right),
        "bytes": lambda: bytes_diff(left, right),
        "profile": lambda: profile_diff(left, right),
    }
    if key is None:
        builders["rows"] = lambda: multiset_diff(left, right)
        builders["columns"] = lambda: column_surplus(left, right)
    else:
        builders["values"] = lambda: keyed_diff(left, right, key)
        builders["samples"] = lambda: keyed_samples(left, right, key)
    return Reports(builders)
