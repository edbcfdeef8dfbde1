"""Order-sensitive work on groups of any size.

A window over ``PARTITION BY key`` puts each key into one task.  Here a hot key is cut into many
contiguous *fragments* first.  Windows run inside a fragment, and what crosses a border is
solved on one summary row per fragment.  Where rows only feed aggregates, they are cut by
range-partitioning on (key, order, tie); where they are returned, only large keys are cut, at
borders that are fixed beforehand, and each row is shuffled once.
"""

from __future__ import annotations

import functools
import json
import struct
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRAGMENT = "_fragment"


def fragmented(
    df: DataFrame, keys: Sequence[str], order: str, tie: Column | None = None
) -> DataFrame:
    """Cut the rows into contiguous fragments of the order (keys, order, tie)."""
    ranges = [F.col(k) for k in keys] + [F.col(order)]
    if tie is not None:
        ranges.append(tie)
    return df.repartitionByRange(*ranges).withColumn(FRAGMENT, F.spark_partition_id())


def gap_summary(rows: DataFrame, key: str, value: str, tie: Column) -> DataFrame:
    """Per key: number of values, smallest and largest gap between sorted neighbours,
    and the number of distinct values.  NULL values sort first and take no part.
    """
    inside = Window.partitionBy(key, FRAGMENT).orderBy(value)
    parts = (
        fragmented(rows, [key], value, tie)
        .select(key, FRAGMENT, value, (F.lead(value).over(inside) - F.col(value)).alias("gap"))
        .groupBy(key, FRAGMENT)
        .agg(
            F.count(value).alias("n"),
            F.min(value).alias("lo"),
            F.max(value).alias("hi"),
            F.min("gap").alias("min_gap"),
            F.max("gap").alias("max_gap"),
            F.count_if(F.col("gap") == 0).alias("repeats"),
        )
    )
    borders = (
        parts.groupBy(key)
        .agg(
            F.sum("n").alias("n_values"),
            F.min("min_gap").alias("min_gap"),
            F.max("max_gap").alias("max_gap"),
            F.sum("repeats").alias("repeats"),
            # at most one entry per range partition
            F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"),
        )
        .withColumn(
            "border_gaps",
            F.transform(
                F.slice("spans", F.lit(2), F.size("spans")),
                lambda s, i: s["lo"] - F.get(F.col("spans"), i)["hi"],
            ),
        )
    )
    return borders.select(
        key,
        "n_values",
        F.least("min_gap", F.array_min("border_gaps")).alias("min_gap"),
        F.greatest("max_gap", F.array_max("border_gaps")).alias("max_gap"),
        (
            F.col("n_values")
            - F.col("repeats")
            - F.size(F.filter("border_gaps", lambda g: g == 0))
        ).alias("distinct_values"),
    )


#: A key with more rows than this is cut into fragments of about as many.
FRAGMENT_ROWS = 1_000_000
#: Bound on the number of keys that are cut, and on the fragments of all of them beyond one each.
FRAGMENTS = 4096
#: Sampled rows from which a fragment's border is taken.
SAMPLES = 20


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    parts = [left[n].eqNullSafe(right[n]) for n in names]
    return functools.reduce(Column.__and__, parts)


def split_points(rows: DataFrame, keys: Sequence[str], order: Column) -> DataFrame | None:
    """Borders of the fragments of large keys, as a local table (keys, ``_splits``); None without large keys.

    ``order`` is an orderable value, unique within a key as far as its rows are unlike.  Borders come from a
    sample, but are fixed when this function returns: every later use cuts the rows alike, and what
    the sample was only decides how even the fragments are.  At most FRAGMENTS keys and twice as many
    borders reach the driver.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FRAGMENT_ROWS)
    large = counts.orderBy(F.desc("_n")).limit(FRAGMENTS).collect()
    if not large:
        return None
    total = sum(r["_n"] for r in large)
    each = max(FRAGMENT_ROWS, total // FRAGMENTS)
    pieces = [(*r[:-1], -(-r["_n"] // each)) for r in large]
    schema = T.StructType([counts.schema[k] for k in keys] + [T.StructField("_pieces", T.LongType())])
    spark = rows.sparkSession
    wanted = F.broadcast(spark.createDataFrame(pieces, schema))
    share = min(1.0, SAMPLES * sum(p[-1] for p in pieces) / total)
    kept = rows.select(*keys, order.alias("_order"))
    sampled = kept.join(wanted, _same(kept, wanted, keys)).select(*[kept[k] for k in keys], "_order", "_pieces")
    ordered = F.sort_array(F.collect_list("_order")).alias("_s")
    lists = sampled.sample(share, seed=7).groupBy(*keys, "_pieces").agg(ordered)
    points = F.transform(
        F.sequence(F.lit(1).cast("long"), F.col("_pieces") - 1),
        lambda i: F.get("_s", F.floor(i * F.size("_s") / F.col("_pieces")).cast("int")),
    )
    cut = lists.where("_pieces > 1").select(*keys, F.array_distinct(points).alias("_splits"))
    return spark.createDataFrame(cut.collect(), cut.schema)


def cut_at(rows: DataFrame, keys: Sequence[str], order: Column, splits: DataFrame | None) -> DataFrame:
    """Add the fragment of each row, by binary search among its key's borders; other keys have the fragment 0."""
    if splits is None:
        return rows.withColumn(FRAGMENT, F.lit(0))
    few = F.broadcast(splits)  # at most 2 * FRAGMENTS borders in all
    steps = F.array(*[F.lit(1 << k) for k in range(FRAGMENTS.bit_length(), -1, -1)])
    at = F.aggregate(
        steps,
        F.lit(0),
        # the border before the place reached and stepped over is still at or below the row; none lies beyond the end
        lambda at, step: at + F.when(F.get(few["_splits"], at + step - 1) <= order, step).otherwise(0),
    )
    joined = rows.join(few, _same(rows, few, keys), "left")
    return joined.select(*[rows[c] for c in rows.columns], F.coalesce(at, F.lit(0)).alias(FRAGMENT))


def _of_fragments(cut: DataFrame, keys: Sequence[str], splits: DataFrame, *aggs: Column) -> DataFrame:
    """Aggregates of the fragments of large keys: at most one row for each border and each large key."""
    few = F.broadcast(splits)
    return cut.join(few, _same(cut, few, keys), "left_semi").groupBy(*keys, FRAGMENT).agg(*aggs)


def with_next_value(
    rows: DataFrame, key: str, value: str, tie: Column, next_name: str, extent: Sequence[str] = ()
) -> DataFrame:
    """Add the next value of the same key in sorted order (NULL values come first), and with
    three names in ``extent`` the smallest and largest value and the number of rows of the key.

    Each row is shuffled once, by its key and fragment.  The last row of a fragment takes its
    successor from a table of the large keys' fragments.  Runs its search for large keys when called.
    """
    tied = rows.withColumn("_tie", tie)
    order = F.struct(F.col(value).isNotNull(), value, "_tie")
    splits = split_points(tied, [key], order)
    cut = cut_at(tied, [key], order, splits)
    group = Window.partitionBy(key, FRAGMENT)
    inside = group.orderBy(value, "_tie")
    ends = [F.min(value), F.max(value), F.count(F.lit(1))]
    names = ("_lo", "_hi", "_n")[: len(extent)]
    led = cut.select(
        "*",
        F.lead(value).over(inside).alias("_next"),
        F.lead(F.lit(1)).over(inside).isNull().alias("_is_last"),
        *[end.over(group).alias(n) for end, n in zip(ends, names)],
    )
    if splits is None:
        return led.select(*rows.columns, F.col("_next").alias(next_name), *map(_renamed, names, extent))
    first = F.when(~F.bool_or(F.col(value).isNull()), F.min(value)).alias("_first")
    parts = _of_fragments(cut, [key], splits, first, *[end.alias(n) for end, n in zip(ends, ("_lo", "_hi", "_n"))])
    across = Window.partitionBy(key)
    table = parts.select(
        F.col(key).alias("_key"),
        F.col(FRAGMENT).alias("_at"),
        F.lead("_first").over(across.orderBy(FRAGMENT)).alias("_after"),
        *[f(n).over(across).alias(f"_all{n}") for f, n in zip((F.min, F.max, F.sum), names)],
    )
    on = F.col(key).eqNullSafe(F.col("_key")) & (F.col(FRAGMENT) == F.col("_at"))
    known = led.join(F.broadcast(table), on, "left")
    whole = [F.when(F.col("_at").isNotNull(), F.col(f"_all{n}")).otherwise(F.col(n)).alias(n) for n in names]
    return known.select(
        *rows.columns, F.when(F.col("_is_last"), F.col("_after")).otherwise(F.col("_next")).alias(next_name), *whole
    ).withColumnsRenamed(dict(zip(names, extent)))


def _renamed(old: str, new: str) -> Column:
    return F.col(old).alias(new)


def with_position(rows: DataFrame, keys: Sequence[str], order: Column, name: str) -> DataFrame:
    """Add each row's place, from 1, among the rows of its keys in the order of a struct.

    Places within a fragment come from a window, those of the fragments before it from prefix sums
    over the table of fragments, so no window holds a large key whole.  Rows that are equal in
    the order may take each other's places.
    """
    splits = split_points(rows, keys, order)
    cut = cut_at(rows, keys, order, splits)
    inside = Window.partitionBy(*keys, FRAGMENT).orderBy(order)
    placed = cut.select("*", F.row_number().over(inside).cast("long").alias("_place"))
    if splits is None:
        return placed.select(*rows.columns, F.col("_place").alias(name))
    parts = _of_fragments(cut, keys, splits, F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(FRAGMENT).rowsBetween(Window.unboundedPreceding, -1)
    table = parts.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.col(FRAGMENT).alias("_at"),
        F.sum("_n").over(before).alias("_before"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    on = functools.reduce(Column.__and__, same) & (F.col(FRAGMENT) == F.col("_at"))
    known = placed.join(F.broadcast(table), on, "left")
    return known.select(*rows.columns, (F.col("_place") + F.coalesce("_before", F.lit(0))).alias(name))


#: Ranges into which a round of the search for a median cuts a bracket: eleven bits of a double's 64.
RANGES = 2048


def _key(x: float) -> int:
    """Whole number in the order of the doubles; equal doubles have equal keys."""
    (bits,) = struct.unpack("<q", struct.pack("<d", x + 0.0))
    return bits if bits >= 0 else -(bits & (2**63 - 1))


def _value(key: int) -> float:
    return struct.unpack("<d", struct.pack("<q", key if key >= 0 else -key - 2**63))[0]


def _borders(lo: float, hi: float) -> list[float]:
    """Where the ranges after the first one start: equally many doubles apart, whatever their size."""
    low, high = _key(lo), _key(hi)
    keys = {low + (high - low + 1) * i // RANGES for i in range(1, RANGES)}
    return [_value(k) for k in sorted(keys - {low})]


def _range_of(value: Column, borders: list[float]) -> Column:
    """Number of borders at or below a value, by binary search."""
    # one literal: Spark folds it before the job starts
    listed = F.from_json(F.lit(json.dumps(borders)), "array<double>")
    steps = F.array(*[F.lit(1 << k) for k in range(len(borders).bit_length() - 1, -1, -1)])
    if not borders:
        return F.lit(0)
    return F.aggregate(
        steps, F.lit(0), lambda at, n: at + F.when(F.get(listed, at + n - 1) <= value, n).otherwise(0)
    )


def exact_medians(df: DataFrame, columns: Sequence[str], accuracy: int = 100_000) -> DataFrame:
    """Exact median of several numeric columns, as rows (column, median).

    A mergeable quantile sketch gives each column a narrow bracket.  Rounds then count the values within the
    brackets, and only those, by range; the range that holds the median is the next bracket.  Ranges
    cut the doubles of a bracket into equal numbers, so eleven bits are settled a round and six rounds are
    enough for any data; at most RANGES rows per column and round reach the driver.  A sketch that
    misses costs one round more.

    NaN counts as the largest value and infinities as themselves. A column without values has
    no row. The search runs its jobs when this function is called.
    """
    found, _ = search_medians(df, columns, accuracy)
    return df.sparkSession.createDataFrame(
        [(c, found[c]) for c in columns if c in found], "column string, median double"
    )


def search_medians(
    df: DataFrame, columns: Sequence[str], accuracy: int = 100_000
) -> tuple[dict[str, float], int]:
    """The medians of ``exact_medians``, and in how many rounds they were found."""
    found: dict[str, float] = {}
    if not columns:
        return found, 0
    numbers = {c: F.col(c).cast("double") + F.lit(0.0) for c in columns}
    # NaN and infinity share the last place until the end
    placed = {c: F.when(F.isnan(v), F.lit(float("inf"))).otherwise(v) for c, v in numbers.items()}
    half = min(0.5, 4.0 / accuracy)
    head = df.agg(
        *[
            f(c).alias(f"{tag}_{i}")
            for i, c in enumerate(columns)
            for tag, f in (
                ("n", lambda c: F.count(numbers[c])),
                ("reals", lambda c: F.count_if(~F.isnan(numbers[c]))),
                ("q", lambda c: F.percentile_approx(placed[c], [0.5 - half, 0.5 + half], accuracy)),
            )
        ]
    ).first()
    ranks: dict[str, tuple[int, int]] = {}
    brackets: dict[str, tuple[float, float]] = {}
    for i, c in enumerate(columns):
        n = head[f"n_{i}"]
        if not n:
            continue
        ranks[c] = ((n - 1) // 2, n // 2)
        if ranks[c][1] >= head[f"reals_{i}"]:
            found[c] = float("nan")
        else:
            brackets[c] = tuple(head[f"q_{i}"])
    if not brackets:
        return found, 0
    below = _count_below(df, placed, brackets)
    rounds = 0
    while brackets:
        rounds += 1
        cells = []
        for c, (lo, hi) in brackets.items():
            inside = F.when(placed[c].between(F.lit(lo), F.lit(hi)), _range_of(placed[c], _borders(lo, hi)))
            cells.append(F.struct(F.lit(c).alias("column"), placed[c].alias("v"), inside.alias("r")))
        counts = (
            df.select(F.inline(F.filter(F.array(*cells), lambda x: x["r"].isNotNull())))
            .groupBy("column", "r")
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .collect()
        )
        missed: dict[str, tuple[float, float]] = {}
        for c, (lo, hi) in list(brackets.items()):
            lower, upper = ranks[c]
            before, known, target = below[c], {}, None
            for row in sorted((r for r in counts if r["column"] == c), key=lambda r: r["r"]):
                for rank in {lower, upper}:
                    if rank == before or row["lo"] == row["hi"] and before <= rank < before + row["n"]:
                        known[rank] = row["lo"]
                    elif rank == before + row["n"] - 1:
                        known[rank] = row["hi"]
                    elif before <= rank < before + row["n"]:
                        target = (row["lo"], row["hi"], before)
                before += row["n"]
            if {lower, upper} <= set(known):
                low, high = known[lower], known[upper]
                found[c] = low / 2 + high / 2 if lower != upper else low
                del brackets[c]
            elif target is not None:
                brackets[c], below[c] = target[:2], target[2]
            else:
                # the sketch's bracket does not hold both ranks
                missed[c] = (float("-inf"), hi) if lower < below[c] else (lo, float("inf"))
        wide = {c: b for c, b in missed.items() if b != brackets[c]}
        brackets |= wide
        if wide:
            below |= _count_below(df, placed, wide)
    return found, rounds


def _count_below(df: DataFrame, values: dict[str, Column], brackets: dict[str, tuple[float, float]]) -> dict[str, int]:
    names = list(brackets)
    row = df.agg(*[F.count_if(values[c] < F.lit(brackets[c][0])).alias(f"b{i}") for i, c in enumerate(names)]).first()
    return {c: row[f"b{i}"] for i, c in enumerate(names)}
