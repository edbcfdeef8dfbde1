"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions.

The ring has ``cells`` equal arcs. Each shard owns ``points`` random places on it; going clockwise
from a cell, the order in which the shards first appear is the cell's order of preference. A key falls into
a cell by its hash and belongs to the first shard of that order that has room: keys that overflow a full
shard continue clockwise. Keys at home come before keys that overflow from elsewhere, then cells count in ring
order, then the hash decides, so the result does not depend on the order of the input.

All keys of a cell prefer the same shards, so who overflows is settled on counts: one pass counts the
rows of each cell and split (``cells * splits`` numbers, whatever the input), the walk around the ring
hands out intervals of positions, and one window per cell and split gives each row its position. The
interval also says where its positions start in the shard, which makes slots gapless without another shuffle.

With ``slack`` 0 the room of all shards adds up to the number of rows, so counts differ by one at most
("rows" law); with more slack a shard holds at most ``ceil((1 + slack) * rows / shards)`` and fewer keys overflow.

Defined results: a null key is a key of its own; rows that share a key are dealt over the splits of
its cell by their other columns; rows equal in all columns are counted once with their number and
drawn apart at the end, so they may be many; an empty table gives no rows. Columns of the input keep
their names and must not be maps; ``shard`` and ``slot`` are added and may not be among them.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def preferences(shards: int, points: int, cells: int) -> list[list[int]]:
    """For each cell the shards in the order in which a walk clockwise meets them."""
    marks: list[set[int]] = [set() for _ in range(cells)]
    for shard in range(shards):
        for point in range(points):
            digest = hashlib.blake2b(f"{shard}/{point}".encode(), digest_size=8).digest()
            marks[int.from_bytes(digest, "big") % cells].add(shard)
    out: list[list[int]] = [[]] * cells
    order: list[int] = []
    # two turns against the clock: the second one sees the points beyond the ring's seam
    for cell in [*range(cells - 1, -1, -1)] * 2:
        here = sorted(marks[cell])
        order = here + [shard for shard in order if shard not in marks[cell]]
        out[cell] = order
    return out


def room(rows: int, shards: int, slack: float) -> list[int]:
    """How many rows each shard takes."""
    if slack:
        return [-int(-(1 + slack) * rows // shards)] * shards
    each, more = divmod(rows, shards)
    return [each + (shard < more) for shard in range(shards)]


def walk(counts: list[int], order: list[list[int]], splits: int, free: list[int]) -> list[tuple[int, ...]]:
    """Intervals ``(group, first, count, shard, slot of first)`` of row positions within groups.

    ``counts[group]`` rows of group ``cell * splits + split`` go round the ring; ``free`` is each shard's room.
    """
    free, slot = list(free), [0] * len(free)
    done = [0] * len(counts)
    out = []
    for turn in range(len(free)):
        for group, count in enumerate(counts):
            shard = order[group // splits][turn]
            take = min(count - done[group], free[shard])
            if take > 0:
                out.append((group, done[group], take, shard, slot[shard]))
                done[group] += take
                free[shard] -= take
                slot[shard] += take
    return out


def placed(
    rows: DataFrame,
    key: str,
    *,
    shards: int = 8,
    slack: float = 0.0,
    points: int = 128,
    cells: int = 2048,
    splits: int = 4,
) -> DataFrame:
    """The rows with ``shard`` and ``slot``; meant for keys and what goes with them, not for texts."""
    spark = rows.sparkSession
    columns = [F.col(f"`{c}`") for c in rows.columns]
    cell = F.pmod(F.shiftrightunsigned(F.xxhash64(F.col(f"`{key}`")), 16), F.lit(cells))
    mixed = F.xxhash64(F.lit("row"), *columns)
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    grouped = counted.withColumn("_mixed", mixed).withColumn(
        "_group", (cell * splits + F.pmod(F.shiftrightunsigned("_mixed", 16), F.lit(splits))).cast("int")
    )
    sizes = grouped.groupBy("_group").agg(F.sum("_copies").alias("n")).collect()
    counts = [0] * (cells * splits)
    for size in sizes:
        counts[size["_group"]] = size["n"]
    intervals = walk(counts, preferences(shards, points, cells), splits, room(sum(counts), shards, slack))
    dealt = spark.range(1).select(
        F.explode(F.from_json(F.lit(json.dumps(intervals)), "array<array<bigint>>")).alias("_i")
    )
    dealt = dealt.select(
        F.col("_i")[0].cast("int").alias("_group"), F.col("_i")[1].alias("_from"),
        F.col("_i")[2].alias("_count"), F.col("_i")[3].cast("int").alias("shard"), F.col("_i")[4].alias("_slot"),
    )
    before = Window.partitionBy("_group").orderBy("_mixed", *columns).rowsBetween(Window.unboundedPreceding, -1)
    placed_at = grouped.withColumn("_at", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
    each = placed_at.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    position = F.col("_at") + F.col("_copy")
    joined = each.join(dealt, "_group").where(
        (position >= F.col("_from")) & (position < F.col("_from") + F.col("_count"))
    )
    return joined.select(*columns, "shard", (F.col("_slot") + position - F.col("_from")).alias("slot"))
