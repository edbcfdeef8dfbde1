"""Merkle manifest of a dataset: one tree per group of rows and one over the groups, with a proof for each row.

A row's leaf is the digest of its fields. Within a group the leaves ascend by the order column; while a tree has
more than one node, each run of ``fanout`` consecutive nodes becomes the digest of the run, also where the last run
is shorter or a single node. What remains is the group's subroot. The subroots, ordered by group (null first, then
bytewise), make the top tree, and its last node is the root.

Each level is one window over chunks of ``fanout ** 3`` nodes: columns of fixed lag and lead, masked by the slot
within the run and by the length of the run, are the siblings; the first child of a run, where the lag columns are
empty, hashes itself and what follows to the parent. Levels are written to the shared folder, each a
``fanout``-th of the one below, and siblings are handed down from the root by joins of a run with its parent.

Positions come without a window over a group: rows are range-partitioned and sorted, their index within a partition
follows from Spark's ascending ids, and the groups' counts per partition, at most one row for each group and
partition beyond the number of groups, say where a partition starts. A group of any size is so cut into many tasks.

Defined results: a null group is a group of its own and differs from an empty one; null order values come first;
rows with equal order ascend by leaf, and rows equal in both are interchangeable, each a leaf of its own; a
text of any length is one field; an empty table has no rows. Columns not named in the call are not read, so extra
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Columns that name a tree; neither is ever null.
_TREE = ["_named", "_name"]
_NODE = [*_TREE, "_pos", "_n", "_digest"]
#: Ascending ids hold the partition above this bit and the row's index below it.
_INDEX_BITS = 33


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of fields in order: each ``-`` if null, else its length in bytes, a colon and its value as text."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with ``_pos``, their position in their tree by ``order``, and ``_n``, the tree's number of rows."""
    # the id comes last so that rows equal in everything else do not share one partition
    cut = (
        rows.withColumn("_id", F.monotonically_increasing_id())
        .repartitionByRange(*_TREE, *order, "_id")
        .sortWithinPartitions(*_TREE, *order, "_id")
        .drop("_id")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", _INDEX_BITS).cast("int")
    cut = stored(cut).withColumn("_part", part)
    counts = cut.groupBy(*_TREE, "_part").agg(F.count(F.lit(1)).alias("_count"), F.min("_at").alias("_first"))
    tree = Window.partitionBy(*_TREE)
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *_TREE,
        "_part",
        (F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_count").over(tree).alias("_n"),
    )
    return cut.join(starts, [*_TREE, "_part"]).withColumn("_pos", F.col("_at") + F.col("_shift")).drop(
        "_at", "_part", "_shift"
    )


def _with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Adds the digests of the run's nodes to the left and to the right, each as one text."""
    # as SQL text: building thirty window columns one by one would take longer than running them
    run = f"OVER (PARTITION BY {', '.join(_TREE)}, _chunk ORDER BY _pos)"
    left = [f"if(_slot >= {k}, lag(_digest, {k}) {run}, '')" for k in range(fanout - 1, 0, -1)]
    right = [f"if(_slot + {k} < _length, lead(_digest, {k}) {run}, '')" for k in range(1, fanout)]
    return (
        nodes.withColumns({"_chunk": F.expr(f"_pos div {fanout**3}"), "_slot": F.expr(f"_pos % {fanout}")})
        .withColumn("_length", F.expr(f"least({fanout}, _n - _pos + _slot)"))
        .withColumns({"_left": F.expr(f"concat({', '.join(left)})"), "_right": F.expr(f"concat({', '.join(right)})")})
        .drop("_chunk", "_slot", "_length")
    )


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The next level: first children hash their run. A tree that has come down to one node keeps it."""
    first = _with_siblings(nodes.select(*_NODE), fanout).where(F.pmod("_pos", F.lit(fanout)) == 0)
    return first.select(
        *_TREE,
        F.floor(F.col("_pos") / fanout).alias("_pos"),
        F.ceil(F.col("_n") / fanout).alias("_n"),
        F.when(F.col("_n") > 1, _hash(F.col("_digest"), F.col("_right"))).otherwise(F.col("_digest")).alias("_digest"),
    )


def _climbed(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """All levels from the leaves up to one node for each tree."""
    levels = [nodes]
    most = nodes.agg(F.max("_n")).first()[0] or 0
    while most > 1:
        levels.append(stored(_parents(levels[-1], fanout)))
        most = -(-most // fanout)
    return levels


def _descended(levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """The lowest level's rows with ``subroot``, ``root`` and ``path``: siblings level by level, from the leaf up.

    ``tops`` has these columns for each tree; a level that a tree has outgrown adds nothing to its path.
    """
    known = ["subroot", "root", "path"]
    paths = tops.select(*_TREE, F.lit(0).cast("long").alias("_pos"), *known)
    for nodes in reversed(levels[:-1]):
        above = paths.select(*_TREE, F.col("_pos").alias("_up"), *known)
        here = _with_siblings(nodes, fanout).withColumn("_up", F.floor(F.col("_pos") / fanout))
        step = F.array(F.struct(F.col("_left").alias("left"), F.col("_right").alias("right")))
        path = F.when(F.col("_n") > 1, F.concat(step, "path")).otherwise(F.col("path"))
        paths = here.join(above, [*_TREE, "_up"]).withColumn("path", path).drop("_up", "_left", "_right")
    if len(levels) == 1:
        paths = levels[0].join(paths.drop("_pos"), _TREE)
    return paths


def manifest(
    rows: DataFrame, *, tree: str, order: str, leaf: Column, presented: Column | None = None, fanout: int = 16
) -> DataFrame:
    """Per row ``key`` (its order value), ``leaf``, ``presented``, ``subroot``, ``root`` and ``path``.

    ``presented`` may be a leaf computed from data that is to be verified, or null. ``path`` is an array of
    (left, right): the digests of the siblings of each level, as text, from the leaf's run to the root's.
    """
    group = F.col(f"`{tree}`").cast("string")
    start = rows.select(
        group.isNotNull().alias("_named"),
        F.coalesce(group, F.lit("")).alias("_name"),
        F.col(f"`{order}`").alias("key"),
        leaf.alias("_digest"),
        (F.lit(None).cast("string") if presented is None else presented).alias("presented"),
    )
    levels = _climbed(stored(_numbered(start, ["key", "_digest"])), fanout)
    subroots = levels[-1].select(*_TREE, F.col("_digest").alias("subroot"))
    # the top tree's rows are the groups, in order of their names
    named = subroots.select(
        F.lit(True).alias("_named"), F.lit("").alias("_name"), F.struct(*_TREE).alias("group"),
        F.col("subroot").alias("_digest"),
    )
    top = _climbed(stored(_numbered(named, ["group"])), fanout)
    none = F.array().cast("array<struct<left:string,right:string>>")
    last = top[-1].select(*_TREE, F.lit("").alias("subroot"), F.col("_digest").alias("root"), none.alias("path"))
    tops = stored(_descended(top, last, fanout).select("group.*", F.col("_digest").alias("subroot"), "root", "path"))
    return _descended(levels, tops, fanout).select(
        "key", F.col("_digest").alias("leaf"), "presented", "subroot", "root", "path"
    )


def proof(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return _hash(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def folded(digest: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and the siblings on its path."""
    return F.aggregate(path, digest, lambda d, p: _hash(p["left"], d, p["right"]))
