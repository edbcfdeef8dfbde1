"""Near-duplicate documents by SetSketch registers, banding, joint estimation and exact checks.

The set of a document is its distinct shingles of ``size`` words. A register holds, on an exponential
scale and cut to a byte, the smallest of the hash values that the shingles take in it: registers of a
union are the larger ones of each place, and equal registers become more likely with the similarity.

1. Sketch every document. Documents of equal sets are one node, the smallest id among them.
2. Bands of registers put nodes into buckets. No pairs are listed within a bucket: first each node is
   checked against one leader, the smallest node it meets. Then nodes are checked against the first and
   the last node of their buckets, where they are not connected yet. What is left are buckets with
   nodes of different components. Components with close sketches there form a family, and the nodes
   of a family are compared exactly across components, in cells of bounded size that give back at
   most one link for two components. So every pair that shares a bucket
   is linked, connected otherwise, or checked, whatever the size of the bucket.
3. A pair is checked by the size bound, by the likelihood of both sketches (dropped six standard errors
   below the threshold) and then exactly, on the shingle sets of both whole texts.

A pair at the threshold misses all bands with a chance of 5e-7, a more similar one less.

Defined results: a null or empty text, or one without words, has an empty set and is linked with nothing; a
text of fewer words than a shingle is one shingle; a null id is linked with nothing; rows that repeat a
document get the same result each; a text of any length counts with its whole set. The id is the document's
key. Other columns of the input are not used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as X
from .components import components
from .shared import mapped, numbered, stored

BANDS, ROWS = 48, 6
REGISTERS = BANDS * ROWS
#: Nodes that are compared at once with as many others: by sketches in a bucket, by sets in a family.
BLOCK, FAMILY_BLOCK = 2000, 400
#: Scale of the hash values and base of the registers; with these a register fits a byte.
RATE, BASE = 20.0, 1.12

_SEEDS = X.mixed(np.arange(REGISTERS, dtype=np.uint64), 11).astype(np.uint32)
_FACTORS = X.mixed(np.arange(REGISTERS, dtype=np.uint64), 12).astype(np.uint32) | np.uint32(1)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = X.words(X.lowered(X.column_bytes(column)))
    runs = X.grams(w.hashes, size)
    for begin, end in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if end - begin >= size:
            yield np.unique(runs[begin : end - size + 1])
        elif end > begin:
            yield X.grams(w.hashes[begin:end], end - begin)
        else:
            yield np.empty(0, np.uint64)


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a set; an empty set has zeros."""
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    if not len(shingles):
        return np.zeros(REGISTERS, np.uint8)
    low = X.mixed(shingles, 13).astype(np.uint32)
    for at in range(0, len(low), 128):
        block = (low[at : at + 128, None] ^ _SEEDS) * _FACTORS
        np.minimum(least, block.min(axis=0), out=least)
    value = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, 255).astype(np.uint8)


def merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sketched sets."""
    return np.maximum(one, other)


def _reach(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def estimated(one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray) -> np.ndarray:
    """Most likely similarity of pairs, from their registers (a row each) and set sizes."""
    above = (one > other).sum(axis=1)[:, None]
    below = (one < other).sum(axis=1)[:, None]
    share = (n_one / (n_one + n_other))[:, None]
    most = np.minimum(share, 1 - share) / np.maximum(share, 1 - share)
    grid = np.linspace(0, 1, 81)[None, :] * most
    up = np.clip(_reach(share - (1 - share) * grid), 1e-12, 1)
    down = np.clip(_reach((1 - share) - share * grid), 1e-12, 1)
    same = np.clip(1 - up - down, 1e-12, 1)
    chance = above * np.log(up) + below * np.log(down) + (one.shape[1] - above - below) * np.log(same)
    return np.take_along_axis(grid, chance.argmax(axis=1)[:, None], 1)[:, 0]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), REGISTERS)


def sketches(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``doc, n, f1, f2, regs`` of every row; f1 and f2 are a 128-bit hash of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches):
            sets = list(shingle_sets(batch.column(1), size))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array([int(X.mixed(s, k).sum().view(np.int64)) for s in sets], pa.int64()) for k in (1, 2)),
                    pa.array([registers(s).tobytes() for s in sets], pa.binary()),
                ],
                ["doc", "n", "f1", "f2", "regs"],
            )

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    return mapped(rows, run, "doc long, n long, f1 long, f2 long, regs binary")


def _bands(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = _matrix(batch.column(1)).reshape(-1, BANDS, ROWS).astype(np.uint64)
            packed = (regs << (np.arange(ROWS, dtype=np.uint64) * np.uint64(8))).sum(axis=2, dtype=np.uint64)
            keys = X.mixed(packed + (np.arange(BANDS, dtype=np.uint64) << np.uint64(50)))
            node = np.repeat(batch.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(node)], ["band", "node"])

    return mapped(nodes.select("node", "regs"), run, "band long, node long")


def _checked(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by bound, estimate and exact count."""

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, n_a, n_b, r_a, r_b = batch.columns
            guess = estimated(_matrix(r_a), _matrix(r_b), n_a.to_numpy(), n_b.to_numpy())
            limit = percent / 100
            error = np.sqrt(limit * (1 - limit) / REGISTERS)
            keep = pa.array(guess >= limit - 6 * error)
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "t_a"):
            keep = []
            for one, other in zip(shingle_sets(batch.column(2), size), shingle_sets(batch.column(3), size), strict=True):
                common = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(common > 0 and 100 * common >= percent * (len(one) + len(other) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    def side(frame: DataFrame, end: str, *columns: str) -> DataFrame:
        return frame.select(F.col("node").alias(end), *[F.col(c).alias(f"{c[0]}_{end}") for c in columns])

    sized = pairs.join(side(nodes, "a", "n", "regs"), "a").join(side(nodes, "b", "n", "regs"), "b")
    sized = sized.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    guessed = mapped(sized.select("a", "b", "n_a", "n_b", "r_a", "r_b"), likely, "a long, b long")
    read = guessed.join(side(texts, "a", "text"), "a").join(side(texts, "b", "text"), "b")
    return stored(mapped(read.select("a", "b", "t_a", "t_b"), exact, "a long, b long"))


class _Groups:
    """Union-find over the component numbers of a cell."""

    def __init__(self, labels: np.ndarray):
        self.of, self.index = np.unique(labels, return_inverse=True)
        self.links: list[tuple[int, int]] = []

    def join(self, one: int, others: np.ndarray) -> None:
        """Link the group of row ``one`` with those of the rows ``others``."""
        root = self.index[one]
        for other in np.unique(self.index[others]).tolist():
            if other != root:
                self.links.append((int(self.of[root]), int(self.of[other])))
                self.index[self.index == other] = root

    def batch(self) -> pa.RecordBatch:
        a, b = zip(*self.links, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _cells(rows: DataFrame, key: str, block: int) -> DataFrame:
    """Deal the rows of each key into blocks of about ``block`` rows, and let each two blocks meet
    in one cell ``(key, i, j)``, so that a cell is bounded whatever the size of its key."""
    counted = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = rows.join(counted, key).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        F.col(key).alias("key"), F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
        "block", "node", "component",
    )


def _by_cell(cells: DataFrame, value: str, compare: Callable[[pa.Table], _Groups]) -> DataFrame:
    """Links ``a, b`` between components that ``compare`` finds in each cell, a forest per cell."""

    def links(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        found = compare(cell)
        if found.links:
            yield found.batch()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            keys = np.stack([rows.column(c).to_numpy() for c in ("key", "i", "j")], axis=1)
            cuts = (np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1).tolist()
            for a, b in zip([0, *cuts], cuts, strict=False):
                yield from links(rows.slice(a, b - a))
            held = rows.slice(cuts[-1] if cuts else 0).to_batches()
        if held and sum(b.num_rows for b in held):
            yield from links(pa.Table.from_batches(held))

    dealt = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return mapped(dealt.select("key", "i", "j", "block", "node", "component", "n", value), run, "a long, b long")


def _sides(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    block, i, j = cell.column("block").to_numpy(), cell.column("i")[0].as_py(), cell.column("j")[0].as_py()
    return np.flatnonzero(block == i), np.flatnonzero(block == j)


def _families(state: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a band and have nodes with close sketches."""
    limit = percent / 100
    least = limit - 6 * np.sqrt(limit * (1 - limit) / REGISTERS)

    def close(cell: pa.Table) -> _Groups:
        groups, size = _Groups(cell.column("component").to_numpy()), cell.column("n").to_numpy()
        regs = _matrix(cell.column("regs").combine_chunks())
        left, right = _sides(cell)
        for at in left.tolist():
            others = right[groups.index[right] != groups.index[at]]
            others = others[(regs[others] == regs[at]).mean(axis=1) >= least]
            if len(others):
                mine = np.broadcast_to(regs[at], (len(others), REGISTERS))
                guess = estimated(mine, regs[others], np.full(len(others), size[at]), size[others])
                groups.join(at, others[guess >= least])
        return groups

    return _by_cell(_cells(state, "band", BLOCK).join(nodes, "node"), "regs", close)


def _exact_links(members: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between the components of a family, by comparing all their nodes exactly."""

    def alike(cell: pa.Table) -> _Groups:
        groups, count = _Groups(cell.column("component").to_numpy()), cell.column("n").to_numpy()
        sets = list(shingle_sets(cell.column("text").combine_chunks(), size))
        _, ids, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # a bit for each shingle that several of the sets have
        place = np.where(times > 1, np.cumsum(times > 1) - 1, -1)
        width = -(-max(int((times > 1).sum()), 1) // 64) * 64
        bits = np.zeros((len(sets), width // 64), np.uint64)
        ends = np.cumsum([len(s) for s in sets])
        for row, (a, b) in enumerate(zip(ends - [len(s) for s in sets], ends, strict=True)):
            flags = np.zeros(width, bool)
            own = place[ids[a:b]]
            flags[own[own >= 0]] = True
            bits[row] = np.packbits(flags).view(np.uint64)
        left, right = _sides(cell)
        for at in left.tolist():
            others = right[groups.index[right] != groups.index[at]]
            others = others[100 * np.minimum(count[others], count[at]) >= percent * np.maximum(count[others], count[at])]
            common = np.bitwise_count(bits[others] & bits[at]).sum(axis=1, dtype=np.int64)
            groups.join(at, others[100 * common >= percent * (count[others] + count[at] - common)])
        return groups

    cells = _cells(members, "family", FAMILY_BLOCK)
    rows = cells.join(nodes.select("node", "n"), "node").join(texts, "node")
    return stored(_by_cell(rows, "text", alike))


def near_duplicates(
    docs: DataFrame, *, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc, n_shingles, component, kept`` for every row of ``docs``."""
    sketched = stored(sketches(docs, key, text, size).withColumn("row", F.monotonically_increasing_id()))
    full = sketched.where("n > 0 and doc is not null")
    equal = stored(
        full.groupBy("f1", "f2", "n").agg(F.min(F.struct("doc", "row")).alias("least")).select(
            "f1", "f2", "n", F.col("least.doc").alias("node"), F.col("least.row").alias("row")
        )
    )
    nodes = full.join(equal.select("row"), "row", "left_semi").select(F.col("doc").alias("node"), "n", "regs")
    nodes = stored(nodes)
    bands = _bands(nodes)
    buckets = bands.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    members = stored(bands.join(buckets, "band"))
    wanted = members.select("node").distinct()
    named = docs.select(F.col(f"`{key}`").cast("long").alias("node"), F.col(f"`{text}`").alias("text"))
    texts = stored(named.join(wanted, "node", "left_semi").dropDuplicates(["node"]))

    def labelled(links: DataFrame) -> DataFrame:
        found = components(links)
        return members.join(found, "node", "left").select(
            "band", "node", "lo", "hi", F.coalesce("component", "node").alias("component")
        )

    # one leader per node
    first = members.where("node > lo").groupBy(F.col("node").alias("a")).agg(F.min("lo").alias("b"))
    links = _checked(first, nodes, texts, size, percent)
    # the first and the last node of each bucket, where not connected yet
    state = stored(labelled(links))
    of_node = state.select(F.col("node").alias("b"), F.col("component").alias("of_b")).distinct()
    tries = state.select(F.col("node").alias("a"), "component", F.explode(F.array("lo", "hi")).alias("b"))
    tries = tries.where("a <> b").distinct().join(of_node, "b").where("component <> of_b")
    tries = stored(tries.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    links = links.union(_checked(tries.join(first, ["a", "b"], "left_anti"), nodes, texts, size, percent))
    # components that still share a bucket, and families of those with close sketches
    state = stored(labelled(links))
    mixed = state.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    shared = state.join(mixed, "band", "left_semi").select("band", "node", "component")
    families = components(_families(shared, nodes, percent)).select(
        F.col("node").alias("component"), F.col("component").alias("family")
    )
    family = state.select("node", "component").distinct().join(families, "component")
    # a node of a component stands for it, being its smallest
    links = links.union(_exact_links(family, nodes, texts, size, percent))
    found = components(links)
    classes = equal.join(found, "node", "left").select(
        "f1", "f2", "n", F.coalesce("component", "node").alias("component")
    )
    joined = sketched.join(classes, ["f1", "f2", "n"], "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
    return joined.select(
        "doc", F.col("n").alias("n_shingles"), component.alias("component"),
        F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns.

    Rows equal in id and text stay once, with the smallest values of the other columns, taken together; rows without
    an id all stay. Other columns may be of any name, but must not be maps.
    """
    found = near_duplicates(docs, key=key, text=text, **options)
    rows, names, back = numbered(docs)
    dropped = found.where(~F.col("kept")).select(F.col("doc").alias("dropped")).distinct()
    left = rows.join(dropped, F.col(names[key]).cast("long") == F.col("dropped"), "left_anti")
    alone = F.when(F.col(names[key]).isNull(), F.monotonically_increasing_id())
    others = [n for c, n in names.items() if c not in (key, text)]
    grouped = left.withColumn("alone", alone).groupBy(names[key], names[text], "alone")
    if not others:
        return grouped.agg(F.count(F.lit(1))).select(*back)
    least = grouped.agg(F.min(F.struct(*others)).alias("least"))
    return least.select(names[key], names[text], *[F.col(f"least.{n}").alias(n) for n in others]).select(*back)
