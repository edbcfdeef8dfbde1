"""Removal of passages that an earlier document already has, through an FM-index per shard.

A window is ``window`` consecutive words of one document. A word goes if a window that covers it also
starts in a document of a smaller id. Everything is judged on the input.

1. Each window has an anchor: the smallest hash among its runs of ``run`` words. Equal windows have equal
   anchors, so only windows whose anchor several documents have can be equal: anchors are counted
   over all documents, and the repeated ones are joined back.
2. Consecutive windows of one anchor form a segment, and segments of an anchor form the shard in which
   all equal windows meet. An anchor of more than ``HOT`` documents is split: each of its windows is a segment
   of its own, sharded by its full hash. Equal segments are merged by hash before their words move.
3. Shards are packed into FM-indices (word ids, Burrows-Wheeler transform in a wavelet matrix).
   Segments stream through by backward search; the interval of each window of full length gives the
   smallest document that has it.
4. These go back to the places of the segments, and runs of windows with a smaller document to the texts.

Words are compared by 64-bit hashes. No step lists pairs; the largest index holds the segments of HOT
documents or BLOCK_BYTES of text.

Defined results: null and empty texts have no words; a null id takes no part (nothing is removed, and it
counts as no earlier document); the id is the key, and rows that repeat a document get the same result; a text
of any length is read whole, by itself if it is longer than a slice; an empty table gives none. Other columns
are carried by ``without_repeats`` and not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X
from .fmindex import WindowIndex
from .shared import mapped

#: Documents of an anchor beyond which its windows are dealt out one by one.
HOT = 2000
#: Text of the shards that share one index.
BLOCK_BYTES = 3 << 20


def _run(window: int) -> int:
    return max(1, min(8, window // 3))


def _anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """The 48-bit anchor of the window at each word; the last ``window - 1`` words have none."""
    run = _run(window)
    values = X.grams(hashes, run)
    width, span = window - run + 1, 1
    if len(values) < width:
        return np.zeros(0, np.int64)
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    values = np.minimum(values[: len(values) - rest], values[rest:]) if rest else values
    return (values >> np.uint64(16)).astype(np.int64)


def _sequence_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * X._power("up", X._BASE, len(hashes)), out=sums[1:])
    down = X._power("down", X._INVERSE, len(hashes) + 1)
    return X.mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64), 5)


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc, body`` of the documents with an id. One form for all joins, which makes Spark shuffle
    the texts once: a join that drops null ids by itself would be another exchange than one that does not."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("body"))
    return rows.where("doc is not null")


def _anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    """``anchor, doc``, once per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "body"):
            w = X.words(X.column_bytes(batch.column(1)))
            found = _anchors(w.hashes, window)
            parts = [
                np.unique(found[a : max(b - window + 1, a)])
                for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)
            ]
            docs_of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(parts)), batch.column(0).take(pa.array(docs_of))], ["anchor", "doc"]
            )

    return mapped(docs, run, "anchor long, doc long")


def _canonical(text: X.Bytes, w: X.Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words joined by one space, and where each begins and ends there."""
    size = w.end - w.begin
    end = np.cumsum(size + 1) - 1
    begin = end - size
    out = np.full(int(end[-1]) if len(end) else 0, 32, np.uint8)
    out[X.ranges(begin, size)] = text.data[X.ranges(w.begin, size)]
    return out.tobytes(), begin, end


def _segments(docs: DataFrame, hits: DataFrame, window: int) -> DataFrame:
    """``doc, place, shard, same``: where segments lie, and what identifies their words in a shard.

    ``place`` is the first word, the number of words and whether the anchor is hot, in one number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "body"):
            w = X.words(X.column_bytes(batch.column(1)))
            anchors = _anchors(w.hashes, window)
            starts, stops, keys, hots, rows = [], [], [], [], []
            for row, wanted in enumerate(batch.column(2)):
                a, b = int(w.first[row]), int(w.first[row + 1]) - window + 1
                if b <= a:
                    continue
                listed = np.sort(wanted.values.to_numpy(zero_copy_only=False))
                own = anchors[a:b]
                at = np.minimum(np.searchsorted(listed, own * 2), len(listed) - 1)
                there = listed[at] >> 1 == own
                hot = there & (listed[at] & 1 == 1)
                # a segment starts where the anchor changes, and at every window of a hot anchor
                opens = np.concatenate(([True], own[1:] != own[:-1])) | hot
                first = np.flatnonzero(opens)
                last = np.append(first[1:], len(own)) - 1
                kept = there[first]
                first, last = first[kept], last[kept]
                starts.append(first + a)
                stops.append(last + a + window)
                keys.append(own[first])
                hots.append(hot[first])
                rows.append(np.full(len(first), row))
            if not starts:
                continue
            start, stop, row, hot = map(np.concatenate, (starts, stops, rows, hots))
            same = _sequence_hashes(w.hashes, start, stop)
            shard = np.where(hot, _hot_shard(same), np.concatenate(keys))
            place = (start - w.first[row]) << 32 | (stop - start) << 1 | hot
            columns = [batch.column(0).take(pa.array(row)), pa.array(place), pa.array(shard), pa.array(_in_shard(same))]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "place", "shard", "same"])

    rows = docs.join(hits, "doc").select("doc", "body", "anchors")
    return mapped(rows, run, "doc long, place long, shard long, same long")


def _in_shard(same: np.ndarray) -> np.ndarray:
    """What tells the segments of one shard apart: 48 bits of the hash, beside the shard's own 48."""
    return (same & np.uint64((1 << 48) - 1)).astype(np.int64)


def _hot_shard(same: np.ndarray) -> np.ndarray:
    return -1 - (X.mixed(same, 6) >> np.uint64(16)).astype(np.int64)


def _spelled(docs: DataFrame, chosen: DataFrame, window: int) -> DataFrame:
    """``shard, same, words, doc, several`` of the places that ``chosen`` lists by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "body"):
            text = X.column_bytes(batch.column(1))
            w = X.words(text)
            joined, begin, end = _canonical(text, w)
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(2)).to_numpy())
            listed = batch.column(2).flatten().to_numpy()
            place, several = listed >> 1, listed & 1 == 1
            start = (place >> 32) + w.first[row]
            stop = start + ((place & 0xFFFFFFFF) >> 1)
            same = _sequence_hashes(w.hashes, start, stop)
            shard = np.where(place & 1 == 1, _hot_shard(same), _anchors(w.hashes, window)[start])
            pieces = [joined[a:b] for a, b in zip(begin[start].tolist(), end[stop - 1].tolist(), strict=True)]
            columns = [pa.array(shard), pa.array(_in_shard(same)), pa.array(pieces, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column(0).take(pa.array(row)), pa.array(several)],
                ["shard", "same", "words", "doc", "several"],
            )

    rows = docs.join(chosen, "doc").select("doc", "body", "places")
    return mapped(rows, run, "shard long, same long, words binary, doc long, several boolean")


def _first_documents(merged: DataFrame, window: int) -> DataFrame:
    """``shard, same, least, firsts``: the smallest document of each window, as an array of 64-bit numbers."""

    def searched(rows: pa.Table) -> pa.RecordBatch:
        w = X.words(X.column_bytes(rows.column("words").cast(pa.string())))
        index = WindowIndex(w.hashes, w.first, window)
        first = rows.column("doc").to_numpy()
        values, begin = index.least(first)
        data = values.astype("<i8").tobytes()
        cuts = (begin * 8).tolist()
        least = np.minimum.reduceat(values, begin[:-1])
        columns = [
            rows.column("shard").combine_chunks(), rows.column("same").combine_chunks(), pa.array(least),
            pa.array([data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
        ]
        out = pa.RecordBatch.from_arrays(columns, ["shard", "same", "least", "firsts"])
        # a segment with a single place matters only where an earlier document has one of its windows
        several = rows.column("several").to_numpy(zero_copy_only=False)
        return out.filter(pa.array(several | (least < first)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in X.slices(batches, "words"):
            held.append(batch)
            if sum(b.nbytes for b in held) < BLOCK_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            shards = rows.column("shard").to_numpy()
            cut = int(np.searchsorted(shards, shards[-1]))  # the last shard may go on
            if cut:
                yield searched(rows.slice(0, cut).combine_chunks())
                held = rows.slice(cut).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield searched(pa.Table.from_batches(held).combine_chunks())

    dealt = merged.repartition("shard").sortWithinPartitions("shard")
    return mapped(
        dealt.select("shard", "same", "words", "doc", "several"), run, "shard long, same long, least long, firsts binary"
    )


def _removed_runs(places: DataFrame, window: int) -> DataFrame:
    """``doc, spans``: word ranges to remove, as pairs of 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i8")
            sizes = pc.binary_length(batch.column(2)).to_numpy() // 8
            row = np.repeat(np.arange(batch.num_rows), sizes)
            inside = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            hit = values < batch.column(0).to_numpy()[row]
            row, at = row[hit], (batch.column(1).to_numpy()[row] + inside)[hit]
            fresh = np.concatenate(([True], (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1))) if len(row) else np.zeros(0, bool)
            opens = np.flatnonzero(fresh)
            closes = np.append(opens[1:], len(row))[: len(opens)] - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row[opens])), pa.array(at[opens]), pa.array(at[closes] + window)],
                ["doc", "from", "to"],
            )

    rows = mapped(places.select("doc", "start", "firsts"), run, "doc long, from long, to long")
    return rows.groupBy("doc").agg(F.collect_list(F.struct("from", "to")).alias("spans"))


def repeated_spans(docs: DataFrame, *, window: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, spans`` of the documents that repeat an earlier one: ranges of words ``from``..``to``."""
    named = _named(docs, key, text)
    anchors = _anchor_rows(named, window)
    shared = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1")
    tagged = shared.select("anchor", (F.col("anchor") * 2 + (F.col("docs") > HOT).cast("long")).alias("tag"))
    hits = anchors.join(tagged, "anchor").groupBy("doc").agg(F.collect_list("tag").alias("anchors"))
    segments = _segments(named, hits, window)
    # equal segments are one, in their first document; only its words are shuffled
    merged = segments.groupBy("shard", "same").agg(
        F.min(F.struct("doc", "place")).alias("least"), F.count(F.lit(1)).alias("n")
    )
    listed = F.shiftleft("least.place", 1) + (F.col("n") > 1).cast("long")
    chosen = merged.groupBy(F.col("least.doc").alias("doc")).agg(F.collect_list(listed).alias("places"))
    firsts = _first_documents(_spelled(named, chosen, window), window)
    places = segments.join(firsts, ["shard", "same"]).where("least < doc")
    return _removed_runs(places.withColumn("start", F.shiftright("place", 32)), window)


def without_repeats(
    docs: DataFrame, *, window: int, key: str = "doc_id", text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """The columns ``carry`` (all where None), then ``_n_words``, ``_n_removed`` and ``_kept``.

    ``_kept`` is what is left of the text: the kept words, joined by one space. Columns of these names that the
    input has are left out.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ("_n_words", "_n_removed", "_kept")]
    spans = repeated_spans(docs, window=window, key=key, text=text)
    if carry == [key]:
        joined = _named(docs, key, text).join(spans, "doc", "left").select(F.col("doc").alias(key), "body", "spans")
        without_id = docs.where(F.col(f"`{key}`").isNull()).select(
            F.lit(None).cast("long").alias(key), F.col(f"`{text}`").alias("body"),
            F.lit(None).cast("array<struct<from:bigint,to:bigint>>").alias("spans"),
        )
        joined = joined.union(without_id)
    else:
        # names of our own, whatever the columns are called
        plain = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(carry)]
        docs_ = docs.select(*plain, F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("body"))
        joined = docs_.join(spans, "doc", "left").select(*[f"_{i}" for i in range(len(carry))], "body", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_at = len(carry)
        for batch in X.slices(batches, "body"):
            bytes_ = X.column_bytes(batch.column(text_at))
            w = X.words(bytes_)
            gone = np.zeros(len(w.hashes) + 1, np.int64)
            spans = batch.column(text_at + 1)
            pairs = spans.flatten()
            if len(pairs):
                row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(spans).fill_null(0).to_numpy())
                np.add.at(gone, pairs.field(0).to_numpy() + w.first[row], 1)
                np.add.at(gone, pairs.field(1).to_numpy() + w.first[row], -1)
            keep = np.cumsum(gone)[:-1] <= 0
            left = X.Words(w.hashes[keep], w.first, w.begin[keep], w.end[keep])
            total = np.concatenate(([0], np.cumsum(keep)))[w.first]
            joined, begin, end = _canonical(bytes_, left)
            kept = [
                joined[begin[a] : end[b - 1]].decode() if b > a else ""
                for a, b in zip(total[:-1].tolist(), total[1:].tolist(), strict=True)
            ]
            columns = [batch.column(i) for i in range(text_at)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.diff(w.first)), pa.array(np.diff(w.first) - np.diff(total)), pa.array(kept, pa.string())],
                [*carry, "_n_words", "_n_removed", "_kept"],
            )

    fields = [T.StructField(c, T.LongType() if carry == [key] else docs.schema[c].dataType) for c in carry]
    added = [T.StructField("_n_words", T.LongType()), T.StructField("_n_removed", T.LongType())]
    return mapped(joined, run, T.StructType([*fields, *added, T.StructField("_kept", T.StringType())]))
