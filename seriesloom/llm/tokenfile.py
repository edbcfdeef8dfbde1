"""Token ids in files, each document compressed alone with a dictionary that all share.

A folder holds one file per range of document ids, in ascending order, and the dictionary. A file is

    frames      one zstandard frame per document: ids in the narrowest of 2 or 4 bytes, little-endian
    index       per document: id, whether it is null, offset and size of the frame, ids
    footer      offset of the index, documents, ids, bytes per id, SHA-256 of the dictionary, MAGIC

so one document is read with three short reads. The dictionary is trained on the serialized ids of
SAMPLE documents of at most SAMPLE_BYTES of text, those with the smallest hashes of their ids (with too few, frames
stand alone); everything else covers all documents.

Files are written under a name of their own and then moved, so a repeated task replaces what an
earlier attempt left. Only rows about files, one each, are seen as a whole anywhere.

Defined results: null and empty texts are the end token alone; a null id sorts first; rows that repeat an id
are written each; a text of any length is one frame, encoded whole, in memory; an empty table gives an empty
folder that reads as no rows. Other columns are not used.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import text as X
from .shared import mapped, stored
from .tokens import encoder

MAGIC = b"TOKENS01"
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 64 << 10, 64 << 10
_INDEX = np.dtype([("doc", "<i8"), ("null", "u1"), ("offset", "<u8"), ("size", "<u8"), ("tokens", "<u8")])
_FOOTER = np.dtype([("at", "<u8"), ("docs", "<u8"), ("tokens", "<u8"), ("width", "<u4"), ("sha256", "V32"), ("magic", "V8")])
END = np.zeros(1, "<u4").tobytes()


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder; ``s3a`` addresses are those of ``s3``."""
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def trained(samples: list[bytes]) -> bytes:
    """A dictionary for such samples; empty where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""


def _narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _wide(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


class Writer:
    """Writes one file; documents come in order, as unsigned 32-bit ids."""

    def __init__(self, stream: io.IOBase, dictionary: bytes, width: int):
        self.stream, self.width, self.at, self.entries = stream, width, 0, []
        self.sha256 = hashlib.sha256(dictionary).digest()
        self.press = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(dictionary))

    def add(self, doc: int | None, ids: bytes) -> None:
        frame = self.press.compress(_narrow(ids, self.width))
        self.stream.write(frame)
        self.entries.append((doc or 0, doc is None, self.at, len(frame), len(ids) // 4))
        self.at += len(frame)

    def close(self) -> tuple[int, int]:
        index = np.array(self.entries, _INDEX)
        tokens = int(index["tokens"].sum())
        self.stream.write(index.tobytes())
        footer = np.array([(self.at, len(index), tokens, self.width, self.sha256, MAGIC)], _FOOTER)
        self.stream.write(footer.tobytes())
        return len(index), tokens


class Reader:
    """Reads one file: its index at once, frames on demand."""

    def __init__(self, source: pa.NativeFile, dictionary: bytes):
        self.source = source
        source.seek(source.size() - _FOOTER.itemsize)
        self.footer = np.frombuffer(source.read(_FOOTER.itemsize), _FOOTER)[0]
        if bytes(self.footer["magic"]) != MAGIC:
            raise ValueError("not a token file")
        if bytes(self.footer["sha256"]) != hashlib.sha256(dictionary).digest():
            raise ValueError("the file was written with another dictionary")
        source.seek(int(self.footer["at"]))
        self.index = np.frombuffer(source.read(int(self.footer["docs"]) * _INDEX.itemsize), _INDEX)
        self.expand = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def ids(self, position: int) -> bytes:
        """Ids of one document, as unsigned 32-bit."""
        entry = self.index[position]
        self.source.seek(int(entry["offset"]))
        return _wide(self.expand.decompress(self.source.read(int(entry["size"]))), int(self.footer["width"]))

    def all(self) -> Iterator[tuple[int | None, bytes]]:
        """All documents, reading on from the start."""
        self.source.seek(0)
        for entry in self.index:
            ids = self.expand.decompress(self.source.read(int(entry["size"])))
            yield None if entry["null"] else int(entry["doc"]), _wide(ids, int(self.footer["width"]))


def _saved(folder: str, name: str, data: bytes) -> None:
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{name}") as out:
        out.write(data)


def _loaded(folder: str, name: str) -> bytes:
    system, path = opened(folder)
    with system.open_input_file(f"{path}/{name}") as source:
        return source.read()


def write(docs: DataFrame, folder: str, *, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents; ``part, file, docs, tokens`` of the files."""
    width = 2 if encoder(vocabulary).tokenizer.get_vocab_size() <= 1 << 16 else 4
    named = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in X.slices(batches):
            ids = [_narrow(found + END, width) for found in encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    short = named.where(F.octet_length("text") <= SAMPLE_BYTES)
    sample = short.orderBy(F.xxhash64("doc"), "doc", "text").limit(SAMPLE)
    dictionary = trained([row.ids for row in mapped(sample, serialized, "ids binary", vocabulary=True).collect()])
    _saved(folder, "dictionary", dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        part = TaskContext.get().partitionId()
        system, path = opened(folder)
        name, writer = f"part-{part:06d}.tokens", None
        attempt = f"{path}/{name}.{uuid.uuid4().hex}"
        for batch in X.slices(batches):
            if writer is None:
                stream = system.open_output_stream(attempt)
                writer = Writer(stream, dictionary, width)
            found = encode(batch.column(1).to_pylist())
            for doc, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                writer.add(doc, ids + END)
        if writer is not None:
            count, tokens = writer.close()
            stream.close()
            system.move(attempt, f"{path}/{name}")
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "docs": [count], "tokens": [tokens]})

    ranges = named.repartitionByRange("doc", F.xxhash64("text")).sortWithinPartitions("doc", "text")
    files = mapped(ranges, run, "part long, file string, docs long, tokens long", vocabulary=True)
    return stored(files)


READ = "doc long, start long, tokens long, ids binary"


def read(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """READ of all documents of the files, ``start`` counting the ids of all documents before."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per file, so one task may number them
    based = files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    dictionary = _loaded(folder, "dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(folder)
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with system.open_input_file(f"{path}/{file}") as source:
                    reader = Reader(source, dictionary)
                    rows, held, start = [], 0, base
                    for doc, ids in reader.all():
                        rows.append((doc, start, len(ids) // 4, ids))
                        start += len(ids) // 4
                        held += len(ids)
                        if held >= X.SLICE_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    dealt = based.select("file", "base").repartition(max(1, files.count()))
    return mapped(dealt, run, READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["doc", "start", "tokens", "ids"])
