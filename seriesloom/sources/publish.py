"""Sinks: clustered Parquet, compressed CSV, column dictionary, checksums, size report."""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from itertools import groupby
from operator import itemgetter
from typing import TYPE_CHECKING
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.compare import orderable

if TYPE_CHECKING:
    import pyarrow as pa

VERSION_KEY = "release_version"
DESCRIPTION_KEY = "comment"

#: Rows of one published file, which bounds what ``checksums`` hashes in one task.
ROWS_PER_FILE = 1_000_000

# Types that readers of the published files cannot be relied on to support.
_FORBIDDEN = tuple(
    getattr(T, name)
    for name in (
        "DateType", "TimeType", "TimestampNTZType", "VariantType", "GeographyType", "GeometryType",
    )
    if hasattr(T, name)
)

# Published names of the Spark types.
_TYPE_NAMES = {
    T.StringType: "STRING",
    T.ByteType: "INTEGER",
    T.ShortType: "INTEGER",
    T.IntegerType: "INTEGER",
    T.LongType: "INTEGER",
    T.FloatType: "FLOAT",
    T.DoubleType: "FLOAT",
    T.BooleanType: "BOOLEAN",
    T.TimestampType: "TIMESTAMP",
    T.BinaryType: "BYTES",
    T.StructType: "RECORD",
}


class UnpublishableType(ValueError):
    """A column has a type that must be cast before publishing."""


def _refused(name: str, kind: T.DataType) -> Iterator[tuple[str, str]]:
    """Places of refused types within a column: its elements, fields, keys and values too."""
    if isinstance(kind, T.ArrayType):
        yield from _refused(f"{name}[]", kind.elementType)
    elif isinstance(kind, T.MapType):
        yield from _refused(f"{name}.key", kind.keyType)
        yield from _refused(f"{name}.value", kind.valueType)
    elif isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _refused(f"{name}.{f.name}", f.dataType)
    elif isinstance(kind, _FORBIDDEN):
        yield name, kind.simpleString()


def refused_columns(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """The places of a schema that publishing refuses, with their types."""
    found = [place for f in schema.fields for place in _refused(f.name, f.dataType)]
    return spark.createDataFrame(found, "place string, type string")


def check_publishable(schema: T.StructType) -> None:
    found = [place for f in schema.fields for place in _refused(f.name, f.dataType)]
    if found:
        listed = ", ".join(f"{name!r} is {kind}" for name, kind in found)
        raise UnpublishableType(f"column {listed}; cast to string or timestamp")


def described(
    df: DataFrame, descriptions: Mapping[str, str] | None = None, version: str | None = None
) -> DataFrame:
    """Attach column descriptions and the release version as field metadata.

    Field metadata is stored with the Parquet schema and comes back on reading.
    """
    descriptions = descriptions or {}
    columns = []
    for f in df.schema.fields:
        meta = dict(f.metadata)
        if descriptions.get(f.name):
            meta[DESCRIPTION_KEY] = descriptions[f.name]
        if version is not None:
            meta[VERSION_KEY] = version
        columns.append(F.col(f"`{f.name}`").alias(f.name, metadata=meta))
    return df.select(*columns)


def release_version(df: DataFrame) -> str | None:
    """Release version stamped on a published table."""
    stamps = {f.metadata.get(VERSION_KEY) for f in df.schema.fields} - {None}
    return stamps.pop() if len(stamps) == 1 else None


def clustered(
    df: DataFrame, order: Sequence[Column | str], files: int | None = None, grain: Sequence[str] = ()
) -> DataFrame:
    """Global output order by range partitioning, so each file covers one key range.

    Low-cardinality columns first make long runs, which compress well.  Rows that tie are ordered, and
    cut across files, by ``grain``, the columns that tell rows apart, or else by a hash of the row: one
    frequent value does not end up in one task and one file.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in order]
    if not keys:
        return df if files is None else df.repartition(files)
    named = {k for k in order if isinstance(k, str)}
    if grain:
        keys += [F.col(f"`{c}`") for c in grain if c not in named]
    else:
        keys.append(F.xxhash64(*[orderable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]))
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    order: Sequence[Column | str] = (),
    descriptions: Mapping[str, str] | None = None,
    version: str | None = None,
    files: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    mode: str = "overwrite",
    grain: Sequence[str] = (),
) -> None:
    """Zstandard Parquet, written by the executors in cluster order."""
    check_publishable(df.schema)
    out = described(clustered(df, order, files, grain), descriptions, version)
    writer = out.write.mode(mode).option("compression", "zstd")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Gzip CSV with a header and backslash escapes; nested columns become JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    flat = df.select(
        *[
            F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, nested)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    flat.write.mode(mode).option("header", True).option("escape", "\\").option(
        "compression", "gzip"
    ).csv(path)


def column_dictionary(
    df: DataFrame,
    table: str,
    table_description: str = "",
    descriptions: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per column: name, type, mode and description."""
    descriptions = descriptions or {}

    def entry(position: int, f: T.StructField) -> tuple:
        repeated = isinstance(f.dataType, T.ArrayType)
        kind = f.dataType.elementType if repeated else f.dataType
        mode = "REPEATED" if repeated else "NULLABLE" if f.nullable else "REQUIRED"
        text = descriptions.get(f.name) or f.metadata.get(DESCRIPTION_KEY, "")
        return (
            table,
            table_description,
            position,
            f.name,
            _TYPE_NAMES.get(type(kind), kind.simpleString().upper()),
            mode,
            text,
        )

    return df.sparkSession.createDataFrame(
        [entry(i, f) for i, f in enumerate(df.schema.fields)],
        "table string, table_description string, position int, name string, type string,"
        " mode string, description string",
    )


#: Ends a piece of a file that ``checksums`` streams.  The header of every Parquet page holds this byte, so a piece
#: is never longer than a page; other bytes are this one about every 256 bytes.
PIECE_END = "\x15"

#: Declares Parquet files compressed by a codec that changes nothing, so that the text reader does not split
#: them.  Hadoop's shaded client has the codec's key under another name.
_WHOLE_FILES = {
    "io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec",
    "io.compress.passthrough.extension": ".parquet",
    "org.apache.hadoop.shaded.io.compress.passthrough.extension": ".parquet",
}


def _file_digests(separator: bytes) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Name and SHA-256 of each file, from batches of its path as a URI, its size and its pieces in order.

    The reader takes a byte order mark off the start and a separator off the end, which the size tells.  Workers
    need not have this package: what is nested here is sent to them.
    """

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Buffer]]:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            paths, sizes, pieces = batch.columns
            ends = [0, *pc.run_end_encode(paths).run_ends.to_pylist()]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces)
            joined = pc.binary_join(lists, pa.scalar(separator, pieces.type))
            for at, data in zip(ends, joined):
                yield paths[at].as_py(), sizes[at].as_py(), data.as_buffer()

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for (path, size), found in groupby(parts(batches), itemgetter(0, 1)):
            hashes, read = {}, 0
            for _, _, data in found:
                if not hashes:
                    # by the bytes that the start may have lost; Parquet files start with PAR1 or PARE
                    marks = (b"",) if data[:3] == b"PAR" else (b"", codecs.BOM_UTF8)
                    hashes = {len(m): hashlib.sha256(m) for m in marks}
                else:
                    read += len(separator)
                    for h in hashes.values():
                        h.update(separator)
                read += data.size
                for h in hashes.values():
                    h.update(data)
            lost = next((n for n in hashes if size - read - n in (0, len(separator))), None)
            if lost is None:
                raise ValueError(f"{path} was read in part: {read} of {size} bytes")
            if read + lost < size:
                hashes[lost].update(separator)
            file = unquote(path.rsplit("/", 1)[-1])
            yield pa.RecordBatch.from_pydict({"file": [file], "sha256": [hashes[lost].hexdigest()]})

    return digests


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every Parquet file under a folder.

    A file of any size is streamed through one task, which holds a batch of it at a time, since SHA-256 takes
    bytes in order; ``tree_checksums`` lets several tasks share a file.  Files without any bytes have no row, nor
    has one of a byte order mark alone, which no Parquet file is.
    """
    pieces = (
        spark.read.format("text")
        .options(**_WHOLE_FILES)
        .option("lineSep", PIECE_END)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("_metadata.file_path", "_metadata.file_size", F.col("value").cast("binary"))
    )
    return pieces.mapInArrow(_file_digests(PIECE_END.encode()), "file string, sha256 string")


#: Ends a piece of a file.  In compressed data it comes about every 16 MB.
SEPARATOR = "\r\n\t"


def tree_checksums(spark: SparkSession, path: str, separator: str = SEPARATOR) -> DataFrame:
    """Digest tree of every Parquet file under a folder: ``file``, ``bytes``, ``pieces``, ``digest``.

    A file is cut after each separator, wherever Spark splits it, so several tasks share a large file and each
    holds one piece at a time.  The digest is the SHA-256 of the pieces' SHA-256 digests as text,
    in order; pieces are hashed without the separator, and an empty last piece does not count.  A separator
    must not be able to overlap itself, or it could be read in two ways where a file is split.
    """
    pieces = (
        spark.read.format("text")
        .option("lineSep", separator)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"),
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_size").alias("bytes"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("piece"),
                F.sha2(F.col("value").cast("binary"), 256).alias("digest"),
            ).alias("_piece"),
        )
    )
    # a digest for each 16 MB
    return (
        pieces.groupBy("_path", "file", "bytes")
        .agg(F.sort_array(F.collect_list("_piece")).alias("_pieces"))
        .select(
            "file",
            "bytes",
            F.size("_pieces").alias("pieces"),
            F.sha2(F.array_join("_pieces.digest", "").cast("binary"), 256).alias("digest"),
        )
    )


def content_digest(df: DataFrame) -> DataFrame:
    """Rows of a table and a digest of their contents that does not depend on order or files.

    Each row is hashed as the SHA-256 of its columns as text, in order, each with its length in bytes and a
    colon before it, or a minus for NULL.  The first 60 bits of all rows are added up, and so are the
    next 60, both modulo 2**60: repeated rows count as often as they occur.
    """
    cells = [F.col(f"`{c}`").cast("string") for c in df.columns]
    marked = [
        F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells
    ]
    hashed = df.select(F.sha2(F.concat(*marked).cast("binary"), 256).alias("h"))
    parts = [F.conv(F.substring("h", at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 16)]
    sums = [F.coalesce(F.sum(p), F.lit(0)).cast("decimal(38,0)") for p in parts]
    wrapped = [(s % F.lit(1 << 60).cast("decimal(20,0)")).cast("bigint") for s in sums]
    return hashed.agg(
        F.count(F.lit(1)).alias("rows"), wrapped[0].alias("digest"), wrapped[1].alias("second_digest")
    )


def file_report(df: DataFrame) -> DataFrame:
    """Rows and bytes per data file of a file-based table, without reading columns."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("rows"))


def size_report(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows, files and bytes per table, and a ``total`` row."""
    parts = None
    for name, path in paths.items():
        part = file_report(spark.read.parquet(path)).select(
            F.lit(name).alias("table"), "rows", "bytes"
        )
        parts = part if parts is None else parts.unionByName(part)
    sums = [
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("bytes"),
    ]
    per_table = parts.groupBy("table").agg(*sums)
    total = per_table.agg(
        F.lit("total").alias("table"), *[F.sum(c).alias(c) for c in ("rows", "files", "bytes")]
    )
    return per_table.unionByName(total)
