"""Tables that cut lineage, kept in the folder that driver and executors share, and the package's
own code for the executors.
"""

from __future__ import annotations

import contextlib
import ctypes
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_own: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def mapped(
    frame: DataFrame, function: Callable, schema: T.StructType | str, vocabulary: bool = False
) -> DataFrame:
    """``frame.mapInArrow`` with this package at hand on the executors.

    Workers outlive tasks and go from one stage to the next. What they keep for encoding texts stays only while
    they run functions that use a ``vocabulary``, and memory that a task has freed goes back to the system.
    """
    ship(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not vocabulary:
            forget()
        yield from function(batches)
        release()

    return frame.mapInArrow(run, schema)


def numbered(frame: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """The rows with columns ``c0``, ``c1``, ..., the new name of each column, and what gives the old ones back.

    Stages work on these, so that names of the input cannot clash with names of their own.
    """
    names = {c: f"c{i}" for i, c in enumerate(frame.columns)}
    return frame.toDF(*names.values()), names, [F.col(n).alias(c) for c, n in names.items()]


def forget() -> None:
    """Drop the encoders that this worker keeps."""
    for name in ("tokens", "alignment", "chat"):
        module = sys.modules.get(f"{__package__}.{name}")
        for kept in getattr(module, "KEPT", ()):
            kept.cache_clear()


def release() -> None:
    """Give freed memory back to the system, where the platform can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder, since driver and tasks
    are one process there; a cluster without the setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own.setdefault(context.applicationId, tempfile.mkdtemp(prefix="shared-"))
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


@contextlib.contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Queries that run in here send their workers Arrow batches of at most ``size`` bytes, or of one longer row."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(frame: DataFrame, **options: int) -> DataFrame:
    """The same rows, written once as Parquet to the shared folder and read back; ``options`` are those of the writer."""
    spark = frame.sparkSession
    path = shared_folder(spark)
    frame.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
