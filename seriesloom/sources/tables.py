"""Input tables: plain Parquet tables and tables partitioned by release version."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import INPUTS, narrowed

VERSION = "idc_version"

# Tables stored with one folder per release; the others hold no version folders.
VERSIONED = frozenset(
    {"instances", "instances_by_version", "instances_curated", "version_bookkeeping"}
)


class MissingRelease(ValueError):
    """The wanted release is in the table of releases but not in the data."""


@dataclass(frozen=True)
class Tables:
    """Resolves ``name`` (and a version) under a root folder of Parquet tables.

    A versioned table is stored as ``root/name/idc_version=N/``; the version then is a
    partition filter and the other versions are not listed in the scan.
    """

    spark: SparkSession
    root: str
    versioned: frozenset[str] = field(default=VERSIONED)

    def all_versions(self, name: str) -> DataFrame:
        """A table with all its releases.

        A declared input is read with its declared fields only.  Lambda functions over
        nested records hide from the optimizer which fields they use, so the unused ones
        are kept out of the scan by the schema of the read.
        """
        path = f"{self.root.rstrip('/')}/{name}"
        rows = self.spark.read.parquet(path)
        if name not in INPUTS:
            return rows
        declared = INPUTS[name]
        release = [f for f in rows.schema.fields if f.name == VERSION]
        narrow = T.StructType(
            [f for f in narrowed(rows.schema, declared).fields if f.name != VERSION] + release
        )
        rows = self.spark.read.schema(narrow).parquet(path)
        wanted = [f for f in declared.fields if f.name != VERSION] + release
        return conform(rows, T.StructType(wanted), cast=False)

    def newest(self, name: str) -> int | None:
        """Newest release: from the small table of releases, or, where there is none,
        from the partition values of the table itself."""
        try:
            source = self.all_versions("versions")
        except AnalysisException:
            source = self.all_versions(name)
        row = source.agg(F.max(VERSION).alias("v")).first()
        return None if row is None or row.v is None else int(row.v)

    def table(self, name: str, version: int | str | None = None) -> DataFrame:
        """``version``: a number, ``"current"`` for the newest, None for all of them.

        Tables without version folders are returned as they are.  A release without data is
        an error, so that nothing good is overwritten with an empty table.
        """
        rows = self.all_versions(name)
        if version is None or name not in self.versioned:
            return rows
        wanted = self.newest(name) if version == "current" else int(version)
        if wanted is None or rows.where(F.col(VERSION) == F.lit(wanted)).isEmpty():
            raise MissingRelease(f"table {name!r} holds nothing of release {wanted}")
        return rows.where(F.col(VERSION) == F.lit(wanted)).drop(VERSION)


def write_versioned(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store a table with one folder per version."""
    df.write.mode(mode).option("compression", "zstd").partitionBy(VERSION).parquet(path)


def conform(df: DataFrame, schema: T.StructType, cast: bool = True) -> DataFrame:
    """Bring an input to a declared schema: missing columns become NULL, repeated
    columns are never NULL, and everything else is cast (or, with ``cast=False``, kept).
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        kind = f.dataType if cast or f.name not in present else present[f.name]
        c = F.col(f"`{f.name}`") if f.name in present else F.lit(None)
        if present.get(f.name) != kind:
            c = c.cast(kind)
        if isinstance(kind, T.ArrayType):
            c = F.coalesce(c, F.array().cast(kind))
        columns.append(c.alias(f.name))
    return df.select(*columns)
