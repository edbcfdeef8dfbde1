"""History of series revisions that are no longer part of the latest release."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import extract_or_null, literal_map, safe_double
from ..lookups import EXCLUDED_BUCKETS, MIRROR_BUCKETS
from ..sources.tables import VERSION

REVISION = "crdc_series_uuid"
_KEYS = (
    "collection_id",
    "PatientID",
    "SeriesInstanceUID",
    "StudyInstanceUID",
    "Modality",
    "gcs_bucket",
    REVISION,
)


def release_revisions(instances_by_version: DataFrame) -> DataFrame:
    """Series revisions of each release with their size: what the history needs of a release.

    Releases never change once they are out, so these rows can be stored by release and put
    together in any order (``update_history``).
    """
    size = safe_double(instances_by_version, "instance_size")
    return (
        instances_by_version.where(F.col(REVISION).isNotNull())
        .withColumn("gcs_bucket", extract_or_null("gcs_url", "gs://([^/]+)/"))
        .groupBy(VERSION, *_KEYS)
        .agg(F.round(F.sum(size) / 1e6, 2).alias("series_size_MB"))
    )


def history(
    revisions: DataFrame,
    latest: int,
    excluded_buckets: Sequence[str] = EXCLUDED_BUCKETS,
    bucket_map: Mapping[str, str] = MIRROR_BUCKETS,
) -> DataFrame:
    """The history as of a release, from the rows of ``release_revisions``."""
    alive = revisions.where(F.col(VERSION) == latest).select(REVISION).distinct()
    mirror = F.try_element_at(literal_map(bucket_map), F.col("gcs_bucket"))
    return (
        revisions.where(F.col(VERSION).between(1, latest))
        .where(~F.col("gcs_bucket").isin(*excluded_buckets))
        .join(alive, REVISION, "left_anti")
        .groupBy(*_KEYS, "series_size_MB")
        .agg(
            F.min(VERSION).cast("bigint").alias("min_idc_version"),
            F.max(VERSION).cast("bigint").alias("max_idc_version"),
        )
        .withColumn("aws_bucket", mirror)
        .select(
            *_KEYS,
            "series_size_MB",
            F.concat(
                F.lit("s3://"), "aws_bucket", F.lit("/"), REVISION, F.lit("/*")
            ).alias("series_aws_url"),
            "aws_bucket",
            "min_idc_version",
            "max_idc_version",
        )
    )


def prior_versions_index(
    instances_by_version: DataFrame,
    latest: int,
    excluded_buckets: Sequence[str] = EXCLUDED_BUCKETS,
    bucket_map: Mapping[str, str] = MIRROR_BUCKETS,
) -> DataFrame:
    """Series revisions of releases 1..latest that the latest release no longer has.

    One scan of the version-partitioned table replaces a union of one branch per
    version.  Instances are folded to revisions before the anti join, which therefore
    sees two small tables instead of the instance table.
    """
    revisions = release_revisions(instances_by_version.where(F.col(VERSION).between(1, latest)))
    return history(revisions, latest, excluded_buckets, bucket_map)


def missing_releases(instances_by_version: DataFrame, stored: DataFrame | None, latest: int) -> DataFrame:
    """The instances of releases up to ``latest`` that the stored revisions lack.

    The filter is on the release alone, so a table with a folder per release is read in the
    missing folders only.
    """
    done = [] if stored is None else [r[0] for r in stored.select(VERSION).distinct().collect()]
    rows = instances_by_version.where(F.col(VERSION).between(1, latest))
    return rows.where(~F.col(VERSION).isin(*done)) if done else rows


def update_history(
    spark: SparkSession, instances_by_version: DataFrame, store: str, latest: int, **options
) -> DataFrame:
    """The history as of ``latest``, with the revisions of each release kept under ``store``.

    Only releases that are not stored yet are read from the instances; the rest comes from rows at the
    grain of revisions.  Writing replaces whole releases, so a run that was cut off can be repeated.
    To take in a corrected release, remove its folder first.
    """
    try:
        stored = spark.read.schema(release_revisions(instances_by_version).schema).parquet(store)
    except AnalysisException:
        stored = None
    fresh = release_revisions(missing_releases(instances_by_version, stored, latest))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "zstd"
    ).partitionBy(VERSION).parquet(store)
    return history(spark.read.schema(fresh.schema).parquet(store), latest, **options)
