"""Series index, version span and the plain projections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import (
    any_of,
    distinct_joined,
    distinct_sorted,
    dotted_part,
    joined_or_null,
    safe_double,
)
from ..lookups import SOP_CLASS_NAMES, TRANSFER_SYNTAX_NAMES
from ..operators.names import strict_names

SERIES = "SeriesInstanceUID"
INSTANCE = "SOPInstanceUID"

_PLAIN_ATTRIBUTES = (
    "collection_id",
    "analysis_result_id",
    "PatientID",
    "StudyInstanceUID",
    "source_DOI",
    "PatientAge",
    "PatientSex",
    "StudyDescription",
    "Modality",
    "SOPClassUID",
    "Manufacturer",
    "ManufacturerModelName",
    "SeriesDescription",
    "SeriesNumber",
    "license_short_name",
    "aws_bucket",
    "crdc_series_uuid",
)

SERIES_INDEX_COLUMNS = (
    "collection_id",
    "analysis_result_id",
    "PatientID",
    "SeriesInstanceUID",
    "StudyInstanceUID",
    "source_DOI",
    "PatientAge",
    "PatientSex",
    "StudyDate",
    "StudyDescription",
    "BodyPartExamined",
    "Modality",
    "SOPClassUID",
    "sop_class_name",
    "TransferSyntaxUID",
    "transfer_syntax_name",
    "PhotometricInterpretation",
    "PixelRepresentation",
    "Manufacturer",
    "ManufacturerModelName",
    "SeriesDate",
    "SeriesDescription",
    "SeriesNumber",
    "instanceCount",
    "license_short_name",
    "series_init_idc_version",
    "series_revised_idc_version",
    "aws_bucket",
    "crdc_series_uuid",
    "series_aws_url",
    "series_size_MB",
)


def version_span(bookkeeping: DataFrame) -> DataFrame:
    """First and last release version of every series."""
    return bookkeeping.groupBy(SERIES).agg(
        F.min("series_init_idc_version").alias("series_init_idc_version"),
        F.max("series_revised_idc_version").alias("series_revised_idc_version"),
    )


def _series_attributes(
    instances: DataFrame, class_names: Mapping[str, str], syntax_names: Mapping[str, str]
) -> DataFrame:
    # reduced to distinct looks first: texts are grouping keys there, which hash
    looks = instances.select(
        SERIES,
        *_PLAIN_ATTRIBUTES,
        F.col("StudyDate").cast("string").alias("StudyDate"),
        F.col("SeriesDate").cast("string").alias("SeriesDate"),
        F.concat("series_aws_url", F.lit("*")).alias("series_aws_url"),
        "PhotometricInterpretation",
        F.col("PixelRepresentation").cast("string").alias("PixelRepresentation"),
        "TransferSyntaxUID",
    )
    looks = looks.groupBy(*looks.columns).agg(F.count(F.lit(1)).alias("_n"))

    def rows_with(column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.col("_n"))), F.lit(0))

    grouped = looks.groupBy(SERIES).agg(
        *[any_of(c).alias(c) for c in (*_PLAIN_ATTRIBUTES, "StudyDate", "SeriesDate", "series_aws_url")],
        *[distinct_joined(c).alias(c) for c in ("PhotometricInterpretation", "PixelRepresentation")],
        distinct_sorted("SOPClassUID").alias("_classes"),
        distinct_sorted("TransferSyntaxUID").alias("_syntaxes"),
        F.sum("_n").alias("_rows"),
        rows_with("SOPClassUID").alias("_class_rows"),
        rows_with("TransferSyntaxUID").alias("_syntax_rows"),
    )
    classes = strict_names(
        F.col("_classes"), F.col("_rows"), F.col("_class_rows"), class_names, "SOPClassUID"
    )
    syntaxes = strict_names(
        F.col("_syntaxes"),
        F.col("_rows"),
        F.col("_syntax_rows"),
        syntax_names,
        "TransferSyntaxUID",
    )
    return (
        grouped
        # the classes are sorted like the UID kept above, so the first name belongs to it
        .withColumn("sop_class_name", F.get(classes, F.lit(0)))
        .withColumn("TransferSyntaxUID", joined_or_null(F.col("_syntaxes")))
        .withColumn(
            "transfer_syntax_name",
            joined_or_null(F.sort_array(F.array_distinct(syntaxes))),
        )
        .drop("_classes", "_syntaxes", "_rows", "_class_rows", "_syntax_rows")
    )


def _series_sizes(instances: DataFrame, curated: DataFrame) -> DataFrame:
    """Count, size and body part: the part of the index that needs the curated table.

    Only three narrow columns cross the join.  Repeated curated rows are folded to one
    row per instance and body part with a multiplicity, so they count as often as a plain
    join would count them, and so are the joined rows per series and body part.
    """
    per_instance = curated.groupBy(INSTANCE, "BodyPartExamined").agg(
        F.count(F.lit(1)).alias("_matches")
    )
    rows = instances.select(
        SERIES, INSTANCE, safe_double(instances, "instance_size").alias("_bytes")
    )
    times = F.coalesce(F.col("_matches"), F.lit(1))
    parts = (
        rows.join(per_instance, INSTANCE, "left")
        .groupBy(SERIES, "BodyPartExamined")
        .agg(
            F.sum(F.when(F.col(INSTANCE).isNotNull(), times)).alias("_count"),
            F.sum(F.col("_bytes") * times).alias("_bytes"),
        )
    )
    return parts.groupBy(SERIES).agg(
        any_of("BodyPartExamined").alias("BodyPartExamined"),
        F.coalesce(F.sum("_count"), F.lit(0)).alias("instanceCount"),
        (F.sum("_bytes") / 1e6).alias("series_size_MB"),
    )


def series_index(
    instances: DataFrame,
    curated: DataFrame,
    bookkeeping: DataFrame,
    class_names: Mapping[str, str] = SOP_CLASS_NAMES,
    syntax_names: Mapping[str, str] = TRANSFER_SYNTAX_NAMES,
) -> DataFrame:
    """One row per series.

    The wide attributes are reduced to looks straight from the scan (map-side combine) and
    never join at instance grain; the three parts end up hash-partitioned on the series
    key, so putting them together needs no further exchange.
    """
    return (
        _series_attributes(instances, class_names, syntax_names)
        .join(_series_sizes(instances, curated), SERIES, "left")
        .join(version_span(bookkeeping), SERIES, "left")
        .select(*SERIES_INDEX_COLUMNS)
    )


def collections_index(collections: DataFrame) -> DataFrame:
    return collections.select(
        "collection_name",
        "collection_id",
        "cancer_types",
        "tumor_locations",
        "subjects",
        "species",
        "sources",
        "supporting_data",
        "program_id",
        "status",
        F.col("updated").cast("string").alias("updated"),
        "description",
    )


def analysis_results_index(results: DataFrame) -> DataFrame:
    return results.select(
        "analysis_result_id",
        "analysis_result_title",
        F.col("source_doi").alias("source_DOI"),
        "source_url",
        "subjects",
        "collections",
        "modalities",
        F.col("Updated").cast("string").alias("updated"),
        "license_url",
        "license_long_name",
        "license_short_name",
        "description",
        "citation",
    )


def clinical_index(columns: DataFrame) -> DataFrame:
    return columns.select(
        "collection_id",
        "table_name",
        dotted_part("table_name", 2).alias("short_table_name"),
        "column",
        "column_label",
        "values",
    )


def version_metadata_index(versions: DataFrame) -> DataFrame:
    return versions.select("idc_version", "version_timestamp")


def latest_version(versions: DataFrame) -> DataFrame:
    """The newest release version as a one-row DataFrame."""
    return versions.agg(F.max("idc_version").alias("latest_idc_version"))
