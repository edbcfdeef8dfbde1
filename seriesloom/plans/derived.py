"""Objects derived from images: segmentations, structure sets and annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import (
    any_of,
    code_pair,
    distinct_joined,
    distinct_sorted,
    distinct_looks,
    first,
    items,
    joined_or_null,
)
from ..lookups import ANN_CLASS, RTSTRUCT_CLASS, SEG_CLASS
from ..operators.fingerprints import MANY_BITS, bit_set, in_set
from .core import INSTANCE, SERIES


def _referenced_instance() -> Column:
    """First referenced instance; three places can hold it, in this order."""
    listed = first(first("ReferencedSeriesSequence")["ReferencedInstanceSequence"])
    return F.coalesce(
        listed["ReferencedSOPInstanceUID"],
        first("ReferencedImageSequence")["ReferencedSOPInstanceUID"],
        first("SourceImageSequence")["ReferencedSOPInstanceUID"],
    )


def segmented_series(instances: DataFrame) -> DataFrame:
    """Segmentation series -> series of the image it was drawn on.

    The references of a series are made distinct before the join.  A bit set of the instances they
    name filters the instance table at its scan, so hardly more rows of it are moved than there are references.
    """
    references = (
        instances.where((F.col("SOPClassUID") == SEG_CLASS) & (F.col("Modality") == "SEG"))
        .where(F.size("SegmentSequence") > 0)
        .select(F.col(SERIES).alias("_seg_series"), _referenced_instance().alias(INSTANCE))
        .where(F.col(INSTANCE).isNotNull())
        .distinct()
    )
    named = bit_set(references.select(F.xxhash64(INSTANCE).alias("h")), MANY_BITS)
    images = instances.where(in_set(named, F.xxhash64(INSTANCE), MANY_BITS)).select(
        INSTANCE, F.col(SERIES).alias("_image_series")
    )
    pairs = references.join(images, INSTANCE)
    # hashed to distinct pairs before texts are compared
    return (
        distinct_looks(pairs, ["_seg_series", "_image_series"])
        .groupBy(F.col("_seg_series").alias(SERIES))
        .agg(any_of("_image_series").alias("segmented_SeriesInstanceUID"))
    )


#: What the index lists of a segment; numbers are counted and of the type the smallest is kept.
_SEGMENT_TYPE, _SEGMENT_NUMBER = "SegmentationType", "total_segments"
_SEGMENT_LISTS = (
    "SegmentedPropertyCategory_CodeMeanings",
    "SegmentedPropertyType_CodeMeanings",
    "AnatomicRegion_CodeMeanings",
)
_SEGMENT_TEXTS = ("AlgorithmType", "AlgorithmName")


def seg_index(segmentations: DataFrame, instances: DataFrame | None = None) -> DataFrame:
    """One row per segmentation series.

    ``segmentations`` holds the segments and ``instances`` the table the references
    are resolved in; they may be the same table.
    """
    instances = segmentations if instances is None else instances
    # long form (series, attribute, value), made distinct by hashing, so that lists are built
    # from distinct values and not from segments
    segment = F.col("s")
    values = {
        _SEGMENT_TYPE: F.col("SegmentationType"),
        _SEGMENT_NUMBER: segment["SegmentNumber"].cast("string"),
        "AlgorithmType": segment["SegmentAlgorithmType"],
        "AlgorithmName": first(segment["SegmentAlgorithmName"]),
        "SegmentedPropertyCategory_CodeMeanings": first(segment["SegmentedPropertyCategoryCodeSequence"])["CodeMeaning"],
        "SegmentedPropertyType_CodeMeanings": first(segment["SegmentedPropertyTypeCodeSequence"])["CodeMeaning"],
        "AnatomicRegion_CodeMeanings": first(segment["AnatomicRegionSequence"])["CodeMeaning"],
    }
    places = {name: i for i, name in enumerate(values)}
    entries = [F.struct(F.lit(places[n]).alias("attribute"), v.alias("value")) for n, v in values.items()]
    segments = (
        segmentations.where(F.col("SOPClassUID") == SEG_CLASS)
        .select(SERIES, "SegmentationType", F.explode("SegmentSequence").alias("s"))
        .select(SERIES, F.inline(F.array(*entries)))
    )

    def found(name: str) -> Column:
        return F.collect_list(F.when(F.col("attribute") == places[name], F.col("value")))

    numbers = (F.col("attribute") == places[_SEGMENT_NUMBER]) & F.col("value").isNotNull()
    return (
        distinct_looks(segments, [SERIES, "attribute", "value"])
        .groupBy(SERIES)
        .agg(
            F.array_min(found(_SEGMENT_TYPE)).alias(_SEGMENT_TYPE),
            F.count_if(numbers).alias(_SEGMENT_NUMBER),
            *[joined_or_null(F.sort_array(found(n))).alias(n) for n in _SEGMENT_TEXTS],
            *[F.sort_array(found(n)).alias(n) for n in _SEGMENT_LISTS],
        )
        .join(segmented_series(instances), SERIES, "left")
        .select(
            SERIES,
            "SegmentationType",
            "total_segments",
            "AlgorithmType",
            "AlgorithmName",
            "segmented_SeriesInstanceUID",
            "SegmentedPropertyCategory_CodeMeanings",
            "SegmentedPropertyType_CodeMeanings",
            "AnatomicRegion_CodeMeanings",
        )
    )


def rtstruct_index(instances: DataFrame) -> DataFrame:
    """One row per structure-set series.

    Regions, observations and references of one object share a row.  The numbers of its
    regions are one set, and one filter over the observations keeps those of a known
    region, so a row yields as many entries as it has regions and observations.
    """
    frames = items("ReferencedFrameOfReferenceSequence")
    studies = F.flatten(F.transform(frames, lambda f: items(f["RTReferencedStudySequence"])))
    series = F.flatten(F.transform(studies, lambda s: items(s["RTReferencedSeriesSequence"])))

    def tagged(kind: str, values: Column) -> Column:
        return F.transform(
            values, lambda v: F.struct(F.lit(kind).alias("kind"), v.cast("string").alias("value"))
        )

    regions = "StructureSetROISequence"
    seen = F.filter(
        "observations", lambda o: F.array_contains(F.col("numbers"), o["ReferencedROINumber"])
    )
    entries = (
        instances.where((F.col("SOPClassUID") == RTSTRUCT_CLASS) & (F.size(regions) > 0))
        .select(
            SERIES,
            F.array_min(F.transform(series, lambda s: s[SERIES])).alias("referenced"),
            items("RTROIObservationsSequence").alias("observations"),
            F.transform(regions, lambda r: r["ROINumber"]).alias("numbers"),
            F.transform(regions, lambda r: r["ROIName"]).alias("names"),
            F.transform(regions, lambda r: r["ROIGenerationAlgorithm"]).alias("algorithms"),
        )
        .select(
            SERIES,
            "referenced",
            F.inline(
                F.concat(
                    tagged("number", F.col("numbers")),
                    tagged("name", F.col("names")),
                    tagged("algorithm", F.col("algorithms")),
                    tagged("type", F.transform(seen, lambda o: o["RTROIInterpretedType"])),
                )
            ),
        )
    )
    entries = distinct_looks(entries, entries.columns)

    def of(kind: str) -> Column:
        return F.when(F.col("kind") == kind, F.col("value"))

    return entries.groupBy(SERIES).agg(
        F.count_distinct(of("number")).alias("total_rois"),
        distinct_sorted(of("name")).alias("ROINames"),
        distinct_sorted(of("algorithm")).alias("ROIGenerationAlgorithms"),
        distinct_sorted(of("type")).alias("RTROIInterpretedTypes"),
        any_of("referenced").alias("referenced_SeriesInstanceUID"),
    )


def ann_index(instances: DataFrame) -> DataFrame:
    """One row per annotation object (one object per series)."""
    return instances.where(F.col("SOPClassUID") == ANN_CLASS).select(
        SERIES,
        "AnnotationCoordinateType",
        first("ReferencedSeriesSequence")[SERIES].alias("referenced_SeriesInstanceUID"),
    )


def ann_group_index(instances: DataFrame) -> DataFrame:
    """One row per annotation group; empty objects have none."""
    group = (
        "AnnotationGroupNumber",
        "AnnotationGroupUID",
        "AnnotationGroupLabel",
        "AnnotationGroupGenerationType",
        "NumberOfAnnotations",
        "GraphicType",
    )
    category = first("g.AnnotationPropertyCategoryCodeSequence")
    kind = first("g.AnnotationPropertyTypeCodeSequence")
    algorithm = first("g.AnnotationGroupAlgorithmIdentificationSequence")
    return (
        instances.where(F.col("SOPClassUID") == ANN_CLASS)
        .select(SERIES, F.explode("AnnotationGroupSequence").alias("g"))
        .select(
            SERIES,
            *[F.col(f"g.{c}") for c in group],
            code_pair(category).alias("AnnotationPropertyCategory_code"),
            category["CodeMeaning"].alias("AnnotationPropertyCategory_CodeMeaning"),
            code_pair(kind).alias("AnnotationPropertyType_code"),
            kind["CodeMeaning"].alias("AnnotationPropertyType_CodeMeaning"),
            algorithm["AlgorithmName"].alias("AlgorithmName"),
        )
    )
