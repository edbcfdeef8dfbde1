"""Slide microscopy: one row per series, and one row per instance."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import (
    any_of,
    distinct_looks,
    first,
    folded,
    items,
    ranked_code,
    safe_double,
    safe_long,
    significant,
)
from ..lookups import PREPARATION_CONCEPTS
from .core import INSTANCE, SERIES

Concepts = Mapping[str, tuple[str, str]]


def _preparation(concept: tuple[str, str]) -> Column:
    """Sorted distinct substances recorded under one preparation concept of a slide.

    Works inside the row: a content item whose names include the concept contributes
    all its codes, so neither an explode nor a shuffle is needed at instance grain.
    """
    scheme, value = concept
    steps = items(first("SpecimenDescriptionSequence")["SpecimenPreparationSequence"])
    contents = F.flatten(
        F.transform(
            steps, lambda s: items(s["SpecimenPreparationStepContentItemSequence"])
        )
    )
    named = F.filter(
        contents,
        lambda c: F.exists(
            items(c["ConceptNameCodeSequence"]),
            lambda n: (n["CodingSchemeDesignator"] == scheme) & (n["CodeValue"] == value),
        ),
    )
    codes = F.flatten(F.transform(named, lambda c: items(c["ConceptCodeSequence"])))
    ranked = F.transform(codes, _meaning_first)
    return F.array_sort(F.array_distinct(F.filter(ranked, lambda r: r.isNotNull())))


def _meaning_first(code: Column) -> Column:
    """Substance ordered by its text ``meaning:scheme:value``; NULL if a part is missing."""
    pair = F.concat(code["CodingSchemeDesignator"], F.lit(":"), code["CodeValue"])
    text = F.concat(code["CodeMeaning"], F.lit(":"), pair)
    return F.when(
        text.isNotNull(),
        F.struct(
            text.alias("text"), pair.alias("pair"), code["CodeMeaning"].alias("meaning")
        ),
    )


def _tagged(concept: str, entries: Column) -> Column:
    return F.transform(
        entries, lambda e: F.struct(F.lit(concept).alias("concept"), e.alias("entry"))
    )


def _two_lists(name: str, entries: Column) -> list[Column]:
    return [
        F.transform(entries, lambda e: e["meaning"]).alias(f"{name}_CodeMeaning"),
        F.transform(entries, lambda e: e["pair"]).alias(f"{name}_code_designator_value_str"),
    ]


def _shared_spacing() -> Column:
    measures = first("SharedFunctionalGroupsSequence")["PixelMeasuresSequence"]
    return first(first(measures)["PixelSpacing"])


def sm_instance_index(
    instances: DataFrame, concepts: Concepts = PREPARATION_CONCEPTS
) -> DataFrame:
    """One row per slide instance: a scan with a filter and a projection, no shuffle."""
    lists = [c for name, k in concepts.items() for c in _two_lists(name, _preparation(k))]
    return instances.where(F.col("Modality") == "SM").select(
        INSTANCE,
        SERIES,
        *lists,
        safe_double(instances, _shared_spacing()).alias("PixelSpacing_0"),
        "ImageType",
        "TransferSyntaxUID",
        "instance_size",
        "TotalPixelMatrixColumns",
        "TotalPixelMatrixRows",
        "crdc_instance_uuid",
    )


def sm_index(
    instances: DataFrame, concepts: Concepts = PREPARATION_CONCEPTS
) -> DataFrame:
    """One row per slide series.

    The modality is constant within a series, so it filters the scan.  Substances are
    de-duplicated inside the row and exploded one by one, so a series with very many
    instances is combined before its shuffle.
    """
    slides = instances.where(F.col("Modality") == "SM")
    anatomy = first(first("SpecimenDescriptionSequence")["PrimaryAnatomicStructureSequence"])
    coded = {
        "primaryAnatomicStructure": anatomy,
        "primaryAnatomicStructureModifier": first(
            anatomy["PrimaryAnatomicStructureModifierSequence"]
        ),
        "illuminationType": first(
            first("OpticalPathSequence")["IlluminationTypeCodeSequence"]
        ),
        "admittingDiagnosis": first("AdmittingDiagnosesCodeSequence"),
    }
    spacings = {"_spacing": first("PixelSpacing"), "_shared_spacing": _shared_spacing()}
    sizes = {
        "_total_columns": "TotalPixelMatrixColumns", "_total_rows": "TotalPixelMatrixRows",
        "_columns": "Columns", "_rows": "Rows",
    }
    main = folded(
        slides,
        SERIES,
        {
            "ContainerIdentifier": (any_of, "ContainerIdentifier"),
            **{name: (F.min, safe_double(instances, c)) for name, c in spacings.items()},
            **{name: (F.max, c) for name, c in sizes.items()},
            "ObjectiveLensPower": (
                any_of, safe_long(instances, first("OpticalPathSequence")["ObjectiveLensPower"])
            ),
            **{name: (F.min, ranked_code(code)) for name, code in coded.items()},
        },
    )
    substances = F.flatten(F.array(*[_tagged(n, _preparation(k)) for n, k in concepts.items()]))
    preparation = (
        distinct_looks(
            slides.select(SERIES, F.inline(substances)), [SERIES, "concept", "entry"]
        )
        .groupBy(SERIES)
        .agg(
            *[
                F.array_sort(
                    F.collect_set(F.when(F.col("concept") == name, F.col("entry")))
                ).alias(f"_{name}")
                for name in concepts
            ]
        )
    )
    lists = [
        c for name in concepts for c in _two_lists(name, items(f"_{name}"))
    ]
    codes = [
        F.col(name)[part].alias(f"{name}_{suffix}")
        for name in coded
        for part, suffix in (("pair", "code_designator_value_str"), ("meaning", "CodeMeaning"))
    ]
    return main.join(preparation, SERIES, "left").select(
        SERIES,
        "ContainerIdentifier",
        *lists,
        significant(F.coalesce("_spacing", "_shared_spacing")).alias("min_PixelSpacing_2sf"),
        F.coalesce("_total_columns", "_columns").alias("max_TotalPixelMatrixColumns"),
        F.coalesce("_total_rows", "_rows").alias("max_TotalPixelMatrixRows"),
        "ObjectiveLensPower",
        *codes,
    )
