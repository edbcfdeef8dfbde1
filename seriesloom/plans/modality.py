"""Acquisition parameters per series: CT, MR, PT and contrast agents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import (
    Values,
    any_list,
    any_of,
    distinct_sorted,
    element_number,
    first,
    folded,
    nth,
    safe_double,
    safe_long,
    slash_joined,
)
from ..lookups import CONTRAST_MODALITIES, CT_CLASS, MR_CLASS, PT_CLASS
from .core import SERIES


def series_of_class(instances: DataFrame, class_uid: str, values: Values) -> DataFrame:
    """One row per series of a SOP class; the filter comes first so it reaches the scan."""
    return folded(instances.where(F.col("SOPClassUID") == class_uid), SERIES, values)


def _numbers(instances: DataFrame, names: Sequence[str]) -> Values:
    return {n: (any_of, safe_double(instances, n)) for n in names}


def _spacing(instances: DataFrame) -> Values:
    spacing = F.col("PixelSpacing")
    as_number = element_number(instances, "PixelSpacing")
    return {
        "PixelSpacing_row_mm": (any_of, as_number(nth(spacing, 0))),
        "PixelSpacing_col_mm": (any_of, as_number(nth(spacing, 1))),
    }


def _matrix() -> Values:
    return {"Rows": (any_of, "Rows"), "Columns": (any_of, "Columns")}


def _extremes(instances: DataFrame, name: str) -> Values:
    number = safe_double(instances, name)
    return {f"{name}_min": (F.min, number), f"{name}_max": (F.max, number)}


def ct_index(instances: DataFrame) -> DataFrame:
    return series_of_class(
        instances,
        CT_CLASS,
        {
            "ImageType": (any_list, "ImageType"),
            **_spacing(instances),
            **_matrix(),
            **_numbers(instances, ["SliceThickness", "KVP"]),
            "ScanOptions": (any_list, "ScanOptions"),
            "ConvolutionKernel": (any_list, "ConvolutionKernel"),
            **_numbers(instances, ["GantryDetectorTilt"]),
            **_extremes(instances, "XRayTubeCurrent"),
            "FilterType": (any_of, "FilterType"),
            **_extremes(instances, "Exposure"),
            **_extremes(instances, "ExposureTime"),
            **_numbers(instances, ["DataCollectionDiameter", "ReconstructionDiameter"]),
            "SpiralPitchFactor": (any_of, "SpiralPitchFactor"),
        },
    )


def mr_index(instances: DataFrame) -> DataFrame:
    return series_of_class(
        instances,
        MR_CLASS,
        {
            **_numbers(instances, ["MagneticFieldStrength"]),
            "ScanningSequence": (any_list, "ScanningSequence"),
            "SequenceVariant": (any_list, "SequenceVariant"),
            "MRAcquisitionType": (any_of, "MRAcquisitionType"),
            "EchoTime": (distinct_sorted, safe_double(instances, "EchoTime")),
            **_numbers(instances, ["RepetitionTime"]),
            "EchoTrainLength": (any_of, safe_long(instances, "EchoTrainLength")),
            **_numbers(instances, ["FlipAngle", "PixelBandwidth", "ImagingFrequency"]),
            "ImagedNucleus": (any_of, "ImagedNucleus"),
            **_spacing(instances),
            **_matrix(),
            **_numbers(instances, ["SliceThickness", "InversionTime"]),
            "ReceiveCoilName": (any_of, "ReceiveCoilName"),
            "SequenceName": (any_of, "SequenceName"),
            "DiffusionBValue": (distinct_sorted, "DiffusionBValue"),
            "NumberOfTemporalPositions": (any_of, 
                safe_long(instances, "NumberOfTemporalPositions")
            ),
        },
    )


def pt_index(instances: DataFrame) -> DataFrame:
    agent = first("RadiopharmaceuticalInformationSequence")
    return series_of_class(
        instances,
        PT_CLASS,
        {
            "SeriesType": (lambda c: slash_joined(any_list(c)), "SeriesType"),
            "Units": (any_of, "Units"),
            "DecayCorrection": (any_of, "DecayCorrection"),
            "CorrectedImage": (any_list, "CorrectedImage"),
            "RandomsCorrectionMethod": (any_of, "RandomsCorrectionMethod"),
            "ReconstructionMethod": (any_of, "ReconstructionMethod"),
            "ActualFrameDuration": (distinct_sorted, 
                safe_double(instances, "ActualFrameDuration")
            ),
            "ScatterCorrectionMethod": (any_of, "ScatterCorrectionMethod"),
            "AttenuationCorrectionMethod": (any_of, "AttenuationCorrectionMethod"),
            "RadionuclideCodeMeaning": (any_of, 
                first(agent["RadionuclideCodeSequence"])["CodeMeaning"]
            ),
            "RadionuclideTotalDose": (any_of, 
                safe_double(instances, agent["RadionuclideTotalDose"])
            ),
            "RadiopharmaceuticalStartTime": (
                any_of, agent["RadiopharmaceuticalStartTime"].cast("string")
            ),
            "Radiopharmaceutical": (any_of, agent["Radiopharmaceutical"]),
            **_spacing(instances),
            **_matrix(),
            **_numbers(instances, ["SliceThickness"]),
            "NumberOfSlices": (any_of, "NumberOfSlices"),
            "NumberOfTimeSlices": (any_of, "NumberOfTimeSlices"),
        },
    )


def contrast_index(
    instances: DataFrame, modalities: Sequence[str] = CONTRAST_MODALITIES
) -> DataFrame:
    """Series with a contrast agent.

    Rows without any contrast attribute cannot add to a result, so they are dropped
    before the shuffle; a series left with none of them has no row at all.
    """
    columns = ("ContrastBolusAgent", "ContrastBolusIngredient", "ContrastBolusRoute")
    rows = instances.where(F.col("Modality").isin(*modalities))
    rows = rows.where(F.coalesce(*columns).isNotNull())
    return folded(rows, SERIES, {c: (distinct_sorted, c) for c in columns})
