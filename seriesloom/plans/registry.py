"""All indices by name: builder, inputs, grain, output order and column descriptions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import first
from ..sources.publish import ROWS_PER_FILE, column_dictionary, write_parquet
from ..sources.tables import Tables
from . import core, derived, geometry, modality, slide, versions


@dataclass(frozen=True)
class IndexSpec:
    """How an index is made and published."""

    name: str
    builder: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    grain: tuple[str, ...]
    description: str
    columns: Mapping[str, str]
    order: Callable[[], list[Column | str]] = field(default=list)
    # the history index reads all versions and needs to know the latest one
    all_versions: bool = False


# --- column descriptions ------------------------------------------------------------

_SERIES = {"SeriesInstanceUID": "identifier of the series; joins with the series index"}
_SPACING = {
    "PixelSpacing_row_mm": "distance between pixel rows in mm",
    "PixelSpacing_col_mm": "distance between pixel columns in mm",
}
_MATRIX = {"Rows": "pixel rows of an image", "Columns": "pixel columns of an image"}
_PREPARATION = {
    f"{name}{suffix}": text.format(what)
    for name, what in (
        ("embeddingMedium", "embedding media"),
        ("tissueFixative", "tissue fixatives"),
        ("staining_usingSubstance", "staining substances"),
    )
    for suffix, text in (
        ("_CodeMeaning", "names of the {} of the specimen"),
        ("_code_designator_value_str", "codes (scheme:value) of the {} of the specimen"),
    )
}

SERIES_INDEX = {
    "collection_id": "collection of the series",
    "analysis_result_id": "analysis result the series is part of, if any",
    "PatientID": "patient, unique within the collection",
    "SeriesInstanceUID": "identifier of the series",
    "StudyInstanceUID": "identifier of the study",
    "source_DOI": "digital object identifier of the data set the series came from",
    "PatientAge": "age of the patient when imaged",
    "PatientSex": "sex of the patient",
    "StudyDate": "shifted date of the study, as text",
    "StudyDescription": "free-text description of the study",
    "BodyPartExamined": "curated body part; of the source images for derived series",
    "Modality": "acquisition modality",
    "SOPClassUID": "kind of the stored objects",
    "sop_class_name": "name of SOPClassUID",
    "TransferSyntaxUID": "encodings of the instances, comma separated",
    "transfer_syntax_name": "names of the encodings, comma separated",
    "PhotometricInterpretation": "meaning of the pixel values, comma separated",
    "PixelRepresentation": "0 for unsigned and 1 for signed pixels, comma separated",
    "Manufacturer": "maker of the equipment",
    "ManufacturerModelName": "model of the equipment",
    "SeriesDate": "shifted date of the series, as text",
    "SeriesDescription": "free-text description of the series",
    "SeriesNumber": "number of the series in its study",
    "instanceCount": "number of instances",
    "license_short_name": "license of the series",
    "series_init_idc_version": "release that first had the series",
    "series_revised_idc_version": "release that last changed the series",
    "aws_bucket": "storage bucket of the series",
    "crdc_series_uuid": "identifier of this revision of the series",
    "series_aws_url": "address of all instances of the series",
    "series_size_MB": "size of the series in megabytes",
}
PRIOR_VERSIONS = {
    "collection_id": "collection of the series",
    "PatientID": "patient, unique within the collection",
    "SeriesInstanceUID": "identifier of the series",
    "StudyInstanceUID": "identifier of the study",
    "Modality": "acquisition modality",
    "gcs_bucket": "storage bucket of the revision",
    "crdc_series_uuid": "identifier of the revision",
    "series_size_MB": "size of the revision in megabytes",
    "series_aws_url": "address of all instances of the revision in the mirror",
    "aws_bucket": "mirror bucket",
    "min_idc_version": "first release with the revision",
    "max_idc_version": "last release with the revision",
}
COLLECTIONS = {
    "collection_name": "name of the collection",
    "collection_id": "identifier of the collection",
    "cancer_types": "cancers of the subjects",
    "tumor_locations": "where the tumors are",
    "subjects": "number of subjects",
    "species": "species of the subjects",
    "sources": "data sets the collection is made of",
    "supporting_data": "further data on the subjects",
    "program_id": "program the collection belongs to",
    "status": "whether the collection is complete or growing",
    "updated": "date of the last change, as text",
    "description": "long description",
}
ANALYSIS_RESULTS = {
    "analysis_result_id": "identifier of the analysis result",
    "analysis_result_title": "title of the analysis result",
    "source_DOI": "digital object identifier of the analysis result",
    "source_url": "page with more information",
    "subjects": "number of analyzed subjects",
    "collections": "analyzed collections",
    "modalities": "modalities of the produced objects",
    "updated": "time of the last change, as text",
    "license_url": "address of the license",
    "license_long_name": "name of the license",
    "license_short_name": "short name of the license",
    "description": "long description",
    "citation": "how to cite the analysis result",
}
CLINICAL = {
    "collection_id": "collection the table belongs to",
    "table_name": "full name of the clinical table",
    "short_table_name": "third part of the full table name",
    "column": "column of the clinical table",
    "column_label": "readable name of the column",
    "values": "values found in the column",
}
VERSION_METADATA = {
    "idc_version": "release number",
    "version_timestamp": "when the release was made",
}
CT = {
    **_SERIES,
    "ImageType": "image type values",
    **_SPACING,
    **_MATRIX,
    "SliceThickness": "nominal slice thickness in mm",
    "KVP": "peak tube voltage in kV",
    "ScanOptions": "scan options",
    "ConvolutionKernel": "reconstruction kernels",
    "GantryDetectorTilt": "tilt of the gantry in degrees",
    "XRayTubeCurrent_min": "smallest tube current in mA",
    "XRayTubeCurrent_max": "largest tube current in mA",
    "FilterType": "kind of beam filter",
    "Exposure_min": "smallest exposure in mAs",
    "Exposure_max": "largest exposure in mAs",
    "ExposureTime_min": "shortest exposure in ms",
    "ExposureTime_max": "longest exposure in ms",
    "DataCollectionDiameter": "diameter of the measured region in mm",
    "ReconstructionDiameter": "diameter of the reconstructed region in mm",
    "SpiralPitchFactor": "pitch of a helical scan",
}
MR = {
    **_SERIES,
    "MagneticFieldStrength": "field strength in tesla",
    "ScanningSequence": "kinds of pulse sequence",
    "SequenceVariant": "variants of the pulse sequence",
    "MRAcquisitionType": "2D or 3D acquisition",
    "EchoTime": "distinct echo times in ms",
    "RepetitionTime": "repetition time in ms",
    "EchoTrainLength": "echoes per train",
    "FlipAngle": "flip angle in degrees",
    "PixelBandwidth": "bandwidth per pixel in Hz",
    "ImagingFrequency": "precession frequency in MHz",
    "ImagedNucleus": "imaged nucleus",
    **_SPACING,
    **_MATRIX,
    "SliceThickness": "nominal slice thickness in mm",
    "InversionTime": "inversion time in ms",
    "ReceiveCoilName": "receive coil",
    "SequenceName": "maker's name of the sequence",
    "DiffusionBValue": "distinct diffusion weightings in s/mm2",
    "NumberOfTemporalPositions": "number of time frames",
}
PT = {
    **_SERIES,
    "SeriesType": "both series type values with a slash between",
    "Units": "unit of the pixel values",
    "DecayCorrection": "kind of decay correction",
    "CorrectedImage": "corrections that were applied",
    "RandomsCorrectionMethod": "randoms correction",
    "ReconstructionMethod": "reconstruction algorithm",
    "ActualFrameDuration": "distinct frame durations in ms",
    "ScatterCorrectionMethod": "scatter correction",
    "AttenuationCorrectionMethod": "attenuation correction",
    "RadionuclideCodeMeaning": "radionuclide",
    "RadionuclideTotalDose": "administered dose in Bq",
    "RadiopharmaceuticalStartTime": "time of administration, as text",
    "Radiopharmaceutical": "free-text name of the tracer",
    **_SPACING,
    **_MATRIX,
    "SliceThickness": "nominal slice thickness in mm",
    "NumberOfSlices": "number of slices",
    "NumberOfTimeSlices": "number of time frames of a dynamic series",
}
CONTRAST = {
    **_SERIES,
    "ContrastBolusAgent": "distinct agent names",
    "ContrastBolusIngredient": "distinct active ingredients",
    "ContrastBolusRoute": "distinct routes of administration",
}
SLIDE = {
    **_SERIES,
    "ContainerIdentifier": "slide that holds the specimen",
    **_PREPARATION,
    "min_PixelSpacing_2sf": "finest pixel spacing in mm, two significant figures",
    "max_TotalPixelMatrixColumns": "width of the largest image",
    "max_TotalPixelMatrixRows": "height of the largest image",
    "ObjectiveLensPower": "magnification of the objective",
    **{
        f"{name}{suffix}": f"{part} of the {what}"
        for name, what in (
            ("primaryAnatomicStructure", "anatomic site"),
            ("primaryAnatomicStructureModifier", "modifier of the anatomic site"),
            ("illuminationType", "illumination"),
            ("admittingDiagnosis", "admitting diagnosis"),
        )
        for suffix, part in (
            ("_code_designator_value_str", "code (scheme:value)"),
            ("_CodeMeaning", "name"),
        )
    },
}
SLIDE_INSTANCE = {
    "SOPInstanceUID": "identifier of the instance",
    **_SERIES,
    **_PREPARATION,
    "PixelSpacing_0": "pixel spacing in mm",
    "ImageType": "image type values",
    "TransferSyntaxUID": "encoding of the instance",
    "instance_size": "size of the instance in bytes",
    "TotalPixelMatrixColumns": "width of the image",
    "TotalPixelMatrixRows": "height of the image",
    "crdc_instance_uuid": "identifier of this revision of the instance",
}
SEGMENTATION = {
    **_SERIES,
    "SegmentationType": "kind of segmentation",
    "total_segments": "number of distinct segments",
    "AlgorithmType": "how segments were made, comma separated",
    "AlgorithmName": "algorithms that made segments, comma separated",
    "segmented_SeriesInstanceUID": "series the segmentation was made on",
    "SegmentedPropertyCategory_CodeMeanings": "distinct categories of the segments",
    "SegmentedPropertyType_CodeMeanings": "distinct types of the segments",
    "AnatomicRegion_CodeMeanings": "distinct anatomic regions of the segments",
}
STRUCTURE_SET = {
    **_SERIES,
    "total_rois": "number of distinct regions",
    "ROINames": "distinct names of the regions",
    "ROIGenerationAlgorithms": "distinct ways the regions were made",
    "RTROIInterpretedTypes": "distinct interpreted types of the regions",
    "referenced_SeriesInstanceUID": "series the regions were drawn on",
}
ANNOTATION = {
    **_SERIES,
    "AnnotationCoordinateType": "2D or 3D coordinates",
    "referenced_SeriesInstanceUID": "annotated series",
}
ANNOTATION_GROUP = {
    **_SERIES,
    "AnnotationGroupNumber": "number of the group",
    "AnnotationGroupUID": "identifier of the group",
    "AnnotationGroupLabel": "label of the group",
    "AnnotationGroupGenerationType": "how the group was made",
    "NumberOfAnnotations": "number of annotations in the group",
    "GraphicType": "shape of the annotations",
    "AnnotationPropertyCategory_code": "code (scheme:value) of the annotated category",
    "AnnotationPropertyCategory_CodeMeaning": "name of the annotated category",
    "AnnotationPropertyType_code": "code (scheme:value) of the annotated type",
    "AnnotationPropertyType_CodeMeaning": "name of the annotated type",
    "AlgorithmName": "algorithm that made the group",
}
GEOMETRY = {
    **_SERIES,
    "single_orientation": "all slices have the same orientation",
    "orthogonal_orientation": "row and column directions are orthogonal unit vectors",
    "unique_slice_positions": "no two slices share a position",
    "consistent_in_plane_row": "slices do not shift along the rows",
    "consistent_in_plane_col": "slices do not shift along the columns",
    "consistent_pixel_spacing": "all slices have the same pixel spacing",
    "consistent_image_dimensions": "all slices have the same matrix",
    "uniform_slice_spacing": "neighbouring slices are equally far apart",
    "obliquity_degrees": "angle between the slice normal and the nearest axis",
    "regularly_spaced_3d_volume": "all checks hold: the slices form a regular volume",
}


def _last(*names: str) -> list[Column | str]:
    return [F.asc_nulls_last(n) for n in names]


INDEXES: dict[str, IndexSpec] = {
    spec.name: spec
    for spec in (
        IndexSpec(
            "series_index",
            core.series_index,
            ("instances", "instances_curated", "version_bookkeeping"),
            ("SeriesInstanceUID",),
            "One row per series with collection, patient, study and download attributes.",
            SERIES_INDEX,
            lambda: ["collection_id", "PatientID", "StudyInstanceUID", "SeriesInstanceUID"],
        ),
        IndexSpec(
            "prior_versions_index",
            versions.prior_versions_index,
            ("instances_by_version",),
            ("crdc_series_uuid", "gcs_bucket", "series_size_MB"),
            "Series revisions of earlier releases that the latest release no longer has.",
            PRIOR_VERSIONS,
            lambda: ["collection_id", "min_idc_version", "Modality"],
            all_versions=True,
        ),
        IndexSpec(
            "collections_index",
            core.collections_index,
            ("collections",),
            ("collection_id",),
            "One row per collection.",
            COLLECTIONS,
            lambda: ["collection_id"],
        ),
        IndexSpec(
            "analysis_results_index",
            core.analysis_results_index,
            ("analysis_results",),
            ("analysis_result_id",),
            "One row per analysis result.",
            ANALYSIS_RESULTS,
            lambda: ["analysis_result_id"],
        ),
        IndexSpec(
            "clinical_index",
            core.clinical_index,
            ("clinical_columns",),
            ("table_name", "column"),
            "Dictionary of the columns of all clinical tables.",
            CLINICAL,
            lambda: ["collection_id", "table_name"],
        ),
        IndexSpec(
            "sm_index",
            slide.sm_index,
            ("instances",),
            ("SeriesInstanceUID",),
            "One row per slide microscopy series.",
            SLIDE,
            lambda: ["primaryAnatomicStructure_CodeMeaning", first("staining_usingSubstance_CodeMeaning"), "SeriesInstanceUID"],
        ),
        IndexSpec(
            "sm_instance_index",
            slide.sm_instance_index,
            ("instances",),
            ("SOPInstanceUID",),
            "One row per slide microscopy instance.",
            SLIDE_INSTANCE,
            lambda: [first("staining_usingSubstance_CodeMeaning"), "TransferSyntaxUID", "SeriesInstanceUID"],
        ),
        IndexSpec(
            "seg_index",
            derived.seg_index,
            ("instances",),
            ("SeriesInstanceUID",),
            "One row per segmentation series; lists are distinct and independent of each other.",
            SEGMENTATION,
            lambda: [F.desc("SegmentationType"), "AlgorithmType", "AlgorithmName"],
        ),
        IndexSpec(
            "ann_index",
            derived.ann_index,
            ("instances",),
            ("SeriesInstanceUID",),
            "One row per bulk annotation series.",
            ANNOTATION,
            lambda: ["AnnotationCoordinateType", "referenced_SeriesInstanceUID"],
        ),
        IndexSpec(
            "ann_group_index",
            derived.ann_group_index,
            ("instances",),
            ("SeriesInstanceUID", "AnnotationGroupNumber"),
            "One row per annotation group.",
            ANNOTATION_GROUP,
            lambda: [
                "AnnotationPropertyCategory_CodeMeaning",
                "AnnotationPropertyType_CodeMeaning",
                "AlgorithmName",
            ],
        ),
        IndexSpec(
            "contrast_index",
            modality.contrast_index,
            ("instances",),
            ("SeriesInstanceUID",),
            "Contrast agents of series that have any.",
            CONTRAST,
            lambda: [
                first("ContrastBolusAgent"),
                first("ContrastBolusIngredient"),
                first("ContrastBolusRoute"),
            ],
        ),
        IndexSpec(
            "volume_geometry_index",
            geometry.volume_geometry_index,
            ("instances",),
            ("SeriesInstanceUID",),
            "Checks whether CT, MR and PET series are regularly spaced volumes.",
            GEOMETRY,
            lambda: [F.desc("regularly_spaced_3d_volume"), "SeriesInstanceUID"],
        ),
        IndexSpec(
            "rtstruct_index",
            derived.rtstruct_index,
            ("instances",),
            ("SeriesInstanceUID",),
            "One row per structure set series; lists are distinct and independent of each other.",
            STRUCTURE_SET,
            lambda: ["SeriesInstanceUID"],
        ),
        IndexSpec(
            "version_metadata_index",
            core.version_metadata_index,
            ("versions",),
            ("idc_version",),
            "One row per release.",
            VERSION_METADATA,
            lambda: ["idc_version"],
        ),
        IndexSpec(
            "ct_index",
            modality.ct_index,
            ("instances",),
            ("SeriesInstanceUID",),
            "Acquisition parameters of CT series.",
            CT,
            lambda: [
                *_last("KVP"),
                first("ConvolutionKernel").asc_nulls_last(),
                *_last("SliceThickness"),
                "SeriesInstanceUID",
            ],
        ),
        IndexSpec(
            "mr_index",
            modality.mr_index,
            ("instances",),
            ("SeriesInstanceUID",),
            "Acquisition parameters of MR series.",
            MR,
            lambda: [
                *_last("MagneticFieldStrength"),
                first("ScanningSequence").asc_nulls_last(),
                *_last("MRAcquisitionType"),
                first("EchoTime").asc_nulls_last(),
                "SeriesInstanceUID",
            ],
        ),
        IndexSpec(
            "pt_index",
            modality.pt_index,
            ("instances",),
            ("SeriesInstanceUID",),
            "Acquisition parameters of PET series.",
            PT,
            lambda: [*_last("Units", "RadionuclideCodeMeaning"), "SeriesInstanceUID"],
        ),
    )
}


def build(name: str, tables: Tables, version: int | str | None = "current") -> DataFrame:
    """One index from stored tables.  ``version`` selects the release of the inputs."""
    spec = INDEXES[name]
    if spec.all_versions:
        (source,) = spec.inputs
        latest = tables.newest(source) if version in (None, "current") else int(version)
        return spec.builder(tables.all_versions(source), latest)
    return spec.builder(*[tables.table(t, version) for t in spec.inputs])


def dictionary(name: str, df: DataFrame) -> DataFrame:
    spec = INDEXES[name]
    return column_dictionary(df, name, spec.description, spec.columns)


def publish(
    tables: Tables,
    out: str,
    names: Iterable[str] = tuple(INDEXES),
    version: int | str | None = "current",
    stamp: str | None = None,
    files: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> dict[str, str]:
    """Build and write indices and their dictionaries; returns the path of each index."""
    root = out.rstrip("/")
    paths = {}
    for name in names:
        spec = INDEXES[name]
        df = build(name, tables, version)
        paths[name] = f"{root}/{name}"
        write_parquet(
            df,
            paths[name],
            order=spec.order(),
            grain=spec.grain,
            descriptions=spec.columns,
            version=stamp,
            files=files,
            rows_per_file=rows_per_file,
        )
        write_parquet(dictionary(name, df), f"{root}/_dictionary/{name}", files=1)
    return paths
