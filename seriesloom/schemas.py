"""Declared schemas of the input tables.

Repeated columns are never NULL in a conformed table (see ``sources.tables.conform``).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, DATE, TS = (
    T.StringType(),
    T.LongType(),
    T.DoubleType(),
    T.DateType(),
    T.TimestampType(),
)
TEXTS = T.ArrayType(S)


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def many(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(record(**fields))


_CODE = {"CodeValue": S, "CodingSchemeDesignator": S, "CodeMeaning": S}
CODES = many(**_CODE)

_TEXT_COLUMNS = """SOPInstanceUID SeriesInstanceUID StudyInstanceUID PatientID collection_id
analysis_result_id source_DOI license_short_name PatientAge PatientSex StudyDescription
SeriesDescription Manufacturer ManufacturerModelName Modality SOPClassUID TransferSyntaxUID
PhotometricInterpretation SeriesNumber aws_bucket crdc_series_uuid series_aws_url gcs_url
crdc_instance_uuid instance_size SliceThickness KVP GantryDetectorTilt XRayTubeCurrent Exposure
ExposureTime DataCollectionDiameter ReconstructionDiameter FilterType MagneticFieldStrength
EchoTime RepetitionTime EchoTrainLength FlipAngle PixelBandwidth ImagingFrequency InversionTime
NumberOfTemporalPositions MRAcquisitionType ImagedNucleus ReceiveCoilName SequenceName Units
DecayCorrection RandomsCorrectionMethod ReconstructionMethod ScatterCorrectionMethod
AttenuationCorrectionMethod ActualFrameDuration ContrastBolusAgent ContrastBolusIngredient
ContrastBolusRoute ContainerIdentifier SegmentationType FrameOfReferenceUID
AnnotationCoordinateType""".split()

_LONG_COLUMNS = """PixelRepresentation Rows Columns TotalPixelMatrixRows TotalPixelMatrixColumns
NumberOfSlices NumberOfTimeSlices""".split()

_ARRAY_COLUMNS = """ImageType ScanOptions ConvolutionKernel ScanningSequence SequenceVariant
SeriesType CorrectedImage ImagePositionPatient ImageOrientationPatient PixelSpacing""".split()

_NESTED_COLUMNS = {
    "SegmentSequence": many(
        SegmentNumber=L,
        SegmentAlgorithmType=S,
        SegmentAlgorithmName=TEXTS,
        TrackingID=S,
        TrackingUID=S,
        AnatomicRegionSequence=many(**_CODE, AnatomicRegionModifierSequence=CODES),
        SegmentedPropertyCategoryCodeSequence=CODES,
        SegmentedPropertyTypeCodeSequence=CODES,
    ),
    "ReferencedSeriesSequence": many(
        SeriesInstanceUID=S, ReferencedInstanceSequence=many(ReferencedSOPInstanceUID=S)
    ),
    "ReferencedImageSequence": many(ReferencedSOPInstanceUID=S),
    "SourceImageSequence": many(ReferencedSOPInstanceUID=S),
    "StructureSetROISequence": many(ROINumber=L, ROIName=S, ROIGenerationAlgorithm=S),
    "RTROIObservationsSequence": many(ReferencedROINumber=L, RTROIInterpretedType=S),
    "ReferencedFrameOfReferenceSequence": many(
        RTReferencedStudySequence=many(RTReferencedSeriesSequence=many(SeriesInstanceUID=S))
    ),
    "AnnotationGroupSequence": many(
        AnnotationGroupNumber=L,
        AnnotationGroupUID=S,
        AnnotationGroupLabel=S,
        AnnotationGroupGenerationType=S,
        NumberOfAnnotations=L,
        GraphicType=S,
        AnnotationPropertyCategoryCodeSequence=CODES,
        AnnotationPropertyTypeCodeSequence=CODES,
        AnnotationGroupAlgorithmIdentificationSequence=many(AlgorithmName=S),
    ),
    "SpecimenDescriptionSequence": many(
        PrimaryAnatomicStructureSequence=many(
            **_CODE, PrimaryAnatomicStructureModifierSequence=CODES
        ),
        SpecimenPreparationSequence=many(
            SpecimenPreparationStepContentItemSequence=many(
                ConceptNameCodeSequence=CODES, ConceptCodeSequence=CODES
            )
        ),
    ),
    "OpticalPathSequence": many(ObjectiveLensPower=S, IlluminationTypeCodeSequence=CODES),
    "AdmittingDiagnosesCodeSequence": CODES,
    "SharedFunctionalGroupsSequence": many(PixelMeasuresSequence=many(PixelSpacing=TEXTS)),
    "RadiopharmaceuticalInformationSequence": many(
        RadionuclideCodeSequence=CODES,
        RadionuclideTotalDose=S,
        RadiopharmaceuticalStartTime=S,
        Radiopharmaceutical=S,
    ),
}

INSTANCES = record(
    **{n: S for n in _TEXT_COLUMNS},
    StudyDate=DATE,
    SeriesDate=DATE,
    SpiralPitchFactor=D,
    DiffusionBValue=D,
    **{n: L for n in _LONG_COLUMNS},
    **{n: TEXTS for n in _ARRAY_COLUMNS},
    **_NESTED_COLUMNS,
)

INSTANCES_CURATED = record(SOPInstanceUID=S, BodyPartExamined=S)

VERSION_BOOKKEEPING = record(
    SeriesInstanceUID=S, series_init_idc_version=L, series_revised_idc_version=L
)

INSTANCES_BY_VERSION = record(
    idc_version=T.IntegerType(),
    collection_id=S,
    PatientID=S,
    SeriesInstanceUID=S,
    StudyInstanceUID=S,
    Modality=S,
    gcs_url=S,
    crdc_series_uuid=S,
    instance_size=S,
)

COLLECTIONS = record(
    collection_name=S,
    collection_id=S,
    cancer_types=S,
    tumor_locations=S,
    subjects=L,
    species=S,
    sources=many(
        source_id=S,
        source_title=S,
        source_type=S,
        source_doi=S,
        source_url=S,
        modalities=S,
        license=record(license_url=S, license_long_name=S, license_short_name=S),
        citation=S,
        Access=S,
        ImageTypes=S,
    ),
    supporting_data=S,
    program_id=S,
    status=S,
    updated=DATE,
    description=S,
)

ANALYSIS_RESULTS = record(
    analysis_result_id=S,
    analysis_result_title=S,
    source_doi=S,
    source_url=S,
    subjects=L,
    collections=S,
    modalities=S,
    Updated=TS,
    license_url=S,
    license_long_name=S,
    license_short_name=S,
    description=S,
    citation=S,
)

CLINICAL_COLUMNS = record(
    collection_id=S,
    table_name=S,
    column=S,
    column_label=S,
    values=many(option_code=S, option_description=S),
)

VERSIONS = record(idc_version=L, version_timestamp=TS)

CASES = record(project_id=S, submitter_id=S, case_id=S)

COLLECTION_PROJECTS = record(collection_id=S, project_ids=TEXTS)

# Input tables of the indices by name.
INPUTS: dict[str, T.StructType] = {
    "instances": INSTANCES,
    "instances_curated": INSTANCES_CURATED,
    "version_bookkeeping": VERSION_BOOKKEEPING,
    "instances_by_version": INSTANCES_BY_VERSION,
    "collections": COLLECTIONS,
    "analysis_results": ANALYSIS_RESULTS,
    "clinical_columns": CLINICAL_COLUMNS,
    "versions": VERSIONS,
    "cases": CASES,
    "collection_projects": COLLECTION_PROJECTS,
}


def narrowed(stored: T.DataType, declared: T.DataType) -> T.DataType:
    """The declared fields in their stored types, at every level of nesting.

    Fields the files lack keep their declared type; Parquet reads them as NULL.
    """
    if isinstance(stored, T.ArrayType) and isinstance(declared, T.ArrayType):
        return T.ArrayType(narrowed(stored.elementType, declared.elementType), stored.containsNull)
    if isinstance(stored, T.StructType) and isinstance(declared, T.StructType):
        kinds = {f.name: f.dataType for f in stored.fields}
        return T.StructType(
            [
                T.StructField(f.name, narrowed(kinds.get(f.name, f.dataType), f.dataType))
                for f in declared.fields
            ]
        )
    return stored
