"""DuckDB statements that compute the registered queries in a second, plainer way."""

from __future__ import annotations

from seriesloom import lookups

from . import queries as Q
from .adapter import COLLECTION, INSTANCE_KEY, duck_instances


def bars(x: str) -> str:
    """Sorted distinct non-NULL values joined with a bar."""
    values = f"list_sort(list(distinct {x}) filter (where {x} is not null))"
    return f"coalesce(array_to_string({values}, '|'), '')"


def number_bars(x: str) -> str:
    values = f"list_sort(list(distinct {x}) filter (where {x} is not null))"
    return f"coalesce(array_to_string(list_transform({values}, lambda v: cast(v as varchar)), '|'), '')"


def list_bars(x: str) -> str:
    """Smallest filled list of the group joined with a bar."""
    return f"coalesce(array_to_string(min(case when len({x}) > 0 then {x} end), '|'), '')"


def commas(x: str) -> str:
    return f"string_agg(distinct {x}, ',' order by {x})"


def dbl(x: str) -> str:
    return f"try_cast({x} as double)"


def names(values: dict[str, str], name: str) -> str:
    rows = ", ".join(f"('{u}', '{n}')" for u, n in values.items())
    return f"{name}(uid, name) as (values {rows})"


CURATED = f"""cur as (
  select {INSTANCE_KEY} as SOPInstanceUID, 'PART ' || l_linestatus as BodyPartExamined
  from lineitem where l_returnflag <> 'R'
  union all select {INSTANCE_KEY}, 'AGAIN' from lineitem where l_returnflag <> 'R' and l_quantity = 30)"""

SPAN = """span as (
  select cast(l_orderkey as varchar) as SeriesInstanceUID,
    min(cast(year(l_shipdate) - 1994 as bigint)) as series_init_idc_version,
    max(cast(year(l_shipdate) - 1994 + l_linenumber as bigint)) as series_revised_idc_version
  from lineitem group by 1)"""


def series_index() -> str:
    return f"""with {duck_instances(Q.SERIES_COLUMNS)}, {CURATED}, {SPAN},
{names(lookups.SOP_CLASS_NAMES, 'classes')}, {names(lookups.TRANSFER_SYNTAX_NAMES, 'syntaxes')}
select min(collection_id) as collection_id, min(analysis_result_id) as analysis_result_id,
  min(PatientID) as PatientID, i.SeriesInstanceUID, min(StudyInstanceUID) as StudyInstanceUID,
  min(source_DOI) as source_DOI, min(PatientAge) as PatientAge, min(PatientSex) as PatientSex,
  min(cast(StudyDate as varchar)) as StudyDate, min(StudyDescription) as StudyDescription,
  min(BodyPartExamined) as BodyPartExamined, min(Modality) as Modality,
  min(SOPClassUID) as SOPClassUID, min(c.name) as sop_class_name,
  {commas('TransferSyntaxUID')} as TransferSyntaxUID, {commas('t.name')} as transfer_syntax_name,
  {commas('PhotometricInterpretation')} as PhotometricInterpretation,
  {commas('cast(PixelRepresentation as varchar)')} as PixelRepresentation,
  min(Manufacturer) as Manufacturer, min(ManufacturerModelName) as ManufacturerModelName,
  min(cast(SeriesDate as varchar)) as SeriesDate, min(SeriesDescription) as SeriesDescription,
  min(SeriesNumber) as SeriesNumber, count(i.SOPInstanceUID) as instanceCount,
  min(license_short_name) as license_short_name,
  min(series_init_idc_version) as series_init_idc_version,
  min(series_revised_idc_version) as series_revised_idc_version,
  min(aws_bucket) as aws_bucket, min(crdc_series_uuid) as crdc_series_uuid,
  min(series_aws_url || '*') as series_aws_url,
  round(sum(try_cast(instance_size as double)) / 1e6, 8) as series_size_MB
from inst i left join cur on i.SOPInstanceUID = cur.SOPInstanceUID
left join span on i.SeriesInstanceUID = span.SeriesInstanceUID
left join classes c on c.uid = i.SOPClassUID left join syntaxes t on t.uid = i.TransferSyntaxUID
group by i.SeriesInstanceUID"""


def column_subset() -> str:
    cells = ", ".join(lookups.SUBSET_COLUMNS)
    return f"select {cells} from ({series_index()})"


BY_VERSION = """ver as (
  select year(o_orderdate) - 1994 as v, 'collection_' || lower(o_orderstatus) as collection_id,
    cast(o_custkey as varchar) as PatientID,
    cast(o_custkey as varchar) || '.' || o_orderpriority as SeriesInstanceUID,
    cast(o_custkey as varchar) as StudyInstanceUID, 'M' || substr(o_orderpriority, 1, 1) as Modality,
    case l_linenumber when 1 then 'gs://public-datasets-idc/a' when 2 then 'gs://idc-open-idc1/b'
      when 3 then 'gs://idc-open-cr/c' when 4 then 'gs://idc-open-idc/d' when 5 then 'gs://other/e'
      when 6 then 'no bucket' end as gcs_url,
    case when l_tax < 0.075 then cast(o_custkey as varchar) || '.' || o_orderpriority || '.' || o_orderstatus end as crdc_series_uuid,
    case when l_quantity = 50 then 'n/a' else cast(cast(l_quantity as int) * 10000 + 1 as varchar) end as instance_size
  from lineitem join orders on l_orderkey = o_orderkey)"""


def prior_versions() -> str:
    """One row per revision with all it has been in; what is gone has no place in the latest release."""
    mirrors = ", ".join(f"('{k}', '{v}')" for k, v in lookups.MIRROR_BUCKETS.items())
    hidden = ", ".join(f"'{b}'" for b in lookups.EXCLUDED_BUCKETS)
    keys = "collection_id, PatientID, SeriesInstanceUID, StudyInstanceUID, Modality, gcs_bucket, crdc_series_uuid"
    return f"""with {BY_VERSION}, mirrors(bucket, mirror) as (values {mirrors}),
gone as (
  select crdc_series_uuid as id from ver where crdc_series_uuid is not null group by 1
  having not list_contains(list(v), {Q.LATEST})),
known as (
  select {keys}, list(struct_pack(release := v, size := try_cast(instance_size as double))) as held
  from (select *, string_split(gcs_url, '/')[3] as gcs_bucket, starts_with(gcs_url, 'gs://') as is_bucket from ver)
  join gone on id = crdc_series_uuid where is_bucket and v between 1 and {Q.LATEST} group by all),
releases as (
  select *, unnest(list_distinct(list_transform(held, lambda h: h.release))) as release from known),
summed as (
  select *, round(list_sum(list_transform(list_filter(held, lambda h: h.release = release), lambda h: h.size))
    / 1000000, 2) as series_size_MB from releases),
spans as (
  select {keys}, series_size_MB, list(release) as found from summed group by all)
select {keys}, series_size_MB, concat('s3://', mirror, '/', crdc_series_uuid, '/*') as series_aws_url,
  mirror as aws_bucket, list_min(found) as min_idc_version, list_max(found) as max_idc_version
from spans join mirrors on bucket = gcs_bucket
union all
select {keys}, series_size_MB, null, null, list_min(found), list_max(found)
from spans where gcs_bucket not in (select bucket from mirrors) and gcs_bucket not in ({hidden})"""


def latest_members() -> str:
    return f"""with {BY_VERSION}
select crdc_series_uuid, count(distinct v) as versions, count(*) as instances from ver
where crdc_series_uuid in (select crdc_series_uuid from ver where v = {Q.LATEST} and crdc_series_uuid is not null)
group by 1"""


COLLECTIONS = f"""select n_name as collection_name, {COLLECTION} as collection_id,
  case when n_regionkey > 1 then 'Lung' end as cancer_types, 'Chest' as tumor_locations,
  count(c_custkey) as subjects, 'Human' as species, cast(n_regionkey as varchar) as sources,
  'Clinical' as supporting_data, 'P' || cast(n_regionkey as varchar) as program_id,
  'Completed' as status, cast(cast(date '2020-01-01' + n_nationkey as date) as varchar) as updated,
  'about ' || n_name as description
from nation left join customer on c_nationkey = n_nationkey
group by n_name, n_regionkey, n_nationkey"""

RESULTS = """select 'result_' || cast(n_nationkey as varchar) as analysis_result_id,
  'Results of ' || n_name as analysis_result_title, '10.1/' || n_name as source_DOI,
  'https://example.org/' || n_name as source_url, count(*) as subjects,
  lower(n_name) as collections, 'SEG' as modalities,
  cast(cast(date '2021-01-01' + n_nationkey as date) as varchar) as updated,
  'https://example.org/by' as license_url, 'Attribution' as license_long_name,
  'CC BY' as license_short_name, n_name as description, 'cite ' || n_name as citation
from supplier join nation on s_nationkey = n_nationkey group by n_name, n_nationkey"""

CLINICAL = """with t as (
  select lower(p_type) as collection_id,
    case when p_size > 40 then p_name when p_size > 20 then 'project.' || p_name
      else 'project.clinical.' || replace(p_name, ' ', '_') || '.v1' end as table_name,
    'c' || cast(p_partkey as varchar) as "column", p_brand as column_label,
    cast(p_size as varchar) as "values" from part)
select collection_id, table_name, string_split(table_name, '.')[3] as short_table_name,
  "column", column_label, "values" from t"""

RELEASES = """select cast(year(o_orderdate) - 1994 as bigint) as idc_version,
  min(o_orderdate) as version_timestamp from orders group by 1"""


def extremes(name: str) -> str:
    return f"min({dbl(name)}) as {name}_min, max({dbl(name)}) as {name}_max"


def any_number(*columns: str) -> str:
    return ", ".join(f"min({dbl(c)}) as {c}" for c in columns)


def any_text(*columns: str) -> str:
    return ", ".join(f"min({c}) as {c}" for c in columns)


SPACING = (
    "min(try_cast(PixelSpacing[1] as double)) as PixelSpacing_row_mm,"
    " min(try_cast(PixelSpacing[2] as double)) as PixelSpacing_col_mm"
)
MATRIX = 'min("Rows") as "Rows", min("Columns") as "Columns"'


def ct_index() -> str:
    return f"""with {duck_instances(Q.CT_COLUMNS)}
select SeriesInstanceUID, {list_bars('ImageType')} as ImageType, {SPACING}, {MATRIX},
  {any_number('SliceThickness', 'KVP')}, {list_bars('ScanOptions')} as ScanOptions,
  {list_bars('ConvolutionKernel')} as ConvolutionKernel, {any_number('GantryDetectorTilt')},
  {extremes('XRayTubeCurrent')}, min(FilterType) as FilterType, {extremes('Exposure')},
  {extremes('ExposureTime')}, {any_number('DataCollectionDiameter', 'ReconstructionDiameter')},
  min(SpiralPitchFactor) as SpiralPitchFactor
from inst where SOPClassUID = '{lookups.CT_CLASS}' group by 1"""


def mr_index() -> str:
    return f"""with {duck_instances(Q.MR_COLUMNS)}
select SeriesInstanceUID, {any_number('MagneticFieldStrength', 'RepetitionTime', 'FlipAngle')},
  {list_bars('ScanningSequence')} as ScanningSequence, {list_bars('SequenceVariant')} as SequenceVariant,
  {any_text('MRAcquisitionType', 'ImagedNucleus', 'ReceiveCoilName', 'SequenceName')},
  {number_bars(dbl('EchoTime'))} as EchoTime,
  min(try_cast(EchoTrainLength as bigint)) as EchoTrainLength,
  {any_number('PixelBandwidth', 'ImagingFrequency', 'SliceThickness', 'InversionTime')},
  {SPACING}, {MATRIX}, {number_bars('DiffusionBValue')} as DiffusionBValue,
  min(try_cast(NumberOfTemporalPositions as bigint)) as NumberOfTemporalPositions
from inst where SOPClassUID = '{lookups.MR_CLASS}' group by 1"""


def pt_index() -> str:
    agent = "RadiopharmaceuticalInformationSequence[1]"
    return f"""with {duck_instances(Q.PT_COLUMNS)}
select SeriesInstanceUID, min(array_to_string(SeriesType, '/')) as SeriesType,
  {any_text('Units', 'DecayCorrection', 'RandomsCorrectionMethod', 'ReconstructionMethod')},
  {list_bars('CorrectedImage')} as CorrectedImage,
  {number_bars(dbl('ActualFrameDuration'))} as ActualFrameDuration,
  {any_text('ScatterCorrectionMethod', 'AttenuationCorrectionMethod', 'NumberOfSlices', 'NumberOfTimeSlices')},
  min({agent}.RadionuclideCodeSequence[1].CodeMeaning) as RadionuclideCodeMeaning,
  min(try_cast({agent}.RadionuclideTotalDose as double)) as RadionuclideTotalDose,
  min({agent}.RadiopharmaceuticalStartTime) as RadiopharmaceuticalStartTime,
  min({agent}.Radiopharmaceutical) as Radiopharmaceutical,
  {SPACING}, {MATRIX}, {any_number('SliceThickness')}
from inst where SOPClassUID = '{lookups.PT_CLASS}' group by 1"""


def contrast_index() -> str:
    cells = ("ContrastBolusAgent", "ContrastBolusIngredient", "ContrastBolusRoute")
    return f"""with {duck_instances(Q.CONTRAST_COLUMNS)}, g as (
  select SeriesInstanceUID, {', '.join(f'{bars(c)} as {c}' for c in cells)}
  from inst where Modality in ('CT', 'MR', 'PT', 'XA', 'RF') group by 1)
select * from g where {' or '.join(f"{c} <> ''" for c in cells)}"""


def _preparation(key: str) -> str:
    """Distinct substances per concept from a chain of unnests."""
    lists = ",\n".join(
        f"""  list_sort(list(distinct {{'t': m || ':' || k, 'm': m, 'k': k}})
    filter (where concept = '{code}' and scheme = '{scheme}' and m || ':' || k is not null)) as {name}"""
        for name, (scheme, code) in lookups.PREPARATION_CONCEPTS.items()
    )
    return f"""steps as (
  select {key}, unnest(SpecimenDescriptionSequence[1].SpecimenPreparationSequence) as s from inst where Modality = 'SM'),
contents as (select {key}, unnest(s.SpecimenPreparationStepContentItemSequence) as i from steps),
named as (select {key}, unnest(i.ConceptNameCodeSequence) as n, i.ConceptCodeSequence as cs from contents),
coded as (select {key}, n, unnest(cs) as c from named),
prep_rows as (
  select {key}, n.CodeValue as concept, n.CodingSchemeDesignator as scheme, c.CodeMeaning as m,
    c.CodingSchemeDesignator || ':' || c.CodeValue as k from coded),
prep as (select {key},
{lists}
  from prep_rows group by {key})"""


def _lists() -> str:
    def cell(name: str, field: str) -> str:
        return f"coalesce(array_to_string(list_transform({name}, lambda e: e.{field}), '|'), '')"

    return ", ".join(
        f"{cell(n, 'm')} as {n}_CodeMeaning, {cell(n, 'k')} as {n}_code_designator_value_str"
        for n in lookups.PREPARATION_CONCEPTS
    )


def slide_series() -> str:
    anatomy = "SpecimenDescriptionSequence[1].PrimaryAnatomicStructureSequence[1]"
    coded = {
        "primaryAnatomicStructure": anatomy,
        "primaryAnatomicStructureModifier": f"{anatomy}.PrimaryAnatomicStructureModifierSequence[1]",
        "illuminationType": "OpticalPathSequence[1].IlluminationTypeCodeSequence[1]",
        "admittingDiagnosis": "AdmittingDiagnosesCodeSequence[1]",
    }
    picks = ", ".join(
        f"min({c}.CodingSchemeDesignator || ':' || {c}.CodeValue || ':' || {c}.CodeMeaning) as {n}"
        for n, c in coded.items()
    )
    parts = ", ".join(
        f"split_part({n}, ':', 1) || ':' || split_part({n}, ':', 2) as {n}_code_designator_value_str,"
        f" string_split({n}, ':')[3] as {n}_CodeMeaning"
        for n in coded
    )
    scale = "(1 - floor(log10(abs(nullif(sp, 0)))))"
    return f"""with {duck_instances(Q.SLIDE_COLUMNS)}, {_preparation('SeriesInstanceUID')},
main as (
  select SeriesInstanceUID, min(ContainerIdentifier) as ContainerIdentifier, {picks},
    coalesce(min(try_cast(PixelSpacing[1] as double)),
      min(try_cast(SharedFunctionalGroupsSequence[1].PixelMeasuresSequence[1].PixelSpacing[1] as double))) as sp,
    coalesce(max(TotalPixelMatrixColumns), max("Columns")) as max_TotalPixelMatrixColumns,
    coalesce(max(TotalPixelMatrixRows), max("Rows")) as max_TotalPixelMatrixRows,
    min(try_cast(OpticalPathSequence[1].ObjectiveLensPower as bigint)) as ObjectiveLensPower
  from inst where Modality = 'SM' group by 1)
select main.SeriesInstanceUID, ContainerIdentifier, {_lists()},
  case when sp = 0 then 0.0 else round(sp * pow(10.0, {scale})) / pow(10.0, {scale}) end as min_PixelSpacing_2sf,
  max_TotalPixelMatrixColumns, max_TotalPixelMatrixRows, ObjectiveLensPower, {parts}
from main left join prep on main.SeriesInstanceUID = prep.SeriesInstanceUID"""


def slide_instance() -> str:
    return f"""with {duck_instances(Q.SLIDE_INSTANCE_COLUMNS)}, {_preparation('SOPInstanceUID')}
select inst.SOPInstanceUID, SeriesInstanceUID, {_lists()},
  try_cast(SharedFunctionalGroupsSequence[1].PixelMeasuresSequence[1].PixelSpacing[1] as double) as PixelSpacing_0,
  array_to_string(ImageType, '|') as ImageType, TransferSyntaxUID, instance_size,
  TotalPixelMatrixColumns, TotalPixelMatrixRows, crdc_instance_uuid
from inst left join prep on inst.SOPInstanceUID = prep.SOPInstanceUID where Modality = 'SM'"""


def nested_arrays() -> str:
    return f"""with {duck_instances([*Q.IDS, 'SpecimenDescriptionSequence'])}, {_preparation('SOPInstanceUID').replace(" where Modality = 'SM'", "")}
select SOPInstanceUID, concept, k as code, m as meaning from prep_rows"""


def _segmented() -> str:
    return """refs as (
  select SOPInstanceUID as seg, coalesce(
    ReferencedSeriesSequence[1].ReferencedInstanceSequence[1].ReferencedSOPInstanceUID,
    ReferencedImageSequence[1].ReferencedSOPInstanceUID,
    SourceImageSequence[1].ReferencedSOPInstanceUID) as target
  from inst where Modality = 'SEG'),
found as (select seg, i.SeriesInstanceUID as segmented from refs join inst i on target = i.SOPInstanceUID),
segs as (select SeriesInstanceUID, SOPInstanceUID, SegmentationType, unnest(SegmentSequence) as s
  from inst where Modality = 'SEG')"""


def segmentation_index() -> str:
    return f"""with {duck_instances(Q.SEG_COLUMNS)}, {_segmented()}
select SeriesInstanceUID, min(SegmentationType) as SegmentationType,
  count(distinct s.SegmentNumber) as total_segments,
  {commas('s.SegmentAlgorithmType')} as AlgorithmType,
  {commas('s.SegmentAlgorithmName[1]')} as AlgorithmName,
  min(segmented) as segmented_SeriesInstanceUID,
  {bars('s.SegmentedPropertyCategoryCodeSequence[1].CodeMeaning')} as SegmentedPropertyCategory_CodeMeanings,
  {bars('s.SegmentedPropertyTypeCodeSequence[1].CodeMeaning')} as SegmentedPropertyType_CodeMeanings,
  {bars('s.AnatomicRegionSequence[1].CodeMeaning')} as AnatomicRegion_CodeMeanings
from segs left join found on SOPInstanceUID = seg group by 1"""


def segmented_series() -> str:
    return f"""with {duck_instances(Q.SEG_COLUMNS)}, {_segmented()}
select SeriesInstanceUID, min(segmented) as segmented_SeriesInstanceUID
from segs join found on SOPInstanceUID = seg group by 1"""


def structure_set_index() -> str:
    return f"""with {duck_instances(Q.RT_COLUMNS)},
rt as (select * from inst where SOPClassUID = '{lookups.RTSTRUCT_CLASS}'),
roi as (select SeriesInstanceUID, SOPInstanceUID, unnest(StructureSetROISequence) as r from rt),
obs as (select SOPInstanceUID, unnest(RTROIObservationsSequence) as o from rt),
frames as (select SOPInstanceUID, unnest(ReferencedFrameOfReferenceSequence) as f from rt),
studies as (select SOPInstanceUID, unnest(f.RTReferencedStudySequence) as st from frames),
series as (select SOPInstanceUID, unnest(st.RTReferencedSeriesSequence) as se from studies)
select roi.SeriesInstanceUID, count(distinct r.ROINumber) as total_rois,
  {bars('r.ROIName')} as ROINames, {bars('r.ROIGenerationAlgorithm')} as ROIGenerationAlgorithms,
  {bars('o.RTROIInterpretedType')} as RTROIInterpretedTypes,
  min(se.SeriesInstanceUID) as referenced_SeriesInstanceUID
from roi left join obs on roi.SOPInstanceUID = obs.SOPInstanceUID and r.ROINumber = o.ReferencedROINumber
left join series on roi.SOPInstanceUID = series.SOPInstanceUID group by 1"""


def annotation_index() -> str:
    return f"""with {duck_instances(Q.ANN_COLUMNS)}
select SeriesInstanceUID, AnnotationCoordinateType,
  ReferencedSeriesSequence[1].SeriesInstanceUID as referenced_SeriesInstanceUID
from inst where SOPClassUID = '{lookups.ANN_CLASS}'"""


def annotation_groups() -> str:
    plain = ("Number", "UID", "Label", "GenerationType")
    category, kind = "g.AnnotationPropertyCategoryCodeSequence[1]", "g.AnnotationPropertyTypeCodeSequence[1]"
    return f"""with {duck_instances(Q.ANN_GROUP_COLUMNS)}, groups as (
  select SeriesInstanceUID, unnest(AnnotationGroupSequence) as g from inst
  where SOPClassUID = '{lookups.ANN_CLASS}')
select SeriesInstanceUID, {', '.join(f'g.AnnotationGroup{p} as AnnotationGroup{p}' for p in plain)},
  g.NumberOfAnnotations as NumberOfAnnotations, g.GraphicType as GraphicType,
  {category}.CodingSchemeDesignator || ':' || {category}.CodeValue as AnnotationPropertyCategory_code,
  {category}.CodeMeaning as AnnotationPropertyCategory_CodeMeaning,
  {kind}.CodingSchemeDesignator || ':' || {kind}.CodeValue as AnnotationPropertyType_code,
  {kind}.CodeMeaning as AnnotationPropertyType_CodeMeaning,
  g.AnnotationGroupAlgorithmIdentificationSequence[1].AlgorithmName as AlgorithmName
from groups"""


VOLUME = f"('{lookups.CT_CLASS}', '{lookups.MR_CLASS}', '{lookups.PT_CLASS}')"


def _geometry() -> str:
    """Vectors of every instance of a volume class, as arrays, with products by list functions."""

    def triple(column: str, start: int) -> str:
        part = f"list_transform({column}[{start}:{start + 2}], lambda x: try_cast(x as double))"
        return f"case when list_count({part}) = 3 then cast({part} as double[3]) end"

    return f"""arrays as (select *, {triple('ImageOrientationPatient', 1)} as along, {triple('ImageOrientationPatient', 4)} as down,
  {triple('ImagePositionPatient', 1)} as corner from inst where SOPClassUID in {VOLUME}),
facing as (select *, array_cross_product(along, down) as normal from arrays),
placed as (select *, array_inner_product(corner, normal) as pos, sqrt(array_inner_product(normal, normal)) as len,
  array_inner_product(corner, along) as inrow, array_inner_product(corner, down) as incol from facing),
stacks as (select SeriesInstanceUID, list_sort(list(pos) filter (where pos is not null)) as stack,
  count(*) as slices from placed group by 1),
steps as (select *, (stack[-1] - stack[1]) / nullif(slices - 1, 0) as want,
  list_transform(range(1, len(stack)), lambda i: stack[i + 1] - stack[i]) as gaps from stacks)"""


def volume_geometry() -> str:
    verdicts = {
        "single_orientation": "orientations = 1",
        "orthogonal_orientation": "list_min(lens) between 0.99 and 1.01 and list_max(lens) between 0.99 and 1.01",
        "unique_slice_positions": "instances = coalesce(len(list_distinct(stack)), 0)",
        "consistent_in_plane_row": "list_max(inrows) - list_min(inrows) < 0.1",
        "consistent_in_plane_col": "list_max(incols) - list_min(incols) < 0.1",
        "consistent_pixel_spacing": "spacings = 1",
        "consistent_image_dimensions": "heights = 1 and widths = 1",
        "uniform_slice_spacing": "greatest(abs(list_min(gaps) - want), abs(list_max(gaps) - want)) < abs(want) / 100",
    }
    cells = ", ".join(f"{rule} as {name}" for name, rule in verdicts.items())
    return f"""with {duck_instances(Q.GEOMETRY_COLUMNS)}, {_geometry()},
facts as (select SeriesInstanceUID, list(len) as lens, list(inrow) as inrows, list(incol) as incols,
    count(distinct array_to_string(ImageOrientationPatient, '/')) as orientations,
    count(distinct array_to_string(PixelSpacing, '/')) as spacings, count(distinct SOPInstanceUID) as instances,
    count(distinct "Rows") as heights, count(distinct "Columns") as widths,
    min(case when len > 0 then round(degrees(acos(least(1.0,
      list_max(list_transform(cast(normal as double[]), lambda x: abs(x))) / len))), 2) end)
      as obliquity_degrees,
    bool_or(list_contains(ImageType, 'LOCALIZER')
      or len(list_filter(ImageType, lambda t: contains(t, 'MIP'))) > 0) as overview
  from placed group by 1),
judged as (select SeriesInstanceUID, {cells}, obliquity_degrees from facts join steps using (SeriesInstanceUID)
  where not coalesce(overview, false))
select *, {' and '.join(verdicts)} as regularly_spaced_3d_volume from judged"""


def slice_intervals() -> str:
    return f"""with {duck_instances(Q.GEOMETRY_COLUMNS)}, {_geometry()},
ordered as (select SeriesInstanceUID, unnest(list(struct_pack(s := SOPInstanceUID, p := pos)
    order by pos nulls first, SOPInstanceUID)) as one,
    unnest(range(1, count(*) + 1)) as i, list(pos order by pos nulls first, SOPInstanceUID) as all_pos
  from placed group by SeriesInstanceUID)
select o.SeriesInstanceUID, one.s as SOPInstanceUID, round(one.p, 9) as slice_position,
  round(all_pos[i + 1] - one.p, 9) as slice_interval, round(want, 9) as expected_spacing
from ordered o join steps using (SeriesInstanceUID)"""


def slice_positions() -> str:
    cells = {
        "slice_position": "pos", "normal_length": "len", "in_plane_row": "inrow",
        "in_plane_col": "incol", "normal_x": "normal[1]", "normal_y": "normal[2]", "normal_z": "normal[3]",
    }
    return f"""with {duck_instances(Q.GEOMETRY_COLUMNS)}, {_geometry()}
select SeriesInstanceUID, SOPInstanceUID, {", ".join(f"round({v}, 9) as {k}" for k, v in cells.items())}
from placed"""


_PATTERNS = ", ".join(f"('{p}')" for p in lookups.SHARED_COLLECTION_PATTERNS)

STUDIES = f"""wanted as (
  select distinct collection_id as c from inst, (values {_PATTERNS}) patterns(pattern) where collection_id like pattern),
looks as (
  select StudyInstanceUID, list(distinct struct_pack(c := collection_id, p := PatientID)) as owners,
    min(cast(StudyDate as varchar)) as StudyDate, min(StudyDescription) as StudyDescription,
    coalesce(bool_or(Modality = 'SM'), false) as slides
  from inst semi join wanted on c = collection_id group by StudyInstanceUID),
studies as (
  select list_min(list_transform(owners, lambda o: o.c)) as collection_id,
    list_min(list_transform(owners, lambda o: o.p)) as PatientID, StudyInstanceUID, StudyDate, StudyDescription,
    if(slides, 'M', 'R') as study_type from looks)"""

CASES = f"""cases as (
  select case when n_regionkey = 1 then case when c_mktsegment < 'F' then 'CPTAC-2' else 'CPTAC-3' end
    else upper(n_name) end as project_id, cast(c_custkey as varchar) as submitter_id,
    unnest(case when c_mktsegment = 'BUILDING'
      then ['case-' || cast(c_custkey as varchar), 'b-case-' || cast(c_custkey as varchar)]
      else ['case-' || cast(c_custkey as varchar)] end) as case_id
  from customer join nation on c_nationkey = n_nationkey where c_acctbal > 0),
projects as (
  select {COLLECTION} as collection_id, unnest(case when n_regionkey = 1 then ['CPTAC-2', 'CPTAC-3']
    else [upper(n_name)] end) as project_id
  from nation where not (n_regionkey = 4 and n_nationkey > 20)),
picked as (
  select collection_id, submitter_id as PatientID, min(case_id) as gdc_case_id
  from cases join projects on cases.project_id = projects.project_id group by 1, 2)"""

MATCHED = """matched as (
  select studies.*, gdc_case_id from studies left join picked
  on studies.collection_id = picked.collection_id and studies.PatientID = picked.PatientID)"""


def with_studies(tail: str, *more: str) -> str:
    return f"with {', '.join([duck_instances(Q.STUDY_COLUMNS), STUDIES, *more])} {tail}"


def unknown_class_codes() -> str:
    known = [
        u for u in lookups.SOP_CLASS_NAMES if u not in (lookups.SEG_CLASS, lookups.ANN_CLASS)
    ]
    quoted = ", ".join(f"'{u}'" for u in known)
    return f"""with {duck_instances(['SOPClassUID'])}
select SOPClassUID as uid, count(*) as rows from inst where SOPClassUID not in ({quoted}) group by 1"""


def rejected_series() -> str:
    known = [u for u in lookups.SOP_CLASS_NAMES if u not in (lookups.SEG_CLASS, lookups.ANN_CLASS)]
    listed = "[" + ", ".join(f"'{u}'" for u in known) + "]"
    return f"""with {duck_instances(['SeriesInstanceUID', 'SOPClassUID'])}
select SeriesInstanceUID, 'Unmapped SOPClassUID: ' || coalesce(list_min(list(SOPClassUID)), 'NULL') as message,
  count(*) as rows
from inst where not coalesce(list_contains({listed}, SOPClassUID), false) group by 1"""


SIGNIFICANT = f"""with t as (
  select {INSTANCE_KEY} as id, l_extendedprice as p, l_discount / 7 as s from lineitem),
k as (select *, cast(1 - floor(log10(abs(p))) as int) as kp, cast(1 - floor(log10(abs(nullif(s, 0)))) as int) as ks from t)
select id, case when kp >= 0 then round(p * pow(10.0, kp)) / pow(10.0, kp)
    else round(p / pow(10.0, -kp)) * pow(10.0, -kp) end as price_2sf,
  round(case when s = 0 then 0.0 else round(s * pow(10.0, ks)) / pow(10.0, ks) end, 12) as small_2sf from k"""


def safe_casts() -> str:
    return f"""with {duck_instances(['SOPInstanceUID', 'instance_size', 'EchoTrainLength', 'KVP'])}
select SOPInstanceUID, try_cast(instance_size as double) as bytes,
  try_cast(EchoTrainLength as bigint) as echoes, try_cast(KVP as double) as kvp from inst"""


def ordered_positions() -> str:
    return f"""with ct as ({ct_index()})
select SeriesInstanceUID, row_number() over (
  partition by split_part(ConvolutionKernel, '|', 1)
  order by KVP asc nulls last, SliceThickness asc nulls last, SeriesInstanceUID) as place from ct"""


ORDERS_PAIR = """a as (
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
    case when o_orderstatus = 'F' then o_totalprice end as amount from orders),
b as (
  select o_orderkey, cast(o_custkey as double) as o_custkey,
    case when o_totalprice > 400000 then 'X' else o_orderstatus end as o_orderstatus, o_totalprice,
    substr(o_orderpriority, 1, 3) as o_orderpriority,
    case when o_totalprice > 100000 then o_totalprice end as amount, cast(year(o_orderdate) as int) as o_year
  from orders where o_orderpriority <> '5-LOW')"""

LINES_PAIR = """a as (
  select l_orderkey, l_returnflag, l_linenumber, case when l_quantity > 10 then l_linestatus end as status from lineitem),
b as (
  select l_orderkey, l_returnflag, l_linenumber, case when l_quantity < 40 then l_linestatus end as status
  from lineitem where l_discount > 0.02)"""


def keyed_diff(pair: str, key: str, cells: list[str]) -> str:
    parts = " union all ".join(
        f"""select '{c}' as "column", count(*) as pairs, count(*) filter (where a.{c} <> b.{c}) as differing,
  count(*) filter (where a.{c} is distinct from b.{c}) as unequal from a join b on a.{key} = b.{key}"""
        for c in cells
    )
    return f"""with {pair}, d as ({parts})
select *, round(differing * 100.0e0 / pairs, 6) as percent, unequal = 0 as identical,
  cast(row_number() over (order by differing desc, "column") as int) as rank from d"""


def keyed_samples() -> str:
    cells = {
        "amount": "varchar",
        "o_custkey": "varchar",
        "o_orderpriority": "varchar",
        "o_orderstatus": "varchar",
        "o_totalprice": "varchar",
    }
    parts = " union all ".join(
        f"""select '{c}' as "column", a.o_orderkey, cast(a.{c} as {t}) as left_value,
  cast(b.{c} as {t}) as right_value from a join b on a.o_orderkey = b.o_orderkey where a.{c} <> b.{c}"""
        for c, t in cells.items()
    )
    return f"""with {ORDERS_PAIR}, d as ({parts}), r as (
  select *, row_number() over (partition by "column" order by o_orderkey) as sample from d)
select "column", cast(sample as int) as sample, o_orderkey, left_value, right_value from r where sample <= 5"""


def multiset_diff() -> str:
    cells = "l_linenumber, l_orderkey, l_returnflag, status"
    return f"""with {LINES_PAIR}, t as (
  select {cells}, 1 as w from a union all select {cells}, -1 from b),
g as (select {cells}, sum(w) as w from t group by all)
select {cells}, case when w > 0 then 'left' else 'right' end as surplus_side,
  cast(abs(w) as bigint) as surplus from g where w <> 0"""


def profile_diff() -> str:
    def side(t: str, tag: str, c: str) -> str:
        f = {
            "mean": f"avg({t}.{c})", "median": f"median(cast({t}.{c} as double))",
            "std": f"stddev_samp({t}.{c})", "min": f"cast(min({t}.{c}) as double)",
            "max": f"cast(max({t}.{c}) as double)",
        }
        return ", ".join(f"(select round({x}, 4) from {t}) as {tag}_{n}" for n, x in f.items())

    rows = " union all ".join(
        f"""select '{c}' as "column", {side('a', 'left', c)}, {side('b', 'right', c)}"""
        for c in ("amount", "o_custkey", "o_orderkey", "o_totalprice")
    )
    return f"with {ORDERS_PAIR} {rows}"


def _bytes() -> str:
    wide = {"o_orderkey": "8", "o_custkey": "8", "o_totalprice": "8", "amount": "8", "o_year": "4"}

    def one(t: str, c: str) -> str:
        size = f"case when {c} is null then 0 else {wide[c]} end" if c in wide else f"coalesce(strlen({c}), 0)"
        return f"""select '{c}' as "column", cast(sum({size}) as bigint) as bytes from {t}"""

    shared = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "amount"]
    left = " union all ".join(one("a", c) for c in shared)
    right = " union all ".join(one("b", c) for c in [*shared, "o_year"])
    return f"""{ORDERS_PAIR}, lb as ({left}), rb as ({right}), bd as (
  select coalesce(lb."column", rb."column") as "column", lb.bytes as left_bytes, rb.bytes as right_bytes
  from lb full join rb on lb."column" = rb."column"),
bx as (select *, abs(coalesce(left_bytes, 0) - coalesce(right_bytes, 0)) as difference,
  round(abs(coalesce(left_bytes, 0) - coalesce(right_bytes, 0)) * 100.0e0
    / greatest(coalesce(left_bytes, 0), coalesce(right_bytes, 0)), 6) as percent,
  left_bytes is not null and right_bytes is not null as common from bd)"""


TOTALS = """select cast(sum(left_bytes) as bigint) as left_bytes, cast(sum(right_bytes) as bigint) as right_bytes,
  cast(coalesce(sum(left_bytes) filter (where common), 0) as bigint) as left_common_bytes,
  cast(coalesce(sum(right_bytes) filter (where common), 0) as bigint) as right_common_bytes,
  cast(coalesce(sum(left_bytes) filter (where not common), 0) as bigint) as left_only_bytes,
  cast(coalesce(sum(right_bytes) filter (where not common), 0) as bigint) as right_only_bytes from bx"""

def _described(side: str) -> str:
    """Column names and Spark's names of the types of one side of the orders pair."""
    spelled = "replace(replace(lower(column_type), 'varchar', 'string'), 'integer', 'int')"
    return f"(select column_name as col, {spelled} as kind from (describe with {ORDERS_PAIR} select * from {side}))"


def comparison_overview() -> str:
    return f"""with {_bytes()}, l as {_described('a')}, r as {_described('b')}
select coalesce(l.col, r.col) as "column", l.kind as left_type, r.kind as right_type,
  case when r.col is null then 'only_left' when l.col is null then 'only_right'
    when l.kind = r.kind then 'same' else 'type_differs' end as status, left_bytes, right_bytes
from l full join r on l.col = r.col left join bx on coalesce(l.col, r.col) = bx."column" """


def shape_diff() -> str:
    cells = {f"{side}_{what}": query for side, t in (("left", "a"), ("right", "b")) for what, query in (
        ("rows", f"(select count(*) from {t})"), ("columns", f"(select count(*) from {_described(t)})"))}
    return f"""with {ORDERS_PAIR}, n as (select {", ".join(f"{q} as {c}" for c, q in cells.items())})
select *, left_rows = right_rows and left_columns = right_columns as same_shape from n"""


_BIG = "(9007199254740992 + o_orderkey)"
_HUGE = "(cast(4611686018427387904 as bigint) + o_orderkey * 256)"
TYPED_PAIR = f"""a as (
  select o_orderkey, cast(o_custkey as double) as exact, cast({_BIG} as hugeint) as large, cast({_HUGE} as hugeint) as huge, o_custkey as whole,
    cast(o_orderkey as varchar) as text, o_custkey as pairs from orders),
b as (
  select o_orderkey, cast(o_custkey as double) as exact, cast(cast({_BIG} as double) as hugeint) as large, cast(cast({_HUGE} as double) as hugeint) as huge,
    o_custkey as whole, cast(o_orderkey + (o_orderkey % 5 = 0)::int as varchar) as text,
    case when o_orderstatus = 'P' then -1 else o_custkey end as pairs from orders)"""


def typed_multiset() -> str:
    cells = "exact, cast(whole as varchar) as whole, text"
    return f"""with {TYPED_PAIR}, t as (select {cells}, 1 as w from a union all select {cells}, -1 from b),
g as (select exact, whole, text, sum(w) as w from t group by all)
select exact, whole, text, if(w > 0, 'left', 'right') as surplus_side, cast(abs(w) as bigint) as surplus from g where w <> 0"""


def column_surplus() -> str:
    parts = " union all ".join(
        f"""select '{c}' as "column", cast({c} as varchar) as v, {w} as w from {t}"""
        for c in ("l_linenumber", "l_orderkey", "l_returnflag", "status")
        for t, w in (("a", 1), ("b", -1))
    )
    return f"""with {LINES_PAIR}, t as ({parts}), g as (select "column", v, sum(w) as w from t group by all)
select "column", cast(coalesce(sum(w) filter (w > 0), 0) as bigint) as left_surplus,
  cast(coalesce(-sum(w) filter (w < 0), 0) as bigint) as right_surplus from g group by 1"""


def nan_medians() -> str:
    def middle(v: str) -> str:
        s = f"list_sort(list({v}))"
        m = f"({s}[(count(*) + 1) // 2] / 2 + {s}[count(*) // 2 + 1] / 2)"
        return f"case when isnan({m}) then 'NaN' when isinf({m}) then 'Infinity' else cast(round({m}, 4) as varchar) end"

    v = "case when l_quantity > 10 then cast('{}' as double) else l_quantity end"
    return f"""select 'v' as "column", {middle(v.format('nan'))} as left_median, {middle(v.format('inf'))} as right_median from lineitem
union all select 'w', {middle('l_tax')}, {middle('l_tax')} from lineitem"""


def wide_bytes() -> str:
    cells = {f"c{i:02}": f"substr(o_orderpriority, 1, {1 + i % 9}) || '{'x' * i}'" for i in range(30)}
    rows = " union all ".join(
        f"""select '{c}' as "column", sum(strlen({cell})) as l, sum(strlen({cell} || '{'y' * (i % 26)}')) as r from orders"""
        for i, (c, cell) in enumerate(cells.items())
    )
    return f"""with d as ({rows})
select "column", cast(l as bigint) as left_bytes, cast(r as bigint) as right_bytes, cast(abs(l - r) as bigint) as difference,
  round(abs(l - r) * 100.0e0 / greatest(l, r), 6) as percent, true as common
from d where l <> r order by difference desc, "column" limit 20"""


def published_order() -> str:
    return f"""with ct as ({ct_index()})
select SeriesInstanceUID, SliceThickness, row_number() over (
  order by SliceThickness asc nulls last, SeriesInstanceUID desc) as place from ct"""


def published_dictionary() -> str:
    return f"""with n as (select count(*) as rows from ({contrast_index()}))
select position, name, type, mode, description, '24.0' as version, rows from n, (values
  (0, 'SeriesInstanceUID', 'STRING', 'NULLABLE', 'key of a series'),
  (1, 'ContrastBolusAgent', 'STRING', 'REPEATED', 'agents'),
  (2, 'ContrastBolusIngredient', 'STRING', 'REPEATED', ''),
  (3, 'ContrastBolusRoute', 'STRING', 'REPEATED', '')) v(position, name, type, mode, description)"""


def refused_types() -> str:
    counts = " union all ".join(f"""select '{t}' as "table", count(*) as rows from {t}""" for t in Q.TABLES)
    return f"""select column_name as place, 'timestamp_ntz' as type, t."table", rows
from ({counts}) t join duckdb_columns() on table_name = t."table" where data_type = 'TIMESTAMP'"""


#: Where the given tables lie: the folder that the view of one of them names, among those there are.
HOME = r"""home as (
  select regexp_extract(sql, '[''"]([^''"]*)/documents\.parquet', 1) as folder from duckdb_views()
  where view_name = 'documents')"""
FILES = "/root/testdata/*/*.parquet"


def checksums() -> str:
    return f"""with {HOME}
select parse_filename(filename) as file, sha256(content) as sha256
from read_blob('{FILES}') join home on parse_dirpath(filename) = folder"""


def size_report() -> str:
    return f"""with {HOME}, parts as (
  select parse_filename(b.filename, true) as "table", num_rows as rows, size as bytes
  from read_blob('{FILES}') b join parquet_file_metadata('{FILES}') m on m.file_name = b.filename
  join home on parse_dirpath(b.filename) = folder),
tables as (select "table", sum(rows) as rows, count(*) as files, sum(bytes) as bytes from parts group by 1)
select "table", cast(rows as bigint) as rows, files, cast(bytes as bigint) as bytes from tables
union all select 'total', cast(sum(rows) as bigint), cast(sum(files) as bigint), cast(sum(bytes) as bigint) from tables"""


#: Columns of the given tables that do not enter a digest as their plain text.
DIGEST_CELLS = {
    "embedding": "array_to_string(list_transform(embedding, lambda x: cast(floor(cast(x as double) * 1000000) as bigint)), ',')",
    "ts": "epoch_us(ts)", "l_shipdate": "epoch_us(l_shipdate)", "o_orderdate": "epoch_us(o_orderdate)",
}
DIGEST_CELLS |= {
    c: f"cast(floor({c} * 1000000) as bigint)"
    for c in "c_acctbal s_acctbal value l_quantity l_extendedprice l_discount l_tax o_totalprice p_retailprice".split()
}
COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax"
    " l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props", "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label", "pages": "page_id url html", "benchmark": "item_id text",
    "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}


def content_digests() -> str:
    def part(name: str, columns: list[str]) -> str:
        texts = [f"cast({DIGEST_CELLS.get(c, c)} as varchar)" for c in columns]
        cells = " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts)
        sums = [
            f"cast(coalesce(sum(cast(cast('0x' || h[{a}:{a + 14}] as bigint) as hugeint)), 0) % 1152921504606846976 as bigint)"
            for a in (1, 16)
        ]
        return f"""select count(*) as rows, {sums[0]} as digest, {sums[1]} as second_digest, '{name}' as "table"
from (select sha256({cells}) as h from {name})"""

    return " union all ".join(part(name, columns.split()) for name, columns in COLUMNS.items())


def oracle_sql() -> dict[str, str]:
    return {
        "series_index": series_index(),
        "version_span": f"with {SPAN} select * from span",
        "prior_versions": prior_versions(),
        "collections_index": COLLECTIONS,
        "analysis_results_index": RESULTS,
        "clinical_index": CLINICAL,
        "version_metadata": RELEASES,
        "latest_version": f"select max(idc_version) as latest_idc_version from ({RELEASES})",
        "ct_index": ct_index(),
        "mr_index": mr_index(),
        "pt_index": pt_index(),
        "contrast_index": contrast_index(),
        "slide_series": slide_series(),
        "slide_instance": slide_instance(),
        "segmentation_index": segmentation_index(),
        "structure_set_index": structure_set_index(),
        "annotation_index": annotation_index(),
        "annotation_groups": annotation_groups(),
        "volume_geometry": volume_geometry(),
        "study_selection": with_studies("select * from studies"),
        "catalogue_mapping": with_studies(
            "select * from matched where gdc_case_id is not null", CASES, MATCHED
        ),
        "column_subset": column_subset(),
        "slice_intervals": slice_intervals(),
        "segmented_series": segmented_series(),
        "unknown_codes": unknown_class_codes(),
        "unmapped_collections": with_studies(
            """select collection_id, count(*) as studies from studies
            where collection_id not in (select collection_id from projects) group by 1""",
            CASES,
        ),
        "cases_by_collection": with_studies(
            "select p.* from picked p semi join studies s on p.collection_id = s.collection_id and p.PatientID = s.PatientID",
            CASES,
        ),
        "catalogue_mapping_checked": with_studies(
            "select * from matched where gdc_case_id is not null", CASES, MATCHED
        ),
        "mapping_validation": with_studies(
            f"""select collection_id, count(gdc_case_id) as matched, count(*) as studies
            from matched where collection_id not in ('{Q.EXEMPT[0]}') group by 1 having count(gdc_case_id) = 0""",
            CASES.replace("where c_acctbal > 0", "where c_acctbal > 0 and upper(n_name) <> 'NATION_9'"),
            MATCHED,
        ),
        "match_summary": with_studies(
            """select count(gdc_case_id) as studies_matched, count(*) as studies,
            count(distinct case when gdc_case_id is not null then collection_id || '/' || PatientID end) as patients_matched,
            count(distinct collection_id || '/' || PatientID) as patients from matched""",
            CASES,
            MATCHED,
        ),
        "nested_arrays": nested_arrays(),
        "significant_figures": SIGNIFICANT,
        "safe_casts": safe_casts(),
        "latest_members": latest_members(),
        "ordered_positions": ordered_positions(),
        "comparison_overview": comparison_overview(),
        "shape_diff": shape_diff(),
        "keyed_diff_types": keyed_diff(TYPED_PAIR, "o_orderkey", ["exact", "huge", "large", "pairs", "text", "whole"]),
        "multiset_diff_types": typed_multiset(),
        "column_surplus": column_surplus(),
        "profile_diff_nan": nan_medians(),
        "published_order": published_order(),
        "published_dictionary": published_dictionary(),
        "refused_types": refused_types(),
        "checksums": checksums(),
        "size_report": size_report(),
        "history_increment": prior_versions(),
        "rejected_series": rejected_series(),
        "content_digests": content_digests(),
        "keyed_diff": keyed_diff(
            ORDERS_PAIR,
            "o_orderkey",
            ["amount", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice"],
        ),
        "keyed_diff_repeated": keyed_diff(
            LINES_PAIR, "l_orderkey", ["l_linenumber", "l_returnflag", "status"]
        ),
        "keyed_samples": keyed_samples(),
        "multiset_diff": multiset_diff(),
        "profile_diff": profile_diff(),
        "column_bytes": """select 'doc_id' as "column", cast(8 * count(doc_id) as bigint) as bytes from documents
            union all select 'text', cast(sum(strlen(text)) as bigint) from documents
            union all select 'lang', cast(sum(strlen(lang)) as bigint) from documents
            union all select 'source', cast(sum(strlen(source)) as bigint) from documents
            union all select 'n_chars', cast(8 * count(n_chars) as bigint) from documents""",
        "bytes_diff": f"with {_bytes()} select * from bx",
        "largest_bytes_differences": wide_bytes(),
        "bytes_totals": f"with {_bytes()} {TOTALS}",
        "published_ct": ct_index(),
        "published_csv": contrast_index(),
        "slice_positions": slice_positions(),
        "revision_sizes": f"""with {BY_VERSION} select cast(v as int) as idc_version, crdc_series_uuid,
            round(sum(try_cast(instance_size as double)) / 1000000, 2) as series_size_MB
            from ver group by 1, 2""",
        "versioned_scan": f"""with {BY_VERSION} select collection_id, Modality, count(*) as instances,
            count(distinct SeriesInstanceUID) as series from ver where v = 3 group by 1, 2""",
        "patient_pairs": with_studies(
            """select distinct collection_id, PatientID from studies
            where collection_id is not null and PatientID is not null"""
        ),
        "match_counts": with_studies(
            """select collection_id, count(gdc_case_id) as matched, count(*) as studies
            from matched group by 1""",
            CASES,
            MATCHED,
        ),
    }
