"""Registered queries: every builder and operator on the given tables.

Array columns are joined with ``|`` in the registered form, so that comparing results
does not depend on how a client renders arrays.
"""

from __future__ import annotations

import functools
import os
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom import lookups
from seriesloom.functions import expr as E
from seriesloom.operators import compare as C
from seriesloom.operators import fragments
from seriesloom.operators import names
from seriesloom.operators.names import unknown_codes
from seriesloom.plans import core, derived, geometry, mapping, modality, slide, versions
from seriesloom.sources import publish
from seriesloom.sources.tables import Tables, write_versioned

from .adapter import COLLECTION, INSTANCE_KEY, instances, lines_with_orders, table

Query = Callable[[SparkSession, str], DataFrame]

# --- columns each builder needs ---------------------------------------------------

IDS = ["SOPInstanceUID", "SeriesInstanceUID"]

SERIES_COLUMNS = [
    *IDS, "StudyInstanceUID", "PatientID", "collection_id", "analysis_result_id", "source_DOI",
    "PatientAge", "PatientSex", "StudyDate", "StudyDescription", "Modality", "SOPClassUID",
    "TransferSyntaxUID", "PhotometricInterpretation", "PixelRepresentation", "Manufacturer",
    "ManufacturerModelName", "SeriesDate", "SeriesDescription", "SeriesNumber",
    "license_short_name", "aws_bucket", "crdc_series_uuid", "series_aws_url", "instance_size",
]
CT_COLUMNS = [
    "SeriesInstanceUID", "SOPClassUID", "ImageType", "PixelSpacing", "Rows", "Columns",
    "SliceThickness", "KVP", "ScanOptions", "ConvolutionKernel", "GantryDetectorTilt",
    "XRayTubeCurrent", "FilterType", "Exposure", "ExposureTime", "DataCollectionDiameter",
    "ReconstructionDiameter", "SpiralPitchFactor",
]
MR_COLUMNS = [
    "SeriesInstanceUID", "SOPClassUID", "PixelSpacing", "Rows", "Columns", "SliceThickness",
    "MagneticFieldStrength", "ScanningSequence", "SequenceVariant", "MRAcquisitionType",
    "EchoTime", "RepetitionTime", "EchoTrainLength", "FlipAngle", "PixelBandwidth",
    "ImagingFrequency", "ImagedNucleus", "InversionTime", "ReceiveCoilName", "SequenceName",
    "DiffusionBValue", "NumberOfTemporalPositions",
]
PT_COLUMNS = [
    "SeriesInstanceUID", "SOPClassUID", "PixelSpacing", "Rows", "Columns", "SliceThickness",
    "SeriesType", "Units", "DecayCorrection", "CorrectedImage", "RandomsCorrectionMethod",
    "ReconstructionMethod", "ActualFrameDuration", "ScatterCorrectionMethod",
    "AttenuationCorrectionMethod", "RadiopharmaceuticalInformationSequence", "NumberOfSlices",
    "NumberOfTimeSlices",
]
CONTRAST_COLUMNS = [
    "SeriesInstanceUID", "Modality", "ContrastBolusAgent", "ContrastBolusIngredient",
    "ContrastBolusRoute",
]
SLIDE_COLUMNS = [
    *IDS, "Modality", "ContainerIdentifier", "PixelSpacing", "SharedFunctionalGroupsSequence",
    "TotalPixelMatrixColumns", "TotalPixelMatrixRows", "Columns", "Rows",
    "OpticalPathSequence", "SpecimenDescriptionSequence", "AdmittingDiagnosesCodeSequence",
]
SLIDE_INSTANCE_COLUMNS = [
    *IDS, "Modality", "SharedFunctionalGroupsSequence", "SpecimenDescriptionSequence",
    "ImageType", "TransferSyntaxUID", "instance_size", "TotalPixelMatrixColumns",
    "TotalPixelMatrixRows", "crdc_instance_uuid",
]
SEG_COLUMNS = [
    *IDS, "Modality", "SOPClassUID", "SegmentationType", "SegmentSequence",
    "ReferencedSeriesSequence", "ReferencedImageSequence", "SourceImageSequence",
]
RT_COLUMNS = [
    *IDS, "SOPClassUID", "StructureSetROISequence", "RTROIObservationsSequence",
    "ReferencedFrameOfReferenceSequence",
]
ANN_COLUMNS = ["SeriesInstanceUID", "SOPClassUID", "AnnotationCoordinateType", "ReferencedSeriesSequence"]
ANN_GROUP_COLUMNS = ["SeriesInstanceUID", "SOPClassUID", "AnnotationGroupSequence"]
GEOMETRY_COLUMNS = [
    *IDS, "SOPClassUID", "ImageType", "ImagePositionPatient", "ImageOrientationPatient",
    "PixelSpacing", "Rows", "Columns",
]
STUDY_COLUMNS = [
    "collection_id", "PatientID", "StudyInstanceUID", "StudyDate", "StudyDescription", "Modality",
]


# --- other inputs -----------------------------------------------------------------


def curated(spark: SparkSession, d: str) -> DataFrame:
    """Curated body parts: none for returned lines, two rows for some instances."""
    lines = table(spark, d, "lineitem").where("l_returnflag <> 'R'")
    once = lines.selectExpr(f"{INSTANCE_KEY} as SOPInstanceUID", "'PART ' || l_linestatus as BodyPartExamined")
    again = lines.where("l_quantity = 30").selectExpr(
        f"{INSTANCE_KEY} as SOPInstanceUID", "'AGAIN' as BodyPartExamined"
    )
    return once.unionByName(again)


def bookkeeping(spark: SparkSession, d: str) -> DataFrame:
    """Version bookkeeping at instance grain."""
    return table(spark, d, "lineitem").selectExpr(
        "cast(l_orderkey as string) as SeriesInstanceUID",
        "cast(year(l_shipdate) - 1994 as bigint) as series_init_idc_version",
        "cast(year(l_shipdate) - 1994 + l_linenumber as bigint) as series_revised_idc_version",
    )


def instances_by_version(spark: SparkSession, d: str) -> DataFrame:
    """Instances of all releases: a patient's series of one priority live in many years."""
    lines = lines_with_orders(spark, d)
    series = "cast(o_custkey as string) || '.' || o_orderpriority"
    return lines.selectExpr(
        "cast(year(o_orderdate) - 1994 as int) as idc_version",
        "'collection_' || lower(o_orderstatus) as collection_id",
        "cast(o_custkey as string) as PatientID",
        f"{series} as SeriesInstanceUID",
        "cast(o_custkey as string) as StudyInstanceUID",
        "'M' || substr(o_orderpriority, 1, 1) as Modality",
        """case l_linenumber when 1 then 'gs://public-datasets-idc/a' when 2 then 'gs://idc-open-idc1/b'
           when 3 then 'gs://idc-open-cr/c' when 4 then 'gs://idc-open-idc/d' when 5 then 'gs://other/e'
           when 6 then 'no bucket' end as gcs_url""",
        f"case when l_tax < 0.075 then {series} || '.' || o_orderstatus end as crdc_series_uuid",
        "case when l_quantity = 50 then 'n/a' else cast(cast(l_quantity as int) * 10000 + 1 as string) end as instance_size",
    )


LATEST = 7
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def study_rows(spark: SparkSession, d: str) -> DataFrame:
    return mapping.study_selection(instances(spark, d, STUDY_COLUMNS))


def cases(spark: SparkSession, d: str) -> DataFrame:
    """Case catalogue: customers with money, some registered twice."""
    rows = table(spark, d, "customer").where("c_acctbal > 0").join(
        F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")
    )
    project = """case n_regionkey when 1 then case when c_mktsegment < 'F' then 'CPTAC-2' else 'CPTAC-3' end
      else upper(n_name) end"""
    first = rows.selectExpr(
        f"{project} as project_id", "cast(c_custkey as string) as submitter_id",
        "'case-' || cast(c_custkey as string) as case_id",
    )
    second = rows.where("c_mktsegment = 'BUILDING'").selectExpr(
        f"{project} as project_id", "cast(c_custkey as string) as submitter_id",
        "'b-case-' || cast(c_custkey as string) as case_id",
    )
    return first.unionByName(second)


def projects(spark: SparkSession, d: str) -> DataFrame:
    """Collections of the nations, except those of region 4 with a key above 20."""
    nation = table(spark, d, "nation").where("not (n_regionkey = 4 and n_nationkey > 20)")
    return nation.selectExpr(
        f"{COLLECTION} as collection_id",
        "case when n_regionkey = 1 then array('CPTAC-2', 'CPTAC-3') else array(upper(n_name)) end as project_ids",
    )


#: A collection of the test data that no project serves.
EXEMPT = ("hcmi_nation_24",)


def matched(spark: SparkSession, d: str) -> DataFrame:
    return mapping.attach_cases(study_rows(spark, d), cases(spark, d), projects(spark, d))


def orders_pair(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two editions of the orders table for the comparison operators."""
    left = table(spark, d, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        "case when o_orderstatus = 'F' then o_totalprice end as amount",
    )
    right = table(spark, d, "orders").where("o_orderpriority <> '5-LOW'").selectExpr(
        "o_orderkey", "cast(o_custkey as double) as o_custkey",
        "case when o_totalprice > 400000 then 'X' else o_orderstatus end as o_orderstatus",
        "o_totalprice", "substr(o_orderpriority, 1, 3) as o_orderpriority",
        "case when o_totalprice > 100000 then o_totalprice end as amount",
        "year(o_orderdate) as o_year",
    )
    return left, right


def lines_pair(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two line-item editions keyed by order: the key repeats on both sides."""
    left = table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_returnflag", "l_linenumber",
        "case when l_quantity > 10 then l_linestatus end as status",
    )
    right = table(spark, d, "lineitem").where("l_discount > 0.02").selectExpr(
        "l_orderkey", "l_returnflag", "l_linenumber",
        "case when l_quantity < 40 then l_linestatus end as status",
    )
    return left, right


# --- helpers ----------------------------------------------------------------------


def flat(df: DataFrame, decimals: int | None = None) -> DataFrame:
    """Join array columns with ``|``; optionally round doubles."""
    cells = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|", "NULL")
        elif decimals is not None and isinstance(f.dataType, T.DoubleType):
            c = F.round(c, decimals)
        cells.append(c.alias(f.name))
    return df.select(*cells)


def on(builder: Callable[..., DataFrame], names: list[str], decimals: int | None = None) -> Query:
    return lambda spark, d: flat(builder(instances(spark, d, names)), decimals)


def series_index(spark: SparkSession, d: str) -> DataFrame:
    return flat(
        core.series_index(
            instances(spark, d, SERIES_COLUMNS, parts_first=True), curated(spark, d), bookkeeping(spark, d)
        ),
        decimals=8,
    )


def column_subset(spark: SparkSession, d: str) -> DataFrame:
    index = core.series_index(
        instances(spark, d, SERIES_COLUMNS, parts_first=True), curated(spark, d), bookkeeping(spark, d)
    )
    return flat(mapping.column_subset(index), decimals=8)


def collections(spark: SparkSession, d: str) -> DataFrame:
    """Collections metadata made of nations, with their customers as subjects."""
    customers = table(spark, d, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("subjects")
    )
    rows = table(spark, d, "nation").join(
        customers, F.col("n_nationkey") == F.col("c_nationkey"), "left"
    )
    return rows.selectExpr(
        "n_name as collection_name", f"{COLLECTION} as collection_id",
        "case when n_regionkey > 1 then 'Lung' end as cancer_types", "'Chest' as tumor_locations",
        "coalesce(subjects, 0) as subjects", "'Human' as species",
        "array(named_struct('source_id', cast(n_regionkey as string), 'Access', 'Public')) as sources",
        "'Clinical' as supporting_data", "'P' || cast(n_regionkey as string) as program_id",
        "'Completed' as status", "date_add(date '2020-01-01', n_nationkey) as updated",
        "'about ' || n_name as description",
    )


def collections_index(spark: SparkSession, d: str) -> DataFrame:
    out = core.collections_index(collections(spark, d))
    return out.withColumn("sources", F.col("sources")[0]["source_id"])


def analysis_results_index(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "supplier").groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("subjects")
    )
    rows = customers.join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    return core.analysis_results_index(
        rows.selectExpr(
            "'result_' || cast(n_nationkey as string) as analysis_result_id",
            "'Results of ' || n_name as analysis_result_title", "'10.1/' || n_name as source_doi",
            "'https://example.org/' || n_name as source_url", "subjects",
            "lower(n_name) as collections", "'SEG' as modalities",
            "date_add(date '2021-01-01', n_nationkey) as Updated", "'https://example.org/by' as license_url",
            "'Attribution' as license_long_name", "'CC BY' as license_short_name",
            "n_name as description", "'cite ' || n_name as citation",
        )
    )


def clinical_index(spark: SparkSession, d: str) -> DataFrame:
    return core.clinical_index(
        table(spark, d, "part").selectExpr(
            "lower(p_type) as collection_id",
            """case when p_size > 40 then p_name when p_size > 20 then 'project.' || p_name
               else 'project.clinical.' || replace(p_name, ' ', '_') || '.v1' end as table_name""",
            "'c' || cast(p_partkey as string) as column", "p_brand as column_label",
            "cast(p_size as string) as values",
        )
    )


def version_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(
        F.expr("cast(year(o_orderdate) - 1994 as bigint)").alias("idc_version")
    ).agg(F.min("o_orderdate").alias("version_timestamp"))


def history_source(spark: SparkSession, d: str) -> DataFrame:
    return flat(versions.prior_versions_index(instances_by_version(spark, d), LATEST))


# --- single operators -------------------------------------------------------------


def unknown_class_codes(spark: SparkSession, d: str) -> DataFrame:
    known = {
        u: n for u, n in lookups.SOP_CLASS_NAMES.items()
        if u not in (lookups.SEG_CLASS, lookups.ANN_CLASS)
    }
    return unknown_codes(instances(spark, d, ["SOPClassUID"]), "SOPClassUID", known)


def rejected_series(spark: SparkSession, d: str) -> DataFrame:
    """Series on which the strict class lookup fails the job, with the message it fails with."""
    known = {u: n for u, n in lookups.SOP_CLASS_NAMES.items() if u not in (lookups.SEG_CLASS, lookups.ANN_CLASS)}
    rows = instances(spark, d, ["SeriesInstanceUID", "SOPClassUID"])
    return names.rejected_groups(rows, "SeriesInstanceUID", "SOPClassUID", known, "SOPClassUID")


def significant_figures(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr(
        f"{INSTANCE_KEY} as id", "l_extendedprice as price", "l_discount / 7 as small"
    ).select(
        "id",
        E.significant(F.col("price")).alias("price_2sf"),
        F.round(E.significant(F.col("small")), 12).alias("small_2sf"),
    )


def nested_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Sibling arrays of one record unnested to their product, empty lists drop the row."""
    rows = instances(spark, d, [*IDS, "SpecimenDescriptionSequence"])
    step = (
        rows.select("SOPInstanceUID", E.first("SpecimenDescriptionSequence").alias("s"))
        .select("SOPInstanceUID", F.explode("s.SpecimenPreparationSequence").alias("p"))
        .select("SOPInstanceUID", F.explode("p.SpecimenPreparationStepContentItemSequence").alias("i"))
        .select("SOPInstanceUID", "i.ConceptCodeSequence", F.explode("i.ConceptNameCodeSequence").alias("n"))
        .select("SOPInstanceUID", "n", F.explode("ConceptCodeSequence").alias("c"))
    )
    return step.select(
        "SOPInstanceUID",
        F.col("n.CodeValue").alias("concept"),
        E.code_pair(F.col("c")).alias("code"),
        F.col("c.CodeMeaning").alias("meaning"),
    )


def safe_casts(spark: SparkSession, d: str) -> DataFrame:
    rows = instances(spark, d, ["SOPInstanceUID", "instance_size", "EchoTrainLength", "KVP"])
    return rows.select(
        "SOPInstanceUID",
        E.safe_double(rows, "instance_size").alias("bytes"),
        E.safe_long(rows, "EchoTrainLength").alias("echoes"),
        E.safe_double(rows, "KVP").alias("kvp"),
    )


def latest_members(spark: SparkSession, d: str) -> DataFrame:
    """Revisions of the newest release (set membership, the other half of the anti join)."""
    rows = instances_by_version(spark, d)
    alive = rows.where(F.col("idc_version") == LATEST).select("crdc_series_uuid").distinct()
    return (
        rows.join(alive, "crdc_series_uuid", "left_semi")
        .groupBy("crdc_series_uuid")
        .agg(F.countDistinct("idc_version").alias("versions"), F.count(F.lit(1)).alias("instances"))
    )


def ordered_positions(spark: SparkSession, d: str) -> DataFrame:
    """The published CT order (NULLs last, first array element) as a rank per kernel."""
    index = modality.ct_index(instances(spark, d, CT_COLUMNS))
    sizes = [c for name in ("KVP", "SliceThickness") for c in (F.col(name).isNull(), F.col(name))]
    rows = index.withColumn("_kernel", E.first("ConvolutionKernel"))
    placed = fragments.with_position(rows, ["_kernel"], F.struct(*sizes, "SeriesInstanceUID"), "place")
    return placed.select("SeriesInstanceUID", "place")


def slice_positions(spark: SparkSession, d: str) -> DataFrame:
    """Slice normals and projections of every instance of a volume class."""
    return flat(geometry.slice_positions(instances(spark, d, GEOMETRY_COLUMNS)), decimals=9)


def revision_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Size of every revision in every release, all releases in one scan."""
    rows = instances_by_version(spark, d)
    size = E.safe_double(rows, "instance_size")
    return rows.groupBy("idc_version", "crdc_series_uuid").agg(
        F.round(F.sum(size) / 1e6, 2).alias("series_size_MB")
    )


def versioned_scan(spark: SparkSession, d: str) -> DataFrame:
    """Store the instances with one folder per release and read one release back."""
    root = scratch_dir(spark)
    write_versioned(instances_by_version(spark, d), f"{root}/instances_by_version")
    rows = Tables(spark, root).table("instances_by_version", 3)
    return rows.groupBy("collection_id", "Modality").agg(
        F.count(F.lit(1)).alias("instances"),
        F.count_distinct("SeriesInstanceUID").alias("series"),
    )


def published_csv(spark: SparkSession, d: str) -> DataFrame:
    """Write the contrast index as compressed CSV and read it back."""
    path = scratch_dir(spark) + "/contrast_index"
    publish.write_csv(modality.contrast_index(instances(spark, d, CONTRAST_COLUMNS)), path)
    back = spark.read.option("header", True).option("escape", "\\").csv(path)
    arrays = [c for c in back.columns if c != "SeriesInstanceUID"]
    return flat(
        back.select(
            "SeriesInstanceUID",
            *[F.from_json(c, "array<string>").alias(c) for c in arrays],
        )
    )


def patient_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Distinct complete (collection, patient) pairs of the selected studies."""
    return mapping.patient_pairs(study_rows(spark, d))


def match_counts(spark: SparkSession, d: str) -> DataFrame:
    """Matched and all studies of every collection."""
    return matched(spark, d).groupBy("collection_id").agg(
        F.count("gdc_case_id").alias("matched"), F.count(F.lit(1)).alias("studies")
    )


def _diff(f: Callable[..., DataFrame], pair: Callable, *args) -> Query:
    return lambda spark, d: f(*pair(spark, d), *args)


def keyed_diff(spark: SparkSession, d: str) -> DataFrame:
    return counts_as_long(C.keyed_diff(*orders_pair(spark, d), "o_orderkey"))


def keyed_diff_repeated(spark: SparkSession, d: str) -> DataFrame:
    return counts_as_long(C.keyed_diff(*lines_pair(spark, d), "l_orderkey"))


def profile_diff(spark: SparkSession, d: str) -> DataFrame:
    out = C.profile_diff(*orders_pair(spark, d))
    return flat(out, decimals=4)


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder in the folder that all machines share, as spark.checkpoint.dir names it.

    Where the setting is missing, a local session takes a temporary folder and a cluster is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="published-")
    return f"{shared.rstrip('/')}/published-{os.urandom(6).hex()}"


def size_report(spark: SparkSession, d: str) -> DataFrame:
    return publish.size_report(spark, {n: f"{d.rstrip('/')}/{n}.parquet" for n in TABLES})


def checksums(spark: SparkSession, d: str) -> DataFrame:
    return publish.checksums(spark, d)


def published_ct(spark: SparkSession, d: str) -> DataFrame:
    """Write the CT index clustered and stamped, then read it back."""
    path = scratch_dir(spark) + "/ct_index"
    publish.write_parquet(
        modality.ct_index(instances(spark, d, CT_COLUMNS)),
        path,
        order=[F.asc_nulls_last("KVP"), F.asc_nulls_last("SliceThickness"), "SeriesInstanceUID"],
        version="1.0",
    )
    return flat(spark.read.parquet(path))


def published_order(spark: SparkSession, d: str) -> DataFrame:
    """The order in which published rows lie in their files, as a rank over all files.

    The index is written ascending by slice thickness, NULLs last, and by series id descending.
    """
    path = scratch_dir(spark) + "/ct_order"
    order = [F.asc_nulls_last("SliceThickness"), F.desc("SeriesInstanceUID")]
    publish.write_parquet(modality.ct_index(instances(spark, d, CT_COLUMNS)), path, order=order, files=4)
    rows = spark.read.parquet(path).select(
        "SeriesInstanceUID", "SliceThickness",
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"),
    )
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = files.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return rows.join(files, "file").select(
        "SeriesInstanceUID", "SliceThickness", (F.col("before") + F.col("row") + 1).alias("place")
    )


def published_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Column dictionary and version stamp read back from published files, with their rows."""
    path = scratch_dir(spark) + "/contrast"
    publish.write_parquet(
        modality.contrast_index(instances(spark, d, CONTRAST_COLUMNS)), path, version="24.0",
        descriptions={"SeriesInstanceUID": "key of a series", "ContrastBolusAgent": "agents"},
    )
    back = spark.read.parquet(path)
    rows = back.agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit("contrast_index"))
    words = publish.column_dictionary(back, "contrast_index")
    return words.join(rows, "table").select(
        F.col("position").cast("long").alias("position"), "name", "type", "mode", "description",
        F.lit(publish.release_version(back)).alias("version"), "rows",
    )


def refused_types(spark: SparkSession, d: str) -> DataFrame:
    """What publishing refuses of the given tables as they are stored, with the rows that would be lost."""
    parts = []
    for name in TABLES:
        rows = table(spark, d, name)
        counted = rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(name))
        refused = publish.refused_columns(spark, rows.schema).withColumn("table", F.lit(name))
        parts.append(refused.join(counted, "table"))
    return functools.reduce(DataFrame.unionByName, parts)


def checked_mapping(spark: SparkSession, d: str) -> DataFrame:
    """The validated mapping; the collection of EXEMPT has a project without any case."""
    known = projects(spark, d).unionByName(
        spark.range(1).select(
            F.lit(EXEMPT[0]).alias("collection_id"), F.array(F.lit("NO CASES")).alias("project_ids")
        )
    )
    path = scratch_dir(spark) + "/mapping"
    return mapping.write_mapping(study_rows(spark, d), cases(spark, d), path, known, exempt=EXEMPT)


def mapping_validation(spark: SparkSession, d: str) -> DataFrame:
    """Collections without a case, where another one than the exempt collection has none either."""
    fewer = cases(spark, d).where("project_id <> 'NATION_9'")
    rows = mapping.attach_cases(study_rows(spark, d), fewer, projects(spark, d))
    return mapping.collections_without_match(rows, EXEMPT)


def content_digests(spark: SparkSession, d: str) -> DataFrame:
    """Digest of the contents of every table, whatever files they lie in.

    Floating numbers enter in millionths and times in microseconds, which other engines write alike.
    """
    parts = []
    for name in TABLES:
        rows = table(spark, d, name)
        cells = []
        for f in rows.schema.fields:
            c = F.col(f.name)
            if isinstance(f.dataType, T.DoubleType):
                c = F.floor(c * 1e6)
            elif isinstance(f.dataType, T.ArrayType):
                c = F.array_join(F.transform(c, lambda x: F.floor(x.cast("double") * 1e6).cast("string")), ",")
            elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
                c = F.unix_micros(c.cast("timestamp"))
            cells.append(c.alias(f.name))
        parts.append(publish.content_digest(rows.select(*cells)).withColumn("table", F.lit(name)))
    return functools.reduce(DataFrame.unionByName, parts)


def history_increment(spark: SparkSession, d: str) -> DataFrame:
    """The history after one more release, whose instances alone are read then."""
    root = scratch_dir(spark)
    write_versioned(instances_by_version(spark, d), f"{root}/instances_by_version")
    rows = Tables(spark, root).all_versions("instances_by_version")
    versions.update_history(spark, rows, f"{root}/revisions", LATEST - 1)
    return flat(versions.update_history(spark, rows, f"{root}/revisions", LATEST))


def wide_pair(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two editions of a table with 30 text columns, 25 of which differ in bytes."""
    cells = [f"substr(o_orderpriority, 1, {1 + i % 9}) || '{'x' * i}' as c{i:02}" for i in range(30)]
    more = [f"c{i:02} || '{'y' * (i % 26)}' as c{i:02}" for i in range(30)]
    left = table(spark, d, "orders").selectExpr("o_orderkey", *cells)
    return left, left.selectExpr("o_orderkey", *more)


def typed_pair(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two editions of the orders whose columns differ in type, some also in value."""
    big = "cast(9007199254740992 as bigint) + o_orderkey"
    huge = "4611686018427387904L + o_orderkey * 256"
    left = table(spark, d, "orders").selectExpr(
        "o_orderkey", "cast(o_custkey as decimal(12,1)) as exact", f"{big} as large", f"{huge} as huge", "o_custkey as whole",
        "cast(o_orderkey as string) as text", "map('a', o_custkey, 'b', o_orderkey) as pairs",
    )
    right = table(spark, d, "orders").selectExpr(
        "o_orderkey", "cast(o_custkey as decimal(14,3)) as exact", f"cast({big} as double) as large",
        f"cast({huge} as double) as huge", "cast(o_custkey as double) as whole", "o_orderkey + (case when o_orderkey % 5 = 0 then 1 else 0 end) as text",
        "map('b', o_orderkey, 'a', case when o_orderstatus = 'P' then -1 else o_custkey end) as pairs",
    )
    return left, right


def counts_as_long(frame: DataFrame) -> DataFrame:
    kinds = {c: F.col(c).cast("bigint") for c in ("pairs", "differing", "unequal")}
    return frame.withColumns(kinds).withColumn("percent", F.round("percent", 6))


def typed_multiset(spark: SparkSession, d: str) -> DataFrame:
    """Unkeyed rows of unlike types: how often each side has more of them."""
    left, right = (t.select("exact", "whole", "text") for t in typed_pair(spark, d))
    out = C.multiset_diff(left, right)
    return out.select(F.col("exact").cast("double").alias("exact"), F.col("whole"), "text", "surplus_side", "surplus")


def nan_pair(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Line items whose middle value is NaN on the left and infinite on the right."""
    left = table(spark, d, "lineitem").selectExpr(
        "case when l_quantity > 10 then double('NaN') else l_quantity end as v", "l_tax as w"
    )
    right = table(spark, d, "lineitem").selectExpr(
        "case when l_quantity > 10 then double('Infinity') else l_quantity end as v", "l_tax as w"
    )
    return left, right


def nan_medians(spark: SparkSession, d: str) -> DataFrame:
    """Medians with NaN and infinities, as text."""
    left, right = nan_pair(spark, d)
    out = C.profile_diff(left, right)
    text = lambda c: F.round(c, 4).cast("string").alias(c)
    return out.select("column", text("left_median"), text("right_median"))


def comparison_overview(spark: SparkSession, d: str) -> DataFrame:
    """Head of a comparison report: types and bytes of every column of both tables."""
    left, right = orders_pair(spark, d)
    return C.schema_diff(left, right).join(
        C.bytes_diff(left, right).select("column", "left_bytes", "right_bytes"), "column", "left"
    )


def queries() -> dict[str, Query]:
    return {
        # index builders
        "series_index": series_index,
        "version_span": lambda s, d: core.version_span(bookkeeping(s, d)),
        "prior_versions": history_source,
        "collections_index": collections_index,
        "analysis_results_index": analysis_results_index,
        "clinical_index": clinical_index,
        "version_metadata": lambda s, d: core.version_metadata_index(version_rows(s, d)),
        "latest_version": lambda s, d: core.latest_version(version_rows(s, d)),
        "ct_index": on(modality.ct_index, CT_COLUMNS),
        "mr_index": on(modality.mr_index, MR_COLUMNS),
        "pt_index": on(modality.pt_index, PT_COLUMNS),
        "contrast_index": on(modality.contrast_index, CONTRAST_COLUMNS),
        "slide_series": on(slide.sm_index, SLIDE_COLUMNS),
        "slide_instance": on(slide.sm_instance_index, SLIDE_INSTANCE_COLUMNS),
        "segmentation_index": on(derived.seg_index, SEG_COLUMNS),
        "structure_set_index": on(derived.rtstruct_index, RT_COLUMNS),
        "annotation_index": on(derived.ann_index, ANN_COLUMNS),
        "annotation_groups": on(derived.ann_group_index, ANN_GROUP_COLUMNS),
        "volume_geometry": on(geometry.volume_geometry_index, GEOMETRY_COLUMNS),
        "study_selection": lambda s, d: mapping.as_text(study_rows(s, d)),
        "catalogue_mapping": lambda s, d: mapping.cross_catalogue_mapping(
            study_rows(s, d), cases(s, d), projects(s, d)
        ),
        "column_subset": column_subset,
        # parts of builders that are operators of their own
        "slice_positions": slice_positions,
        "slice_intervals": on(geometry.slice_intervals, GEOMETRY_COLUMNS, decimals=9),
        "segmented_series": on(derived.segmented_series, SEG_COLUMNS),
        "unknown_codes": unknown_class_codes,
        "unmapped_collections": lambda s, d: mapping.unmapped_collections(
            study_rows(s, d), projects(s, d)
        ),
        "cases_by_collection": lambda s, d: mapping.cases_of_patients(
            study_rows(s, d), cases(s, d), projects(s, d)
        ),
        "catalogue_mapping_checked": checked_mapping,
        "mapping_validation": mapping_validation,
        "match_summary": lambda s, d: mapping.match_summary(matched(s, d)),
        "nested_arrays": nested_arrays,
        "significant_figures": significant_figures,
        "safe_casts": safe_casts,
        "latest_members": latest_members,
        "revision_sizes": revision_sizes,
        "versioned_scan": versioned_scan,
        "patient_pairs": patient_pairs,
        "match_counts": match_counts,
        "ordered_positions": ordered_positions,
        "history_increment": history_increment,
        "rejected_series": rejected_series,
        # comparison
        "comparison_overview": comparison_overview,
        "shape_diff": _diff(C.shape_diff, orders_pair),
        "keyed_diff": keyed_diff,
        "keyed_diff_repeated": keyed_diff_repeated,
        "keyed_diff_types": lambda s, d: counts_as_long(C.keyed_diff(*typed_pair(s, d), "o_orderkey")),
        "multiset_diff_types": typed_multiset,
        "column_surplus": _diff(C.column_surplus, lines_pair),
        "profile_diff_nan": nan_medians,
        "keyed_samples": _diff(C.keyed_samples, orders_pair, "o_orderkey"),
        "multiset_diff": _diff(C.multiset_diff, lines_pair),
        "profile_diff": profile_diff,
        "column_bytes": lambda s, d: C.column_bytes(table(s, d, "documents")),
        "bytes_diff": lambda s, d: flat(C.bytes_diff(*orders_pair(s, d)), decimals=6),
        "largest_bytes_differences": lambda s, d: flat(
            C.largest_bytes_differences(*wide_pair(s, d)), decimals=6
        ),
        "bytes_totals": _diff(C.bytes_totals, orders_pair),
        # publishing
        "published_ct": published_ct,
        "published_order": published_order,
        "published_dictionary": published_dictionary,
        "refused_types": refused_types,
        "published_csv": published_csv,
        "size_report": size_report,
        "checksums": checksums,
        "content_digests": content_digests,
    }
