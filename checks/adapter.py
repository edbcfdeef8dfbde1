"""Instance-level imaging metadata derived from the given order tables.

The same column expressions serve both engines: a dialect only spells arrays and
records.  One line item is one instance, one order is one series.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SparkText:
    @staticmethod
    def arr(*values: str) -> str:
        return f"array({', '.join(values)})"

    @staticmethod
    def rec(**fields: str) -> str:
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"

    never = "array()"


class DuckText:
    @staticmethod
    def arr(*values: str) -> str:
        return f"[{', '.join(values)}]"

    @staticmethod
    def rec(**fields: str) -> str:
        return "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"

    never = "[]"


INSTANCE_KEY = (
    "cast(l_orderkey as string) || '.' || cast(l_linenumber as string) || '.' ||"
    " cast(l_partkey as string) || '.' || cast(l_suppkey as string) || '.' ||"
    " cast(cast(l_quantity as int) as string)"
)

MODALITY = """case substr(o_orderpriority, 1, 1)
  when '1' then case when o_orderstatus = 'P' then 'XA' else 'CT' end
  when '2' then case when o_orderstatus = 'P' then 'RF' else 'MR' end
  when '3' then case when o_orderstatus = 'P' then 'ANN' else 'PT' end
  when '4' then case when o_orderstatus = 'P' then 'RTSTRUCT' else 'SM' end
  else case when o_orderstatus = 'P' then 'SR' else 'SEG' end end"""

COLLECTION = """case n_regionkey when 0 then 'tcga_' when 1 then 'cptac_' when 2 then 'acrin_'
  when 3 then 'cddp_eagle_' else 'hcmi_' end || lower(n_name)"""

_CLASSES = {
    "CT": "1.2.840.10008.5.1.4.1.1.2",
    "XA": "1.2.840.10008.5.1.4.1.1.12.1",
    "MR": "1.2.840.10008.5.1.4.1.1.4",
    "RF": "1.2.840.10008.5.1.4.1.1.12.2",
    "PT": "1.2.840.10008.5.1.4.1.1.128",
    "ANN": "1.2.840.10008.5.1.4.1.1.91.1",
    "SM": "1.2.840.10008.5.1.4.1.1.77.1.6",
    "RTSTRUCT": "1.2.840.10008.5.1.4.1.1.481.3",
    "SEG": "1.2.840.10008.5.1.4.1.1.66.4",
    "SR": "1.2.840.10008.5.1.4.1.1.88.22",
}


@cache
def columns(d: type) -> dict[str, str]:
    """Column name -> expression over the joined tables and ``Modality``."""
    text = "cast({} as string)".format
    none = "cast(null as string)"

    def code(value: str, meaning: str, scheme: str = "'SCT'", **more: str) -> str:
        return d.rec(CodeValue=value, CodingSchemeDesignator=scheme, CodeMeaning=meaning, **more)

    def unless(condition: str, filled: str) -> str:
        return f"case when {condition} then {d.never} else {filled} end"

    def item(concept: str, *codes: str) -> str:
        return d.rec(
            ConceptNameCodeSequence=d.arr(code(f"'{concept}'", "'concept'")),
            ConceptCodeSequence=d.arr(*codes),
        )

    klass = "case Modality " + " ".join(
        f"when '{m}' then '{u}'" for m, u in _CLASSES.items()
    ) + " end"
    out = {
        # keys
        "SOPInstanceUID": INSTANCE_KEY,
        "SeriesInstanceUID": text("l_orderkey"),
        "StudyInstanceUID": "cast(o_custkey as string) || '.' || cast(year(o_orderdate) as string)",
        "PatientID": text("o_custkey"),
        "collection_id": COLLECTION,
        "idc_version": "cast(year(o_orderdate) - 1994 as int)",
        # series attributes
        "Modality": "Modality",
        "SOPClassUID": klass,
        "analysis_result_id": "case when o_orderstatus = 'P' then 'result_' || substr(o_orderpriority, 1, 1) end",
        "source_DOI": "'10.0000/' || lower(c_mktsegment)",
        "license_short_name": "case o_orderstatus when 'F' then 'CC BY 4.0' else 'CC BY-NC 3.0' end",
        "PatientAge": "case when c_acctbal > 0 then '0' || cast(c_nationkey + 40 as string) || 'Y' end",
        "PatientSex": "case when c_mktsegment < 'F' then 'F' else 'M' end",
        "StudyDate": "cast(o_orderdate as date)",
        "StudyDescription": "case when o_orderstatus <> 'O' then 'study ' || o_orderpriority end",
        "SeriesDate": "cast(l_shipdate as date)",
        "SeriesDescription": "p_name",
        "SeriesNumber": text("o_orderkey"),
        "TransferSyntaxUID": "case l_returnflag when 'A' then '1.2.840.10008.1.2'"
        " when 'N' then '1.2.840.10008.1.2.1' else '1.2.840.10008.1.2.4.90' end",
        "PhotometricInterpretation": "case when Modality in ('SEG', 'SR') then null"
        " when l_linestatus = 'F' then 'MONOCHROME2' else 'RGB' end",
        "PixelRepresentation": "cast(case when l_linenumber > 3 then 1 else 0 end as bigint)",
        "Manufacturer": "p_brand",
        "ManufacturerModelName": "p_type",
        "aws_bucket": "'bucket-' || lower(o_orderstatus)",
        "crdc_series_uuid": "'series-' || cast(l_orderkey as string)",
        "crdc_instance_uuid": "'instance-' || " + INSTANCE_KEY,
        "series_aws_url": "'s3://bucket-' || lower(o_orderstatus) || '/' || cast(l_orderkey as string) || '/'",
        "gcs_url": "case l_linestatus when 'F' then 'gs://public-datasets-idc/' else 'gs://idc-open-cr/' end || cast(l_orderkey as string)",
        "instance_size": f"case when l_tax > 0.075 then 'n/a' else {text('l_extendedprice')} end",
        # geometry
        "ImageType": d.arr(
            "'ORIGINAL'",
            "'PRIMARY'",
            "case when l_quantity = 50 then 'LOCALIZER' when l_quantity = 49 then 'MIP_MAX' else 'AXIAL' end",
        ),
        "ImagePositionPatient": unless(
            "l_quantity = 47",
            d.arr(text("l_discount"), "'0'", text("2.5e0 * l_linenumber")),
        ),
        "ImageOrientationPatient": "case when l_quantity = 46 then "
        + d.never
        + " when l_quantity = 45 then "
        + d.arr("'1'", "'0'", "'0'", "'0'", "'0.5'", "'0'")
        + " when o_orderstatus = 'F' then "
        + d.arr("'1'", "'0'", "'0'", "'0'", "'1'", "'0'")
        + " else "
        + d.arr("'1'", "'0'", "'0'", "'0'", "'0.8'", "'0.6'")
        + " end",
        "PixelSpacing": d.arr(
            "case when l_quantity = 44 then '0.75' when l_quantity = 43 then 'bad' else '0.000252' end",
            "'0.5'",
        ),
        "Rows": "cast(case when l_quantity = 42 then 256 else 512 end as bigint)",
        "Columns": "cast(512 as bigint)",
        # CT
        "SliceThickness": text("p_size"),
        "KVP": "case when l_tax > 0.075 then '120kV' else '120' end",
        "ScanOptions": unless("l_returnflag = 'R'", d.arr("'HELICAL MODE'", "l_linestatus")),
        "ConvolutionKernel": d.arr("p_type"),
        "GantryDetectorTilt": text("l_discount"),
        "XRayTubeCurrent": text("l_quantity"),
        "FilterType": "case l_returnflag when 'A' then 'WEDGE' when 'N' then 'FLAT' end",
        "Exposure": "case when l_returnflag = 'R' then null else " + text("l_quantity") + " end",
        "ExposureTime": text("l_extendedprice"),
        "DataCollectionDiameter": "'500'",
        "ReconstructionDiameter": text("p_retailprice"),
        "SpiralPitchFactor": "l_tax",
        # MR
        "MagneticFieldStrength": "case when l_linestatus = 'F' then '1.5' else '3' end",
        "ScanningSequence": d.arr("'SE'", "l_returnflag"),
        "SequenceVariant": d.arr("'SK'"),
        "MRAcquisitionType": "case when p_size > 25 then '2D' else '3D' end",
        "EchoTime": text("l_quantity / 2"),
        "RepetitionTime": text("p_retailprice"),
        "EchoTrainLength": "case when l_returnflag = 'A' then 'x' else " + text("l_linenumber") + " end",
        "FlipAngle": text("p_size"),
        "PixelBandwidth": text("l_suppkey"),
        "ImagingFrequency": "'63.87'",
        "ImagedNucleus": "'1H'",
        "InversionTime": "case when p_size > 25 then " + text("p_size") + " end",
        "ReceiveCoilName": "p_name",
        "SequenceName": "'*' || lower(p_type)",
        "DiffusionBValue": "case when l_returnflag <> 'A' then cast(l_linenumber * 100 as double) end",
        "NumberOfTemporalPositions": text("l_linenumber"),
        # PT
        "SeriesType": d.arr("'STATIC'", "case when o_orderstatus = 'F' then 'IMAGE' else 'REPROJECTION' end"),
        "Units": "'BQML'",
        "DecayCorrection": "case l_returnflag when 'A' then 'START' when 'N' then 'ADMIN' end",
        "CorrectedImage": d.arr("'ATTN'", "'DECY'"),
        "RandomsCorrectionMethod": "p_type",
        "ReconstructionMethod": "'OSEM'",
        "ActualFrameDuration": "case when l_returnflag = 'R' then 'long' else " + text("l_linenumber * 1000") + " end",
        "ScatterCorrectionMethod": none,
        "AttenuationCorrectionMethod": "p_brand",
        "NumberOfSlices": "cast(l_linenumber as bigint)",
        "NumberOfTimeSlices": "cast(case when l_linestatus = 'F' then 2 end as bigint)",
        "RadiopharmaceuticalInformationSequence": unless(
            "l_returnflag = 'R'",
            d.arr(
                d.rec(
                    RadionuclideCodeSequence=d.arr(code("'77004003'", "p_type")),
                    RadionuclideTotalDose=text("p_retailprice"),
                    RadiopharmaceuticalStartTime="'10:' || cast(10 + l_linenumber as string) || ':00'",
                    Radiopharmaceutical="p_name",
                )
            ),
        ),
        # contrast
        "ContrastBolusAgent": "case when l_quantity > 40 then p_name end",
        "ContrastBolusIngredient": "case when l_quantity > 45 then p_type end",
        "ContrastBolusRoute": "case when l_quantity > 35 and l_returnflag = 'A' then 'IV' end",
        # slides
        "ContainerIdentifier": "'slide-' || cast(l_orderkey as string)",
        "TotalPixelMatrixColumns": "cast(case when l_returnflag <> 'R' then l_linenumber * 1000 end as bigint)",
        "TotalPixelMatrixRows": "cast(case when l_returnflag = 'A' then l_linenumber * 900 end as bigint)",
        "AdmittingDiagnosesCodeSequence": unless(
            "l_returnflag <> 'A'", d.arr(code("'D' || cast(p_size as string)", "p_name"))
        ),
        "OpticalPathSequence": unless(
            "l_linenumber = 7",
            d.arr(
                d.rec(
                    ObjectiveLensPower="case when l_linenumber > 3 then '40' else '20x' end",
                    IlluminationTypeCodeSequence=d.arr(code("'111744'", "'Brightfield'", "'DCM'")),
                )
            ),
        ),
        "SharedFunctionalGroupsSequence": d.arr(
            d.rec(
                PixelMeasuresSequence=unless(
                    "l_linenumber = 1",
                    d.arr(d.rec(PixelSpacing=d.arr(text("p_size / 1e3"), "'0.5'"))),
                )
            )
        ),
        "SpecimenDescriptionSequence": unless(
            "l_quantity = 1",
            d.arr(
                d.rec(
                    PrimaryAnatomicStructureSequence=d.arr(
                        code(
                            "'A' || cast(p_size as string)",
                            "p_type",
                            PrimaryAnatomicStructureModifierSequence=unless(
                                "l_returnflag = 'N'", d.arr(code("'M1'", "p_brand", "'SRT'"))
                            ),
                        )
                    ),
                    SpecimenPreparationSequence=d.arr(
                        d.rec(
                            SpecimenPreparationStepContentItemSequence=d.arr(
                                item("430863003", code("'E1'", "'Paraffin ' || l_linestatus")),
                                item(
                                    "424361007",
                                    code("'S1'", "p_brand"),
                                    code("'S2'", "p_type"),
                                ),
                            )
                        ),
                        d.rec(
                            SpecimenPreparationStepContentItemSequence=unless(
                                "l_returnflag = 'A'",
                                d.arr(
                                    item(
                                        "430864009",
                                        code(
                                            "'F' || l_returnflag",
                                            "case when l_linestatus = 'F' then 'Formalin' end",
                                        ),
                                    )
                                ),
                            )
                        ),
                    ),
                )
            ),
        ),
        # segmentations
        "SegmentationType": "case when o_orderstatus = 'F' then 'BINARY' else 'FRACTIONAL' end",
        "SegmentSequence": unless(
            "l_quantity = 50",
            d.arr(
                *[
                    d.rec(
                        SegmentNumber=f"cast(l_linenumber + {shift} as bigint)",
                        SegmentAlgorithmType="case l_returnflag when 'A' then 'MANUAL' when 'N' then 'AUTOMATIC' end",
                        SegmentAlgorithmName=unless("l_returnflag = 'A'", d.arr("p_brand")),
                        SegmentedPropertyCategoryCodeSequence=d.arr(code("'91723000'", kind)),
                        SegmentedPropertyTypeCodeSequence=d.arr(code("'T1'", "p_type")),
                        AnatomicRegionSequence=unless(
                            "l_linenumber > 4", d.arr(code("'R1'", "p_name"))
                        ),
                    )
                    for shift, kind in ((0, "'Anatomical Structure'"), (1, "p_name"))
                ]
            ),
        ),
        "ReferencedSeriesSequence": unless(
            "l_returnflag = 'R'",
            d.arr(
                d.rec(
                    SeriesInstanceUID=text("l_orderkey + 1"),
                    ReferencedInstanceSequence=unless(
                        "l_returnflag <> 'A'", d.arr(d.rec(ReferencedSOPInstanceUID="first_ct"))
                    ),
                )
            ),
        ),
        "ReferencedImageSequence": unless(
            "l_returnflag <> 'N'", d.arr(d.rec(ReferencedSOPInstanceUID="first_ct"))
        ),
        "SourceImageSequence": d.arr(
            d.rec(
                ReferencedSOPInstanceUID="case when l_returnflag = 'R' then 'elsewhere' else last_ct end"
            )
        ),
        # structure sets
        "StructureSetROISequence": unless(
            "l_quantity = 50",
            d.arr(
                *[
                    d.rec(
                        ROINumber=f"cast(l_linenumber + {shift} as bigint)",
                        ROIName=name,
                        ROIGenerationAlgorithm="case l_returnflag when 'A' then 'MANUAL' when 'N' then 'AUTOMATIC' end",
                    )
                    for shift, name in ((0, "p_brand"), (10, "p_type"))
                ]
            ),
        ),
        "RTROIObservationsSequence": d.arr(
            d.rec(
                ReferencedROINumber="cast(l_linenumber as bigint)",
                RTROIInterpretedType="case when p_size > 25 then 'GTV' else 'PTV' end",
            ),
            d.rec(
                ReferencedROINumber="cast(l_linenumber as bigint)",
                RTROIInterpretedType="case when l_linestatus = 'F' then 'ORGAN' end",
            ),
            d.rec(ReferencedROINumber="cast(99 as bigint)", RTROIInterpretedType="'ORPHAN'"),
        ),
        "ReferencedFrameOfReferenceSequence": unless(
            "l_returnflag = 'R'",
            d.arr(
                d.rec(
                    RTReferencedStudySequence=d.arr(
                        d.rec(
                            RTReferencedSeriesSequence=d.arr(
                                d.rec(SeriesInstanceUID=text("l_partkey")),
                                d.rec(SeriesInstanceUID=text("l_suppkey")),
                            )
                        )
                    )
                )
            ),
        ),
        # annotations
        "AnnotationCoordinateType": "case when l_linestatus = 'F' then '2D' else '3D' end",
        "AnnotationGroupSequence": unless(
            "l_quantity = 50",
            d.arr(
                *[
                    d.rec(
                        AnnotationGroupNumber=f"cast({n} as bigint)",
                        AnnotationGroupUID=f"{INSTANCE_KEY} || '.{n}'",
                        AnnotationGroupLabel="p_name",
                        AnnotationGroupGenerationType="case when l_returnflag = 'A' then 'MANUAL' else 'AUTOMATIC' end",
                        NumberOfAnnotations="cast(l_quantity as bigint)",
                        GraphicType="'POLYGON'",
                        AnnotationPropertyCategoryCodeSequence=d.arr(
                            code("'4421005'", "p_type", "case when l_linestatus = 'F' then 'SCT' end")
                        ),
                        AnnotationPropertyTypeCodeSequence=unless(
                            "l_linenumber > 5", d.arr(code("'84640000'", "'Nucleus'"))
                        ),
                        AnnotationGroupAlgorithmIdentificationSequence=unless(
                            "l_returnflag = 'A'", d.arr(d.rec(AlgorithmName="p_brand"))
                        ),
                    )
                    for n in (1, 2)
                ]
            ),
        ),
    }
    return out


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _read(spark, sf_dir, name)


#: Megabytes of stored line items and orders for a task that joins them, once there are so many of them.
TASK_MB, MANY_MB = 4, 64
SERIES_OF_LINE, SERIES_OF_ORDER = "cast(l_orderkey as string)", "cast(o_orderkey as string)"


def _pieces(spark: SparkSession, sf_dir: str) -> list[int]:
    """Number of partitions for the join of line items and orders, or nothing for small tables, which Spark deals.

    It grows with the stored bytes, so a task does not; Spark's own tasks grow up to 64 MB of compressed rows.
    """
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in ("lineitem", "orders")]
    conf = spark._jsc.hadoopConfiguration()
    mb = sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in paths) / 1e6
    return [math.ceil(mb / TASK_MB)] if mb > MANY_MB else []


def _on_series(lines: DataFrame, series: DataFrame, pieces: list[int]) -> DataFrame:
    """Line items joined with their orders, dealt by the series key as it is named later.

    Spark sees that the result is partitioned on the key, so grouping by series moves no row again, and each task
    joins by a hash table of its few orders, without sorting.
    """
    line, order = F.expr(SERIES_OF_LINE), F.expr(SERIES_OF_ORDER)
    return lines.repartition(*pieces, line).join(
        series.repartition(*pieces, order).hint("shuffle_hash"), line == order
    )


def lines_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders."""
    lines, orders = (_read(spark, sf_dir, t) for t in ("lineitem", "orders"))
    return _on_series(lines, orders, _pieces(spark, sf_dir))


def _ct_instances(lines: DataFrame) -> DataFrame:
    """First and last CT instance of every patient: what segmentations refer to."""
    return (
        lines.where(F.expr(MODALITY) == "CT")
        .withColumn("sop", F.expr(INSTANCE_KEY))
        .groupBy(F.col("o_custkey").alias("ct_custkey"))
        .agg(F.min("sop").alias("first_ct"), F.max("sop").alias("last_ct"))
    )


def instances(spark: SparkSession, sf_dir: str, names: Sequence[str], parts_first: bool = False) -> DataFrame:
    """The named instance columns; only the dimensions they use are joined.

    Where no filter on the series leaves out most line items, ``parts_first`` joins the parts before the series, so
    the rows stay partitioned on the series even if the parts are too many to be broadcast.
    """
    texts = {n: columns(SparkText)[n] for n in names}
    used = set(re.findall(r"\b([a-z]+)_[a-z]+\b", " ".join(texts.values())))
    orders = _read(spark, sf_dir, "orders")
    series = orders
    if used & {"c", "n"}:
        customer = _read(spark, sf_dir, "customer")
        series = series.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    if "n" in used:
        nation = _read(spark, sf_dir, "nation")  # fixed at 25 rows
        series = series.join(
            F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
    lines = _read(spark, sf_dir, "lineitem")
    same_order = F.col("l_orderkey") == F.col("o_orderkey")
    if used & {"first", "last"}:
        cts = _ct_instances(lines.join(orders, same_order))
        series = series.join(cts, F.col("o_custkey") == F.col("ct_custkey"), "left")
    pieces = _pieces(spark, sf_dir)
    if "p" in used:
        part, same_part = _read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    if "p" in used and parts_first:
        rows = _on_series(lines.join(part, same_part, "left"), series, pieces)
    else:
        rows = _on_series(lines, series, pieces)
        if "p" in used:
            rows = rows.join(part, same_part, "left")
    return rows.withColumn("Modality", F.expr(MODALITY)).select(
        *[F.expr(t).alias(n) for n, t in texts.items()]
    )


def duck_instances(names: Sequence[str], name: str = "inst") -> str:
    """The same instance columns as a DuckDB common table expression."""
    texts = {n: columns(DuckText)[n] for n in names}
    cells = ",\n  ".join(f'{t} as "{n}"' for n, t in texts.items())
    return f"""{name}_ct as (
  select o_custkey as ct_custkey, min({INSTANCE_KEY}) as first_ct, max({INSTANCE_KEY}) as last_ct
  from lineitem join orders on l_orderkey = o_orderkey where ({MODALITY}) = 'CT' group by 1
), {name}_raw as (
  select *, {MODALITY} as Modality
  from lineitem join orders on l_orderkey = o_orderkey
  left join part on l_partkey = p_partkey
  left join customer on o_custkey = c_custkey
  left join nation on c_nationkey = n_nationkey
  left join {name}_ct on o_custkey = ct_custkey
), {name} as (
  select {cells}
  from {name}_raw
)"""
