"""Instances are aggregated by hashing: sorting starts above the first shuffle at the earliest."""

import pytest

from checks import queries as Q
from checks.adapter import instances
from seriesloom.lookups import CT_CLASS, SEG_CLASS
from seriesloom.plans import core, derived, mapping, modality, slide

from .support import instances as made

BUILDERS = {
    "ct": (modality.ct_index, Q.CT_COLUMNS),
    "mr": (modality.mr_index, Q.MR_COLUMNS),
    "pt": (modality.pt_index, Q.PT_COLUMNS),
    "contrast": (modality.contrast_index, Q.CONTRAST_COLUMNS),
    "slides": (slide.sm_index, Q.SLIDE_COLUMNS),
    "structures": (derived.rtstruct_index, Q.RT_COLUMNS),
    "studies": (mapping.study_selection, Q.STUDY_COLUMNS),
    "segmentations": (derived.seg_index, Q.SEG_COLUMNS),
    "annotations": (derived.ann_index, Q.ANN_COLUMNS),
    "annotation_groups": (derived.ann_group_index, Q.ANN_GROUP_COLUMNS),
}


def first_aggregates(node):
    """Names of the aggregates nearest to each leaf."""
    children = node.children()
    found = [n for i in range(children.size()) for n in first_aggregates(children.apply(i))]
    if not found and "Aggregate" in node.nodeName():
        return [node.nodeName()]
    return found


def plan_of(spark, df):
    return df._jdf.queryExecution().executedPlan()


@pytest.fixture()
def stored(spark, tmp_path):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")

    def write(columns):
        path = str(tmp_path / "instances")
        instances(spark, "/root/testdata/sf0.001", columns).limit(50).write.parquet(path)
        return spark.read.parquet(path)

    yield write
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)


@pytest.mark.parametrize("name", BUILDERS)
def test_instances_are_hashed(spark, stored, name):
    builder, columns = BUILDERS[name]
    found = first_aggregates(plan_of(spark, builder(stored(columns))))
    # a builder without a group has no aggregate
    assert set(found) <= {"HashAggregate"} and (found or name in ("annotations", "annotation_groups"))


def test_references_filter_the_instances_they_are_looked_up_in(spark, tmp_path):
    """Rows that leave the scan of the looked-up instances are bounded by the references."""
    images = [{"SOPInstanceUID": f"i{k}", "SeriesInstanceUID": f"s{k % 9}", "SOPClassUID": CT_CLASS} for k in range(3000)]
    marks = [
        {
            "SOPInstanceUID": f"m{k}", "SeriesInstanceUID": f"seg{k}", "SOPClassUID": SEG_CLASS, "Modality": "SEG",
            "SegmentSequence": [{}], "SourceImageSequence": [{"ReferencedSOPInstanceUID": f"i{k * 7}"}],
        }
        for k in range(20)
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made(spark, images + marks).write.parquet(str(tmp_path / "i"))
        out = derived.segmented_series(spark.read.parquet(str(tmp_path / "i")))
        assert {(r[0], r[1]) for r in out.collect()} == {(f"seg{k}", f"s{k * 7 % 9}") for k in range(20)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = []

    def walk(node):
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        elif node.nodeName() == "Exchange" and "_image_series" in node.schema().simpleString():
            moved.append(node.metrics().apply("shuffleRecordsWritten").value())

    walk(out._jdf.queryExecution().executedPlan())
    assert moved and max(moved) <= 40


def test_series_index_hashes_instances_and_curated_rows(spark, stored):
    rows = stored(Q.SERIES_COLUMNS)
    curated = rows.selectExpr("SOPInstanceUID", "Modality as BodyPartExamined")
    spans = rows.selectExpr("SeriesInstanceUID", "1 as series_init_idc_version", "2 as series_revised_idc_version")
    found = first_aggregates(plan_of(spark, core.series_index(rows, curated, spans)))
    assert found and set(found) == {"HashAggregate"}
