import datetime as dt

import pytest

from seriesloom import prior_versions_index, series_index, version_span
from seriesloom.lookups import CT_CLASS
from seriesloom.operators.names import unknown_codes
from seriesloom.plans.core import SERIES_INDEX_COLUMNS, clinical_index, collections_index
from seriesloom.plans.core import latest_version

from .support import by, instances


def row(sop, series="s1", **more):
    base = {
        "SOPInstanceUID": sop,
        "SeriesInstanceUID": series,
        "SOPClassUID": CT_CLASS,
        "TransferSyntaxUID": "1.2.840.10008.1.2",
        "instance_size": "1000000",
    }
    return {**base, **more}


def index(spark, rows, curated=(), books=()):
    return series_index(
        instances(spark, rows),
        spark.createDataFrame(list(curated), "SOPInstanceUID string, BodyPartExamined string"),
        spark.createDataFrame(
            list(books),
            "SeriesInstanceUID string, series_init_idc_version long, series_revised_idc_version long",
        ),
    )


def test_one_row_per_series(spark):
    rows = [
        row("1", StudyDate=dt.date(2020, 1, 2), PhotometricInterpretation="RGB"),
        row("2", TransferSyntaxUID="1.2.840.10008.1.2.1", PhotometricInterpretation="MONOCHROME2"),
        row("3", instance_size="broken", series_aws_url="s3://b/u/"),
        row("4", "s2", PixelRepresentation=1),
    ]
    df = index(
        spark, rows, [("1", "CHEST"), ("9", "HEAD")], [("s1", 3, 5), ("s1", 2, 4), ("s9", 1, 1)]
    )
    assert tuple(df.columns) == SERIES_INDEX_COLUMNS
    got = by(df, "SeriesInstanceUID")
    assert set(got) == {"s1", "s2"}
    s1 = got["s1"]
    assert s1.instanceCount == 3 and s1.series_size_MB == 2.0
    assert s1.TransferSyntaxUID == "1.2.840.10008.1.2,1.2.840.10008.1.2.1"
    assert s1.transfer_syntax_name == "Explicit VR Little Endian,Implicit VR Little Endian"
    assert s1.sop_class_name == "CT Image Storage" and s1.BodyPartExamined == "CHEST"
    assert s1.PhotometricInterpretation == "MONOCHROME2,RGB" and s1.StudyDate == "2020-01-02"
    assert (s1.series_init_idc_version, s1.series_revised_idc_version) == (2, 5)
    assert s1.series_aws_url == "s3://b/u/*"
    assert got["s2"].PixelRepresentation == "1" and got["s2"].series_init_idc_version is None
    assert got["s2"].PhotometricInterpretation is None


def test_repeated_curated_rows_count_like_a_join(spark):
    df = index(spark, [row("1"), row("2")], [("1", "A"), ("1", "B"), ("1", "C")])
    (got,) = df.collect()
    assert got.instanceCount == 4 and got.series_size_MB == 4.0 and got.BodyPartExamined == "A"


@pytest.mark.parametrize("uid, shown", [("1.2.3", "1.2.3"), (None, "NULL")])
def test_unknown_class_fails_with_its_name(spark, uid, shown):
    rows = [row("1"), row("2", SOPClassUID=uid)]
    with pytest.raises(Exception, match=f"Unmapped SOPClassUID: {shown}"):
        index(spark, rows).collect()


def test_unknown_syntax_fails(spark):
    with pytest.raises(Exception, match="Unmapped TransferSyntaxUID: 9.9"):
        index(spark, [row("1", TransferSyntaxUID="9.9")]).collect()


def test_audit_lists_unknown_codes(spark):
    rows = [row("1"), row("2", SOPClassUID="x"), row("3", SOPClassUID="x"), row("4", SOPClassUID=None)]
    got = unknown_codes(instances(spark, rows), "SOPClassUID", {CT_CLASS: "CT"}).collect()
    assert sorted((r.uid or "", r.rows) for r in got) == [("", 1), ("x", 2)]


def test_version_bounds(spark):
    books = spark.createDataFrame(
        [("a", 4, 6), ("a", 2, 9), ("b", 1, 1)],
        "SeriesInstanceUID string, series_init_idc_version long, series_revised_idc_version long",
    )
    got = by(version_span(books), "SeriesInstanceUID")
    assert (got["a"][1], got["a"][2]) == (2, 9) and (got["b"][1], got["b"][2]) == (1, 1)


def test_prior_versions(spark):
    columns = (
        "idc_version int, collection_id string, PatientID string, SeriesInstanceUID string,"
        " StudyInstanceUID string, Modality string, gcs_url string, crdc_series_uuid string,"
        " instance_size string"
    )

    def v(version, uuid, url="gs://public-datasets-idc/x", size="1230000"):
        return (version, "c", "p", "s", "st", "CT", url, uuid, size)

    rows = [
        v(1, "alive"), v(3, "alive"),  # still in the latest release
        v(1, "gone"), v(1, "gone", size="2"), v(2, "gone"), v(2, "gone", size="2"),
        v(1, "old bucket", "gs://idc-open-idc/x"),  # excluded
        v(1, "no url", None),  # a missing bucket is dropped as well
        v(2, "elsewhere", "gs://somewhere/x"),
        v(9, "future"),  # beyond the latest release
        v(1, None),
    ]
    got = by(prior_versions_index(spark.createDataFrame(rows, columns), 3), "crdc_series_uuid")
    assert set(got) == {"gone", "elsewhere"}
    gone = got["gone"]
    assert (gone.min_idc_version, gone.max_idc_version, gone.series_size_MB) == (1, 2, 1.23)
    assert gone.aws_bucket == "idc-open-data" and gone.series_aws_url == "s3://idc-open-data/gone/*"
    assert got["elsewhere"].aws_bucket is None and got["elsewhere"].series_aws_url is None
    assert len(gone) == 12


def test_prior_versions_keeps_different_sizes_apart(spark):
    columns = (
        "idc_version int, collection_id string, PatientID string, SeriesInstanceUID string,"
        " StudyInstanceUID string, Modality string, gcs_url string, crdc_series_uuid string,"
        " instance_size string"
    )
    rows = [
        (1, "c", "p", "s", "st", "CT", "gs://idc-open-cr/x", "u", "1000000"),
        (2, "c", "p", "s", "st", "CT", "gs://idc-open-cr/x", "u", "2000000"),
    ]
    got = prior_versions_index(spark.createDataFrame(rows, columns), 3).collect()
    assert sorted((r.series_size_MB, r.min_idc_version, r.max_idc_version) for r in got) == [
        (1.0, 1, 1), (2.0, 2, 2),
    ]


def test_projections(spark):
    clinical = spark.createDataFrame(
        [("c", "p.d.t_x.v", "a", "A", "1"), ("c", "short", "b", "B", "2")],
        "collection_id string, table_name string, column string, column_label string, values string",
    )
    assert [r.short_table_name for r in clinical_index(clinical).orderBy("column").collect()] == ["t_x", None]
    versions = spark.createDataFrame([(3,), (24,), (7,)], "idc_version long")
    assert latest_version(versions).first().latest_idc_version == 24
    from seriesloom.schemas import COLLECTIONS
    from seriesloom.sources.tables import conform

    rows = spark.createDataFrame([("c", dt.date(2024, 5, 6))], "collection_id string, updated date")
    got = collections_index(conform(rows, COLLECTIONS)).first()
    assert got.updated == "2024-05-06" and got.sources == []
