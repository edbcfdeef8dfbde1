import datetime as dt

import pytest

from seriesloom import checked_mapping, column_subset, cross_catalogue_mapping, study_selection
from seriesloom.lookups import COLLECTION_PROJECTS
from seriesloom.plans import mapping

from .support import by, instances


def test_study_selection(spark):
    def row(study, collection, modality):
        return {"StudyInstanceUID": study, "collection_id": collection, "Modality": modality,
                "PatientID": "p", "StudyDate": dt.date(2020, 1, 1)}

    rows = [
        row("a", "tcga_brca", "CT"), row("a", "tcga_brca", "SM"), row("b", "tcga_brca", "CT"),
        row("c", "my_apollo_x", None), row("d", "nlst", "SM"), row("e", "xtcga", "CT"),
    ]
    got = by(study_selection(instances(spark, rows)), "StudyInstanceUID")
    assert {k: r.study_type for k, r in got.items()} == {"a": "M", "b": "R", "c": "R"}


@pytest.fixture()
def studies(spark):
    return spark.createDataFrame(
        [
            ("tcga_acc", "p1", "s1"),
            ("tcga_acc", "p1", "s2"),
            ("tcga_acc", "p2", "s3"),
            ("cptac_brca", "q1", "s4"),
            ("cptac_luad", "q2", "s5"),
            ("cptac_cm", "q3", "s6"),
            ("tcga_acc", None, "s7"),
        ],
        "collection_id string, PatientID string, StudyInstanceUID string",
    )


@pytest.fixture()
def cases(spark):
    return spark.createDataFrame(
        [
            ("TCGA-ACC", "p1", "c1"),
            ("TCGA-LUAD", "p2", "wrong project"),
            ("CPTAC-3", "q1", "c9"),
            ("CPTAC-2", "q1", "c4"),
            ("CPTAC-2", "q2", "c5"),
            ("TCGA-ACC", None, "c0"),
        ],
        "project_id string, submitter_id string, case_id string",
    )


def test_mapping_attaches_one_case(studies, cases):
    got = by(checked_mapping(studies, cases), "StudyInstanceUID")
    assert {k: r.gdc_case_id for k, r in got.items()} == {"s1": "c1", "s2": "c1", "s4": "c4", "s5": "c5"}
    kept = cross_catalogue_mapping(studies, cases, keep_unmatched=True)
    assert kept.count() == 7


def test_summary_and_validation(spark, studies, cases):
    projects = mapping.collection_projects(spark)
    matched = mapping.attach_cases(studies, cases, projects)
    s = mapping.match_summary(matched).first()
    assert (s.studies_matched, s.studies, s.patients_matched, s.patients) == (4, 7, 3, 5)
    assert mapping.collections_without_match(matched).count() == 0
    (bad,) = mapping.collections_without_match(matched, exempt=()).collect()
    assert bad.collection_id == "cptac_cm" and bad.studies == 1


def test_unmapped_collection_is_an_error(spark, studies, cases):
    more = studies.unionByName(
        spark.createDataFrame([("unknown", "p", "s9")], studies.schema)
    )
    with pytest.raises(mapping.MappingError, match="^1 collections") as error:
        checked_mapping(more, cases)
    assert [tuple(r) for r in error.value.rows.collect()] == [("unknown", 1)]


def test_all_offending_collections_are_listed(spark, studies, cases):
    many = spark.range(300).selectExpr("'new' || id as collection_id", "'p' as PatientID", "'t' || id as StudyInstanceUID")
    with pytest.raises(mapping.MappingError) as error:
        checked_mapping(studies.unionByName(many), cases)
    assert error.value.count == 300 == error.value.rows.count()
    projects = spark.createDataFrame([(f"new{i}", ["X"]) for i in range(300)], "collection_id string, project_ids array<string>")
    with pytest.raises(mapping.MappingError) as error:
        checked_mapping(many, cases, projects)
    assert error.value.count == 300 == error.value.rows.count()


def test_umbrella_project_does_not_multiply_its_cases(spark, cases):
    projects = spark.createDataFrame([(f"c{i}", ["CPTAC-2", "CPTAC-3", "CPTAC-2"]) for i in range(14)], "collection_id string, project_ids array<string>")
    one = spark.createDataFrame([("c3", "q1", "s")], "collection_id string, PatientID string, StudyInstanceUID string")
    assert [tuple(r) for r in mapping.cases_of_patients(one, cases, projects).collect()] == [("c3", "q1", "c4")]


def test_written_mapping_is_checked_in_one_job(spark, studies, cases, tmp_path):
    path = str(tmp_path / "m")
    got = mapping.write_mapping(studies, cases, path)
    assert sorted(map(str, got.collect())) == sorted(map(str, checked_mapping(studies, cases).collect()))
    with pytest.raises(mapping.MappingError, match="no matching case") as error:
        mapping.write_mapping(studies, cases, path, exempt=())
    assert [tuple(r) for r in error.value.rows.collect()] == [("cptac_cm", 1)]
    many = spark.range(300).selectExpr("'new' || id as collection_id", "'p' as PatientID", "'t' || id as StudyInstanceUID")
    with pytest.raises(mapping.MappingError, match="no projects") as error:
        mapping.write_mapping(studies.unionByName(many), cases, path)
    assert error.value.count == 300 == error.value.rows.count()
    empty = studies.limit(0)
    assert mapping.write_mapping(empty, cases, path).count() == 0


def test_studies_are_derived_once(spark, studies, cases, tmp_path):
    studies.write.parquet(f"{tmp_path}/s")
    stored = spark.read.parquet(f"{tmp_path}/s")
    plan = mapping.attach_cases(stored, cases, mapping.collection_projects(spark))
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_collection_without_match_is_an_error(studies, cases):
    with pytest.raises(mapping.MappingError) as error:
        checked_mapping(studies, cases, exempt=())
    assert [tuple(r) for r in error.value.rows.collect()] == [("cptac_cm", 1)]


def test_mapping_table(spark):
    assert len(COLLECTION_PROJECTS) == 54
    assert mapping.collection_projects(spark).count() == 54


def test_text_casts_and_subset(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 2), 1, 2.0, True, "x")], "d date, n long, f double, b boolean, s string"
    )
    out = mapping.as_text(df)
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "bigint", "double", "boolean", "string"]
    assert out.first().d == "2020-01-02"
    assert column_subset(df, ["s", "n"]).columns == ["s", "n"]
