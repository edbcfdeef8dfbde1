"""Study selection, matching of patients to cases of another catalogue, download subset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import any_of, folded, like_any
from ..lookups import (
    COLLECTION_PROJECTS,
    COLLECTIONS_WITHOUT_CASES,
    SHARED_COLLECTION_PATTERNS,
    SUBSET_COLUMNS,
)

PATIENT = ["collection_id", "PatientID"]


class MappingError(ValueError):
    """The collection-to-project mapping does not fit the data.

    ``rows`` holds every offending collection with its number of studies, ``count`` how many
    they are; the message names no more than their number.
    """

    def __init__(self, problem: str, rows: DataFrame, count: int) -> None:
        super().__init__(f"{count} {problem}; see the rows of this error")
        self.rows = rows
        self.count = count


def study_selection(
    instances: DataFrame, patterns: Sequence[str] = SHARED_COLLECTION_PATTERNS
) -> DataFrame:
    """Studies of the matching collections; a study with any slide is microscopy (M)."""
    values = {c: (any_of, c) for c in ("collection_id", "PatientID", "StudyDate", "StudyDescription")}
    slides = F.coalesce(F.col("Modality") == "SM", F.lit(False))
    studies = folded(
        instances.where(like_any("collection_id", patterns)),
        "StudyInstanceUID",
        {**values, "_slides": (F.max, slides)},
    )
    return studies.select(
        *PATIENT,
        "StudyInstanceUID",
        "StudyDate",
        "StudyDescription",
        F.when(F.col("_slides"), "M").otherwise("R").alias("study_type"),
    )


def patient_pairs(studies: DataFrame) -> DataFrame:
    """Distinct complete (collection, patient) pairs of the studies."""
    return studies.select(*PATIENT).dropna().distinct()


def collection_projects(
    spark: SparkSession, projects: Mapping[str, Sequence[str]] = COLLECTION_PROJECTS
) -> DataFrame:
    """The mapping as a table of one row per collection, of a size the optimizer knows."""
    table = pa.table(
        {"collection_id": list(projects), "project_ids": [list(p) for p in projects.values()]},
        pa.schema([("collection_id", pa.string()), ("project_ids", pa.list_(pa.string()))]),
    )
    return spark.createDataFrame(table)


def unmapped_collections(studies: DataFrame, projects: DataFrame) -> DataFrame:
    """Collections of the studies that the mapping does not know, with their studies."""
    return (
        studies.where(F.col("collection_id").isNotNull() & F.col("PatientID").isNotNull())
        .groupBy("collection_id")
        .agg(F.count(F.lit(1)).alias("studies"))
        .join(projects, "collection_id", "left_anti")
    )


def cases_of_patients(studies: DataFrame, cases: DataFrame, projects: DataFrame) -> DataFrame:
    """One case per (collection, patient) of the studies: the smallest id among the mapped projects.

    The projects are attached to the patients that occur, so a project that serves many
    collections does not multiply its cases, and the join is on (project, submitter).
    """
    wanted = patient_pairs(studies).join(projects, "collection_id").select(
        *PATIENT, F.explode(F.array_distinct("project_ids")).alias("project_id")
    )
    known = (
        cases.where(F.col("submitter_id").isNotNull() & F.col("case_id").isNotNull())
        .groupBy("project_id", F.col("submitter_id").alias("PatientID"), "case_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        wanted.join(known, ["project_id", "PatientID"])
        .groupBy(*PATIENT)
        .agg(F.min("case_id").alias("gdc_case_id"))
    )


def _attached(studies: DataFrame, cases: DataFrame, projects: DataFrame) -> DataFrame:
    """Studies with ``gdc_case_id`` and ``_mapped``, whether the mapping knows the collection.

    The studies are used once, so they are derived once: the projects of their collection and the
    cases of their patient come to them, the latter as a map of the smallest case of each project,
    which has at most as many entries as there are mapped projects.
    """
    of_collection = projects.groupBy("collection_id").agg(
        F.array_distinct(F.flatten(F.collect_list("project_ids"))).alias("_projects")
    )
    mapped = projects.select(F.explode("project_ids").alias("project_id")).distinct()
    of_patient = (
        cases.where(F.col("submitter_id").isNotNull() & F.col("case_id").isNotNull())
        .join(mapped, "project_id", "left_semi")
        # distinct first: equal rows are hashed away before texts are compared
        .groupBy("project_id", F.col("submitter_id").alias("PatientID"), "case_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("PatientID", "project_id")
        .agg(F.min("case_id").alias("case_id"))
        .groupBy("PatientID")
        .agg(F.map_from_entries(F.collect_list(F.struct("project_id", "case_id"))).alias("_cases"))
    )
    found = F.transform("_projects", lambda p: F.try_element_at("_cases", p))
    return (
        studies.join(of_collection, "collection_id", "left")
        .join(of_patient, "PatientID", "left")
        .select(
            *studies.columns,
            F.array_min(F.filter(found, lambda c: c.isNotNull())).alias("gdc_case_id"),
            F.col("_projects").isNotNull().alias("_mapped"),
        )
    )


def attach_cases(studies: DataFrame, cases: DataFrame, projects: DataFrame) -> DataFrame:
    """Studies with the case of their patient, NULL where there is none."""
    return _attached(studies, cases, projects).drop("_mapped")


def collections_without_match(
    matched: DataFrame, exempt: Sequence[str] = COLLECTIONS_WITHOUT_CASES
) -> DataFrame:
    """Collections that got no case at all although they should have one."""
    return (
        matched.where(F.col("collection_id").isNotNull())
        .groupBy("collection_id")
        .agg(F.count("gdc_case_id").alias("matched"), F.count(F.lit(1)).alias("studies"))
        .where((F.col("matched") == 0) & ~F.col("collection_id").isin(*exempt))
    )


def match_summary(matched: DataFrame) -> DataFrame:
    """Studies and distinct patients, matched and in total."""
    found = F.col("gdc_case_id").isNotNull()
    return matched.agg(
        F.count_if(found).alias("studies_matched"),
        F.count(F.lit(1)).alias("studies"),
        F.count_distinct(*[F.when(found, F.col(c)) for c in PATIENT]).alias(
            "patients_matched"
        ),
        F.count_distinct(*PATIENT).alias("patients"),
    )


def cross_catalogue_mapping(
    studies: DataFrame,
    cases: DataFrame,
    projects: DataFrame | None = None,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Studies whose patient is a case of the other catalogue, all columns as text.

    This is the plan alone; ``checked_mapping`` also verifies the mapping.
    """
    if projects is None:
        projects = collection_projects(studies.sparkSession)
    matched = attach_cases(studies, cases, projects)
    if not keep_unmatched:
        matched = matched.dropna(subset=["gdc_case_id"])
    return as_text(matched)


def checked_mapping(
    studies: DataFrame,
    cases: DataFrame,
    projects: DataFrame | None = None,
    exempt: Sequence[str] = COLLECTIONS_WITHOUT_CASES,
    keep_unmatched: bool = False,
) -> DataFrame:
    """``cross_catalogue_mapping`` that first fails on an unmapped collection or on a
    collection without a single match.

    Both are decided by one aggregate over one row per collection; two counts reach the driver.
    """
    if projects is None:
        projects = collection_projects(studies.sparkSession)
    matched = attach_cases(studies, cases, projects)
    known = projects.select("collection_id", F.lit(True).alias("_mapped")).distinct()
    collections = (
        matched.where(F.col("collection_id").isNotNull())
        .groupBy("collection_id")
        .agg(
            F.count(F.lit(1)).alias("studies"),
            F.count("PatientID").alias("_with_patient"),
            F.count("gdc_case_id").alias("_matched"),
        )
        .join(known, "collection_id", "left")
    )
    unmapped = F.col("_mapped").isNull() & (F.col("_with_patient") > 0)
    empty = (F.col("_matched") == 0) & ~F.col("collection_id").isin(*exempt)
    counts = collections.agg(
        F.count_if(unmapped).alias("unmapped"), F.count_if(empty).alias("empty")
    ).first()
    if counts["unmapped"]:
        rows = collections.where(unmapped).select("collection_id", F.col("_with_patient").alias("studies"))
        raise MappingError("collections have no projects mapped", rows, counts["unmapped"])
    if counts["empty"]:
        rows = collections.where(empty).select("collection_id", "studies")
        raise MappingError("collections have no matching case at all", rows, counts["empty"])
    if not keep_unmatched:
        matched = matched.dropna(subset=["gdc_case_id"])
    return as_text(matched)


#: Collections of a mapping that is checked while it is written.
MAPPED_COLLECTIONS = 10_000


def write_mapping(
    studies: DataFrame,
    cases: DataFrame,
    path: str,
    projects: DataFrame | None = None,
    exempt: Sequence[str] = COLLECTIONS_WITHOUT_CASES,
    keep_unmatched: bool = False,
) -> DataFrame:
    """``checked_mapping`` in one job: the result is written to ``path``, observed on the way, and read back.

    The checks read metrics of the job that writes, so the studies are derived once.  They come
    after the writing: when they fail, what lies at ``path`` must not be used.
    """
    spark = studies.sparkSession
    if projects is None:
        projects = collection_projects(spark)
    names = sorted(
        r[0]
        for r in projects.where(F.col("collection_id").isNotNull())
        .select("collection_id")
        .distinct()
        .limit(MAPPED_COLLECTIONS + 1)
        .collect()
    )
    if len(names) > MAPPED_COLLECTIONS:
        raise ValueError(f"more than {MAPPED_COLLECTIONS} mapped collections")
    wanted = [c for c in names if c not in set(exempt)]
    patient = F.col("collection_id").isNotNull() & F.col("PatientID").isNotNull()
    metrics = [F.count_if(patient & ~F.col("_mapped")).alias("unmapped")]
    for i, c in enumerate(wanted):
        here = F.col("collection_id") == c
        metrics += [
            F.count_if(here).alias(f"studies_{i}"),
            F.count_if(here & F.col("gdc_case_id").isNotNull()).alias(f"matched_{i}"),
        ]
    checks = Observation()
    matched = _attached(studies, cases, projects).observe(checks, *metrics).drop("_mapped")
    if not keep_unmatched:
        matched = matched.dropna(subset=["gdc_case_id"])
    out = as_text(matched)
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)
    seen = checks.get
    if seen["unmapped"]:
        rows = unmapped_collections(studies, projects)
        raise MappingError("collections have no projects mapped", rows, rows.count())
    counts = [(c, seen[f"studies_{i}"], seen[f"matched_{i}"]) for i, c in enumerate(wanted)]
    empty = [(c, n) for c, n, found in counts if n and not found]
    if empty:
        rows = spark.createDataFrame(empty, "collection_id string, studies long")
        raise MappingError("collections have no matching case at all", rows, len(empty))
    return spark.read.schema(out.schema).parquet(path)


def as_text(df: DataFrame) -> DataFrame:
    """Cast every column that is not text, boolean, long or double to text."""
    plain = (T.StringType, T.BooleanType, T.LongType, T.DoubleType)
    return df.select(
        *[
            F.col(f.name)
            if isinstance(f.dataType, plain)
            else F.col(f.name).cast("string").alias(f.name)
            for f in df.schema.fields
        ]
    )


def column_subset(index: DataFrame, columns: Sequence[str] = SUBSET_COLUMNS) -> DataFrame:
    return index.select(*columns)
