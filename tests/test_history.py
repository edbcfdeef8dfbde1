"""The history of releases: put together from stored releases, and from all instances at once."""

import random

import pytest

from seriesloom.plans import versions
from seriesloom.sources.tables import Tables, write_versioned

BUCKETS = ["gs://public-datasets-idc/x", "gs://idc-open-idc1/x", "gs://idc-open-idc/x", "gs://new/x", "none", None]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = []
    for release in range(1, 7):
        for series in range(60):
            for _ in range(3):
                bucket = BUCKETS[series % 6]
                revision = rng.choice([None, f"r{series}.{rng.randrange(2)}"])
                size = rng.choice(["1000", "2500000", "bad", None])
                data.append((release, "c", f"p{series % 9}", f"s{series}", "st", "CT", bucket, revision, size))
    names = "collection_id PatientID SeriesInstanceUID StudyInstanceUID Modality gcs_url crdc_series_uuid instance_size"
    schema = "idc_version int, " + ", ".join(f"{n} string" for n in names.split())
    return spark.createDataFrame(data, schema)


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_releases_one_by_one(spark, rows, tmp_path):
    write_versioned(rows, str(tmp_path / "in/instances_by_version"))
    source = Tables(spark, str(tmp_path / "in")).all_versions("instances_by_version")
    store = str(tmp_path / "revisions")
    for latest in (2, 3, 3, 6):
        got = content(versions.update_history(spark, source, store, latest))
        assert got == content(versions.prior_versions_index(rows, latest)) and got
    # an older state can be asked for again, and its releases are not read anew
    assert content(versions.update_history(spark, source, store, 4)) == content(versions.prior_versions_index(rows, 4))


def test_only_missing_releases_are_read(spark, rows, tmp_path):
    write_versioned(rows, str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    versions.update_history(spark, source, str(tmp_path / "store"), 5)
    fresh = versions.missing_releases(source, spark.read.parquet(str(tmp_path / "store")), 6)
    assert {r.idc_version for r in fresh.select("idc_version").distinct().collect()} == {6}
    scan = next(x for x in fresh._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "PushedFilters: []" in scan and "PartitionFilters: [isnotnull(idc_version" in scan
    # the files of older releases may be damaged: they are not opened
    for release in range(1, 6):
        for f in (tmp_path / f"in/idc_version={release}").glob("*.parquet"):
            f.write_bytes(b"unreadable")
    got = versions.update_history(spark, source, str(tmp_path / "store"), 6)
    assert content(got) == content(versions.prior_versions_index(rows, 6))
