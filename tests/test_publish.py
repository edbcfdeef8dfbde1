import datetime as dt
import hashlib
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seriesloom import INDEXES, Tables, build, publish
from seriesloom import schemas as S
from seriesloom.lookups import CT_CLASS
from seriesloom.sources import publish as P
from seriesloom.sources.tables import conform, write_versioned

from .support import instances

NAMES = {
    "series_index", "prior_versions_index", "collections_index", "analysis_results_index",
    "clinical_index", "sm_index", "sm_instance_index", "seg_index", "ann_index",
    "ann_group_index", "contrast_index", "volume_geometry_index", "rtstruct_index",
    "version_metadata_index", "ct_index", "mr_index", "pt_index",
}

def test_registry_covers_all_indices():
    assert set(INDEXES) == NAMES


@pytest.mark.parametrize("name", sorted(NAMES))
def test_every_column_is_described_and_publishable(spark, tmp_path, name):
    spec = INDEXES[name]
    frames = [spark.createDataFrame([], S.INPUTS[i]) for i in spec.inputs]
    df = spec.builder(*frames, 3) if spec.all_versions else spec.builder(*frames)
    assert set(df.columns) == set(spec.columns) and spec.description
    assert set(spec.grain) <= set(df.columns)
    path = str(tmp_path / name)
    P.write_parquet(df, path, order=spec.order(), descriptions=spec.columns)
    back = spark.read.schema(df.schema).parquet(path)
    assert back.columns == df.columns and back.count() == 0


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
def test_forbidden_types(spark, tmp_path, kind):
    df = spark.sql(f"select cast(null as {kind}) as bad")
    with pytest.raises(P.UnpublishableType, match="bad"):
        P.write_parquet(df, str(tmp_path / "x"))
    P.check_publishable(spark.sql("select current_timestamp() as t, array('a') as l").schema)


def test_write_is_clustered_and_stamped(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 7 as g", "id as v", "if(id % 5 = 0, null, id) as n")
    path = str(tmp_path / "t")
    P.write_parquet(df, path, order=["g", F.asc_nulls_last("n")], files=4, version="24.1", descriptions={"g": "group"})
    back = spark.read.parquet(path)
    assert back.count() == 1000 and P.release_version(back) == "24.1"
    assert back.schema["g"].metadata["comment"] == "group"
    files = sorted(Path(path).glob("*.parquet"))
    assert 1 < len(files) <= 4 and all("zstd" in f.name for f in files)
    ranges = []
    for f in files:
        part = [(r.g, r.n) for r in spark.read.parquet(str(f)).select("g", "n").collect()]
        keyed = [(g, n is None, n or 0) for g, n in part]
        assert keyed == sorted(keyed)
        ranges.append((keyed[0], keyed[-1]))
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi"', ["a", "b"])], "k int, s string, l array<string>")
    P.write_csv(df, str(tmp_path / "c"))
    assert list((tmp_path / "c").glob("*.csv.gz"))
    back = spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "c")).first()
    assert (back.k, back.s, back.l) == ("1", 'say "hi"', '["a","b"]')


def test_dictionary(spark):
    df = spark.sql("select 1L as n, array(1D) as l, named_struct('a', 'x') as r, true as b")
    got = {r.name: r for r in P.column_dictionary(df, "t", "about", {"n": "count"}).collect()}
    assert (got["n"].type, got["n"].description, got["n"].table_description) == ("INTEGER", "count", "about")
    assert (got["l"].type, got["l"].mode) == ("FLOAT", "REPEATED")
    assert got["r"].type == "RECORD" and got["b"].type == "BOOLEAN"


def test_checksums_and_sizes(spark, tmp_path):
    paths = {}
    for name, n in (("a", 10), ("b", 25)):
        paths[name] = str(tmp_path / name)
        spark.range(n).repartition(2).write.parquet(paths[name])
    files = {f.name: f for f in tmp_path.rglob("*.parquet") if f.is_file()}
    got = {r.file: r.sha256 for r in P.checksums(spark, str(tmp_path)).collect()}
    assert got == {n: hashlib.sha256(f.read_bytes()).hexdigest() for n, f in files.items()}
    report = {r.table: r for r in P.size_report(spark, paths).collect()}
    assert report["a"].rows == 10 and report["b"].rows == 25 and report["total"].rows == 35
    assert report["total"].bytes == sum(f.stat().st_size for f in files.values())
    assert report["total"].files == len(files)


def test_checksums_stream_files_and_never_split_them(spark, tmp_path):
    end, mark = P.PIECE_END.encode(), b"\xef\xbb\xbf"
    contents = {
        "long.parquet": b"PAR1" + b"".join(hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(5000)),
        "no piece.parquet": bytes(range(22, 256)) * 2000,
        "x+%20é#?.parquet": b"PAR1" + end * 3000 + b"PAR1" + end,
        "only.parquet": end,
        "short.parquet": b"\xff\x00" + end + b"\r\n",
        "marked.parquet": mark + b"a" + end + mark + end,
        "mark.parquet": mark + b"a" + end + mark,
        "other.txt": b"a",
    }
    want = []
    for folder in ("x", "y"):
        (tmp_path / folder / "z").mkdir(parents=True)
        for i, (name, data) in enumerate(contents.items()):
            data = data if folder == "x" else data * 2
            (tmp_path / folder / ("z" if i % 2 else "") / name).write_bytes(data)
            want += [(name, hashlib.sha256(data).hexdigest())] if name.endswith("parquet") else []
    settings = {
        "spark.sql.sources.binaryFile.maxLength": "100",  # stands for 2 GB
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "7",
    }
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for size in ("3000b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = P.checksums(spark, str(tmp_path))
            assert sorted((r.file, r.sha256) for r in got.collect()) == sorted(want)
            assert got.schema.simpleString() == "struct<file:string,sha256:string>"
    finally:
        for name in (*settings, "spark.sql.files.maxPartitionBytes"):
            spark.conf.unset(name)


def test_a_file_read_in_part_has_no_checksum():
    digests = P._file_digests(b"\x15")
    batch = pa.RecordBatch.from_pydict({"path": ["a", "a"], "size": [9, 9], "piece": [b"PAR1", b"b"]})
    with pytest.raises(ValueError, match="6 of 9 bytes"):
        list(digests([batch]))


def test_conform_fills_and_casts(spark):
    df = spark.createDataFrame([("x", None)], "SOPInstanceUID string, ImageType array<string>")
    got = conform(df, S.INSTANCES).first()
    assert got.ImageType == [] and got.SegmentSequence == [] and got.Rows is None


def test_versions_and_publishing_end_to_end(spark, tmp_path):
    root = str(tmp_path / "in")

    def ct(sop, series):
        return {"SOPInstanceUID": sop, "SeriesInstanceUID": series, "SOPClassUID": CT_CLASS, "KVP": "120",
                "TransferSyntaxUID": "1.2.840.10008.1.2", "StudyDate": dt.date(2020, 1, 1)}

    old = instances(spark, [ct("1", "a")]).withColumn("idc_version", F.lit(1))
    new = instances(spark, [ct("1", "a"), ct("2", "b")]).withColumn("idc_version", F.lit(2))
    write_versioned(old.unionByName(new), f"{root}/instances")
    for name in ("instances_curated", "version_bookkeeping"):
        spark.createDataFrame([], S.INPUTS[name]).write.parquet(f"{root}/{name}")
    spark.createDataFrame([(1, None), (2, None)], S.VERSIONS).write.parquet(f"{root}/versions")
    tables = Tables(spark, root, versioned=frozenset({"instances"}))
    assert tables.newest("instances") == 2
    assert build("ct_index", tables).count() == 2 and build("ct_index", tables, 1).count() == 1
    plan = build("ct_index", tables, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "idc_version" in plan
    out = publish(tables, str(tmp_path / "out"), ["ct_index", "series_index", "version_metadata_index"], stamp="2.0")
    assert spark.read.parquet(out["series_index"]).count() == 2
    assert spark.read.parquet(out["version_metadata_index"]).count() == 2
    assert P.release_version(spark.read.parquet(out["ct_index"])) == "2.0"
    words = spark.read.parquet(str(tmp_path / "out" / "_dictionary" / "ct_index"))
    assert words.where("description = ''").count() == 0 and words.count() == 21


def test_scan_reads_declared_fields_only(spark, tmp_path):
    nested = """array(named_struct('PrimaryAnatomicStructureSequence',
        array(named_struct('CodeValue', 'a', 'CodingSchemeDesignator', 'S', 'CodeMeaning', 'm', 'LongCode', 'x')),
        'SpecimenShortDescription', 'never read'))"""
    df = spark.sql(
        f"""select 's' as SeriesInstanceUID, 'i' as SOPInstanceUID, 'SM' as Modality, 1.5D as KVP,
        {nested} as SpecimenDescriptionSequence, 'never read' as Unused,
        cast(null as array<string>) as ImageType"""
    )
    df.write.parquet(f"{tmp_path}/instances")
    tables = Tables(spark, str(tmp_path), versioned=frozenset())
    index = build("sm_index", tables)
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Modality), EqualTo(Modality,SM)]" in plan
    scan = next(x for x in plan.splitlines() if "ReadSchema" in x)
    for absent in ("LongCode", "SpecimenShortDescription", "Unused", "KVP"):
        assert absent not in scan.split("ReadSchema")[1]
    assert index.first().primaryAnatomicStructure_CodeMeaning == "m"
    rows = tables.table("instances")
    assert rows.schema["KVP"].dataType.simpleString() == "double"
    assert rows.first().ImageType == [] and rows.first().SegmentSequence == []


def test_release_without_data_is_an_error(spark, tmp_path):
    from seriesloom.sources.tables import MissingRelease

    rows = spark.createDataFrame([(1, "a"), (2, "b")], "idc_version int, SOPInstanceUID string")
    write_versioned(rows, str(tmp_path / "instances"))
    spark.createDataFrame([(1,), (2,), (3,)], "idc_version int").write.parquet(str(tmp_path / "versions"))
    tables = Tables(spark, str(tmp_path))
    assert tables.table("instances", 2).count() == 1
    with pytest.raises(MissingRelease, match="release 3"):
        tables.table("instances", "current")


def test_refused_types_are_found_at_any_depth(spark):
    schema = spark.sql("select array(date '2020-01-01') a, struct(1 as x, map('k', date '2020-01-01') as m) s, 1 n").schema
    assert [tuple(r) for r in P.refused_columns(spark, schema).collect()] == [("a[]", "date"), ("s.m.value", "date")]
    with pytest.raises(P.UnpublishableType, match="s.m.value"):
        P.check_publishable(schema)


def test_one_frequent_value_gives_even_files(spark, tmp_path):
    df = spark.range(40_000).selectExpr("if(id % 100 = 0, id, -1) as g", "id", "map('a', id) as m")
    for i, grain in enumerate([["id"], []]):
        path = tmp_path / str(i)
        P.write_parquet(df, str(path), order=["g"], files=8, grain=grain)
        sizes = [spark.read.parquet(str(f)).count() for f in sorted(path.glob("*.parquet"))]
        assert len(sizes) == 8 and sum(sizes) == 40_000 and max(sizes) < 2 * 5000
        assert spark.read.parquet(str(path)).groupBy("g").count().where("g = -1").first()["count"] == 39_600


def test_digest_tree_is_the_same_however_a_file_is_split(spark, tmp_path):
    content = b"".join(bytes([i % 256]) * (i % 7) + (b"\n\t" if i % 5 == 0 else b"\n") for i in range(40_000))
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.parquet").write_bytes(content)
    (tmp_path / "x" / "b.parquet").write_bytes(b"no separator \xff\x00")
    want = {}
    for name, data in (("a.parquet", content), ("b.parquet", b"no separator \xff\x00")):
        pieces = data.split(b"\n\t")
        pieces = pieces if pieces[-1] else pieces[:-1]
        text = "".join(hashlib.sha256(p).hexdigest() for p in pieces)
        want[name] = (len(data), len(pieces), hashlib.sha256(text.encode()).hexdigest())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("3000b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = P.tree_checksums(spark, str(tmp_path / "x"), "\n\t")
            assert {r.file: (r.bytes, r.pieces, r.digest) for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_content_digest_tells_rows_apart(spark):
    def digest(rows):
        df = spark.createDataFrame(rows, "a string, b string")
        return tuple(P.content_digest(df.repartition(3)).first())

    assert digest([("x", "y"), ("z", None)]) == digest([("z", None), ("x", "y")])
    tables = [[("a", "a")] * 2, [("b", "b")] * 2, [("a\t", "a")] * 2, [("a", "\ta")] * 2, [("a", None)] * 2, [("a", "\\N")] * 2]
    assert len({digest(t) for t in tables}) == len(tables)
    assert digest([])[0] == 0
