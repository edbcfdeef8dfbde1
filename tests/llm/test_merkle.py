"""The manifest against a plain recursive reading of it."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from seriesloom.llm import merkle, queries

from .support import DOCS


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    return digest(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def build(nodes, fanout):
    """Root and, for each leaf, its siblings as (left, right) lists level by level."""
    paths = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, above_owners = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for k, own in enumerate(owners[at : at + fanout]):
                for i in own:
                    paths[i].append((run[:k], run[k + 1 :]))
            above.append(digest(*run))
            above_owners.append([i for own in owners[at : at + fanout] for i in own])
        nodes, owners = above, above_owners
    return nodes[0], paths


def expected(rows, fanout=16):
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for name in names:
        group = sorted(groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        built[name] = group, *build([leaf(r) for r in group], fanout)
    root, upper = build([built[n][1] for n in names], fanout)
    out = []
    for name, over in zip(names, upper, strict=True):
        group, subroot, paths = built[name]
        for row, path in zip(group, paths, strict=True):
            path = path + over
            seen = dict(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and row["text"]:
                seen["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])
            fold = leaf(seen)
            for left, right in path:
                fold = digest(*left, fold, *right)
            proof = digest(*(d for left, right in path for d in left + right))
            out.append((row["doc_id"], leaf(row), subroot, root, proof, fold, fold == root))
    return sorted(out, key=repr)


def found(spark, rows, tmp_path):
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in queries.op11_manifest(spark, str(tmp_path)).collect()), key=repr)


def row(i, text="Some Text", source="s", lang="en"):
    return {"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": len(text or "")}


def test_groups_of_all_sizes(spark, tmp_path):
    rng = random.Random(5)
    sizes = {None: 17, "": 1, "a": 2, "b": 15, "c": 16, "é": 33, "z": 700, "zz": 257} | {f"t{i}": 1 for i in range(20)}
    rows = [row(0, source=s, text=rng.choice(["Aa é", "low", "", None])) for s, n in sizes.items() for _ in range(n)]
    for i, one in enumerate(rng.sample(rows, len(rows))):
        one["doc_id"] = 3 * i
    assert found(spark, rows, tmp_path) == expected(rows)


def test_nulls_ties_repeats_and_long_texts(spark, tmp_path):
    rows = [row(7, "Same"), row(7, "Same"), row(7, "Other"), row(None, None, None, None), row(None, "X" * 300_000)]
    rows += [row(5, "copy")] * 40 + [{**row(3), "n_chars": None}]
    assert found(spark, rows, tmp_path) == expected(rows)


def test_empty_and_single(spark, tmp_path):
    assert found(spark, [], tmp_path / "none") == []
    one = [row(1, "Only")]
    got = found(spark, one, tmp_path / "one")
    assert got == expected(one) and got[0][1] == got[0][2] == got[0][3]


@pytest.mark.parametrize("fanout", [2, 3])
def test_small_fanout_and_clashing_columns(spark, fanout):
    rows = [row(i, source="ab"[i % 2]) for i in range(41)]
    docs = spark.createDataFrame(rows, DOCS)
    for extra in ("key", "leaf", "path", "root", "_digest", "_pos", "_n", "_name", "group", "presented"):
        docs = docs.withColumn(extra, F.lit(1))
    digests = merkle.leaf([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    out = merkle.manifest(docs, tree="source", order="doc_id", leaf=digests, fanout=fanout)
    got = {r["key"]: r for r in out.withColumn("proof", merkle.proof(F.col("path"))).collect()}
    want = expected(rows, fanout)
    assert {(k, r["leaf"], r["subroot"], r["root"], r["proof"]) for k, r in got.items()} == {w[:5] for w in want}


def test_windows_hold_chunks_not_groups(spark):
    docs = spark.createDataFrame([row(i) for i in range(40)], DOCS)
    out = merkle.manifest(docs, tree="source", order="doc_id", leaf=merkle.leaf([F.col("text")]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line and "lag(" in line]
    assert windows and all("_chunk" in line for line in windows)
