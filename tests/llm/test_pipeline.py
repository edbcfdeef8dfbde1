import random
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from seriesloom.llm.tokens import vocabulary

from .support import ODD_TEXTS, documents
from .test_decontaminate import expected as contaminated
from .test_neardup import expected as near
from .test_quality import expected as measures
from .test_substring import expected as substrings


def write(spark, folder, docs, benchmark, labels):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def corpus():
    rng = random.Random(11)
    vocabulary_ = [f"w{i}" for i in range(900)]
    pick = lambda n: [rng.choice(vocabulary_) for _ in range(n)]
    items = [(i, " ".join(pick(30))) for i in range(8)]
    passage = pick(70)
    texts = list(ODD_TEXTS)
    for i in range(150):
        w = pick(rng.randrange(5, 200))
        if i % 5 == 0:
            w[3:3] = passage
        if i % 7 == 0:
            w[2:2] = items[i % 8][1].split()
        texts += [" ".join(w)] * rng.choice((1, 1, 2))
        if i % 6 == 0 and len(w) > 60:
            w[5] = "changed"
            texts.append("\n".join(w))
    return texts, items


def test_whole_pipeline_against_brute_force(spark, tmp_path):
    texts, items = corpus()
    folder = write(spark, tmp_path, documents(spark, texts).repartition(3), items, [(0, 1, 0)])
    kept = []
    for i, text in enumerate(texts):
        m = measures(text)
        if not (m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]):
            kept.append(i)
    classes = near([texts[i] for i in kept], 5)
    kept = [i for at, i in enumerate(kept) if classes[at][2]]
    cut = substrings([texts[i] for i in kept], corpus_pipeline.PASSAGE_WORDS)
    assert any(c[1] for c in cut.values())
    left = {i: cut[at][2] if cut[at][1] else texts[i] for at, i in enumerate(kept)}
    hits = {list(left)[at] for at, _ in contaminated(list(left.values()), items)}
    assert hits
    left = {i: t for i, t in left.items() if i not in hits}
    tokenizer = Tokenizer.from_file(vocabulary(corpus_pipeline.VOCABULARY))
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        pieces[r.doc_id].append((r.start, r.ids))
    assert set(pieces) == set(left)
    for i, text in left.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert b"".join(p for _, p in sorted(pieces[i])) == np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_handles_empty_tables_nulls_and_extra_columns(spark, tmp_path, name, stage):
    docs = documents(spark, [*ODD_TEXTS, None])
    docs = docs.union(docs.selectExpr("cast(null as long)", "text", "lang", "source", "n_chars"))
    docs = docs.selectExpr("*", "doc_id as doc", "text as component", "lang as spans", "1 as _stratum")
    clashing = ("_measures", "_kept", "_n_words", "_n_removed", "_doc", "_base_failed", "_c0", "c1", "dropped", "alone")
    docs = docs.selectExpr("*", *[f"{i} as {name}" for i, name in enumerate(clashing)])
    folder = write(spark, tmp_path, documents(spark, []), [], [])
    for frame in (docs, docs.limit(0), docs.union(docs)):
        out = stage(spark, frame, folder)
        if name != "packing":
            assert out.columns == frame.columns
            assert out.schema.simpleString() == frame.schema.simpleString()
        out.write.format("noop").mode("overwrite").save()
