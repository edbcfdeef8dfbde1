import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from seriesloom.llm import tokenfile
from seriesloom.llm.tokens import vocabulary

from .support import ODD_TEXTS, documents

FILE = vocabulary("byte_bpe_50k.json")


def expected(texts):
    tokenizer = Tokenizer.from_file(FILE)
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes() for t in texts]


def test_round_trip(spark, tmp_path):
    rng = random.Random(3)
    texts = [*ODD_TEXTS, *(" ".join(rng.choice(["ice", "fire", "wind"]) for _ in range(rng.randrange(200))) for _ in range(150))]
    docs = documents(spark, texts).withColumnRenamed("lang", "ids").repartition(5)
    folder = str(tmp_path / "out")
    files = tokenfile.write(docs, folder, vocabulary=FILE)
    rows = sorted(tokenfile.read(spark, folder, files).collect(), key=lambda r: r.doc)
    want = expected(texts)
    assert [r.ids for r in rows] == want
    assert [r.tokens for r in rows] == [len(ids) // 4 for ids in want]
    assert [r.start for r in rows] == [sum(len(ids) // 4 for ids in want[:i]) for i in range(len(want))]
    listed = files.orderBy("part").collect()
    assert sum(f.docs for f in listed) == len(texts) and sum(f.tokens for f in listed) == rows[-1].start + rows[-1].tokens
    # one document alone, through the index
    system, path = tokenfile.opened(folder)
    with system.open_input_file(f"{path}/{listed[-1].file}") as source:
        reader = tokenfile.Reader(source, (tmp_path / "out" / "dictionary").read_bytes())
        last = len(reader.index) - 1
        assert reader.ids(last) == want[int(reader.index[last]["doc"])]
        with pytest.raises(ValueError, match="another dictionary"):
            tokenfile.Reader(source, b"x")


def test_dictionary_helps_short_documents():
    rng = np.random.default_rng(1)
    phrases = rng.integers(0, 50000, (40, 12)).astype("<u2")
    samples = [phrases[rng.integers(0, 40, 5)].tobytes() for _ in range(800)]
    dictionary = tokenfile.trained(samples)
    import zstandard

    alone = zstandard.ZstdCompressor(level=3)
    shared = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary))
    assert sum(len(shared.compress(s)) for s in samples) < sum(len(alone.compress(s)) for s in samples) / 2
    assert tokenfile.trained([]) == b"" and tokenfile.trained([b"ab"]) == b""


def test_null_and_repeated_ids_and_empty_table(spark, tmp_path):
    docs = documents(spark, ["b", "a"])
    docs = docs.union(docs).union(docs.selectExpr("cast(null as long)", "text", "lang", "source", "n_chars"))
    files = tokenfile.write(docs, str(tmp_path / "a"), vocabulary=FILE)
    rows = sorted(tokenfile.read(spark, str(tmp_path / "a"), files).collect(), key=lambda r: r.start)
    assert [r.doc for r in rows] == [None, None, 0, 0, 1, 1]
    assert [r.start for r in rows] == [0, 2, 4, 6, 8, 10]
    none = tokenfile.write(docs.limit(0), str(tmp_path / "b"), vocabulary=FILE)
    assert tokenfile.read(spark, str(tmp_path / "b"), none).count() == 0
