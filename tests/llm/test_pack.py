import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from seriesloom.llm import pack
from seriesloom.llm.tokens import Encoder, vocabulary

from .support import ODD_TEXTS, documents

FILE = vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    out = Tokenizer.from_file(FILE)
    return out


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_encoder_equals_whole_text_encoding(tokenizer, monkeypatch):
    rng = random.Random(1)
    marks = [" ", "\n", "  ", "\t", " ", "\x1c", "　", "\x85", "it's", "42", "é", "word", "!", "<|endoftext|>"]
    texts = [*ODD_TEXTS, *("".join(rng.choice(marks) for _ in range(rng.randrange(25))) for _ in range(2000))]
    want = [np.array(ids_of(tokenizer, t)[:-1], "<u4").tobytes() for t in texts]
    assert Encoder(FILE).encode(texts) == want
    monkeypatch.setattr("seriesloom.llm.tokens.CACHE", 20)
    small = Encoder(FILE)
    assert [small.encode([t])[0] for t in texts] == want


def test_marks_and_repeats_are_not_encoded_again(tokenizer, monkeypatch):
    encoder = Encoder(FILE)
    fresh, seen = encoder._fresh, []
    monkeypatch.setattr(encoder, "_fresh", lambda parts: seen.extend(parts) or fresh(parts))
    texts = ["in sun, sun. sun! moon: moon", "in moon, moon, moon; x.y. 's, don't. stars"]
    want = [np.array(ids_of(tokenizer, t)[:-1], "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == want
    assert len(seen) == len(set(seen))
    assert {"sun", "moon"} <= set(seen) and not {"sun,", "sun.", "moon,", "moon:"} & set(seen)
    assert encoder.encode(texts) == want and len(seen) == len(set(seen))


def test_hilbert_curve_visits_each_cell_and_moves_by_one():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    index = pack.hilbert_index(cells, bits=3)
    assert sorted(index.tolist()) == list(range(512))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_pieces_cover_each_document_without_padding(spark, tokenizer):
    rng = random.Random(4)
    texts = [*ODD_TEXTS, *(" ".join(rng.choice(["sun", "moon", "stars"]) for _ in range(rng.randrange(300))) for _ in range(80))]
    docs = documents(spark, texts).withColumnRenamed("lang", "ids").repartition(3)
    rows = pack.packed(docs, vocabulary=FILE, length=64).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc].append(r)
        by_sequence[r.sequence].append(r)
        assert r.length > 0 and len(r.ids) == 4 * r.length
    assert set(by_doc) == set(range(len(texts)))
    for doc, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        want = np.array(ids_of(tokenizer, texts[doc]), "<u4").tobytes()
        assert b"".join(r.ids for r in pieces) == want
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        assert {r.tokens for r in pieces} == {len(want) // 4}
        assert zlib.crc32(want) == zlib.crc32(b"".join(r.ids for r in pieces))
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        total = sum(r.length for r in pieces)
        assert total == 64 or total < 64 and total & (total - 1) == 0


def test_neighbours_are_alike(spark):
    texts = [f"{kind} " * 40 + str(i) for i, kind in enumerate(["apple", "river", "engine"] * 40)]
    rows = pack.packed(documents(spark, texts), vocabulary=FILE, length=128).collect()
    order = sorted({(r.sequence, r.offset): r.doc for r in rows if r.start == 0}.items())
    kinds = [doc % 3 for _, doc in order]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) < 20


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = documents(spark, ["a b", "c"])
    docs = docs.union(docs).union(docs.selectExpr("cast(null as long)", "text", "lang", "source", "n_chars"))
    rows = pack.packed(docs, vocabulary=FILE, length=4).collect()
    assert sum(r.length for r in rows) == 3 * (3 + 2)
    assert pack.packed(docs.limit(0), vocabulary=FILE).count() == 0
