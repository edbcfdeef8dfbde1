"""Alignment of two vocabularies against encoding each whole text by the libraries."""

import functools
import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel

from seriesloom.llm import alignment
from seriesloom.llm.tokens import vocabulary

from .support import ODD_TEXTS, documents

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
TEXTS = [
    *ODD_TEXTS, "x▁y", "<s>a</s> <unk> <|endoftext|>!", "ﬁ Å　 é́", "a\r\n\r\nb\t\tc  d   \n", "😀😀 👩‍👩‍👧 z",
    "don't we'll \x00 \x1c it's", "no-spaces," * 50, "same words here", "same words here", "   lead", "trail   ",
    "日本語のとても長い文章。" * 40, "1234567890" * 30, "<0x41>", "a" * 500,
]


@functools.cache
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_table():
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def groups_of(text):
    """Groups of a whole text as (A ids, B ids), or None."""
    if not text:
        return None
    a, b = libraries()
    table = byte_table()
    one = a.encode(" " + text, add_special_tokens=False)
    a_tokens = [(i, bytes(table[c] for c in t)) for i, t in zip(one.ids, one.tokens, strict=True)]
    b_tokens = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        b_tokens.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    if any(b"".join(x for _, x in tokens) != want for tokens in (a_tokens, b_tokens)):
        return None
    ends = []
    for tokens in (a_tokens, b_tokens):
        at, own = 0, []
        for i, raw in tokens:
            at += len(raw)
            own.append((i, at))
        ends.append(own)
    common = sorted({e for _, e in ends[0]} & {e for _, e in ends[1]})
    out, low = [], 0
    for high in common:
        out.append(tuple([i for i, e in side if low < e <= high] for side in ends))
        low = high
    return out


def text_of(groups):
    return ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)


def expected(rows):
    counts, found = Counter(), []
    for key, text in rows:
        groups = groups_of(text)
        links = Counter((i, j) for a, b in groups or [] for i in a for j in b)
        counts.update(links.keys())
        found.append((key, groups, links))
    top = {}
    for (i, _), n in counts.items():
        top[i] = max(n, top.get(i, 0))
    out = []
    for key, groups, links in found:
        best = sum(n for pair, n in links.items() if counts[pair] == top[pair[0]])
        total = sum(n * counts[pair] for pair, n in links.items())
        digest = hashlib.sha256(text_of(groups).encode()).hexdigest() if groups else ""
        sides = [sum(len(g[k]) for g in groups or []) for k in (0, 1)]
        out.append((key, *sides, len(groups or []), sum(links.values()), best, total, digest))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("chunk", "block"), [(1 << 16, 16 << 20), (40, 2000), (7, 1)])
def test_like_whole_texts(spark, chunk, block):
    rng = random.Random(chunk)
    letters = ["a", "é", " ", "  ", "\n", "'", "s", ".", "7", "日", "Word", "the", "\t", "-", "▁", "😀", " "]
    odd = ["".join(rng.choices(letters, k=rng.randrange(1, 120))) for _ in range(60)]
    docs = documents(spark, TEXTS + odd).repartition(3)
    out = alignment.aligned(docs, a=A, b=B, chunk=chunk, block=block)
    assert got(out) == expected(list(enumerate(TEXTS + odd)))


def test_null_keys_repeats_and_clashing_columns(spark):
    rows = [(None, "a b"), (None, "a b"), (1, "a b c"), (1, "a b c"), (2, None), (None, "word " * 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for extra in ("key", "row", "block", "groups", "pair", "n_a", "words"):
        docs = docs.withColumn(extra, F.lit("x"))
    assert got(alignment.aligned(docs, a=A, b=B, chunk=500)) == expected(rows)
    assert got(alignment.aligned(docs.limit(0), a=A, b=B)) == []


def test_fragments_compose_in_any_order():
    rng = random.Random(3)
    pair = alignment.vocabularies(A, B)
    for text in ["it's a don't-know, thing\n\n  x y. " * 6, "日本 語x'y z" * 9, "abc" * 30, " ".join(["unusual"] * 30)]:
        text = " " + text
        a, b = (alignment.cut_places(text, 5, p) for p in (alignment._CUT_A, alignment._CUT_B))
        parts = []
        for k in range(len(a) - 1):
            low, high = min(a[k], b[k]), max(a[k + 1], b[k + 1])
            spans = (a[k] - low, a[k + 1] - low), (b[k] - low, b[k + 1] - low)
            parts.append(pair.range_fragment(text[low:high], len(text[:low].encode()), *spans))
        want = text_of(groups_of(text[1:]))
        for _ in range(20):
            left = list(parts)
            while len(left) > 1:
                k = rng.randrange(len(left) - 1)
                left[k : k + 2] = [alignment.composed(left[k], left[k + 1])]
            assert alignment.whole(left[0]) == want


def test_packed_numbers_come_back():
    for most in (0, 255, 256, 70_000, 1 << 40):
        values = np.array([0, most, 1 if most else 0], np.int64)
        assert alignment.unpacked(alignment.packed(values)).tolist() == values.tolist()
    assert alignment.unpacked(alignment.packed(np.empty(0, np.int64))).tolist() == []


def test_block_is_narrow():
    """A few bytes for each word of a document and for each link of the dictionary."""
    own = alignment.Block(0)
    words = [f"{i},{i + 1}|{i + 2}" for i in range(200)]
    for key in range(100):
        own.add(key, words, 1)
    *docs, kept = (batch for batch in own.batches())
    held = sum(len(w.as_py()) for batch in docs for w in batch.column("words"))
    assert held <= 100 * (200 + 1)
    sizes = {c: len(kept.column(c)[0].as_py()) for c in ("pairs", "docs", "first", "members", "times")}
    assert sizes == {"pairs": 8 * 400 + 1, "docs": 400 + 1, "first": 2 * 201 + 1, "members": 2 * 400 + 1, "times": 400 + 1}


def test_texts_come_in_small_batches(spark, monkeypatch):
    """Tasks hold a few MB of texts at a time, however large the session's batches are."""
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before, stored = spark.conf.get(name), alignment.stored

    def watched(frame, **options):
        if "words" in frame.columns:
            texts = spark.range(0, 3000, 1, 1).selectExpr("repeat('abcdefgh', 1000) t")
            sizes = texts.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long")
            seen.extend(r.n for r in sizes.collect())
        return stored(frame, **options)

    monkeypatch.setattr(alignment, "stored", watched)
    assert alignment.aligned(documents(spark, ["a b", None]), a=A, b=B).count() == 2
    assert sum(seen) > 16 << 20 and max(seen) <= 5 << 20
    assert spark.conf.get(name) == before
