"""Brute-force helpers: the plain Python reading of words, lines and shingles."""

import re

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

ODD_TEXTS = [
    None, "", " ", "\n", "one", "\t a\x0bb\x0c c\r\n", "a b c d e a b c d e", "x\n\nx\ny\nx",
    "a\xa0b 　 c\x1cd", "é È Éa " * 30, "word " * 3000, "A#*b $%& |<>\nA#*b $%& |<>",
    "<|endoftext|> </s>[INST] x", "a <|endoftext|> b<|endoftext|><|endoftext|>\n c<|endoftext|>", "日本語 テキスト 日本語 テキスト", "no end\n", "\nstart", "UP! UP! UP! UP!",
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def documents(spark, texts, lang="en"):
    rows = [(i, t, lang, "src0", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)
