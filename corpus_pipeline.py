"""From raw documents to packed training sequences, stage by stage.

Each stage works on all rows that the one before kept. Null columns, empty tables and repeated rows
are handled as the operators define; a stage keeps the columns of its documents, the last one returns
pieces of sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import decontaminate, neardup, pack, quality, substring
from seriesloom.llm.shared import numbered, stored
from seriesloom.llm.tokens import vocabulary

#: Words of a passage that counts as repeated.
PASSAGE_WORDS = 50
VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the risk-controlled rules accept."""
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return neardup.one_of_each(docs, size=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one has.

    A text that loses nothing stays as it is; of others the kept words are joined by one space, and a
    text that loses everything is empty. ``n_chars`` follows the text.
    """
    rows, names, back = numbered(docs)
    found = substring.without_repeats(rows, window=PASSAGE_WORDS, key=names["doc_id"], text=names["text"])
    changed = F.col("_n_removed") > 0
    rewritten = {names["text"]: F.when(changed, F.col("_kept")).otherwise(F.col(names["text"]))}
    if "n_chars" in names:
        chars = F.when(changed, F.length("_kept")).otherwise(F.col(names["n_chars"]))
        rewritten[names["n_chars"]] = chars.cast(docs.schema["n_chars"].dataType)
    return found.withColumns(rewritten).select(*back)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that resembles a benchmark item."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens, with their token ids."""
    pieces = pack.packed(docs, vocabulary=vocabulary(VOCABULARY), length=1024)
    return pieces.withColumnsRenamed({"doc": "doc_id", "tokens": "doc_tokens", "sequence": "sequence_id"})


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL cannot express certified cutoffs, curve order and token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents; what a stage returns is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
