"""Registered queries of the operators for training text."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, chat, decontaminate, hmm, licences, merkle, neardup, pack, pagetext, quality, sharding, substring,
    tokenfile,
)
from .shared import mapped, shared_folder, stored
from .tokens import vocabulary

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    measured = stored(quality.with_measures(docs, carry=["doc_id", "lang"]))
    out = quality.judged(docs, _table(spark, folder, "labels"), carry=["doc_id"], measured=measured)
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select(
        "doc_id",
        *[F.col(f"_measures.{c}").alias(c) for c in base],
        F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
    )


def op1_pack(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    pieces = pack.packed(docs, vocabulary=vocabulary("byte_bpe_50k.json"), length=1024)
    return pieces.select(
        F.col("doc").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        F.col("tokens").alias("doc_tokens"), F.col("sequence").alias("sequence_id"), "offset",
    )


def op2_substring(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    out = substring.without_repeats(docs, window=13, carry=["doc_id"])
    return out.select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"),
        F.sha2(F.col("_kept"), 256).alias("kept_sha256"),
    )


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = _table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return sharding.placed(rows, "doc_id", shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.matches(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.withColumnsRenamed({"doc": "doc_id", "item": "item_id"})


def op5_tokenfile(spark: SparkSession, folder: str) -> DataFrame:
    target = shared_folder(spark)
    docs = _table(spark, folder, "documents")
    files = tokenfile.write(docs, target, vocabulary=vocabulary("byte_bpe_50k.json"))
    return tokenfile.read(spark, target, files).select(
        F.col("doc").alias("doc_id"), "start", F.col("tokens").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op6_hmm(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.scored(_table(spark, folder, "documents")).withColumnRenamed("doc", "doc_id")


def op7_licences(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scanned(_table(spark, folder, "documents"))
    counts = [F.col(c).cast("long").alias(c) for c in ("shared", "size", "template_size")]
    return found.select(F.col("doc").alias("doc_id"), F.col("line").cast("long").alias("line"), "licence", *counts)


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("</s>[INST] ok [/INST]").alias("text")
    both = [F.struct(F.lit(i).alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))]
    turns = F.explode(F.array(*both))
    added = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), turns.alias("t"), text)
    added = added.select("conv_id", F.col("t.turn").cast("long").alias("turn"), "t.role", "text")
    out = chat.formatted(rows.union(added), vocabulary=vocabulary("byte_bpe_50k.json"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                turns = chat.turns_of(row["text"])
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                spans = (np.array(row[c], np.int64) for c in ("starts", "ends"))
                loss = "".join(chat.loss_texts(row["text"], *spans, np.array(row["loss"], bool)))
                sums = [hashlib.sha256(t.encode()).hexdigest() for t in (said, loss)]
                found.append((row["conv"], len(turns), sums[0], len(loss), sums[1], len(row["text"])))
            columns = list(zip(*found, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return mapped(out, digest, schema)


def op8_neardup(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(_table(spark, folder, "documents"), size=2, percent=80)
    return found.select(
        F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept"
    )


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    fields = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    lowered = fields | {"text": F.translate("text", string.ascii_uppercase, string.ascii_lowercase)}
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = merkle.manifest(
        docs, tree="source", order="doc_id", leaf=merkle.leaf([*fields.values()]),
        presented=F.when(tampered, merkle.leaf([*lowered.values()])),
    )
    out = rows.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"),
        merkle.folded(F.coalesce("presented", "leaf"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_pagetext(spark: SparkSession, folder: str) -> DataFrame:
    return pagetext.main_text(_table(spark, folder, "pages")).withColumnRenamed("key", "page_id")


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    paths = {"a": vocabulary("byte_bpe_50k.json"), "b": vocabulary("piece_bpe_32k.model")}
    return alignment.aligned(docs, **paths).withColumnRenamed("key", "doc_id")


def queries() -> dict[str, Query]:
    return {
        "op1_pack": op1_pack,
        "op2_substring": op2_substring,
        "op3_sharding": op3_sharding,
        "op4_decontamination": op4_decontamination,
        "op5_tokenfile": op5_tokenfile,
        "op6_hmm": op6_hmm,
        "op7_licences": op7_licences,
        "op8_neardup": op8_neardup,
        "op9_chat": op9_chat,
        "op10_quality": op10_quality,
        "op11_manifest": op11_manifest,
        "op12_pagetext": op12_pagetext,
        "op13_alignment": op13_alignment,
    }
