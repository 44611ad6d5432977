"""One query per operator: its production settings over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardpulse.llm import (
    chat,
    decontam,
    dual_lloyd,
    html_main,
    language,
    merkle,
    piece_bpe,
    quality_trees,
    robust,
    secret_ledger,
    sentence_spans,
    simhash,
    simple8b,
)
from boardpulse.llm.oracle import ORACLE_SQL  # noqa: F401


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    found = language.document_languages(_table(spark, folder, "documents"))
    return found.select("doc_id", "language", "probability", "accepted")


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_classes(_table(spark, folder, "documents"))
    return found.select("doc_id", simhash.fingerprint_text(found.fp).alias("fingerprint"), "component_id")


def op3_decontam(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op4_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return sentence_spans.without_repeats(documents.select("doc_id", "text", F.char_length("text").alias("n_before"), "n_chars")).select(
        "doc_id", "text", "n_chars", (F.coalesce("n_before", F.lit(0)) - F.coalesce("n_chars", F.lit(0))).alias("n_removed")
    )


def _vocabulary(name: str) -> bytes:
    """A file of the public tokenizers, for the tasks of a job."""
    return Path(public_tokenizers.path(name)).read_bytes()


def op5_simple8b(spark: SparkSession, folder: str) -> DataFrame:
    return simple8b.id_digests(_table(spark, folder, "documents"), _vocabulary("byte_bpe_50k.json"))


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_main.extracted(_table(spark, folder, "pages"))


def op7_piece_bpe(spark: SparkSession, folder: str) -> DataFrame:
    proto = _vocabulary("piece_bpe_32k.model")
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    found = piece_bpe.round_trip(documents, proto)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_robust(spark: SparkSession, folder: str) -> DataFrame:
    found = robust.quality_verdicts(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return quality_trees.scored(documents, quality_trees.learn(documents, _table(spark, folder, "labels")))


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit("</s>[INST] ok [/INST]")
    )
    return chat.conversation_digests(chat.format_conversations(rows.union(own)))


def op11_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_ledger.secret_digests(_table(spark, folder, "documents"))


def op12_dual_lloyd(spark: SparkSession, folder: str) -> DataFrame:
    return dual_lloyd.vector_codes(_table(spark, folder, "embeddings"))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified(merkle.document_manifest(_table(spark, folder, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_simhash": op2_simhash,
    "op3_decontam": op3_decontam,
    "op4_sentence_spans": op4_sentence_spans,
    "op5_simple8b": op5_simple8b,
    "op6_main_text": op6_main_text,
    "op7_piece_bpe": op7_piece_bpe,
    "op8_robust": op8_robust,
    "op9_quality_trees": op9_quality_trees,
    "op10_chat": op10_chat,
    "op11_secrets": op11_secrets,
    "op12_dual_lloyd": op12_dual_lloyd,
    "op13_merkle": op13_merkle,
}
