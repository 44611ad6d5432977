"""From documents to token ids: five stages, each an operator of the library over all that the last one kept.

All but the last return the columns of their input, whatever further ones it has and however they
are named; without rows they return none. Nulls in any column are kept; what a null or empty text
means to a stage is said there.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardpulse.llm import decontam, language, piece_bpe, sentence_spans, simhash
from boardpulse.llm.common import scratch_folder, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those in no known language; null and empty texts go by their other evidence."""
    return language.without_rejected(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of four-word shingles link at four differing bits or fewer.

    The smallest id stays, ties by a hash of the text. Texts without words have the fingerprint zero and are one group.
    """
    return simhash.one_of_each(docs)


def repeated_span_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand in an earlier document or place; no document goes, a null text stays null."""
    return sentence_spans.without_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold benchmark passages; null and empty texts hold none."""
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): sentence-piece ids of each text, and the text decoded from them; a null is an empty text."""
    proto = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    found = piece_bpe.round_trip(docs.select("doc_id", "text"), proto)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES: list[tuple[str, Stage]] = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_spans", repeated_span_stage),
    ("decontamination", decontamination_stage),
    ("pieces", piece_stage),
]

#: SQL has no sentence pieces, fingerprints or likelihoods; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each but the last is written and read again."""
    folder = scratch_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name, folder)
    return STAGES[-1][1](spark, docs, sf_dir)
