"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import decontaminate, exact_dedup, language_id, packing, simhash
from ledgerlake.llm.common import materialise
from ledgerlake.llm.queries import table, tokenizer

# Texts that a Python task takes at once: one after another, the stages share the executors' memory.
BATCH_BYTES = 2 << 20


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a letter, or without a likely language, go."""
    return language_id.drop_unknown(docs, tokenizer("piece_bpe_32k.model"), batch_bytes=BATCH_BYTES)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs, words=3, radius=2)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated rows go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), keep_words=False, added_tokens=True,
                        batch_bytes=BATCH_BYTES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("benchmark_decontamination", benchmark),
    ("packing", pack),
]

# A learned classifier and a tokenizer are among the stages: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
