"""The corpus pipeline: quality rules, near duplicates, decontamination, secrets, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscope.llm import bpe, decontam, jaccard_join, quality, secrets
from gridscope.sources.tables import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of least doc_id, of each group of near duplicates."""
    return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars follows the text."""
    length = F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))
    return secrets.redact(docs).withColumn("n_chars", length)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, with digests of the ids and of what they decode to."""
    return bpe.round_trips(docs, bpe.default_path("byte_bpe_50k.tiktoken"), keep_ids=True)


STAGES = [
    ("quality_rules", good_quality),
    ("ngram_jaccard_join", without_copies),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("byte_bpe", token_ids),
]

#: Chosen-path joins and byte-pair merges have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
