"""The corpus pipeline: quality, near duplicates, benchmark passages, secrets, packing, each over what the stage before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridgate.llm import decontaminate, near_duplicates, packing, quality, secrets
from gridgate.llm.common import ready, staged


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    ready(spark)
    return quality.accept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    ready(spark)
    return near_duplicates.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With every passage of a benchmark item cut out of the texts; documents of which no word is left go."""
    ready(spark)
    return decontaminate.remove_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With every secret masked in the texts."""
    ready(spark)
    return secrets.mask_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2,048 tokens, with their ids."""
    ready(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scan),
    ("packing", packed),
]

#: Models, tokenizers and alignments cannot be put in SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
