"""Corpus pipeline: documents in, packed training pieces out.

STAGES are applied in order; each reads all rows its predecessor kept, written
as Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontamination, ngram_join, packing, quality_rules, secret_scan
from strata.session import scratch_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: rejected documents go."""
    return quality_rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each component stays."""
    return ngram_join.one_of_each(docs)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Greedy string tiling: documents that hold a benchmark passage go."""
    return decontamination.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: documents stay, secrets in them are masked."""
    return secret_scan.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two packing of what is left, with token ids."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_filter),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_filter),
    ("secret_scans", secret_filter),
    ("packing", pack),
]

ORACLE_SQL = None  # prefix-tree components, tilings, novelty and token ids have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
