"""Queries of the training-data operators: one ``opN_<name>`` each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (
    bpe,
    context_mixing,
    decontamination,
    hard_negatives,
    html_text,
    language_id,
    license_scan,
    ngram_join,
    packing,
    quality_rules,
    secret_scan,
    token_counts,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under 5-word shingle Jaccard >= 0.75."""
    return ngram_join.ngram_components(_documents(spark, sf_dir))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page, laid out."""
    return html_text.extracted(_table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside fold 1 of 3."""
    return language_id.held_out_languages(_documents(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item found in it, with the tiles."""
    return decontamination.contaminations(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document."""
    return packing.packed_digests(_documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact length histogram with running sums; each length is a context limit."""
    return token_counts.with_sums(token_counts.length_histogram(_documents(spark, sf_dir)))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: pattern spans and incompressible strings."""
    return secret_scan.secret_digests(_documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document, its base rules and its host's verdict."""
    return quality_rules.judged(_documents(spark, sf_dir))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document, its own or its directory's."""
    return license_scan.licenses(license_scan.as_files(_documents(spark, sf_dir)))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document by context mixing and by word unigrams."""
    return context_mixing.held_out_scores(_documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th embedding against all others."""
    return hard_negatives.mined(hard_negatives.relabelled(_table(spark, sf_dir, "embeddings")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the covariance's 32 largest components, whitened."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-pair ids of every document and the text they decode to, as digests."""
    return bpe.round_trip_digests(_documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_html_extraction": op2_html_extraction,
        "op3_language_id": op3_language_id,
        "op4_decontamination": op4_decontamination,
        "op5_packing": op5_packing,
        "op6_token_counts": op6_token_counts,
        "op7_secret_scan": op7_secret_scan,
        "op8_quality_rules": op8_quality_rules,
        "op9_license_scan": op9_license_scan,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_whitening": op12_whitening,
        "op13_bpe": op13_bpe,
    }


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the operator on whole tables; the others are
    tested against brute force, round trips or held-out accuracy."""
    return {
        "op8_quality_rules": quality_rules.ORACLE_SQL,
        "op9_license_scan": license_scan.ORACLE_SQL,
        "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    }
