"""The registered queries of this subpackage and their SQL forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import benchmark, chat, divergence, html, licenses, mixing, prefixes, quality, resampling, secrets, simhash, substrings, tokens
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(table(spark, sf_dir, "pages"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.secret_scan(docs, secrets.train(docs))


def op7_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against a variant that repeats its first answer at the end."""
    turns = table(spark, sf_dir, "conversations")
    return chat.preference_rows(turns, chat.repeated_answer(turns))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sampled(table(spark, sf_dir, "documents"), columns=["doc_id", "source", "lang"])


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.edit_fingerprints(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in (
    op1_quality_rules, op2_license_scan, op3_substring_dedup, op4_benchmark_decontamination, op5_html_extraction, op6_secret_scan,
    op7_preference_formatting, op8_source_mixing, op9_simhash_near_dedup, op10_token_counts, op11_source_divergence, op12_document_fingerprints,
    op13_importance_resampling)}
SQL: dict[str, str] = {
    "op1_quality_rules": quality.SQL, "op3_substring_dedup": substrings.SQL, "op7_preference_formatting": chat.SQL,
    "op11_source_divergence": divergence.SQL, "op13_importance_resampling": resampling.SQL}
