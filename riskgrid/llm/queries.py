"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.llm import (
    alignment, decontaminate, hard_negatives, language_id, line_templates, mixing, near_dup, paragraph_dedup, pu_classifier, quality_rules, secrets, suffix_dedup, token_counts)
from riskgrid.llm.common import read


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary file, installed on every machine with its package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_classifier.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = token_counts.prefix_counts(read(spark, sf_dir, "documents"), vocabulary())
    out = token_counts.answers(table, budgets=(token_counts.LIMIT,), lengths=(1000,))
    return out.select("doc_id", "n_bytes", "n_tokens", token_counts.over_limit(), "chars_within_512", "tokens_of_1000")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dup.near_duplicates(read(spark, sf_dir, "documents"), size=4, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.report(read(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_templates.drop_recurring_lines(read(spark, sf_dir, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", "text_kept")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", label.alias("label"), "embedding"), F.col("id") % 50 == 0, scale=256.0)


QUERIES = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_quality_classifier, op3_token_counts, op4_secret_scan, op5_minhash_near_dedup, op6_benchmark_decontamination, op7_paragraph_dedup, op8_source_mixing, op9_line_dedup,
    op10_quality_rules, op11_cross_tokenizer_alignment, op12_language_id, op13_hard_negatives)}
SQL = {
    "op6_benchmark_decontamination": decontaminate.sql(),
    "op8_source_mixing": mixing.sql(),
    "op9_line_dedup": line_templates.sql(),
    "op13_hard_negatives": hard_negatives.sql(),
}
