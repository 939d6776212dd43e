"""Queries of the large-scale text operators: one per operator, and the pipeline.

Each takes (spark, sf_dir), applies its operator with production parameters to the whole
table and returns the columns of its contract (more may follow)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import block_repeats, conversation_trie, decontaminate, html_mincut, language_id, minhash_dedup, multi_index, oracles, permutation_index, phrase_repeats, quality_rules, secret_scan, source_mix, token_output
from folio.llm.common import table


def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(table(spark, sf_dir, "documents"))


def op2_fast_similarity_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.components(table(spark, sf_dir, "documents"), words=minhash_dedup.WORDS)


def op3_subset_sum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(table(spark, sf_dir, "documents"))


def op4_multipart_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op5_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op6_hierarchical_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op7_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op8_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op9_minimum_cut_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_mincut.extract(table(spark, sf_dir, "pages"))


def op10_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return multi_index.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op13_zfast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(conversation_trie.regrafted(conversation_trie.turns_of(table(spark, sf_dir, "conversations"))))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_wavelet_tokens, op2_fast_similarity_dedup, op3_subset_sum_mix, op4_multipart_secrets, op5_rule_ledger, op6_hierarchical_language_id, op7_prefix_free_parsing, op8_block_anchors, op9_minimum_cut_html, op10_template_decontamination, op11_permutation_index, op12_inverted_multi_index, op13_zfast_trie, pipeline)}

ORACLES: dict[str, str] = oracles.ORACLES
