"""Registered queries of this subpackage: one per operator, each over its whole
table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docrank.llm import (bpe, ctw, filter_audit, html_blocks, lang_id, mixing, perm_index, pii, rp_forest, setsketch,
                         token_counts, token_files, whitening)
from docrank.llm.common import table
from docrank.llm.oracle import ORACLE_SQL  # noqa: F401


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perm_index.search_report(table(spark, sf_dir, "embeddings"))


def op2_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_report(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_report(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op5_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_report(table(spark, sf_dir, "documents"))


def op6_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op7_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicate_report(table(spark, sf_dir, "documents"), words=3, percent=85)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.file_report(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.language_report(table(spark, sf_dir, "documents"))


def op11_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.text_report(table(spark, sf_dir, "pages"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_permutation_index, op2_rp_forest, op3_token_counts, op4_bpe, op5_ctw, op6_pivotal_mix, op7_setsketch,
    op8_token_files, op9_pii, op10_language_id, op11_block_labeller, op12_filter_audit,
    op13_feast_whitening)}
