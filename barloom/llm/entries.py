"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import binary_out, decontam, html, licenses, packing, quality, simhash, spans, token_counts, urls
from .common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(*quality.COLUMNS)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_out.packed_matrix(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup_substrings(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_decontamination, op2_token_counts, op3_quality_rules, op4_license_scan, op5_binary_output, op6_packing, op7_html_extraction, op8_simhash, op9_substring_dedup, op10_url_filter)}


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": quality.ORACLE_SQL, "op10_url_filter": urls.oracle_sql()}
