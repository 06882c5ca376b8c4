"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (
    chat,
    clustering,
    codes,
    decontamination,
    fingerprints,
    jaccard_join,
    language_id,
    licenses,
    mixing,
    token_counts,
    topk,
    toxicity,
    url_filters,
)
from tessera.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.url_filter_query(spark, sf_dir)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digests(table(spark, sf_dir, "conversations"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_decontamination, op3_url_filters, op4_fingerprints, op5_jaccard_join, op6_chat_formatting, op7_mixing,
    op8_token_counts, op9_license_scan, op10_language_id, op11_exact_top_k, op12_centroid_clustering, op13_vector_codes)}
ORACLES = {
    "op2_decontamination": decontamination.ORACLE,
    "op3_url_filters": url_filters.ORACLE,
    "op6_chat_formatting": chat.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op9_license_scan": licenses.ORACLE,
    "op11_exact_top_k": topk.ORACLE,
    "op12_centroid_clustering": clustering.ORACLE,
    "op13_vector_codes": codes.ORACLE,
}
