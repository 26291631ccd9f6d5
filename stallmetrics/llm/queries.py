"""The registered queries of this subpackage, with production parameters over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stallmetrics.llm import (
    chat, decontaminate, embedding_dedup, html_extract, line_dedup, mixing, ngram_join, phrases, pii, quality, sharding,
    url_filter, variants,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leak_report(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.similar_vectors(_table(spark, folder, "embeddings"))


def op3_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extraction_report(_table(spark, folder, "pages"))


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, folder, "documents"))


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_report(_table(spark, folder, "conversations"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_report(_table(spark, folder, "documents"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixing_report(_table(spark, folder, "documents"))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_report(_table(spark, folder, "pages"))


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.phrase_report(_table(spark, folder, "documents"))


def op12_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_variants(_table(spark, folder, "documents"))


def op13_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_report(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_html_extract": op3_html_extract,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op6_sharding": op6_sharding,
    "op5_chat_format": op5_chat_format,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality": op8_quality,
    "op9_mixing": op9_mixing,
    "op10_url_filter": op10_url_filter,
    "op11_phrases": op11_phrases,
    "op12_variants": op12_variants,
    "op13_pii": op13_pii,
}
ORACLES: dict[str, str] = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op2_embedding_dedup": embedding_dedup.ORACLE,
    "op4_ngram_jaccard": ngram_join.ORACLE,
    "op5_chat_format": chat.ORACLE,
    "op6_sharding": sharding.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op10_url_filter": url_filter.ORACLE,
    "op11_phrases": phrases.ORACLE,
    "op12_variants": variants.ORACLE,
}
