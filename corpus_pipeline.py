"""The corpus pipeline: documents that a training run should see, in shards.

Every stage reads what its predecessor kept, as a table in the folder that all executors share, and returns the columns of
``documents``; the last one adds its shards. What earlier stages left on the driver is collected before the next one begins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stallmetrics.llm import decontaminate, mixing, ngram_join, quality, sharding
from stallmetrics.llm.shared import settle, tidy


def _keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    tidy(spark)
    return quality.drop_poor(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    tidy(spark)
    return ngram_join.one_of_each(docs)


def _keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    tidy(spark)
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a single epoch, mixed to the target weights."""
    tidy(spark)
    return mixing.mix(docs)


def _shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their bytes and their shard."""
    tidy(spark)
    return sharding.assign_shards(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", _keep_good),
    ("near_duplicates", _keep_one),
    ("decontamination", _keep_unleaked),
    ("mixing", _mix),
    ("sharding", _shard),
]

#: A classifier has no SQL twin; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
