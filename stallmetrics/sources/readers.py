"""Thin readers. Connection settings always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(
    spark: SparkSession, options: Mapping[str, str], table: str, split: Mapping[str, str] | None = None
) -> DataFrame:
    """Table over JDBC. ``split`` (partitionColumn, lowerBound, upperBound, numPartitions) reads it in parallel."""
    return spark.read.format("jdbc").options(**options, **(split or {})).option("dbtable", table).load()


def read_jdbc_query(spark: SparkSession, options: Mapping[str, str], query: str) -> DataFrame:
    """Result of a query the database runs."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()
