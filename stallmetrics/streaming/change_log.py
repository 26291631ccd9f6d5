"""Change-log records as JSON text: parse each value, keep the bad ones apart, never stop the stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BAD = "_bad_record"


def read_topic(spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Values of a Kafka topic as text, from the earliest offset. Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**(options or {}))
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def parse_changes(values: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of each value plus ``bad_record``: the raw text when it is no valid record, else NULL.

    A bad value becomes a record of NULL fields, so good and bad rows add up to the input.
    """
    wide = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    parsed = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    missing = F.col("value").isNull() | (F.trim("value") == "")
    rows = values.withColumn("_r", parsed)
    fields = [F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields]
    bad = F.coalesce(F.when(missing, F.coalesce("value", F.lit(""))), F.col(f"_r.{_BAD}"))
    return rows.select(*fields, bad.alias("bad_record"))
