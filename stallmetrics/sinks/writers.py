"""Writers for result tables: Parquet folders partitioned by slice, and JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from stallmetrics.sinks.publishing import publish, settled

__all__ = ["append_jdbc", "overwrite_slices", "publish", "rewrite_jdbc", "rewrite_parquet"]


def overwrite_slices(df: DataFrame, path: str, slices: Sequence[str]) -> None:
    """Replace just the partitions ``df`` has rows for. Rows stay in parallel; nothing is coalesced."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*slices)
        .parquet(path)
    )


def rewrite_parquet(next_rows: DataFrame, path: str, slices: Sequence[str] = ()) -> None:
    """Replace a whole Parquet table by rows derived from it."""
    writer = settled(next_rows).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*slices) if slices else writer).parquet(path)


def append_jdbc(df: DataFrame, options: Mapping[str, str], table: str, batch_rows: int = 1000) -> None:
    """Append over JDBC in batches."""
    df.write.format("jdbc").mode("append").options(**options).option("dbtable", table).option(
        "batchsize", batch_rows
    ).save()


def rewrite_jdbc(next_rows: DataFrame, options: Mapping[str, str], table: str) -> None:
    """Replace a whole JDBC table by rows derived from it, keeping its definition."""
    settled(next_rows).write.format("jdbc").mode("overwrite").options(**options).option("dbtable", table).option(
        "truncate", "true"
    ).save()
