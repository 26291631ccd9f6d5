"""Streams into tables, one folder or batch per micro-batch, so that a repeated batch changes nothing."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stallmetrics.session import folders
from stallmetrics.sinks.writers import append_jdbc

BATCH = "batch_id"
#: The checkpoint a row came through, and what it holds: by these a repeat is known also after the checkpoint is lost.
RUN, DIGEST = "run_id", "row_digest"


def _write_batch(path: str, rows: DataFrame, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def _started(writer, every: str | None) -> StreamingQuery:
    """Without ``every``, take what is there and stop."""
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def stream_to_parquet(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", every: str | None = None
) -> StreamingQuery:
    """Write each micro-batch to its own folder. Without ``every``, take what is there and stop."""
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(partial(_write_batch, path))
    )
    return _started(writer, every)


# --- rows that arrive once, whatever happens to the checkpoint --------------------------------------------------------


def digested(rows: DataFrame) -> DataFrame:
    """Rows with a digest of all their columns; NULL and empty text differ."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("")) for c in rows.columns]
    return rows.withColumn(DIGEST, F.sha2(F.to_json(F.array(*parts)), 256))


def _others(spark: SparkSession, path: str, run: str, batch_id: int) -> DataFrame | None:
    """What ``path`` holds but for this very batch."""
    if not [f for f in folders(spark, path) if "=" in f]:
        return None
    held = spark.read.option("mergeSchema", "true").parquet(path)
    return held.filter((F.col(RUN) != run) | (F.col(BATCH) != batch_id))


def _counted(rows: DataFrame | None, like: DataFrame, name: str, value) -> DataFrame:
    if rows is None:
        return like.select(DIGEST).limit(0).withColumn(name, F.lit(0).cast("long"))
    return rows.groupBy(DIGEST).agg(value.cast("long").alias(name))


def commit_batch(path: str, rows: DataFrame, batch_id: int, run: str) -> None:
    """Write a batch's rows that the table does not hold yet, and enter what was delivered in the ledger beside it.

    A run (one checkpoint) reads its source from the start, so the table is to hold every row as often as the run that got
    furthest has delivered it. While there is one run, that is all of its rows, and nothing is looked up. With a fresh
    checkpoint, copies of a row that are already there are left out, and only what goes beyond them is written. The ledger
    comes first: a batch that stops in between is written by its repeat, or by the next run.
    """
    spark, table, ledger = rows.sparkSession, f"{path}/rows", f"{path}/delivered"
    here = f"{RUN}={run}/{BATCH}={batch_id}"
    marked = digested(rows)
    marked.groupBy(DIGEST).agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{ledger}/{here}")
    known_runs = {f.rsplit("=", 1)[-1] for f in folders(spark, table) if "=" in f}
    if known_runs - {run}:
        delivered, held = _others(spark, ledger, run, batch_id), _others(spark, table, run, batch_id)
        before = _counted(None if delivered is None else delivered.filter(F.col(RUN) == run), marked, "_before", F.sum("n"))
        there = _counted(held, marked, "_there", F.count(F.lit(1)))
        number = F.row_number().over(Window.partitionBy(DIGEST).orderBy(DIGEST))
        fresh = F.coalesce("_before", F.lit(0)) + F.col("_copy") > F.coalesce("_there", F.lit(0))
        copies = marked.withColumn("_copy", number).join(before, DIGEST, "left").join(there, DIGEST, "left")
        marked = copies.filter(fresh).drop("_copy", "_before", "_there")
    marked.write.mode("overwrite").parquet(f"{table}/{here}")


def stream_once_to_parquet(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to a table with a ledger beside it: every row arrives once, also with a fresh checkpoint."""

    def write(rows: DataFrame, batch_id: int) -> None:
        run = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        commit_batch(path, rows, batch_id, run)

    return _started(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), every)


def read_once(spark: SparkSession, path: str) -> DataFrame:
    """The rows of such a table, without what only the ledger needs."""
    return spark.read.parquet(f"{path}/rows").drop(RUN, BATCH, DIGEST)


def stream_to_jdbc(
    stream: DataFrame,
    options: Mapping[str, str],
    table: str,
    checkpoint: str,
    every: str = "200 milliseconds",
    batch_rows: int = 100,
) -> StreamingQuery:
    """Append each micro-batch over JDBC with its number in ``batch_id`` and a digest of each row in ``row_digest``. Delivery is at
    least once: a unique key of the table over the row's key and ``batch_id``, or over the digest, refuses a repeated batch."""

    def write(rows: DataFrame, batch_id: int) -> None:
        append_jdbc(digested(rows).withColumn(BATCH, F.lit(batch_id)), options, table, batch_rows)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write).trigger(processingTime=every).start()
    )
