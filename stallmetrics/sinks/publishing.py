"""Publishing a report into its partitioned table: written aside, then switched in by partition location.

A run writes the new partitions into a version folder of its own, writes down what it is about to switch (the manifest), and only
then changes the catalog: new partitions are pointed to their folder, other partitions of the slice are dropped. No data
moves in that step, so a reader sees the old partition or the new one, never both and never half of one. A run that stops before
its manifest is complete has changed nothing; one that stops later is finished by the next (``finish``), which repeats only
catalog statements. Which partitions go is decided by their names, not by reading rows.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallmetrics.session import folders, remove_folder, shared_dir
from stallmetrics.sinks.rules import assert_unique_key

# Fixed value: what a partition of NULL is called.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = "action string, partition string, spec string, folder string"


def settled(df: DataFrame) -> DataFrame:
    """``df`` cut from the table it was read from, so that the table can be changed."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def slice_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _unescaped(text: Column) -> Column:
    """Text of a path or partition name without its ``%XX``; a plus sign is no blank there."""
    return F.url_decode(F.regexp_replace(text, r"\+", "%2B"))


def partitions(spark: SparkSession, table: str) -> DataFrame:
    """``partition`` (its name) and the typed slice columns of every partition of a table, from the catalog alone."""
    types, names = dict(spark.table(table).dtypes), spark.sql(f"SHOW PARTITIONS {table}")
    columns = []
    for number, column in enumerate(slice_columns(spark, table)):
        value = _unescaped(F.substring_index(F.get(F.split("partition", "/"), F.lit(number)), "=", -1))
        columns.append(F.when(value != NULL_PARTITION, value).cast(types[column]).alias(column))
    return names.select("partition", *columns)


def _spec(columns: Sequence[str]) -> Column:
    """The partition of a row as SQL names it; NULL is a value like any other there."""
    parts = []
    for c in columns:
        quoted = F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
        parts.append(F.concat(F.lit(f"`{c}` = "), F.coalesce(F.concat(F.lit("'"), quoted, F.lit("'")), F.lit("NULL"))))
    return F.concat_ws(", ", *parts)


def _root(spark: SparkSession, table: str) -> str:
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}  # a row for each column
    return described["Location"].rstrip("/")


def stage(new: DataFrame, table: str, gone: Column, keys: Sequence[str] = (), skip_empty: bool = False) -> str | None:
    """Check the new rows and write them and their manifest beside the table; returns the version, None where nothing is to do."""
    spark = new.sparkSession
    slices, root = slice_columns(spark, table), _root(spark, table)
    rows = settled(new.select(*spark.table(table).columns))
    if skip_empty and rows.isEmpty():
        return None
    if keys:
        assert_unique_key(rows, keys)
    stray = rows.filter(~F.coalesce(gone, F.lit(False))).select(*slices).first()
    if stray is not None:
        raise ValueError(f"rows outside the slice, e.g. {stray.asDict()}")
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    written = f"{root}/_versions/{version}"
    rows.write.partitionBy(*slices).parquet(written)
    # one row for each partition that is written or goes: as few as the table has partitions
    added = spark.read.schema(rows.schema).parquet(written).select(
        *slices, _unescaped(F.regexp_replace("_metadata.file_path", "/[^/]*$", "")).alias("folder")
    ).distinct()
    put = added.select(F.lit("put").alias("action"), F.lit(None).cast("string").alias("partition"), _spec(slices).alias("spec"), "folder")
    stale = partitions(spark, table).filter(gone).select(F.lit("drop").alias("action"), "partition", _spec(slices).alias("spec"), F.lit(None).cast("string").alias("folder"))
    stale = stale.join(put.select("spec"), "spec", "left_anti").select("action", "partition", "spec", "folder")
    put.unionByName(stale).coalesce(1).write.json(f"{root}/_pending/{version}")
    return version


def _complete(spark: SparkSession, folder: str) -> bool:
    return f"{folder}/_SUCCESS" in folders(spark, folder)


def finish(spark: SparkSession, table: str) -> None:
    """Switch what complete manifests name, oldest first; a repeat changes nothing. Unfinished versions are removed."""
    root = _root(spark, table)
    for pending in sorted(folders(spark, f"{root}/_pending")):
        version = pending.rsplit("/", 1)[-1]
        if not _complete(spark, pending):
            remove_folder(spark, f"{root}/_versions/{version}")
            remove_folder(spark, pending)
            continue
        entries = spark.read.schema(_MANIFEST).json(pending)
        for entry in entries.orderBy(F.desc("action"), "spec").collect():  # a row for each partition; new ones first
            if entry.action == "put":
                where = entry.folder.replace("'", "\\'")
                spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({entry.spec}) LOCATION '{where}'")
                spark.sql(f"ALTER TABLE {table} PARTITION ({entry.spec}) SET LOCATION '{where}'")
            else:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({entry.spec})")
        entries.coalesce(1).write.mode("overwrite").json(f"{root}/_done/{version}")
        remove_folder(spark, pending)
        _tidy(spark, root)
    spark.catalog.refreshTable(table)


def _tidy(spark: SparkSession, root: str) -> None:
    """Remove versions none of whose partitions were in use before the last switch: readers may still hold that state."""
    done = sorted(folders(spark, f"{root}/_done"))
    if len(done) < 2:
        return
    log = spark.read.schema(_MANIFEST).option("recursiveFileLookup", "true").json(done[:-1]).withColumn(
        "version", F.regexp_extract("_metadata.file_path", "/_done/([^/]*)/", 1))
    newest = Window.partitionBy("spec").orderBy(F.desc("version"))
    last = log.withColumn("_n", F.row_number().over(newest)).filter("_n = 1 AND action = 'put'").select("version").distinct()
    used = {r.version for r in last.collect()}  # at most a row for each partition
    for folder in done[:-1]:
        version = folder.rsplit("/", 1)[-1]
        if version not in used:
            remove_folder(spark, f"{root}/_versions/{version}")


def publish(new: DataFrame, table: str, gone: Column, keys: Sequence[str] = (), skip_empty: bool = False) -> None:
    """Put a report into its partitioned Parquet table of the catalog: the key is checked, partitions with new rows are switched
    in, other partitions that are ``gone`` are dropped, and all others keep their files.

    ``gone`` is a slice of ``rules``, over the partition columns alone; a repeat changes nothing. New rows may be derived from the
    table. Rows outside the slice are refused, as they would replace partitions that were to stay. A table has one publisher at a time.
    """
    finish(new.sparkSession, table)
    if stage(new, table, gone, keys, skip_empty) is not None:
        finish(new.sparkSession, table)
