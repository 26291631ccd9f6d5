"""Session settings this package is written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Skewed joins are split even where that costs a shuffle: one hot order or product must not pin a task.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # joins switch from sorting to hashing where the shuffled side turns out this small per task
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def build_session(name: str = "stallmetrics", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; keyword values (dots as ``__``) win over them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = RECOMMENDED | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str | None:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def work_folder(spark: SparkSession) -> str:
    """The shared folder, for intermediate tables. Only a session of one machine may go without: it gets a temporary one."""
    folder = shared_dir(spark)
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="stallmetrics-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of what lies directly in a folder; none where there is no such folder."""
    fs, where = _file_system(spark, path)
    return [f"{path.rstrip('/')}/{s.getPath().getName()}" for s in fs.listStatus(where)] if fs.exists(where) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote; nothing where there is none."""
    fs, where = _file_system(spark, path)
    fs.delete(where, True)
