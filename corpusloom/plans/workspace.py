"""Shared storage for written intermediates and checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, from ``spark.checkpoint.dir``.

    A local-mode session without the setting gets its own temporary folder;
    a cluster session without it is an error, as executors do not share disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="corpusloom-")
    return _LOCAL_DIRS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts lineage so that costly steps (model calls above all) are not run
    again by later actions or after the loss of an executor.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def complete_folders(spark: SparkSession, folder: str) -> list[str]:
    """Subfolders of ``folder`` whose writing has ended, in order of their names."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(folder)):
        return []
    found = sorted(s.getPath().toString() for s in fs.listStatus(path(folder)))
    return [f for f in found if fs.exists(path(f"{f}/_SUCCESS"))]
