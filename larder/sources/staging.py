"""Stage outputs: tables written once to the shared folder and read back.

A frame that several later steps use is written as Parquet under ``spark.checkpoint.dir``.
That cuts its lineage, survives lost executors and gives the readers true sizes. Stage tables
go when the application ends, or earlier with ``release``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, list[str]] = {}
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names; without one, a temporary folder in local mode and an error elsewhere."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="larder-")
    return _own[context.applicationId]


def stage_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A new path in the given or else the shared folder, deleted at the end of the application."""
    own = f"{folder.rstrip('/') if folder else shared_dir(spark)}/larder/{uuid.uuid4().hex}"
    files, at = _filesystem(spark, own)
    files.mkdirs(at)
    files.deleteOnExit(at)
    _made.setdefault(spark.sparkContext.applicationId, []).append(own)
    return f"{own}/{name}"


def settle(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write the frame as a stage table and return the table."""
    spark = df.sparkSession
    path = stage_path(spark, name, folder)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the stage tables made so far; frames that read them can't be used any more."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        files, at = _filesystem(spark, path)
        files.delete(at, True)


def _filesystem(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at
