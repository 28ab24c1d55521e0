"""Where intermediate tables and registered sample layouts are written."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session that does not set it gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="harborlog-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/harborlog/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system Spark reaches it by."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(context._jsc.hadoopConfiguration()).delete(hadoop, True)


def give_back_heap(spark: SparkSession) -> None:
    """Have the driver's JVM return heap that earlier queries of a long session have left free.

    Spark deletes shuffle files when the driver collects what refers to them, so those of finished tables go as well.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
