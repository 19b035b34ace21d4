"""Folders in the store that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder of the cluster.

    The folder is `spark.checkpoint.dir`. Only a local session without one falls back to a
    temporary folder of the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="spelltide-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """The file system that a path belongs to, whatever store it is."""
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    file_system(spark, path).delete(hadoop_path(spark, path), True)
