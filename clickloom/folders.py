"""Folders on the file system that all executors share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """File system and path object for a path or glob pattern."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Without that setting it lies below the warehouse, which all executors share as well.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{shared.rstrip('/')}/{name}-{uuid4().hex}"


def ensured(spark: SparkSession, path: str) -> str:
    """The path; its folder is there afterwards."""
    fs, folder = hadoop_path(spark, path)
    fs.mkdirs(folder)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    fs, folder = hadoop_path(spark, path)
    fs.delete(folder, True)
