"""Listing and removing files of the shared storage, through the file system that Spark uses for them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match ``pattern`` (``*`` within a name), in order; empty where there is nothing."""
    target, system = _at(spark, pattern)
    return [str(status.getPath()) for status in system.globStatus(target) or []]


def remove(spark: SparkSession, path: str) -> None:
    """A file or a folder with all it holds; nothing happens where there is none."""
    target, system = _at(spark, path)
    system.delete(target, True)
