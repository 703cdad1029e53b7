"""Folders of a file system that all executors reach, through Hadoop's API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it does not exist."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder))


def delete(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.delete(folder, True)
