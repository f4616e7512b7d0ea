"""Folder listings and deletions on any Hadoop-compatible file system (names only: no data passes the driver)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _fs(spark, path)
    return bool(fs.exists(folder))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``, sorted; none where it doesn't exist."""
    fs, folder = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition folders ``column=value`` directly under ``path``."""
    return [n[len(column) + 1:] for n in children(spark, path) if n.startswith(f"{column}=")]


def delete(spark: SparkSession, path: str) -> None:
    fs, folder = _fs(spark, path)
    fs.delete(folder, True)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, file = _fs(spark, path)
    fs.create(file, True).close()
