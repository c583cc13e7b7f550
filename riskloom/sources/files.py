"""Folder operations through the Hadoop file system, so any supported storage works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _open(spark, path)
    return system.exists(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what it holds; a missing one is fine."""
    system, folder = _open(spark, path)
    system.delete(folder, True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; the place it goes to must be free."""
    system, folder = _open(spark, path)
    if not system.rename(folder, _open(spark, to)[1]):
        raise OSError(f"{path} could not be moved to {to}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children, sorted; empty for a missing folder."""
    system, folder = _open(spark, path)
    if not system.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; 0 for a missing one."""
    system, folder = _open(spark, path)
    return system.getContentSummary(folder).getLength() if system.exists(folder) else 0
