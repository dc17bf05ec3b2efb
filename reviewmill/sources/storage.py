"""Shared storage, through the file system that Spark itself is set up with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def matching(spark: SparkSession, pattern: str) -> dict[str, float]:
    """Files and folders that match, with the time in seconds of their last change."""
    fs, target = _open(spark, pattern)
    found = fs.globStatus(target) or []
    return {f.getPath().toString(): f.getModificationTime() / 1000 for f in found}


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)
