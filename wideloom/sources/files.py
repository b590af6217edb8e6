"""Folder operations on the file system that a path names (shared storage on a cluster)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _at(spark, old)
    if not fs.rename(p, _at(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def siblings(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Paths that are ``path`` with ``suffix`` and more behind it."""
    fs, p = _at(spark, f"{path}{suffix}*")
    return sorted(s.getPath().toString() for s in fs.globStatus(p))
