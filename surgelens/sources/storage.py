"""Directory listings through the Hadoop file system the path belongs to."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _matches(spark: SparkSession, pattern: str) -> list:
    target = _path(spark, pattern)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(fs.globStatus(target) or [])


def exists(spark: SparkSession, path: str) -> bool:
    target = _path(spark, path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(target))


def remove(spark: SparkSession, path: str) -> None:
    target = _path(spark, path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def list_partitions(spark: SparkSession, path: str, *keys: str) -> list[tuple[str, ...]]:
    """Partition values found below ``path`` for the nested ``keys``, sorted."""
    pattern = "/".join([path.rstrip("/"), *[f"{k}=*" for k in keys]])
    found = []
    for status in _matches(spark, pattern):
        parts = status.getPath().toString().split("/")[-len(keys):]
        found.append(tuple(unquote(p.split("=", 1)[1]) for p in parts))
    return sorted(found)


def list_files(spark: SparkSession, path: str, *keys: str) -> list[tuple]:
    """(path, size, time of writing, *partition values) of every data file below ``path``."""
    pattern = "/".join([path.rstrip("/"), *[f"{k}=*" for k in keys], "[!_.]*"])
    found = []
    for status in _matches(spark, pattern):
        parts = status.getPath().getParent().toString().split("/")[-len(keys):]
        values = (unquote(p.split("=", 1)[1]) for p in parts)
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime(), *values))
    return sorted(found)


def committed(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of ``key`` whose directory holds a finished write, sorted."""
    pattern = f"{path.rstrip('/')}/{key}=*/_SUCCESS"
    return sorted(unquote(s.getPath().getParent().getName().split("=", 1)[1]) for s in _matches(spark, pattern))
