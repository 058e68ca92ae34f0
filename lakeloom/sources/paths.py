"""Hadoop file system calls, so that any store Spark can read works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def touch(spark: SparkSession, path: str) -> None:
    _fs(spark, path).create(_path(spark, path), False).close()


def names(spark: SparkSession, pattern: str) -> list[str]:
    """Last path parts of everything that matches a glob, in order."""
    found = _fs(spark, pattern).globStatus(_path(spark, pattern)) or []
    return sorted(status.getPath().getName() for status in found)


def folders_with(spark: SparkSession, pattern: str, name: str) -> list[str]:
    """Last path parts of the folders of a glob that hold a file of that name, from one listing."""
    found = _fs(spark, pattern).globStatus(_path(spark, f"{pattern}/{name}")) or []
    return sorted(status.getPath().getParent().getName() for status in found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with what is in it, if it is there."""
    _fs(spark, path).delete(_path(spark, path), True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name within its file system; nothing may be there yet."""
    _fs(spark, to).mkdirs(_path(spark, to).getParent())
    if not _fs(spark, path).rename(_path(spark, path), _path(spark, to)):
        raise OSError(f"{path} could not be renamed to {to}")
