"""The few Hadoop file system calls a staged write needs; any scheme Spark can write to."""

from __future__ import annotations

import logging
import time

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def data_files(spark: SparkSession, path: str) -> int:
    """Files of a written directory but for its success marker, counted on the JVM side."""
    fs, where = _at(spark, path)
    return fs.getContentSummary(where).getFileCount() - int(exists(spark, f"{path}/_SUCCESS"))


def size(spark: SparkSession, path: str) -> int:
    fs, where = _at(spark, path)
    return fs.getContentSummary(where).getLength() if fs.exists(where) else 0


def children(spark: SparkSession, path: str) -> list[str]:
    fs, where = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def sizes(spark: SparkSession, path: str) -> list[int]:
    """The lengths of the data files right in a directory."""
    fs, where = _at(spark, path)
    return [s.getLen() for s in fs.listStatus(where) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]


def touch(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.create(where, True).close()


def age(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file or directory was last changed, by this machine's clock; None if it is not there."""
    fs, where = _at(spark, path)
    return time.time() - fs.getFileStatus(where).getModificationTime() / 1000 if fs.exists(where) else None


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a directory. The target must be new: a rename onto a directory would move inside it."""
    fs, here = _at(spark, source)
    _, there = _at(spark, target)
    fs.mkdirs(there.getParent())
    if fs.exists(there) or not fs.rename(here, there):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Best effort: a leftover directory must never turn a committed write into a failure."""
    try:
        fs, where = _at(spark, path)
        fs.delete(where, True)
    except Exception:
        log.warning("could not remove %s", path, exc_info=True)
