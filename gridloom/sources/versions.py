"""A small table that is replaced as a whole, one version at a time, on a file system without renames.

A version is a folder; Spark writes its _SUCCESS mark last, and only marked versions are
read. So a reader sees the old table or the new one, a writer that dies leaves nothing
that counts, and a version that is written again with the same number changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in ``path``; none if it isn't there."""
    fs, where = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()] if fs.exists(where) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return bool(fs.exists(where))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished versions, oldest first."""
    named = [int(n.removeprefix("version=")) for n in folders(spark, path) if n.startswith("version=")]
    return sorted(n for n in named if exists(spark, f"{path}/version={n}/_SUCCESS"))


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest finished version; None if there is none."""
    have = versions(spark, path)
    return spark.read.parquet(f"{path}/version={have[-1]}") if have else None


def replace(spark: SparkSession, path: str, number: int, make: Callable[[DataFrame | None], DataFrame]) -> bool:
    """Write version ``number`` from the current one, then drop the older ones. False if it, or a newer one, is there already."""
    have = versions(spark, path)
    if have and have[-1] >= number:
        return False
    make(current(spark, path)).write.mode("overwrite").parquet(f"{path}/version={number}")
    for old in folders(spark, path):
        if old.startswith("version=") and int(old.removeprefix("version=")) < number:
            delete(spark, f"{path}/{old}")
    return True
