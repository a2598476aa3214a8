"""Folders of written tables on whatever file system Spark writes to: looked up, removed, replaced."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    fs, where = _at(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where)]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote; a missing one is fine."""
    fs, where = _at(spark, path)
    fs.delete(where, True)


def replace(spark: SparkSession, new: str, held: str) -> None:
    """``new`` takes the place of ``held``. The held folder is moved aside first and removed last, so
    that a failure in between leaves one whole table or the other beside it, never half of one."""
    fs, target = _at(spark, held)
    _, source = _at(spark, new)
    old = None
    if fs.exists(target):
        _, old = _at(spark, f"{held.rstrip('/')}__old")
        fs.delete(old, True)
        fs.rename(target, old)
    else:
        fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        if old is not None:
            fs.rename(old, target)
        raise OSError(f"cannot move {new} to {held}")
    if old is not None:
        fs.delete(old, True)
    spark.catalog.refreshByPath(held)
