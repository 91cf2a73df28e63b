"""Folders of the shared file system, whatever scheme their path has."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names within a folder; none if it is not there."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(place))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; one that is not there is no error."""
    fs, place = _at(spark, path)
    fs.delete(place, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, place = _at(spark, old)
    if not fs.rename(place, _at(spark, new)[1]):
        raise OSError(f"{old} cannot be renamed to {new}")
