"""Folders of whatever file system Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no folder."""
    place, system = _place(spark, path)
    if not system.exists(place):
        return []
    return [status.getPath().getName() for status in system.listStatus(place)]
