"""Folders of the store that the session reads, through the file systems it knows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(sc._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _opened(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names directly below a folder, sorted; none if there is no such folder."""
    system, place = _opened(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    system, place = _opened(spark, path)
    system.delete(place, True)
