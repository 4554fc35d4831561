"""Folders that triggers write, named by their number and whole once Spark has marked them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def trigger_name(batch_id: int) -> str:
    return f"trigger={batch_id:012d}"


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def is_whole(spark: SparkSession, folder: str) -> bool:
    place, fs = _path(spark, f"{folder}/_SUCCESS")
    return fs.exists(place)


def whole_triggers(spark: SparkSession, folder: str) -> list[str]:
    """Names of the triggers in a folder that were written to the end, in their order."""
    place, fs = _path(spark, folder)
    names = sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []
    return [name for name in names if is_whole(spark, f"{folder}/{name}")]
