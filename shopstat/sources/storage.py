"""Stored size of datasets (S8) from file metadata.

``binaryFile`` lists files with their length; when only ``path`` and ``length``
are selected the file contents are never read, so sizing a dataset costs a
listing, not a scan.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of every data file under ``root`` (hidden / underscore files skipped)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load(str(root)).select("path", "length"))


def stored_bytes(spark: SparkSession, root: str) -> DataFrame:
    """One row: total bytes and file count under ``root``."""
    return file_listing(spark, root).agg(
        F.sum("length").alias("total_bytes"), F.count(F.lit(1)).alias("n_files"))


def stored_bytes_value(spark: SparkSession, root: str) -> int:
    return int(stored_bytes(spark, root).first()["total_bytes"] or 0)
