"""R10 — stored-dataset report: per dataset under a folder, file count, bytes and
a readable size (B / KB / MB / GB / TB in steps of 1024). Built from the file
listing only; no data file is opened."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstat.functions.exprs import human_size
from shopstat.sources.storage import file_listing


def _root_marker(root: str) -> str:
    """The root as it appears inside listed paths (which carry a scheme, e.g. file:)."""
    r = str(root)
    if r.startswith("file:"):
        r = r[len("file:"):]
    if "://" not in r:
        r = os.path.abspath(r)
    return r.rstrip("/") + "/"


def dataset_report(spark: SparkSession, root: str) -> DataFrame:
    # dataset = first path component below ``root`` (a file, or a dataset folder)
    dataset = F.substring_index(F.substring_index(F.col("path"), _root_marker(root), -1), "/", 1)
    return (
        file_listing(spark, root)
        .groupBy(dataset.alias("dataset"))
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("total_bytes"))
        .select("dataset", "n_files", "total_bytes", human_size(F.col("total_bytes")).alias("size_text"))
        .orderBy("dataset")
    )
