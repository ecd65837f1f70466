"""Sinks and readers for the three Spark-native formats.

Writers produce one file per partition (no ``coalesce(1)`` on data that grows);
readers take an explicit schema, so types survive a round trip through CSV text
(a smallint comes back as one). Only CSV files whose types nobody knows are read by
inferred ones (``read_csv_inferred``).
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# CSV text form of timestamps: microseconds kept, no zone (timestamp_ntz).
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_CSV_OPTIONS = {"header": "true", "timestampNTZFormat": CSV_TIMESTAMP_FORMAT,
                "timestampFormat": CSV_TIMESTAMP_FORMAT, "dateFormat": "yyyy-MM-dd"}


# S2 — Parquet sink; returns the path. What was there stays until the new dataset is whole.
def save_parquet(df: DataFrame, path: str) -> str:
    save_together({str(path): df})
    return str(path)


@contextmanager
def staged_together(spark: SparkSession, paths: Sequence[str]):
    """For each path, one beside it to write to. Only when the block ends without an error do they
    take their places, by renames; otherwise they are deleted and the old ones stay."""
    jvm = spark.sparkContext._jvm
    tag = uuid.uuid4().hex[:12]

    def beside(path: str, kind: str):
        at = jvm.org.apache.hadoop.fs.Path(path)
        return jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{kind}-{tag}-{at.getName()}")

    staged = {path: beside(path, "staged") for path in paths}
    fs = next(iter(staged.values())).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        yield {path: at.toString() for path, at in staged.items()}
    except BaseException:
        for at in staged.values():
            fs.delete(at, True)
        raise
    for path, at in staged.items():
        place, old = jvm.org.apache.hadoop.fs.Path(path), beside(path, "replaced")
        if fs.exists(place) and not fs.rename(place, old) or not fs.rename(at, place):
            raise OSError(f"cannot put the new dataset in its place: {path}")
        fs.delete(old, True)


def save_together(datasets: dict[str, DataFrame], single_file: bool = False) -> None:
    """Write Parquet datasets that belong together: each is written beside its place, and only when
    all are whole do they take their places, by renames. A write that fails leaves all old ones."""
    spark = next(iter(datasets.values())).sparkSession
    with staged_together(spark, list(datasets)) as staged:

        def write(path: str) -> None:
            df = datasets[path]
            (df.coalesce(1) if single_file else df).write.parquet(staged[path])

        # Independent jobs: submitted together, their small final stages share the executors.
        with ThreadPoolExecutor(max_workers=len(datasets)) as pool:
            list(pool.map(inheritable_thread_target(spark)(write), datasets))


# S3 — CSV sink with a header row
def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(**_CSV_OPTIONS).csv(str(path))
    return str(path)


# S4 — CSV scan with an explicit schema. A record that does not fit it is an error, never nulls.
def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV_OPTIONS, mode="FAILFAST").csv(str(path))


def infer_csv(spark: SparkSession, path: str, texts: Sequence[str] = ()) -> T.StructType:
    """The schema of CSV files whose types are not known: one pass over all their records, by tasks,
    so a value far down counts as much as the first. Whole numbers become int or long (a decimal of
    no digits beyond), others double, dates and zoneless timestamps such, true and false boolean, all else text.
    A column without any value is text. ``texts`` names columns that stay text whatever they hold (codes
    with leading zeros)."""
    kept = spark.conf.get("spark.sql.timestampType")
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")  # a text without a zone is a wall clock
    try:
        found = spark.read.options(**_CSV_OPTIONS, inferSchema="true", samplingRatio="1.0", enforceSchema="false").csv(str(path)).schema
    finally:
        spark.conf.set("spark.sql.timestampType", kept)
    return T.StructType([T.StructField(f.name, T.StringType() if f.name in texts else f.dataType) for f in found.fields])


def read_csv_inferred(spark: SparkSession, path: str, texts: Sequence[str] = ()) -> DataFrame:
    """S4 without a schema: types from ``infer_csv``, then read strictly by them."""
    return read_csv(spark, path, infer_csv(spark, path, texts))


#: The text of a record that does not fit the schema.
CORRUPT = "_corrupt_record"


def read_csv_set_aside(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """S4 for files that may hold malformed records (a field of another type, too few or too many
    fields): the rows that fit, and the text and file of each record that does not. Both read the
    files; every record is in one of the two, so their counts add up to the records there are."""
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.schema(whole).options(**_CSV_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).csv(str(path))
    # Every field is read whatever the caller selects: otherwise a record would count as good or bad
    # by the columns that happen to be asked for.
    read = F.length(F.concat_ws("", *[F.col("`" + c.replace("`", "``") + "`").cast("string") for c in schema.names])) >= 0
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file")).filter(read)
    good = rows.filter(F.col(CORRUPT).isNull()).select(*schema.names)
    bad = rows.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"), F.col("_file").alias("file"))
    return good, bad


# S5 — ORC sink
def write_orc(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").orc(str(path))
    return str(path)


def write_format(df: DataFrame, fmt: str, path: str) -> str:
    writers = {"csv": write_csv, "parquet": save_parquet, "orc": write_orc}
    return writers[fmt](df, path)


# S6 — scan of any of the three formats with its schema
def read_format(spark: SparkSession, fmt: str, path: str, schema: T.StructType) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return spark.read.schema(schema).format(fmt).load(str(path))


# S7 — the metrics table as CSV with report column names. The table has one row per
# measured format, so a single output file is bounded by construction.
# The columns and their order.
METRIC_COLUMNS = ["format", "file_path", "file_size_mb", "write_time_s", "read_time_s", "peak_memory_mb", "cpu_time_s",
                  "energy_wh", "storage_saving_pct", "write_improvement_pct", "read_improvement_pct", "energy_saving_pct"]


def save_metrics(metrics: DataFrame, path: str) -> str:
    cols = [c for c in METRIC_COLUMNS if c in metrics.columns]
    return write_csv(metrics.select(*cols).coalesce(1), path)
