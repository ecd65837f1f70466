"""R8 — format comparison job: write a table as CSV, Parquet and ORC, size each
dataset, read it back, and compare every format against the CSV baseline.

Timings are wall-clock seconds of distributed jobs: a write, and a full read
executed into the ``noop`` sink (so the whole plan runs, nothing is collected). The
table is stored before the first timer starts, and every format first writes and reads
a few rows untimed.
Sizes come from the file listing (S8). CPU seconds and peak memory are those of the write's
and the read's own tasks, from Spark's event log (``sources.task_metrics``); the energy follows
from the CPU seconds.
"""
from __future__ import annotations

import os
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstat.functions.exprs import bytes_to_mb, energy_wh, fixed_text
from shopstat.operators.compare import compare_to_baseline
from shopstat.schemas import FORMAT_METRICS
from shopstat.session import discard, scratch_path, stored
from shopstat.sources.files import read_format, save_metrics, write_format
from shopstat.sources.storage import stored_bytes_value
from shopstat.sources.task_metrics import event_log, job_group, task_metrics

FORMATS = ("csv", "parquet", "orc")
FORMAT_LABELS = {"csv": "CSV", "parquet": "Parquet", "orc": "ORC"}
COMPARED = ["file_size_mb", "write_time_s", "read_time_s", "energy_wh"]
CHANGE_NAMES = {"file_size_mb": "storage_saving_pct", "write_time_s": "write_improvement_pct",
                "read_time_s": "read_improvement_pct", "energy_wh": "energy_saving_pct"}


def roundtrip(df: DataFrame, fmt: str, path: str) -> DataFrame:
    """Write ``df`` in ``fmt`` and read it back with its own schema."""
    write_format(df, fmt, path)
    return read_format(df.sparkSession, fmt, path, df.schema)


def measure_format(df: DataFrame, fmt: str, path: str) -> tuple:
    """Label, path, bytes, seconds of the write and of the read, and the job group of both."""
    spark, group = df.sparkSession, f"format-{fmt}-{uuid.uuid4().hex[:12]}"
    t0 = time.perf_counter()
    with job_group(spark, group):
        write_format(df, fmt, path)
    write_s = time.perf_counter() - t0
    size_bytes = stored_bytes_value(spark, path)
    t0 = time.perf_counter()
    with job_group(spark, group):
        read_format(spark, fmt, path, df.schema).write.format("noop").mode("overwrite").save()
    read_s = time.perf_counter() - t0
    return (FORMAT_LABELS.get(fmt, fmt), path, float(size_bytes), write_s, read_s, group)


def compare_formats(df: DataFrame, out_dir: str, formats=FORMATS, baseline: str = "csv",
                    metrics_path: str | None = None) -> DataFrame:
    spark: SparkSession = df.sparkSession
    df, source = stored(df, "format-input")
    for fmt in formats:
        measure_format(df.limit(1000), fmt, scratch_path(spark, f"format-warm-up-{fmt}"))
    with event_log(spark) as log:
        rows = [measure_format(df, fmt, os.path.join(str(out_dir), f"benchmark.{fmt}")) for fmt in formats]
    # One row per format; counted once, as the log is deleted before the comparison is read.
    costs = {r["job_group"]: r for r in task_metrics(spark, log).filter(F.col("job_group").isin([r[-1] for r in rows])).collect()}
    discard(spark, log)
    rows = [(*r[:-1], costs[r[-1]]["peak_memory_bytes"], costs[r[-1]]["cpu_time_s"]) for r in rows]
    raw_schema = T.StructType([
        T.StructField("format", T.StringType()), T.StructField("file_path", T.StringType()),
        T.StructField("size_bytes", T.DoubleType()), T.StructField("write_time_s", T.DoubleType()),
        T.StructField("read_time_s", T.DoubleType()), T.StructField("peak_memory_bytes", T.LongType()),
        T.StructField("cpu_time_s", T.DoubleType()),
    ])
    measured = spark.createDataFrame(rows, raw_schema).select(
        "format", "file_path", bytes_to_mb("size_bytes").alias("file_size_mb"), "write_time_s", "read_time_s",
        bytes_to_mb("peak_memory_bytes").alias("peak_memory_mb"), "cpu_time_s", energy_wh("cpu_time_s").alias("energy_wh"),
    ).select(*[f.name for f in FORMAT_METRICS.fields])
    compared = compare_to_baseline(measured, "format", FORMAT_LABELS.get(baseline, baseline), COMPARED,
                                   digits=None, unguarded=("file_size_mb",))
    for m, name in CHANGE_NAMES.items():
        compared = compared.withColumnRenamed(m + "_change_pct", name)
    if metrics_path:
        save_metrics(compared, metrics_path)
    discard(spark, source)
    return compared


def _row_digest(df: DataFrame) -> DataFrame:
    """How many rows, and the sum of their hashes: equal for equal bags of rows."""
    return df.agg(F.count(F.lit(1)).alias("rows_read"), F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")).alias("digest"))


def check_formats(df: DataFrame, metrics: DataFrame) -> DataFrame:
    """What must hold of a comparison whatever the timings: per format, the rows read back,
    whether they are the rows of ``df``, whether bytes were stored, whether CPU seconds, energy and
    its saving were measured, and the saving where it must be zero (the baseline's own)."""
    spark, names = df.sparkSession, {label: fmt for fmt, label in FORMAT_LABELS.items()}
    expected = _row_digest(df).first()
    read = [_row_digest(read_format(spark, names[r["format"]], r["file_path"], df.schema)).select(
        F.lit(r["format"]).alias("format"), "rows_read",
        ((F.col("rows_read") == expected["rows_read"]) & F.col("digest").eqNullSafe(F.lit(expected["digest"]))).alias("rows_match"),
        F.lit(r["file_size_mb"] > 0).alias("has_size"),
        F.lit((r["cpu_time_s"] or 0) > 0).alias("has_cpu"),
        F.lit((r["energy_wh"] or 0) > 0 and r["energy_saving_pct"] is not None).alias("has_energy"),
        F.lit(r["storage_saving_pct"] if r["format"] == FORMAT_LABELS["csv"] else None).cast("double").alias("baseline_saving_pct"))
        for r in metrics.collect()]  # one row per format
    return reduce(DataFrame.unionByName, read)


# Column labels and decimals of the printed comparison.
# F15 — the comparison as display text: two decimals, four for energy (null stays null)
TEXT_COLUMNS = [("file_size_mb", "Size (MB)", 2), ("write_time_s", "Write (s)", 2), ("read_time_s", "Read (s)", 2),
                ("peak_memory_mb", "Peak Mem (MB)", 2), ("cpu_time_s", "CPU (s)", 2), ("energy_wh", "Energy (Wh)", 4),
                ("storage_saving_pct", "Storage Savings (%)", 2), ("write_improvement_pct", "Write Improvement (%)", 2),
                ("read_improvement_pct", "Read Improvement (%)", 2), ("energy_saving_pct", "Energy Savings (%)", 2)]


def metrics_as_text(metrics: DataFrame) -> DataFrame:
    return metrics.select(F.col("format").alias("Format"),
                          *[fixed_text(F.col(c), d).alias(label) for c, label, d in TEXT_COLUMNS])
