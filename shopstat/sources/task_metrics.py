"""What Spark's tasks cost: its event log, read as JSON and summed by job group.

The log is written by Spark's own event-log listener, attached while the measured work runs,
plain and in one file in the shared scratch folder, whether or not the session logs by itself.
CPU seconds are those of the JVM's task threads (Python workers and garbage collection are not
among them). Memory is the largest execution memory of a task, or the largest heap that the
executor saw while the task ran, where it polls for it (``spark.executor.metrics.pollingInterval``;
in local mode that heap is the driver's too); null where Spark measured nothing.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstat.session import checkpoint_dir, scratch_path

# Names of the event log's fields.
_GROUP, _DESCRIPTION, _INTERRUPT = "spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"
_LONG = T.LongType()
EVENTS = T.StructType([
    T.StructField("Event", T.StringType()),
    T.StructField("Job ID", T.IntegerType()),
    T.StructField("Stage IDs", T.ArrayType(T.IntegerType())),
    T.StructField("Properties", T.StructType([T.StructField(_GROUP, T.StringType())])),
    T.StructField("Stage ID", T.IntegerType()),
    T.StructField("Task Metrics", T.StructType([T.StructField(n, _LONG) for n in (
        "Executor CPU Time", "Executor Deserialize CPU Time", "Peak Execution Memory", "Peak On Heap Execution Memory", "Peak Off Heap Execution Memory")])),
    T.StructField("Task Executor Metrics", T.StructType([T.StructField("JVMHeapMemory", _LONG)])),
])


@contextmanager
def event_log(spark: SparkSession) -> Iterator[str]:
    """Log the session's events while the block runs; gives the folder, to be read after the block."""
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    checkpoint_dir(spark)
    folder = scratch_path(spark, "event-log")
    at = jvm.org.apache.hadoop.fs.Path(folder)
    hadoop = context._jsc.hadoopConfiguration()
    at.getFileSystem(hadoop).mkdirs(at)
    conf = context._jsc.sc().conf().clone()
    for key, value in (("compress", "false"), ("rolling.enabled", "false")):
        conf = conf.set(f"spark.eventLog.{key}", value)
    log = jvm.org.apache.spark.scheduler.EventLoggingListener(
        f"events-{uuid.uuid4().hex[:12]}", jvm.scala.Option.empty(), at.getFileSystem(hadoop).makeQualified(at).toUri(), conf, hadoop)
    log.start()
    context._jsc.sc().addSparkListener(log)
    try:
        yield folder
    finally:
        context._jsc.sc().listenerBus().waitUntilEmpty()  # events arrive after the job's return
        context._jsc.sc().removeSparkListener(log)
        log.stop()


@contextmanager
def job_group(spark: SparkSession, name: str) -> Iterator[None]:
    """Jobs of this thread (and of threads that inherit from it) belong to ``name`` inside the block."""
    context = spark.sparkContext
    before = {key: context.getLocalProperty(key) for key in (_GROUP, _DESCRIPTION, _INTERRUPT)}
    context.setJobGroup(name, name)
    try:
        yield
    finally:
        for key, value in before.items():
            context.setLocalProperty(key, value)


def task_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """job_group, tasks, cpu_time_s and peak_memory_bytes of the jobs in an event log. A stage that
    several jobs name belongs to the first of them; failed attempts cost what they cost and count too."""
    events = spark.read.schema(EVENTS).json(folder)
    stages = (events.filter(F.col("Event") == "SparkListenerJobStart")
              .select(F.col("Job ID").alias("job"), F.col("Properties").getField(_GROUP).alias("job_group"), F.explode("Stage IDs").alias("stage"))
              .groupBy("stage").agg(F.min_by("job_group", "job").alias("job_group")))
    cost, seen = F.col("Task Metrics"), F.col("Task Executor Metrics")
    peak = F.greatest(cost["Peak Execution Memory"], cost["Peak On Heap Execution Memory"] + cost["Peak Off Heap Execution Memory"], seen["JVMHeapMemory"])
    tasks = events.filter(F.col("Event") == "SparkListenerTaskEnd").select(
        F.col("Stage ID").alias("stage"), (cost["Executor CPU Time"] + cost["Executor Deserialize CPU Time"]).alias("cpu_ns"),
        F.when(peak > 0, peak).alias("peak"))
    return (tasks.join(stages, "stage").filter(F.col("job_group").isNotNull()).groupBy("job_group")
            .agg(F.count(F.lit(1)).alias("tasks"), (F.sum("cpu_ns") / 1e9).alias("cpu_time_s"), F.max("peak").alias("peak_memory_bytes")))
