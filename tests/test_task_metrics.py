"""Task costs by job group, from Spark's event log, against the same log summed by hand."""
import json
import os
from collections import defaultdict

from pyspark.sql import functions as F

from shopstat.plans.formats import compare_formats
from shopstat.sources.files import save_parquet
from shopstat.sources.task_metrics import event_log, job_group, task_metrics


def by_hand(folder):
    folder = folder.removeprefix("file:")
    group, cpu, tasks = {}, defaultdict(int), defaultdict(int)
    for name in os.listdir(folder):
        for line in open(os.path.join(folder, name)):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for s in e["Stage IDs"]:
                    group.setdefault(s, e["Properties"].get("spark.jobGroup.id"))
            elif e["Event"] == "SparkListenerTaskEnd" and group.get(e["Stage ID"]):
                m = e["Task Metrics"]
                cpu[group[e["Stage ID"]]] += m["Executor CPU Time"] + m["Executor Deserialize CPU Time"]
                tasks[group[e["Stage ID"]]] += 1
    return {g: (tasks[g], cpu[g]) for g in cpu}


def test_costs_by_group(spark, tmp_dir):
    spark.sparkContext.setJobGroup("outer", "the caller's own")
    with event_log(spark) as log:
        with job_group(spark, "a"):
            spark.range(0, 200_000, 1, 5).groupBy((F.col("id") % 1000).alias("k")).count().write.format("noop").mode("overwrite").save()
        with job_group(spark, "b"):  # written by threads of the sink, which inherit the group
            save_parquet(spark.range(0, 1000, 1, 3), os.path.join(tmp_dir, "b.parquet"))
        assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == "outer"
        spark.range(10).count()
    spark.range(10).count()  # after the log was closed
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = {r.job_group: r for r in task_metrics(spark, log).collect()}
    want = by_hand(log)
    assert set(got) == set(want) == {"a", "b", "outer"}
    for g, (tasks, ns) in want.items():
        assert got[g].tasks == tasks and abs(got[g].cpu_time_s - ns / 1e9) < 1e-9 and got[g].cpu_time_s > 0
    assert got["b"].tasks == 3 and got["a"].peak_memory_bytes > 0  # the aggregation's hash map


def test_no_jobs_no_rows(spark):
    with event_log(spark) as log:
        pass
    assert task_metrics(spark, log).count() == 0


def test_peak_memory_of_the_formats_where_the_executor_polls(spark, tmp_dir):
    df = spark.range(0, 1_500_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("name"))
    rows = compare_formats(df, tmp_dir).collect()
    assert len(rows) == 3 and all(r["peak_memory_mb"] > 0 and r["cpu_time_s"] > 0 for r in rows)
