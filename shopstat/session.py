"""Session-level helpers: a test/bench session builder and the shared scratch folder.

Jobs never build their own session: they take the caller's ``SparkSession``.
``local_session`` exists for tests, the bench and command-line use.
"""
from __future__ import annotations

import atexit
import os
import re
import sys
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "shopstat",
                  driver_memory: str = "8g", event_log_dir: str | None = None) -> SparkSession:
    """A local session configured the way the tests and the bench expect.
    ``event_log_dir``: write Spark's event log there (stage and task times)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.executor.metrics.pollingInterval", "100ms")  # heap of running tasks, for the format comparison
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    On a cluster this is read from the session (and it is an error if it is not set).
    Only a local session with nothing set (tests, local runs) gets a private folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — a remote (Connect) session: the server owns the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must be set on the server for checkpoints")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: a machine-local "
                               "folder is not reachable from the executors")
        configured = tempfile.mkdtemp(prefix="shopstat-ckpt-")  # local session only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCRATCH: set[str] = set()  # tables of this program that are not deleted yet


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for a written table. What its owner
    has not deleted by then goes when the driver program ends: results are read lazily."""
    base = checkpoint_dir(spark)
    path = os.path.join(base, "shopstat-scratch", f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.add(path)
    return path


@atexit.register
def _discard_all() -> None:
    jvm = SparkContext._jvm
    if not _SCRATCH or jvm is None:
        return
    try:  # the JVM may be gone, or the folder with the cluster
        context = SparkContext._active_spark_context
        conf = context._jsc.hadoopConfiguration() if context is not None and context._jsc is not None else jvm.org.apache.hadoop.conf.Configuration()
        for path in _SCRATCH:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
    except Exception as e:  # noqa: BLE001
        print(f"scratch tables are left: {e}", file=sys.stderr)


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """``df`` written as Parquet in the shared folder and read back, and its path: what is
    read several times is computed once, and a lost executor does not replay it.
    ``partition_by`` columns must come last in ``df``."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete one of our own scratch tables that nothing reads any more."""
    _SCRATCH.discard(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
