"""Scans: Parquet with an explicit schema (S1), nanosecond-timestamp normaliser."""
from __future__ import annotations

import json
import re
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstat.functions.exprs import epoch_micros_to_ntz


# S1 — Parquet scan. With a schema the footer types are checked against it (a
# mismatch fails at scan time); column pruning and filters still reach the scan.
def load_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(str(path))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _footer_by_hadoop(spark: SparkSession, uri: str) -> tuple[str, list[str], list[str]]:
    """The layout, the columns and the TIMESTAMP(NANOS) columns in a file's footer, read by the driver."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(unquote(uri)), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        layout = reader.getFooter().getFileMetaData().getSchema()
        text, names = layout.toString(), [f.getName() for f in layout.getFields()]
    finally:
        reader.close()
    return text, names, re.findall(r"^  (?:optional|required) int64 (.+?) \(TIMESTAMP\(NANOS\b", text, re.M)


def _footers_in_tasks(batches):
    """The same of many files; no layout where the store is one that only Spark can open."""
    for batch in batches:
        rows = []
        for uri in batch.column("uri").to_pylist():
            try:
                store, path = pafs.FileSystem.from_uri(uri)
            except (pa.ArrowInvalid, OSError):  # a scheme that Arrow does not know, or has no library for here
                rows.append((uri, None, None, None))
                continue
            with store.open_input_file(path) as source, pq.ParquetFile(source) as file:
                columns = [file.schema.column(i) for i in range(len(file.schema.names))]
            layout = [(c.path, c.physical_type, c.logical_type.to_json(), c.max_repetition_level) for c in columns]
            nanos = [c.path for c in columns if c.path == c.name and c.physical_type == "INT64"
                     and json.loads(c.logical_type.to_json()).get("timeUnit") == "nanoseconds"]
            names = list(dict.fromkeys(c.path if c.path == c.name else c.path.split(".")[0] for c in columns))
            rows.append((uri, json.dumps(layout), names, nanos))
        kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                         names=["uri", "layout", "names", "nanos"])


def file_groups(spark: SparkSession, uris: list[str]) -> list[tuple[list[str], set[str], set[str]]]:
    """Files of one footer layout each, with their columns and their TIMESTAMP(NANOS) columns. Every
    footer is read, by tasks; the driver sees the file names (which it lists anyway) once more."""
    many = max(1, min(len(uris), spark.sparkContext.defaultParallelism * 4))
    read = (spark.createDataFrame([(u,) for u in uris], "uri string").repartition(many)
            .mapInArrow(_footers_in_tasks, "uri string, layout string, names array<string>, nanos array<string>").collect())
    groups: dict[str, tuple[list[str], set[str], set[str]]] = {}
    for uri, layout, names, nanos in sorted(read):
        if layout is None:
            layout, names, nanos = _footer_by_hadoop(spark, uri)
        groups.setdefault(layout, ([], set(names), set(nanos)))[0].append(uri)
    return list(groups.values())


def _folder(spark: SparkSession, path: str) -> str | None:
    """``path`` without escapes where it names one folder, from which folder-name columns are counted."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(re.sub(r"\\(.)", r"\1", path))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return at.toString() if fs.exists(at) and fs.getFileStatus(at).isDirectory() else None


def _normalised(df: DataFrame, nanos: set[str]) -> DataFrame:
    columns = []
    for field in df.schema:
        name = "`" + field.name.replace("`", "``") + "`"
        c = F.col(name)
        if field.name in nanos:  # integer floor division (a double would lose the last microsecond)
            c = epoch_micros_to_ntz(F.expr(f"({name} - pmod({name}, 1000)) div 1000"))
        elif isinstance(field.dataType, T.TimestampType):
            c = epoch_micros_to_ntz(F.unix_micros(c))
        columns.append(c.alias(field.name))
    return df.select(*columns)


# S9 — files written by pandas/pyarrow carry TIMESTAMP(NANOS) columns, which Spark
# refuses. The footers say which columns of which files those are: they are read as epoch
# nanoseconds and turned into timestamp_ntz; any other bigint stays as it is, and a zoned
# timestamp becomes its UTC wall clock whatever the session zone. Files whose footers differ
# (several writers in one folder) are scanned by groups of one layout and put together by
# column name; a column that a group lacks is null there. The flag is on only while schemas are
# inferred; the scans themselves have explicit schemas and need none.
def load_parquet_nanos(spark: SparkSession, path: str) -> DataFrame:
    flag = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(flag, None)
    spark.conf.set(flag, "true")
    try:
        inferred = spark.read.parquet(str(path))
        groups = file_groups(spark, inferred.inputFiles())
        if len(groups) < 2:
            return _normalised(spark.read.schema(inferred.schema).parquet(str(path)), groups[0][2] if groups else set())
        in_files = set().union(*(names for _, names, _ in groups))
        parts = [f for f in inferred.schema if f.name not in in_files]  # columns of the folder names
        base, frames = _folder(spark, str(path)), []
        for uris, names, nanos in groups:
            files = [re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(u)) for u in uris]
            reader = spark.read.option("basePath", base) if base else spark.read
            own = [f for f in reader.parquet(files[0]).schema if f.name in names]
            frames.append(_normalised(reader.schema(T.StructType(own + parts)).parquet(*files), nanos))
    finally:
        spark.conf.unset(flag) if before is None else spark.conf.set(flag, before)
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return whole.select(*["`" + c.replace("`", "``") + "`" for c in [f.name for f in inferred.schema if f.name in whole.columns]
                          + [c for c in whole.columns if c not in inferred.columns]])
