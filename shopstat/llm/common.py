"""Helpers shared by the training-data operators: written intermediate tables, shared
folders and files that tasks read and write themselves."""
from __future__ import annotations

import posixpath
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstat.session import scratch_path

#: Sorts after every real id; stands for a null id wherever rows are ordered by id.
NULL_ID = 2**63 - 1


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts the lineage, and a
    lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the path."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete one of our own intermediate tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def others(df: DataFrame, *names: str) -> list[str]:
    """Columns of ``df`` besides ``names``."""
    return [c for c in df.columns if c not in names]


def quoted(name: str):
    """The column of exactly that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def schema(**columns: str | T.DataType) -> T.StructType:
    """A schema of names and types (objects or their names)."""
    return T.StructType([T.StructField(n, T.DataType.fromDDL(t) if isinstance(t, str) else t) for n, t in columns.items()])


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it, for a task that writes or reads a file itself."""
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[len("file:"):]
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


class CommittedFile:
    """A file written under a name of the task attempt and moved to its own name when whole,
    so that a lost or repeated attempt leaves no half-written file under the real name."""

    def __init__(self, folder: str, name: str, attempt: int) -> None:
        self.fs, root = open_store(folder)
        self.fs.create_dir(root, recursive=True)
        self.final = posixpath.join(root, name)
        self.temporary = posixpath.join(root, f"_{name}.{attempt}.tmp")
        self.out = self.fs.open_output_stream(self.temporary, compression=None)
        self.size = 0
        self.crc = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)
        self.crc = zlib.crc32(data, self.crc)

    def commit(self) -> None:
        self.out.close()
        if self.fs.get_file_info(self.final).type != pafs.FileType.NotFound:
            self.fs.delete_file(self.final)  # of an attempt whose result was lost: the same bytes
        self.fs.move(self.temporary, self.final)


_CACHES: dict[str, Callable[[], None]] = {}


def only_cache(owner: str, clear: Callable[[], None]) -> None:
    """Called by a task that fills the cache of the operator ``owner``: Python workers are used by one
    operator after the other, so the caches that others left in this worker are emptied."""
    left = [name for name in _CACHES if name != owner]
    for name in left:
        _CACHES.pop(name)()
    _CACHES[owner] = clear
    if left:
        pa.default_memory_pool().release_unused()


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of Python values of the columns ``names``."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


class CharacterKinds:
    """Which characters of texts are odd, by a test of a single one that is done once for each."""

    def __init__(self, is_odd: Callable[[str], bool]) -> None:
        self.is_odd = is_odd
        self.kind = np.zeros(0x110000, dtype=np.uint8)  # 1 plain, 2 odd, 0 not seen yet
        self.kind[:128] = 1

    def odd_in(self, texts: Iterable[str]) -> re.Pattern | None:
        """A pattern of the odd characters in ``texts``, if there are any."""
        points = np.frombuffer("".join([t for t in texts if not t.isascii()]).encode("utf-32-le"), "<u4")
        seen = np.unique(points[self.odd(points)])
        return re.compile("[" + "".join(map(re.escape, map(chr, seen.tolist()))) + "]") if len(seen) else None

    def odd(self, points: np.ndarray) -> np.ndarray:
        """Of each code point, whether it is odd."""
        kinds = self.kind[points]
        if (kinds == 0).any():
            for c in np.unique(points[kinds == 0]).tolist():
                self.kind[c] = 2 if self.is_odd(chr(c)) else 1
            kinds = self.kind[points]
        return kinds == 2


def text_slices(batch: pa.RecordBatch, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of about ``most_bytes`` of text each (at least a row), so that the
    Python copies of long texts stay small."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths):
        total += n
        if total >= most_bytes:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < len(lengths):
        yield batch.slice(start)


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array], drop: Iterable[str] = ()) -> pa.RecordBatch:
    """``batch`` with ``columns`` put in place of its own of that name, or added."""
    gone = set(drop) | set(columns)
    kept = {f.name: batch.column(i) for i, f in enumerate(batch.schema) if f.name not in gone}
    both = kept | columns
    return pa.RecordBatch.from_arrays(list(both.values()), names=list(both))
