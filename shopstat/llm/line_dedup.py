"""Line dedup against levelled sorted runs of line hashes.

A line's key is the line stripped of ASCII white space with A-Z lower-cased; keys of at least
``min_chars`` code points count. Documents come in batches of ascending id. Each batch takes the
smallest id of each key of its own, merge-anti-joins it with the sorted runs that earlier batches
left, and stores what is new as a run of level 0. ``fanout`` runs of a level are merged into one
of the next. In the end a key is owned by the smallest document that holds it, and every line whose
key another document owns is dropped.

A run's rows travel to their owner's partition, where owned keys and documents meet in one sorted
stream; no key's lines are ever gathered, so a line that half of the corpus holds costs no more
than any other. Keys are 128-bit hashes.

Defined cases: null text is one empty line and stays null; an empty table stays empty; rows with
the same id are one document; null ids are one document that comes last; a line repeated within
its owner stays each time. The columns ``n_lines`` and ``n_dropped`` replace any of that name.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstat.session import scratch_path

from .common import NULL_ID, others, quoted, remove, schema, stored_at, text_slices

MIN_CHARS = 10
#: Batches of a bulk load and runs of a level before they are merged.
BATCHES = 4
FANOUT = 3

_STRIPPED = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Hash of the key of a line in UTF-8; None if the key is too short to count."""
    key = line.strip(_STRIPPED)
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key.lower())  # bytes.lower() turns A-Z alone


@dataclass
class Runs:
    """The levelled runs: by level the paths of the tables (key, owner), each sorted by key."""

    spark: SparkSession
    fanout: int = FANOUT
    levels: list[list[str]] = field(default_factory=list)

    _SCHEMA = "key binary, owner long"

    def all(self) -> DataFrame | None:
        paths = [p for level in self.levels for p in level]
        return self.spark.read.schema(self._SCHEMA).parquet(*paths) if paths else None

    def add(self, keys: DataFrame) -> None:
        """Merge-anti-join a batch's (key, owner) with the runs; the rest becomes a run."""
        before = self.all()
        fresh = keys.repartition("key") if before is None else keys.join(before.select("key").hint("merge"), "key", "left_anti")
        self._store(fresh, 0)

    def _store(self, rows: DataFrame, level: int) -> None:
        path = scratch_path(self.spark, f"line-run-{level}")
        rows.select("key", "owner").sortWithinPartitions("key").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._store(self.spark.read.schema(self._SCHEMA).parquet(*merged).repartition("key"), level + 1)
            for p in merged:
                remove(self.spark, p)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, owner) of every counted line of (owner, text), once a document row."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                keys, owners = [], []
                for owner, text in zip(part.column("owner").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), strict=True):
                    own = {line_key(x, min_chars) for x in (text or b"").split(b"\n")}
                    own.discard(None)
                    keys += own
                    owners += [owner] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(owners, pa.int64())], names=["key", "owner"])

    return docs.mapInArrow(run, Runs._SCHEMA)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                batches: int = BATCHES, fanout: int = FANOUT, runs: Runs | None = None) -> DataFrame:
    """``docs`` without the lines that an earlier document owns, with ``n_lines`` before and
    ``n_dropped``. Runs given are continued: their owners are of earlier loads. Write a load's result
    before the next load merges its runs."""
    spark = docs.sparkSession
    owner = F.coalesce(quoted(id_col).cast("long"), F.lit(NULL_ID))
    ids = docs.select(owner.alias("o"))
    bounds = [] if batches == 1 or ids.isEmpty() else ids.approxQuantile("o", [i / batches for i in range(1, batches)], 0.001)
    batch = sum((F.when(F.col("owner") > F.lit(int(b)), 1).otherwise(0) for b in bounds), F.lit(0))
    slim = docs.select(owner.alias("owner"), quoted(text_col).alias("text"))
    lines_path = scratch_path(spark, "line-keys")
    line_keys(slim, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(lines_path)
    lines = spark.read.schema("key binary, owner long, batch int").parquet(lines_path)
    runs = runs or Runs(spark, fanout)
    for b in range(batches):
        runs.add(lines.filter(F.col("batch") == b).groupBy("key").agg(F.min("owner").alias("owner")))
    remove(spark, lines_path)

    kept = others(docs, "n_lines", "n_dropped")
    rows = docs.select(owner.alias("_owner"), F.lit(1).alias("_kind"), F.lit(None).cast("binary").alias("_key"),
                       quoted(text_col).alias("_text"), F.struct(*[quoted(c) for c in kept if c != text_col]).alias("_row"))
    kind = rows.schema["_row"].dataType
    owned = runs.all().select(F.col("owner").alias("_owner"), F.lit(0).alias("_kind"), F.col("key").alias("_key"),
                              F.lit(None).cast("string").alias("_text"), F.lit(None).cast(kind).alias("_row"))
    merged = rows.unionByName(owned).repartition("_owner").sortWithinPartitions("_owner", "_kind")

    def drop(stream):
        current, mine = None, set()
        for whole in stream:
            for part in text_slices(whole, "_text"):
                at, texts, n_lines, n_dropped = [], [], [], []
                for i, (own, k, key, text) in enumerate(zip(*(part.column(c).to_pylist() for c in ("_owner", "_kind", "_key", "_text")), strict=True)):
                    if own != current:
                        current, mine = own, set()
                    if k == 0:
                        mine.add(key)
                        continue
                    lines = (text or "").encode().split(b"\n")
                    left = [x for x in lines if (h := line_key(x, min_chars)) is None or h in mine]
                    at.append(i)
                    texts.append(text if len(left) == len(lines) else b"\n".join(left).decode())
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(left))
                if at:
                    yield pa.RecordBatch.from_arrays([
                        part.column("_row").take(pa.array(at)), pa.array(texts, pa.string()),
                        pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=["_row", "_text", "n_lines", "n_dropped"])

    out = merged.mapInArrow(drop, schema(_row=kind, _text="string", n_lines="long", n_dropped="long"))
    columns = [F.col("_text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in kept]
    return out.select(*columns, "n_lines", "n_dropped")
