"""WARC archives: a deterministic sharded writer and a parallel reader.

Payload digests alone decide which records are whole: of equal payloads of at least
``revisit_bytes`` bytes the smallest page is a response and the others revisit it. The decisions
(a few bytes a page) and the pages are range-sorted by page together, so both meet in one stream
and no join carries payloads. Ranges are cut where the exact running sum of payload bytes, in the
order of page and payload hash, passes a multiple of the range's size, so they are equal in bytes
however the ids lie, and the same each time. Each range is one task; it writes gzip members, one a record, and rolls to the
next file when a file reaches ``roll_bytes`` compressed. Record ids, digests, lengths and dates are
made anew from the page itself, so a repeated attempt writes the same bytes. A file is written
under a name of the attempt and renamed when whole; the manifest, written last by Spark's own
commit, names the files that belong to the archive with size and checksum.

Defined cases: null html is an empty payload; null urls become ``urn:page:<id>``; control
characters and spaces of a url are percent-encoded; rows that share the smallest page id of a
payload are all responses; null page ids come last, as one page. Rows of one page (or of null
pages) are split between ranges by their payloads; rows equal in page and payload stay together
and are written one by one. An empty table gives no files.
"""
from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstat.operators.ranking import global_running_sum
from shopstat.session import discard, scratch_path, stored

from .common import NULL_ID, CommittedFile, open_store, quoted, text_slices

REVISIT_BYTES = 100
#: Payload bytes of a range, and how many ranges there are at most: beyond their product the ranges
#: grow. The first keys of the ranges are all that the driver sees of the pages.
RANGE_BYTES = 32 << 20
MAX_RANGES = 1 << 14
#: Compressed bytes at which a file is closed: a sixteenth of the range's payload, within these limits.
ROLL_SHARE = 16
LEAST_ROLL, MOST_ROLL = 1 << 20, 1 << 30
#: Bytes that a record takes besides its payload, about.
HEADER_BYTES = 300
#: The date that every record bears unless the caller names one.
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("9c0b4f1e-7c55-5b0e-9d0a-3f2f4a6d1b11")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _target(url: str | None, page: int | None) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else f"urn:page:{page}"


def record(page: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, refers_url: str | None,
           digest: str, date: str = DATE) -> bytes:
    """A WARC record. Ids are made of the page, so a revisit can name the record it refers to."""
    rid = lambda p: f"<urn:uuid:{uuid.uuid5(_SPACE, str(p))}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {rid(page)}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {_target(url, page)}", f"WARC-Payload-Digest: sha256:{digest}",
            f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {rid(refers_to)}",
                 f"WARC-Refers-To-Target-URI: {_target(refers_url, refers_to)}", f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page: {refers_to}"]
    if page is not None:
        head.append(f"X-Page: {page}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)  # gzip with a header that names no time
    return packer.compress(data) + packer.flush()


def payload_digest(html: Column) -> Column:
    return F.sha2(F.coalesce(html, F.lit("")).cast("binary"), 256)


def digests(pages: DataFrame) -> DataFrame:
    """page, digest, payload_bytes, the smallest url and the number of rows, once a page and digest."""
    size = F.octet_length(F.coalesce(F.col("html"), F.lit(""))).cast("long")
    seen = pages.select("page", "url", payload_digest(F.col("html")).alias("digest"), size.alias("payload_bytes"))
    return seen.groupBy("page", "digest", "payload_bytes").agg(F.min("url").alias("url"), F.count(F.lit(1)).alias("n"))


def decisions(seen: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page, digest, payload_bytes, n, and refers_to with its url for revisits, of ``digests``."""
    first = (seen.filter((F.col("payload_bytes") >= revisit_bytes)).groupBy("digest")
             .agg(F.min(F.struct("page", "url")).alias("f"), F.count(F.lit(1)).alias("pages")).filter("pages > 1")
             .select("digest", F.col("f.page").alias("first_page"), F.col("f.url").alias("first_url")))
    # An equi-join of thin rows: a hot digest's side is split by adaptive execution.
    both = seen.join(first, "digest", "left")
    again = F.col("first_page") < F.col("page")
    return both.select("page", "digest", "payload_bytes", "n", F.when(again, F.col("first_page")).alias("refers_to"),
                       F.when(again, F.col("first_url")).alias("refers_url"))


def _within(digest: Column) -> Column:
    """The payload hash, 28 bits, that orders rows of one page."""
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long")


def page_ranges(decided: DataFrame, range_bytes: int, max_ranges: int = MAX_RANGES) -> tuple[int, list[tuple[int, int]]]:
    """The payload bytes of a range, and the first page and payload hash of each range, in order."""
    sizes = (decided.groupBy("page", _within(F.col("digest")).alias("within"))
             .agg(F.sum((F.col("payload_bytes") + HEADER_BYTES) * F.col("n")).alias("size")))
    total = decided.agg(F.sum((F.col("payload_bytes") + HEADER_BYTES) * F.col("n"))).first()[0] or 0
    count = max(1, min(max_ranges, -(-total // range_bytes)))
    size = max(1, -(-total // count))
    before = global_running_sum(sizes, [F.col("page"), F.col("within")], "size", "before", inclusive=False)
    starts = before.groupBy(F.expr(f"before div {size}").alias("range")).agg(F.min(F.struct("page", "within")).alias("start"))
    return size, sorted((r.start.page, r.start.within) for r in starts.collect())  # at most max_ranges rows


def _sort_keys(pages: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Page and payload hash as bytes in their order."""
    keys = np.empty(len(pages), dtype=[("page", ">u8"), ("within", ">u4")])
    keys["page"] = pages.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    keys["within"] = within
    return keys.view("S12")


def shard_of(starts: list[tuple[int, int]]):
    """The range of a page and payload hash, as a column function."""
    firsts = _sort_keys(np.array([p for p, _ in starts], dtype=np.int64), np.array([w for _, w in starts], dtype=np.int64))

    def find(page: pd.Series, within: pd.Series) -> pd.Series:
        at = np.searchsorted(firsts, _sort_keys(page.to_numpy(), within.to_numpy()), side="right") - 1
        return pd.Series(at.astype(np.int32))

    return F.pandas_udf(find, "int")


_MANIFEST = "shard int, file int, path string, bytes long, crc32 long, n_records long, first_page long, last_page long"


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               revisit_bytes: int = REVISIT_BYTES, roll_bytes: int | None = None, range_bytes: int = RANGE_BYTES,
               level: int = 6, date: str = DATE, max_ranges: int = MAX_RANGES) -> None:
    """Write one record per row of ``pages`` into ``folder`` (shared by all executors). Without
    ``roll_bytes``, files are closed at a ``ROLL_SHARE``-th of a range's payload."""
    spark = pages.sparkSession
    slim = pages.select(F.coalesce(quoted(id_col).cast("long"), F.lit(NULL_ID)).alias("page"), quoted(url_col).alias("url"), quoted(html_col).alias("html"))
    seen, seen_path = stored(digests(slim), "warc-digests")
    decided, decided_path = stored(decisions(seen, revisit_bytes), "warc-decisions")
    range_size, starts = page_ranges(decided, range_bytes, max_ranges)
    roll_at = roll_bytes or min(MOST_ROLL, max(LEAST_ROLL, range_size // ROLL_SHARE))
    none = lambda kind: F.lit(None).cast(kind)
    rows = decided.select("page", F.lit(0).alias("kind"), "digest", "refers_to", "refers_url", none("string").alias("url"), none("string").alias("html"))
    rows = rows.unionByName(slim.select("page", F.lit(1).alias("kind"), none("string").alias("digest"), none("long").alias("refers_to"),
                                        none("string").alias("refers_url"), "url", "html"))
    within = _within(F.coalesce(F.col("digest"), payload_digest(F.col("html"))))
    rows = rows.withColumn("shard", shard_of(starts)("page", within))
    # A range is a partition of its own. Equal pages are put in the order of url and payload, for the same bytes every time.
    ordered = (rows.repartitionById(max(1, len(starts)), "shard")
               .sortWithinPartitions("shard", "page", "kind", F.coalesce("url", F.lit("")), F.xxhash64("html")))

    def write(batches):
        task = TaskContext.get()
        shard, done, out = None, [], None
        current, known = None, {}
        n = first = last = 0

        def close():
            out.commit()
            done.append((shard, number, f"{folder}/{name}", out.size, out.crc, n, first, last))

        for batch in batches:
            for part in text_slices(batch, "html"):
                columns = (part.column(c).to_pylist() for c in ("shard", "page", "kind", "digest", "refers_to", "refers_url", "url", "html"))
                for own, page, kind, digest, refers_to, refers_url, url, html in zip(*columns, strict=True):
                    if own != shard:
                        if out is not None:
                            close()
                        shard, number, out = own, 0, None
                    if page != current:
                        current, known = page, {}
                    if kind == 0:
                        known[digest] = (refers_to, refers_url)
                        continue
                    payload = (html or "").encode()
                    digest = hashlib.sha256(payload).hexdigest()
                    refers_to, refers_url = known[digest]
                    if out is None:
                        name = f"part-{shard:06d}-{number:05d}.warc.gz"
                        out, n, first = CommittedFile(folder, name, task.taskAttemptId()), 0, page
                    out.write(_member(record(None if page == NULL_ID else page, url, payload, "response" if refers_to is None else "revisit",
                                             refers_to, refers_url, digest, date), level))
                    n, last = n + 1, page
                    if out.size >= roll_at:
                        close()
                        number, out = number + 1, None
        if out is not None:
            close()
        if done:
            kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)],
                                             names=["shard", "file", "path", "bytes", "crc32", "n_records", "first_page", "last_page"])

    ordered.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/manifest")
    _remove_unfinished(spark, folder)
    discard(spark, seen_path)
    discard(spark, decided_path)


def _remove_unfinished(spark: SparkSession, folder: str) -> None:
    """Delete the files that lost attempts left under their temporary names."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    at = path(f"{folder}/_part-*.tmp")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(at) or []:
        fs.delete(status.getPath(), False)


#: Compressed bytes given to the inflater at once: what follows a member in them is copied.
PIECE = 16 << 10


def members(stream) -> Iterator[bytes]:
    """The inflated gzip members of a stream, one at a time."""
    data, at = memoryview(b""), 0
    while True:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if at == len(data):
                data, at = memoryview(stream.read(1 << 20)), 0
            if not len(data):
                if parts:
                    raise ValueError("the last record is cut off")
                return
            piece = data[at:at + PIECE]
            parts.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        yield b"".join(parts)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record; checks its digest and length."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[:int(fields["content-length"])]
    if rest[len(block):] != b"\r\n\r\n" or "sha256:" + hashlib.sha256(block).hexdigest() != fields["warc-block-digest"]:
        raise ValueError("a record's block differs from its header")
    return fields, block


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, url, record_type, payload_digest, payload_bytes (both of the full payload), refers_to,
    and the payload of responses, of every record of the files in the manifest."""
    schema = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"
    files = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, local = open_store(path)
                rows, held = [], 0
                with store.open_input_stream(local, compression=None) as stream:
                    for data in members(stream):
                        fields, block = parse(data)
                        http, _, payload = block.partition(b"\r\n\r\n")
                        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{path}: a payload differs from its digest")
                        size = int(http.decode().lower().partition("content-length: ")[2].partition("\r\n")[0])
                        page, refers = fields.get("x-page"), fields.get("x-refers-to-page")
                        rows.append((None if page is None else int(page), fields["warc-target-uri"], kind, digest, size,
                                     None if refers is None else int(refers), payload if kind == "response" else None))
                        held += len(payload)
                        if held >= 8 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    many = max(1, spark.sparkContext.defaultParallelism * 4)
    return files.select("path").repartition(many).mapInArrow(read, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"])


def warc_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages and read the archive back."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    write_warc(pages, folder)
    return read_warc(pages.sparkSession, folder)
