"""WARC round trip against a brute-force version."""
import gzip
import hashlib
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from shopstat.llm import queries
from shopstat.llm.warc import decisions, digests, members, page_ranges, read_warc, shard_of, warc_round_trip, write_warc


def brute(rows):
    first = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100:
            first[b] = min(first.get(b, p), p)
    return sorted((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if (r := first.get(b, p)) != p else "response", r if r != p else None)
                  for p, _, h in rows for b in [(h or "").encode()])


def got(df):
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def pages():
    rng = random.Random(1)
    rows = [(i, f"http://a.example/{i}", rng.choice(["<p>é" + "x" * rng.randint(0, 300) + "</p>", "y" * 99, "z" * 100, "é" * 50, "", None])) for i in range(200)]
    rows += [(300, None, "z" * 100), (301, "http://b.example/a b\r\nX: y", "q" * 400), (302, "", "\r\n\r\n" * 60), (300, None, "z" * 100), (303, "u", "q" * 400)]
    return rows + [(400 + i, "http://hot.example/", "hot " * 80) for i in range(300)]


def test_round_trip(table):
    assert got(warc_round_trip(table(pages(), "page_id long, url string, html string"))) == brute(pages())


def test_files_roll_and_are_the_same_each_time(spark, table, tmp_dir):
    df = table(pages(), "page_id long, url string, html string")
    sums = []
    for k in range(2):
        folder = os.path.join(tmp_dir, str(k))
        write_warc(df, folder, roll_bytes=4000, range_bytes=40_000)
        names = sorted(x for x in os.listdir(folder) if x.endswith(".gz"))
        assert len(names) > 3 and not [x for x in os.listdir(folder) if "tmp" in x]
        listed = {os.path.basename(r.path): r for r in spark.read.parquet(folder + "/manifest").collect()}
        assert sorted(listed) == names and all(listed[n].bytes == os.path.getsize(f"{folder}/{n}") for n in names)
        sums.append([(n, hashlib.sha256(open(f"{folder}/{n}", "rb").read()).hexdigest()) for n in names])
        assert b"".join(gzip.open(f"{folder}/{n}").read() for n in names).count(b"WARC/1.1\r\n") == len(pages())
        assert got(read_warc(spark, folder)) == brute(pages())
    assert sums[0] == sums[1]


def test_null_page_and_empty_table(table):
    out = warc_round_trip(table([(None, "u", "n" * 200), (5, "u", "n" * 200)], "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in out if r.page_id) == [(5, "response", None)]
    assert [(r.record_type, r.refers_to) for r in out if r.page_id is None] == [("revisit", 5)]
    assert warc_round_trip(table([], "page_id long, url string, html string")).count() == 0


def ranges(df, size, most=1 << 14):
    slim = df.select(F.coalesce("page_id", F.lit(2**63 - 1)).alias("page"), "url", "html")
    return page_ranges(decisions(digests(slim)), size, most)


def test_ranges_are_even_whatever_the_ids(spark, table):
    """One far outlying id, negative ids, one page and null pages that hold a third of the rows each."""
    rng = random.Random(5)
    body = lambda i: f"{i} " + "w" * rng.randint(600, 800)
    rows = [(i, "u", body(i)) for i in range(1000)] + [(2**60, "u", body(-1)), (-2**62, "u", body(-2))]
    rows += [(500, "u", body(f"p{i}")) for i in range(1000)] + [(None, "u", body(f"n{i}")) for i in range(1000)]
    df = table(rows, "page_id long, url string, html string")
    size, starts = ranges(df, 100_000)
    assert 25 <= len(starts) <= 35 and starts == ranges(df.repartition(7), 100_000)[1]
    assert len(ranges(df, 100_000, most=4)[1]) == 4
    placed = [(2**63 - 1 if p is None else p, int(hashlib.sha256(h.encode()).hexdigest()[:7], 16), len(h) + 300) for p, _, h in rows]
    found = table([(p, w) for p, w, _ in placed], "page long, w long").select("page", "w", shard_of(starts)("page", "w").alias("s")).collect()
    want = {(p, w): max(i for i, start in enumerate(starts) if start <= (p, w)) for p, w, _ in placed}
    assert {(r.page, r.w): r.s for r in found} == want
    held = [0] * len(starts)
    for p, w, n in placed:
        held[want[p, w]] += n
    assert max(held) <= size + 1200 and min(held[:-1]) >= size - 1200
    folder = queries.warc.scratch_path(spark, "warc-test")
    write_warc(df, folder, range_bytes=100_000, roll_bytes=20_000)
    files = spark.read.parquet(folder + "/manifest").collect()
    assert len({r.shard for r in files}) == len(starts) and sum(r.n_records for r in files) == len(rows)
    back = sorted((r.page_id or -1, r.payload_digest) for r in read_warc(spark, folder).collect())
    assert back == sorted((p or -1, hashlib.sha256(h.encode()).hexdigest()) for p, _, h in rows)


def test_unfinished_files_go(table, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "w"))
    open(os.path.join(tmp_dir, "w", "_part-000000-00000.warc.gz.77.tmp"), "w").close()
    write_warc(table(pages(), "page_id long, url string, html string"), os.path.join(tmp_dir, "w"))
    assert not [x for x in os.listdir(os.path.join(tmp_dir, "w")) if x.endswith(".tmp")]


def test_members_of_all_sizes():
    rng = random.Random(3)
    parts = [rng.randbytes(rng.choice([0, 1, 50, 20_000, 70_000])) for _ in range(300)] + [rng.randbytes(3 << 20)]
    data = b"".join(gzip.compress(p) for p in parts)
    assert list(members(io.BytesIO(data))) == parts
    with pytest.raises(ValueError):
        list(members(io.BytesIO(data[:-9])))


def test_registered_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.page_id, None, r.html) for r in spark.read.parquet(d + "/pages.parquet").collect()]
    assert got(queries.op6_warc(spark, d)) == brute(rows)
