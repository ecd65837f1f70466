"""k-d shards: laws of the result."""
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shopstat.llm.kd_sharding import shard_by_bytes


def laws(out, rows, shards, slack):
    got = out.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    by, size, where = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        by[r.shard].append(r.slot)
        size[r.shard] += r.size
        where[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(shards))
    mean = sum(size.values()) / shards
    assert all(abs(size[s] - mean) <= slack * mean for s in range(shards)), size
    return where


def test_laws_with_hot_group_and_source(table):
    rng = random.Random(1)
    rows = [(i, "é" * rng.randint(0, 300) + str(i), rng.choice(["en", "de", None]), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    rows += [(5000 + i, "copies of one text " * 9, "en", f"s{i % 5}") for i in range(1500)] + [(9000 + i, f"pair {i // 2}" * 20, "en", f"s{i % 2}") for i in range(200)]
    rows += [(None, None, None, None), (None, None, None, None), (1, "again", "en", "x"), (1, "again", "en", "x")]
    df = table(rows, "doc_id long, text string, lang string, source string").withColumnRenamed("text", "text")
    where = laws(shard_by_bytes(df, 16, slot_rows=64), rows, 16, 0.03)
    pairs = [where[zlib.crc32((f"pair {i}" * 20).encode())] for i in range(100)]
    assert all(len(p) == 1 for p in pairs)


def test_clashing_columns_empty_table_and_few_rows(table):
    rows = [(i, "x" * 10) for i in range(8)]
    df = table(rows, "doc_id long, text string").withColumn("size", F.lit(1)).withColumn("node", F.lit(1)).withColumn("d0", F.lit(1))
    assert {r.shard for r in shard_by_bytes(df, 4).collect()} <= set(range(4))
    assert shard_by_bytes(table([], "doc_id long, text string"), 16).count() == 0
    assert shard_by_bytes(df.limit(1), 16).count() == 1
    with pytest.raises(ValueError):
        shard_by_bytes(df, 3)
