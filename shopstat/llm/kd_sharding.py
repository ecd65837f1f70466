"""Shards of near equal bytes by k-d tree partitioning, in DataFrame operations alone.

Equal texts form a group, and a group is a point of metadata: its size, its language, its source
and the hash of its text, each as an integer of ``GRID_BITS`` bits (the smallest value of a group
whose rows differ). A node's widest dimension is the one whose values spread most (the variance
weighted by bytes, relative to the grid); the node is split there at the median weighted by bytes, and
so on until the leaves are the shards, each of the target size. The order along a dimension
goes on by text hash, so a value that a third of all rows share is split as evenly as any other
and groups stay whole. Only a group of more than ``WHOLE_SHARE`` of a shard's target is dealt into
chunks, which lie side by side and part only where a median falls between them.

A median is found by histograms: the order's digits, ``DIGIT_BITS`` at a time, are counted for all
nodes of a level at once with partial aggregation, and only the bin that holds the median is
refined. What reaches the driver is a row a node. Slots number a shard's rows from 0: counts of
hash buckets of about ``SLOT_ROWS`` rows give each bucket its first slot, and rows are numbered
within their bucket only.

Defined cases: null text has size 1 and no bytes; null metadata is a value of its own; equal rows
are told apart by nothing but still counted and numbered each; an empty table gives no rows. Extra
columns take no part.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, stored

GRID_BITS = 16
DIGIT_BITS = 16
#: Of the last resort in the order: bits of the text hash and of the chunk.
TEXT_BITS, CHUNK_BITS = 34, 14
TIE_BITS = TEXT_BITS + CHUNK_BITS
WHOLE_SHARE = 0.02
SLOT_ROWS = 8192


def _grid(hash_column: Column) -> Column:
    return F.shiftrightunsigned(hash_column, 64 - GRID_BITS)


def points(docs: DataFrame, shards: int, id_col: str, text_col: str, dimensions: list[str]) -> DataFrame:
    """doc_id, size, text_crc32, the dimensions d0... of the row's group on the grid, and tie."""
    raw = F.coalesce(quoted(text_col), F.lit("")).cast("binary")
    size = F.length(raw).cast("long") + 1
    # Sizes lie on a logarithmic grid, so that the widest dimension is not always the size.
    top = (1 << GRID_BITS) - 1
    present = [quoted(c) for c in dimensions if c in docs.columns]
    grids = [F.when(c.isNull(), F.lit(0)).otherwise(_grid(F.xxhash64(c.cast("string")))) for c in present]
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), size.alias("size"), F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("text_hash"),
                       *[g.alias(f"m{i}") for i, g in enumerate(grids)])
    rows = stored(rows, "kd-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    whole = max(1.0, WHOLE_SHARE * total / shards)
    # Partial aggregation meets a hot group first; the join back is of thin rows, split by adaptive execution.
    groups = rows.groupBy("text_hash", "text_crc32", "size").agg(F.count(F.lit(1)).alias("copies"), *[F.min(f"m{i}").alias(f"d{i + 1}") for i in range(len(grids))])
    groups = groups.withColumn("chunks", F.least(F.ceil(F.col("size") * F.col("copies") / whole), F.lit(1 << CHUNK_BITS)).cast("long"))
    logs = F.least(F.floor(F.log2(F.col("size").cast("double")) * F.lit((1 << GRID_BITS) / 40)), F.lit(top)).cast("long")
    both = rows.join(groups.drop("copies"), ["text_hash", "text_crc32", "size"])
    tie = F.shiftleft(F.shiftrightunsigned("text_hash", 64 - TEXT_BITS), CHUNK_BITS).bitwiseOR(F.pmod(F.xxhash64("doc_id"), F.col("chunks")))
    return both.select("doc_id", "size", "text_crc32", logs.alias("d0"), *[f"d{i + 1}" for i in range(len(grids))],
                       _grid(F.col("text_hash")).alias(f"d{len(grids) + 1}"), tie.alias("tie"))


def _case(node: Column, values: dict[int, object], kind: str) -> Column:
    """A value for each node; at most a node's worth of literals."""
    return reduce(lambda c, kv: c.when(node == kv[0], F.lit(kv[1]).cast(kind)), list(values.items())[1:],
                  F.when(node == next(iter(values)), F.lit(next(iter(values.values()))).cast(kind)))


def _medians(rows: DataFrame, goal: dict[int, float]) -> dict[int, tuple[int, int]]:
    """Of each node the (position, tie) whose predecessors weigh nearest to its goal. ``rows``: node, at, tie, size."""
    digits = [("at", s) for s in range(max(0, GRID_BITS - DIGIT_BITS), -1, -DIGIT_BITS)]
    if digits[-1][1]:
        digits.append(("at", 0))
    digits += [("tie", s) for s in range(TIE_BITS - DIGIT_BITS, -1, -DIGIT_BITS)]
    if digits[-1][1]:
        digits.append(("tie", 0))
    found = {n: {"at": 0, "tie": 0, "left": g} for n, g in goal.items()}
    done: dict[str, int] = {"at": GRID_BITS, "tie": TIE_BITS}
    for column, shift in digits:
        inside = F.lit(True)
        for c in ("at", "tie"):
            if done[c] < (GRID_BITS if c == "at" else TIE_BITS):
                prefix = {n: f[c] >> done[c] for n, f in found.items()}
                inside = inside & (F.shiftrightunsigned(F.col(c), done[c]) == _case(F.col("node"), prefix, "long"))
        width = done[column] - shift
        digit = F.shiftrightunsigned(F.col(column), shift).bitwiseAND(F.lit((1 << width) - 1))
        bins = rows.filter(inside).groupBy("node", digit.alias("digit")).agg(F.sum("size").alias("w"))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("digit"))
        left = _case(F.col("node"), {n: float(f["left"]) for n, f in found.items()}, "double")
        hit = bins.withColumn("upto", upto).filter((F.col("upto") - F.col("w") <= left) & (F.col("upto") > left))
        for r in hit.select("node", "digit", "w", (F.col("upto") - F.col("w")).alias("before")).collect():  # a row a node
            found[r.node][column] |= r.digit << shift
            found[r.node]["left"] -= r.before
            if (column, shift) == digits[-1] and found[r.node]["left"] > r.w / 2:
                found[r.node]["tie"] += 1  # the point on the median lies mostly before it
        done[column] = shift
    return {n: (f["at"], f["tie"]) for n, f in found.items()}


def shard_by_bytes(docs: DataFrame, shards: int = 16, dimensions: list[str] | None = None, id_col: str = "doc_id",
                   text_col: str = "text", slot_rows: int = SLOT_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, for a power of two of shards."""
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    rows = stored(points(docs, shards, id_col, text_col, ["lang", "source"] if dimensions is None else dimensions), "kd-points")
    axes = [c for c in rows.columns if c.startswith("d") and c != "doc_id"]
    node = F.lit(0)
    for _ in range(int(math.log2(shards))):
        here = rows.withColumn("node", node)
        unit = float(1 << GRID_BITS)
        spread = [F.struct((F.max(a) - F.min(a)).alias("range"), (F.sum(F.col("size") * (F.col(a) / unit) ** 2) / F.sum("size")
                  - (F.sum(F.col("size") * F.col(a) / unit) / F.sum("size")) ** 2).alias("var")).alias(a) for a in axes]
        stats = here.groupBy("node").agg(F.sum("size").alias("total"), *spread).collect()  # a row a node
        if not stats:
            break
        widest = {r.node: max(range(len(axes)), key=lambda i, r=r: (round(r[axes[i]]["var"], 12), r[axes[i]]["range"], -i)) for r in stats}
        at = reduce(lambda c, i: c.when(_case(F.col("node"), widest, "int") == i, F.col(axes[i])), range(1, len(axes)),
                    F.when(_case(F.col("node"), widest, "int") == 0, F.col(axes[0])))
        cuts = _medians(here.select("node", at.alias("at"), "tie", "size"), {r.node: r.total / 2 for r in stats})
        cut_at, cut_tie = ({n: c[i] for n, c in cuts.items()} for i in (0, 1))
        # The next level in terms of the columns of ``rows`` alone.
        own = node
        place = reduce(lambda c, i: c.when(_case(own, widest, "int") == i, F.col(axes[i])), range(1, len(axes)),
                       F.when(_case(own, widest, "int") == 0, F.col(axes[0])))
        behind = (place > _case(own, cut_at, "long")) | ((place == _case(own, cut_at, "long")) & (F.col("tie") >= _case(own, cut_tie, "long")))
        rows = rows.withColumn("node", (own * 2 + F.when(behind, 1).otherwise(0)).cast("int"))
        rows = stored(rows, "kd-level")
        node = F.col("node")
    rows = rows.withColumn("shard", node.cast("int"))
    total = rows.count()
    buckets = max(1, math.ceil(total / shards / slot_rows))
    spot = F.pmod(F.xxhash64("doc_id", "text_crc32", "tie"), F.lit(buckets)).cast("int")
    rows = rows.withColumn("bucket", spot)
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    first = counts.select("shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("first"))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("tie", "doc_id")) - 1
    placed = rows.withColumn("within", within).join(first, ["shard", "bucket"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("within")).cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
