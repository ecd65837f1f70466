"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Vectors are dealt over shards of about ``SHARD_ROWS`` rows by a hash; a shard's task builds a graph in
batches of doubling size. A greedy search over the graph so far proposes a point's neighbours, and
robust pruning keeps the nearest, then only those that are not ``ALPHA`` times nearer to a kept one than
to the point, so edges stay diverse; reversed edges are added and pruned alike. A query runs a beam
search of width ``BEAM`` in every shard, and the shards' nearest are merged.

Largest inner product is nearest distance after adding one coordinate, sqrt(longest^2 - |x|^2), so
the graph is Euclidean and its edges serve vectors of any length. What the search finds is ranked by the
inner product of the original vectors in double precision.

Equal vectors are one point of the graph with their smallest ids attached, as many as any query can
ask for, so a vector that a third of all rows share costs one point. Queries travel in blocks
to each shard; shards grow in number with the rows and never in size.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part;
vectors meet only vectors of the same length; rows that repeat an id and vector count once; of an
id with several vectors each is a candidate; null ids take no part; an empty table gives no rows.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, stored

SHARD_ROWS = 6_000
QUERY_BLOCK = 4_096
DEGREE = 48
BUILD_BEAM = 80
BEAM = 96
ALPHA = 1.2
SALTS = 16


class Graph:
    """A directed graph over the rows of ``x`` (n, d)."""

    def __init__(self, x: np.ndarray, edges: np.ndarray, entry: int) -> None:
        self.x, self.edges, self.entry = np.ascontiguousarray(x, np.float32), edges, entry
        self.norm = np.einsum("ij,ij->i", self.x, self.x)

    def search(self, q: np.ndarray, beam: int, width: int = 4, among: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Of each query the ids of its nearest ``beam`` points met (-1 pads) and their squared distances
        (less the query's own square), by a beam search that expands ``width`` points a step."""
        m, n, degree = len(q), len(self.x), self.edges.shape[1]
        rows = np.arange(m)
        ids = np.full((m, beam), -1, np.int32)
        far = np.full((m, beam), np.inf, np.float32)
        open_ = np.zeros((m, beam), bool)
        seen = np.zeros((m, n + 1), bool)  # the last column stands for no neighbour
        seen[:, n] = True
        ids[:, 0] = self.entry
        far[:, 0] = self.norm[self.entry] - 2 * (q @ self.x[self.entry])
        open_[:, 0] = True
        seen[:, self.entry] = True
        live = rows
        while len(live):
            score = np.where(open_[live], far[live], np.inf)
            pick = np.argpartition(score, min(width, beam) - 1, axis=1)[:, :width]
            good = np.take_along_axis(score, pick, 1) < np.inf
            at = np.take_along_axis(ids[live], pick, 1)
            open_[live[:, None], pick] = False
            near = np.where(good[:, :, None], self.edges[np.where(good, at, 0)], -1).reshape(len(live), -1)
            near[near < 0] = n
            near.sort(axis=1)
            fresh = ~seen[live[:, None], near]
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            seen[live[:, None], near] = True
            most = int(fresh.sum(1).max(initial=0))
            if most:
                order = np.argsort(~fresh, axis=1, kind="stable")[:, :most]
                near, fresh = np.take_along_axis(near, order, 1), np.take_along_axis(fresh, order, 1)
                safe = np.where(fresh, near, 0)
                d = self.norm[safe] - 2 * np.einsum("ijk,ik->ij", self.x[safe], q[live])
                d[~fresh] = np.inf
                all_d = np.concatenate([far[live], d], 1)
                all_i = np.concatenate([ids[live], np.where(fresh, near, -1).astype(np.int32)], 1)
                all_o = np.concatenate([open_[live], fresh], 1)
                top = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
                far[live], ids[live] = np.take_along_axis(all_d, top, 1), np.take_along_axis(all_i, top, 1)
                open_[live] = np.take_along_axis(all_o, top, 1)
            live = live[open_[live].any(1)]
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)


def robust_prune(x: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Out-edges of each point from its candidates (-1 pads): the nearest first, without those that
    a kept edge leads towards."""
    m, c = cand.shape
    cand = np.where(cand == points[:, None], -1, cand)
    cand = np.sort(cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    rows = x[np.where(cand < 0, 0, cand)]
    d = np.einsum("ijk,ijk->ij", rows - x[points][:, None], rows - x[points][:, None])
    d[cand < 0] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    cand, d, rows = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1), np.take_along_axis(rows, order[:, :, None], 1)
    square = np.einsum("ijk,ijk->ij", rows, rows)
    out = np.full((m, degree), -1, np.int32)
    alive = d < np.inf
    which = np.arange(m)
    for k in range(degree):
        any_ = alive.any(1)
        if not any_.any():
            break
        first = alive.argmax(1)
        out[any_, k] = cand[which, first][any_]
        to_kept = square + square[which, first][:, None] - 2 * np.einsum("ijk,ik->ij", rows, rows[which, first])
        alive &= (alpha * alpha * to_kept > d)
        alive[which, first] = False
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, most: int = 512) -> Graph:
    """The graph of a shard: points enter in batches of doubling size."""
    x = np.ascontiguousarray(x, np.float32)
    n = len(x)
    entry = int(np.argmin(((x - x.mean(0)) ** 2).sum(1)))
    order = np.concatenate([[entry], np.delete(np.random.default_rng(5).permutation(n), np.argmax(np.random.default_rng(5).permutation(n) == entry))])
    graph = Graph(x, np.full((n, degree), -1, np.int32), entry)
    at = 1
    while at < n:
        size = min(most, at, n - at)
        batch = order[at:at + size]
        found, _ = graph.search(x[batch], min(beam, max(2, at)))
        # Points of a batch do not see each other in the search; they propose each other here.
        if size > 1:
            near = np.argsort(graph.norm[batch][None, :] - 2 * x[batch] @ x[batch].T, axis=1)[:, :min(size, 17)]
            found = np.concatenate([found, batch[near]], 1)
        graph.edges[batch] = robust_prune(x, batch, found, degree, alpha)
        src = np.repeat(batch, degree)
        dst = graph.edges[batch].reshape(-1)
        src, dst = src[dst >= 0], dst[dst >= 0]
        o = np.argsort(dst, kind="stable")
        src, dst = src[o], dst[o]
        touched, begin, count = np.unique(dst, return_index=True, return_counts=True)
        room = int(count.max(initial=0))
        added = np.full((len(touched), room), -1, np.int64)
        slot = np.arange(len(dst)) - np.repeat(begin, count)
        added[np.repeat(np.arange(len(touched)), count), slot] = src
        both = np.concatenate([graph.edges[touched], added], 1)
        held = (both >= 0).sum(1)
        fits = held <= degree
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :degree]
        graph.edges[touched[fits]] = packed[fits]
        if (~fits).any():
            graph.edges[touched[~fits]] = robust_prune(x, touched[~fits], both[~fits], degree, alpha)
        at += size
    return graph


#: Powers of two that the lengths in a shard span.
BAND = 8


def _lift(v: np.ndarray, power: int, longest: float) -> np.ndarray:
    """One more coordinate, after which the nearest point has the largest inner product. Vectors are
    scaled by a power of two first, so that no square is lost or too large."""
    v = np.ldexp(v, -power) / longest
    rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", v, v)))
    rest[rest < 1e-3] = 0
    return np.concatenate([v, rest[:, None]], 1)


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    fine = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def _unit(q: np.ndarray) -> np.ndarray:
    q = q / np.abs(q).max(axis=1, keepdims=True)
    return q / np.linalg.norm(q, axis=1, keepdims=True)


def _vectors(rows: list) -> np.ndarray:
    return np.array(rows, dtype=np.float64)


def nearest(base: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int = SHARD_ROWS, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found to each row for which ``queries`` (a
    condition on the column ``id``) holds, its own row left out."""
    rows = base.select(quoted(id_col).cast("long").alias("id"), quoted(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("v", F.transform("v", lambda x: x + 0.0))
    rows = stored(rows, "ann-vectors")
    # Equal vectors: the k + 1 smallest ids, in two steps so that no task gets all of a hot vector.
    salted = Window.partitionBy("v", F.pmod(F.xxhash64("id"), F.lit(SALTS))).orderBy("id")
    few = rows.distinct().withColumn("r", F.row_number().over(salted)).filter(F.col("r") <= k + 1).drop("r")
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("r") <= k + 1)
    points = few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("dim", F.size("v"))
    # Shards hold vectors of similar length: beside much longer ones all others look alike.
    big = F.array_max(F.transform("v", lambda x: F.abs(x)))
    points = points.withColumn("big", big).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + F.pow(x / F.col("big"), F.lit(2.0)))))
    points = points.withColumn("band", F.floor((F.log2("big") + F.log2("norm")) / BAND).cast("int"))
    points = stored(points, "ann-points")
    # A row for each length and band, of which there are few hundred at most.
    exponent = F.floor(F.log2("big")).cast("int")
    bands = {(r["dim"], r["band"]): r for r in points.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n"), F.max(exponent).alias("power")).collect()}
    if not bands:
        return base.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = {key: max(1, math.ceil(r["n"] / shard_rows)) for key, r in bands.items()}
    power = {key: r["power"] for key, r in bands.items()}
    count = F.create_map(*[F.lit(x) for (d, b), n in shards.items() for x in (f"{d} {b}", n)])[F.concat_ws(" ", "dim", "band")]
    placed = points.withColumn("shard", F.pmod(F.xxhash64("v"), count).cast("int"))

    def lifted(x, dim, band):
        return _lift(x, power[dim, band], longest[dim, band])

    scaled = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.pow(x / F.pow(F.lit(2.0), F.col("power").cast("double")), F.lit(2.0)))
    powers = F.create_map(*[F.lit(x) for (d, b), p in power.items() for x in (f"{d} {b}", p)])[F.concat_ws(" ", "dim", "band")]
    longest = {(r["dim"], r["band"]): r["longest"] for r in points.withColumn("power", powers).groupBy("dim", "band").agg(F.max(F.sqrt(scaled)).alias("longest")).collect()}

    def index(t):
        x = _vectors(t.column("v").to_pylist())
        dim, band = t.column("dim")[0].as_py(), t.column("band")[0].as_py()
        graph = build(lifted(x, dim, band))
        edges = [e[e >= 0] for e in graph.edges]
        return pa.table({"dim": t.column("dim"), "band": t.column("band"), "shard": t.column("shard"), "node": pa.array(np.arange(len(x)), pa.int32()), "v": t.column("v"),
                         "ids": t.column("ids"), "edges": pa.array(edges, pa.list_(pa.int32())), "entry": pa.array(np.full(len(x), graph.entry), pa.int32())})

    kinds = "dim int, band int, shard int, node int, v array<double>, ids array<long>, edges array<int>, entry int"
    graphs = stored(placed.select("dim", "band", "shard", "v", "ids").groupBy("dim", "band", "shard").applyInArrow(index, kinds), "ann-graphs")
    asked = rows.filter(queries).distinct().withColumn("dim", F.size("v"))
    asked_n = asked.count()
    blocks = max(1, math.ceil(asked_n / QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    all_shards = F.create_map(*[x for dim in {d for d, _ in shards} for x in (F.lit(dim), F.array(*[
        F.struct(F.lit(b).alias("band"), F.lit(n).alias("n")) for (d, b), n in shards.items() if d == dim]))])
    asked = asked.withColumn("of", F.explode(all_shards[F.col("dim")])).withColumn("band", F.col("of.band")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.col("of.n") - 1))).drop("of")
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(nodes, wanted):
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not nodes.num_rows or not wanted.num_rows:
            return empty
        nodes = nodes.sort_by("node")
        x, dim, band = _vectors(nodes.column("v").to_pylist()), nodes.column("dim")[0].as_py(), nodes.column("band")[0].as_py()
        lists = nodes.column("edges").to_pylist()
        edges = np.full((len(x), max(1, max(map(len, lists)))), -1, np.int32)
        for i, e in enumerate(lists):
            edges[i, :len(e)] = e
        graph = Graph(lifted(x, dim, band), edges, nodes.column("entry")[0].as_py())
        ids = nodes.column("ids").to_pylist()
        q_ids, q = wanted.column("id").to_pylist(), _vectors(wanted.column("v").to_pylist())
        asking = np.concatenate([_unit(q), np.zeros((len(q), 1))], 1).astype(np.float32)
        out = []
        for at in range(0, len(q), 256):
            found, _ = graph.search(asking[at:at + 256], max(beam, 2 * k))
            for i, row in enumerate(found, at):
                row = row[row >= 0]
                with np.errstate(over="ignore", invalid="ignore"):
                    best = np.einsum("ij,j->i", x[row], q[i])
                best[np.isnan(best)] = -np.inf  # infinite parts of both signs
                last = np.sort(-best)[min(k, len(best) - 1)] if len(best) else 0.0  # of k + 1 points one may be the query's own
                got = [(s, v) for s, p in zip((-best).tolist(), row.tolist(), strict=True) if s <= last for v in ids[p] if v != q_ids[i]]
                out += [(q_ids[i], v, -s) for s, v in sorted(got)[:k]]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    both = held.groupBy("dim", "band", "shard", "block").cogroup(asked.groupBy("dim", "band", "shard", "block"))
    hits = both.applyInArrow(search, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
