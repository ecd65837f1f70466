"""Centroid clustering of integer vectors by bit planes: bit i of all 64 components of a vector is
one unsigned 64-bit integer. A dot product is the sum, over pairs of a vector's plane and a
centroid's plane, of the bits that both have, weighted by both planes' place values (the top plane
of two's complement counts negative), so distances are exact integers. Sums of the members are
counts of set bits by plane, and just as exact.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, remove, schema, stored, stored_at

COMPONENTS = 64
#: Rows whose bits are handled together.
SLICE = 8192
#: Sums leave a task in limbs of so many bits, which Spark adds up as decimals.
LIMB = 60
_LONG = 2**63 - 1
_KEPT = "_vector"


def floors(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exactly: as 64-bit integers, or as Python's where those do not suffice.
    Scales are powers of two, so that the product of an ordinary double is exact."""
    if not len(values) or np.abs(values).max() * scale < 2.0**62:
        return np.floor(values * float(scale)).astype(np.int64)
    ratios = [x.as_integer_ratio() for x in values.ravel().tolist()]
    return np.array([n * scale // d for n, d in ratios], dtype=object).reshape(values.shape)


def bits_needed(ints: np.ndarray) -> np.ndarray:
    """Planes of each row in two's complement, the sign's included."""
    size = np.where(ints < 0, -1 - ints, ints).max(axis=1)
    if size.dtype == object:
        return np.array([int(x).bit_length() + 1 for x in size], dtype=np.int64)
    return np.frexp(size.astype(np.float64))[1].astype(np.int64) + 1


def planes_of(ints: np.ndarray, bits: int) -> np.ndarray:
    """The planes of rows of 64 integers, one array row per plane: component j is bit j."""
    out = np.empty((bits, len(ints)), dtype="<u8")
    for i in range(bits):
        plane = ((ints >> i) & 1).astype(np.uint8)
        out[i] = np.packbits(plane, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def place_values(bits: int) -> list[int]:
    return [1 << i for i in range(bits - 1)] + [-(1 << (bits - 1))]


def dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact dot products of the vectors in ``left`` (planes by vectors) with those in ``right``
    (planes, or planes by as many vectors)."""
    small = len(left) + len(right) <= 54  # then weighted counts, their sum and its double fit 64 bits
    out = np.zeros(left.shape[1], dtype=np.int64 if small else object)
    for wi, plane in zip(place_values(len(left)), left, strict=True):
        part = np.zeros(left.shape[1], dtype=np.int64 if small else object)
        for wj, other in zip(place_values(len(right)), right, strict=True):
            count = np.bitwise_count(plane & other)
            part += wj * (count.astype(np.int64) if small else count.astype(object))
        out += wi * part
    return out


class Centroids:
    """The centroids' planes and squared lengths."""

    def __init__(self, rows: list[list[int]]) -> None:
        self.planes, self.squares = [], []
        for row in rows:
            ints = np.array([row], dtype=object)
            self.planes.append(planes_of(ints, int(bits_needed(ints)[0])))
            self.squares.append(sum(x * x for x in row))

    def nearest(self, planes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each vector the nearest centroid, ties to the smaller number, and its squared
        distance less the vector's own squared length."""
        best = which = None
        for k, (own, square) in enumerate(zip(self.planes, self.squares, strict=True)):
            d = dots(planes, own[:, 0])
            d = square - 2 * (d if square < 2**58 else d.astype(object))
            if best is None:
                best, which = d, np.zeros(planes.shape[1], dtype=np.int64)
            else:
                closer = (d < best).astype(bool)
                which[closer] = k
                best = np.where(closer, d, best)
        return which, best


def _plane_groups(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a column of packed planes, by their number of planes: row numbers and planes."""
    packed = column.to_pylist()
    bits = np.array([len(p) // 8 for p in packed])
    for b in np.unique(bits):
        rows = np.flatnonzero(bits == b)
        flat = np.frombuffer(b"".join([packed[i] for i in rows]), dtype="<u8")
        yield rows, np.ascontiguousarray(flat.reshape(-1, b).T)


def _slices(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def packed(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id`` and ``planes`` (little-endian 64-bit words, lowest plane first) of the vectors kept."""
    v = quoted(vector_col).cast("array<double>")
    # A null vector's size is null or negative, and no null or non-finite component passes.
    whole = F.forall(_KEPT, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(quoted(id_col).alias("id"), v.alias(_KEPT)).filter((F.size(_KEPT) == COMPONENTS) & whole)

    def run(batches):
        for batch in _slices(batches):
            values = batch.column(_KEPT).flatten().to_numpy(zero_copy_only=False).reshape(-1, COMPONENTS)
            wide = (np.abs(values) >= 2.0**50).any(axis=1)
            out: list[bytes] = [b""] * len(values)
            for part in (np.flatnonzero(~wide), np.flatnonzero(wide)):
                if len(part):
                    ints = floors(values[part], scale)
                    bits = bits_needed(ints)
                    for b in np.unique(bits):
                        same = np.flatnonzero(bits == b)
                        rows = np.ascontiguousarray(planes_of(ints[same], int(b)).T)
                        for i, row in zip(part[same].tolist(), rows, strict=True):
                            out[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], names=["id", "planes"])

    return kept.mapInArrow(run, schema(id=kept.schema["id"].dataType, planes="binary"))


def unpacked(planes: bytes) -> list[int]:
    words = np.frombuffer(planes, dtype="<u8")
    bits = np.unpackbits(words.view(np.uint8).reshape(len(words), 8), axis=1, bitorder="little")
    return [sum(w * int(bit) for w, bit in zip(place_values(len(words)), column, strict=True)) for column in bits.T]


def _first(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors whose ids have the smallest hashes; a null id counts as an empty text."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(key.alias("h"), "planes").orderBy("h", "planes").limit(k).collect()
    return [unpacked(bytes(r.planes)) for r in rows]


def _limbs(total: int) -> list[int]:
    out = []
    while not -(1 << (LIMB - 1)) <= total < 1 << (LIMB - 1):
        out.append(total & ((1 << LIMB) - 1))
        total >>= LIMB
    return [*out, total]


def _means(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid's members' componentwise floor of sum by count; without members, itself."""
    k = len(centroids)

    def run(batches):
        model = Centroids(centroids)
        counts, sums = [0] * k, np.zeros((k, COMPONENTS), dtype=object)
        for batch in _slices(batches):
            for _, planes in _plane_groups(batch.column("planes")):
                which, _ = model.nearest(planes)
                bits = np.unpackbits(planes.view(np.uint8).reshape(*planes.shape, 8), axis=2, bitorder="little")
                for c in np.unique(which).tolist():
                    member = which == c
                    counts[c] += int(member.sum())
                    set_bits = bits[:, member].sum(axis=1, dtype=np.int64)
                    for w, row in zip(place_values(len(planes)), set_bits, strict=True):
                        sums[c] += w * row.astype(object)
        rows = [(c, j, limb, value) for c in range(k) if counts[c]
                for j, total in enumerate([*sums[c].tolist(), counts[c]]) for limb, value in enumerate(_limbs(total))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
                                             names=["c", "j", "limb", "value"])

    parts = vectors.select("planes").mapInArrow(run, "c int, j int, limb int, value long")
    total = [[0] * (COMPONENTS + 1) for _ in range(k)]
    for r in parts.groupBy("c", "j", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        total[r.c][r.j] += int(r.value) << (LIMB * r.limb)
    return [[x // row[-1] for x in row[:-1]] if row[-1] else old for row, old in zip(total, centroids, strict=True)]


def _assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    def run(batches):
        model = Centroids(centroids)
        for batch in _slices(batches):
            cluster = np.zeros(batch.num_rows, dtype=np.int32)
            distance: list[int | None] = [None] * batch.num_rows
            for rows, planes in _plane_groups(batch.column("planes")):
                which, rest = model.nearest(planes)
                cluster[rows] = which
                for i, d in zip(rows.tolist(), (rest + dots(planes, planes)).tolist(), strict=True):
                    distance[i] = d if d <= _LONG else None
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cluster), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    return vectors.mapInArrow(run, schema(id=vectors.schema["id"].dataType, cluster="int", distance="long"))


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Clusters of the vectors with exactly 64 components, none null or non-finite; the others take
    no part. A component x counts as floor(``scale`` * x), ``scale`` a power of two. The ``k`` kept
    vectors with the smallest sha256 of ``<seed>:<id>`` (a null id is empty there; equal ids go by
    their planes) are the first centroids, fewer where fewer are kept. Each of ``rounds`` rounds
    assigns all vectors (ties to the smaller number) and moves every centroid with members to the
    floor of their mean; rounds that would change nothing any more are not run.

    Returns, a row per kept row: the id, cluster, distance (squared), cluster_inertia, inertia (sums of
    distances over the cluster and over all) and centroid_sha256. A distance or sum that a long cannot
    hold is null. Other columns of ``vectors`` are not returned; an empty table gives an empty one.

    A round reads the packed planes alone, adds up members within tasks and shuffles at most ``k`` * 65
    numbers a task. The driver holds the centroids, whose size does not grow with the table.
    """
    if scale < 1 or scale & (scale - 1):
        raise ValueError("scale must be a power of two")
    spark: SparkSession = vectors.sparkSession
    table, path = stored_at(packed(vectors, id_col, vector_col, scale), "planes")
    centroids = _first(table, k, seed)
    for _ in range(rounds if centroids else 0):
        before, centroids = centroids, _means(table, centroids)
        if centroids == before:
            break
    done = stored(_assigned(table, centroids), "clusters")
    remove(spark, path)
    exact = F.col("distance").cast("decimal(38,0)")
    sums = {r.cluster: (int(r.total), r.missing) for r in done.groupBy("cluster").agg(
        F.coalesce(F.sum(exact), F.lit(0)).alias("total"), F.count_if(F.col("distance").isNull()).alias("missing")).collect()}

    def number(clusters: list[int]):
        total = sum(sums[c][0] for c in clusters)
        whole = total <= _LONG and not any(sums[c][1] for c in clusters)
        return F.lit(total if whole else None).cast("long")

    known = sorted(sums)
    digest = {c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest() for c in known}
    per = F.lit(None).cast("long")
    sha = F.lit(None).cast("string")
    for c in known:
        per = F.when(F.col("cluster") == c, number([c])).otherwise(per)
        sha = F.when(F.col("cluster") == c, F.lit(digest[c])).otherwise(sha)
    return done.select(F.col("id").alias(id_col), "cluster", "distance", per.alias("cluster_inertia"), number(known).alias("inertia"), sha.alias("centroid_sha256"))
