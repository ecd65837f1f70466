"""Bit-plane clustering against the same rounds in Python integers."""
import hashlib
import math
import random

import numpy as np
import pytest

from shopstat.llm.bitplane_kmeans import bits_needed, cluster_vectors, dots, floors, place_values, planes_of, unpacked


def brute(rows, k=8, rounds=10, seed=3, scale=1024):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [(lambda n, d: n * scale // d)(*float(x).as_integer_ratio()) for x in v]))
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(),))
    centroids = [v for _, v in first[:k]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [min((distance(v, c), i) for i, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        which = [i for _, i in assign()]
        for i in range(len(centroids)):
            own = [v for (_, v), w in zip(kept, which, strict=True) if w == i]
            if own:
                centroids[i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    got = assign()
    out = []
    fit = lambda x: x if x < 2**63 else None
    for (vec_id, _), (d, i) in zip(kept, got, strict=True):
        sha = hashlib.sha256(",".join(map(str, centroids[i])).encode()).hexdigest()
        out.append((vec_id, i, fit(d), fit(sum(x for x, w in got if w == i)), fit(sum(x for x, _ in got)), sha))
    return sorted(out, key=str)


def run(df):
    out = cluster_vectors(df)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def test_planes_give_exact_products():
    rng = random.Random(4)
    for size in (1, 300, 2**20, 2**40, 2**90):
        a = np.array([[rng.randint(-size, size) for _ in range(64)] for _ in range(5)], dtype=object)
        b = np.array([[rng.randint(-size, size) for _ in range(64)]], dtype=object)
        pa, pb = planes_of(a, int(bits_needed(a).max())), planes_of(b, int(bits_needed(b)[0]))
        assert dots(pa, pb[:, 0]).tolist() == [sum(x * y for x, y in zip(r, b[0], strict=True)) for r in a]
        assert unpacked(np.ascontiguousarray(pb[:, 0]).tobytes()) == b[0].tolist()
    assert place_values(3) == [1, 2, -4]
    assert floors(np.array([[-0.0001, 0.9999, -1.0]]), 1024).tolist() == [[-1, 1023, -1024]]


def test_rounds_with_ties_repeats_and_rows_that_take_no_part(table):
    rng = random.Random(7)
    vec = lambda spread=1.0: [float(np.float32(rng.gauss(0, spread))) for _ in range(64)]
    rows = [(i, vec(0.2)) for i in range(300)] + [(400 + i, [0.25 * (i % 2)] * 64) for i in range(40)]
    rows += [(900, None), (901, []), (902, vec()[:63]), (903, vec() + [1.0]), (904, [None, *vec()[1:]]), (905, [float("nan"), *vec()[1:]]),
             (906, [float("inf"), *vec()[1:]]), (907, [0.0] * 64), (908, [-0.0] * 64)]
    df = table([(i, v, 9, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster int, `a.b` string").repartition(5)
    assert run(df) == brute(rows)


@pytest.mark.parametrize("size", [1e5, 1e9, 1e30])
def test_wide_components(table, size):
    rng = random.Random(8)
    rows = [(i, [float(np.float32(rng.uniform(-1, 1) * (size if i % 3 else 1))) for _ in range(64)]) for i in range(40)]
    assert run(table(rows, "vec_id long, embedding array<float>")) == brute(rows)


def test_few_null_and_no_rows(table):
    rows = [(None, [0.5] * 64), (3, [0.1] * 64), (4, [0.2] * 64)]
    assert run(table(rows, "vec_id long, embedding array<double>")) == brute(rows)
    assert run(table([], "vec_id long, embedding array<float>")) == []


def test_query_against_brute_force(spark):
    from shopstat.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, QUERIES["op13_bitplane_kmeans"](spark, d).collect()), key=str) == brute(rows)
