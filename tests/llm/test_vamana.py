"""Graph search against brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from shopstat.llm.vamana import nearest


def brute(rows, k, asked):
    seen = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for i, v in seen:
        if asked(i):
            best = sorted({(-float(np.dot(np.array(w), np.array(v))), j) for j, w in seen if j != i and len(w) == len(v)})
            out[i] = [(j, -s) for s, j in best[:k]]
    return out


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_ties_and_odd_vectors(table):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=16) * rng.uniform(0.2, 3)).tolist()) for i in range(1500)]
    hot = rows[5][1]
    rows += [(2000 + i, hot) for i in range(400)]
    rows += [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [None] + [1.0] * 15), (5004, [float("nan")] * 16), (5005, [float("inf")] * 16), (None, hot),
             (5010, [1.0, 2.0]), (5020, [2.0, 1.0]), rows[0]]
    want = brute(rows, 20, lambda i: i % 10 == 0)
    have = got(nearest(table(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(9)), F.col("id") % 10 == 0, 20, shard_rows=500))
    assert set(have) == {i for i, w in want.items() if w}
    hits = [len({j for j, _ in have[i]} & {j for j, _ in want[i]}) / len(want[i]) for i in have]
    assert np.mean(hits) >= 0.95 and all(len(have[i]) == len(want[i]) for i in have)
    exact = {i: dict(w) for i, w in want.items()}
    assert all(abs(s - exact[i].get(j, s)) < 1e-9 for i in have for j, s in have[i])
    assert [j for j, _ in have[2000][:4]] == [j for j, _ in want[2000][:4]] and have[5010] == [(5020, 4.0)]


def test_few_rows_and_empty_table(table):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5])]
    assert got(nearest(table(rows, "vec_id long, embedding array<float>"), F.col("id") == 0)) == {0: [(1, 1.0), (2, 0.5)]}
    assert nearest(table([], "vec_id long, embedding array<float>"), F.col("id") == 0).count() == 0


def test_ties_of_different_vectors_go_to_the_smallest_ids(table):
    rows = [(1000, [1.0] + [0.0] * 60)] + [(60 - i, [0.5] + [float(i == j) for j in range(60)]) for i in range(60)]
    have = got(nearest(table(rows, "vec_id long, embedding array<double>"), F.col("id") == 1000, 5))
    assert have == {1000: [(i, 0.5) for i in range(1, 6)]}


@pytest.mark.parametrize("scales", [(1e-200,), (1e155,), (1e-200, 1.0, 1e150), (5e-324, 1e300)])
def test_tiny_huge_and_mixed_vectors(table, scales):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=8) * scales[i % len(scales)]).tolist()) for i in range(240)]
    rows = [(i, v) for i, v in rows if any(v)]
    with np.errstate(over="ignore", invalid="ignore"):
        want = brute(rows, 20, lambda i: i % 24 == 0)
    have = got(nearest(table(rows, "vec_id long, embedding array<double>"), F.col("id") % 24 == 0, 20, shard_rows=100))
    assert set(have) == set(want) and all(len(v) == 20 for v in have.values())
    if scales == (1e-200, 1.0, 1e150):  # what can be told apart is found: equal products are all as good
        hits = [np.mean([np.isclose(s, t, rtol=1e-9, atol=0) for (_, s), (_, t) in zip(have[i], want[i], strict=True)]) for i in have]
        assert np.mean(hits) >= 0.95


def test_several_full_shards_have_the_recall_asked_for(table):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(200, 64))  # vectors about centres, as embeddings are; without any the recall is 0.7
    rows = [(i, (centres[i % 200] + 0.5 * rng.normal(size=64)).astype(np.float32).tolist()) for i in range(13_000)]
    have = got(nearest(table(rows, "vec_id long, embedding array<float>").repartition(4), F.col("id") % 500 == 0, 20))
    x = np.array([v for _, v in rows], np.float64)
    hits = []
    for i, found in have.items():
        s = x @ x[i]
        s[i] = -np.inf
        hits.append(len({j for j, _ in found} & set(np.argsort(-s)[:20].tolist())) / 20)
    assert len(have) == 26 and np.mean(hits) >= 0.95
