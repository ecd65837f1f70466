"""Registered queries, with their production parameters, against brute force over the smallest tables."""
import zlib

import duckdb
import numpy as np
import pytest
import public_tokenizers as P
from pyspark.sql import functions as F

import corpus_pipeline
from shopstat.llm import kd_sharding, near_dedup, toxicity
from shopstat.llm.queries import QUERIES

from . import test_near_dedup, test_token_output, test_vamana

DIR = "/root/testdata/sf0.001"


def rows(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{DIR}/{name}.parquet'").fetchall()


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_op2(spark):
    out = QUERIES["op2_vamana"](spark, DIR)
    assert out.select("query_id", "rank", "vec_id", "score").schema.simpleString() == "struct<query_id:bigint,rank:int,vec_id:bigint,score:double>"
    want = test_vamana.brute([(i, list(map(float, v)) if v else v) for i, v in rows("embeddings", "vec_id, embedding")], 20, lambda i: i % 20 == 0)
    found = test_vamana.got(out)
    assert found.keys() == want.keys()
    hits = sum(len({j for j, _ in found[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    exact = {q: dict(v) for q, v in test_vamana.brute([(i, list(map(float, v)) if v else v) for i, v in rows("embeddings", "vec_id, embedding")], 1 << 30, lambda i: i % 20 == 0).items()}
    assert all(s == pytest.approx(exact[q][j], rel=1e-12) for q, v in found.items() for j, s in v)


def test_op3(spark):
    assert test_near_dedup.got(QUERIES["op3_near_dedup"](spark, DIR)) == test_near_dedup.brute(rows("documents", "doc_id, text"), 3, (85, 100))


def test_op4(spark):
    out = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op4_token_output"](spark, DIR).collect()), key=lambda r: r[1])
    assert out == test_token_output.expected(rows("documents", "doc_id, text")) and P.path("byte_bpe_50k.json") == test_token_output.PATH


def test_op7(spark):
    """The model of the query, fitted again outside Spark from the rows that are not held out."""
    docs, marks = rows("documents", "doc_id, text"), dict(rows("labels", "doc_id, toxic"))
    learn = sorted((toxicity.columns_of(t).astype("<u4").tobytes(), marks[d], t) for d, t in docs if marks.get(d) in (0, 1) and fold(d, 5) != 0)
    weights, bias = toxicity.fit([(toxicity.columns_of(t), toxicity.swapped(t), y) for _, y, t in learn])
    want = {d: 1 / (1 + np.exp(-(weights[toxicity.columns_of(t)].sum() + bias))) for d, t in docs}
    out = QUERIES["op7_toxicity"](spark, DIR).collect()
    assert {r.doc_id for r in out} == set(want) and len(out) == len(docs)
    for r in out:
        assert r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.5) and r.score == pytest.approx(want[r.doc_id], abs=1e-6)


def test_op8(spark):
    langs = dict(rows("documents", "doc_id, lang"))
    texts = dict(rows("documents", "doc_id, text"))
    learned = {v for d, v in langs.items() if v is not None and fold(d, 4) != 2}
    out = QUERIES["op8_language_id"](spark, DIR).collect()
    assert {r.doc_id for r in out} == set(langs) and len(out) == len(langs)
    for r in out:
        assert r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1
        assert r.lang_pred == "und" if not any(c.isalpha() for c in texts[r.doc_id] or "") else r.lang_pred in learned
    held = [r for r in out if r.held_out and langs[r.doc_id] is not None]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def kd_brute(points, shards):
    """Recursive split of sorted rows at the weighted median along the widest dimension."""
    axes = [c for c in points[0].asDict() if c.startswith("d") and c != "doc_id"]
    out = {}

    def split(part, node, levels):
        if not levels or not part:
            for r in part:
                out[(r.doc_id, r.text_crc32)] = node
            return
        size = np.array([r["size"] for r in part], float)
        spread = []
        for i, a in enumerate(axes):
            x = np.array([r[a] for r in part], float) / (1 << kd_sharding.GRID_BITS)
            spread.append((round(float((size * x**2).sum() / size.sum() - ((size * x).sum() / size.sum()) ** 2), 12), max(r[a] for r in part) - min(r[a] for r in part), -i))
        axis = axes[-max(spread)[2]]
        weight = {}
        for r in part:
            weight[(r[axis], r.tie)] = weight.get((r[axis], r.tie), 0) + r["size"]
        goal, before = size.sum() / 2, 0
        for cut in sorted(weight):
            if before + weight[cut] > goal:
                break
            before += weight[cut]
        stays = goal - before > weight[cut] / 2  # the point on the median lies mostly before it
        left = [r for r in part if (r[axis], r.tie) < cut or (stays and (r[axis], r.tie) == cut)]
        split(left, 2 * node, levels - 1)
        split([r for r in part if not ((r[axis], r.tie) < cut or (stays and (r[axis], r.tie) == cut))], 2 * node + 1, levels - 1)

    split(points, 0, shards.bit_length() - 1)
    return out


def test_op9(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    want = kd_brute(kd_sharding.points(docs, 16, "doc_id", "text", ["lang", "source"]).collect(), 16)
    out = QUERIES["op9_kd_sharding"](spark, DIR).collect()
    assert {(r.doc_id, r.text_crc32): r.shard for r in out} == want and len(out) == docs.count()
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out))) for s in range(16))
    assert {(r.law, r.grown_shard) for r in out} == {("bytes", None)}


def test_op10_finds_every_item_held_word_for_word(spark):
    import re

    low = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    docs = [(d, low(t)) for d, t in rows("documents", "doc_id, text")]
    items = duckdb.sql(f"SELECT * FROM '{DIR}/benchmark.parquet'").df()
    text = next(c for c in items.columns if c in ("text", "question", "passage"))
    want = {(d, i) for i, t in zip(items["item_id"], items[text], strict=True) if low(t).strip() for d, body in docs if low(t) in body}
    out = QUERIES["op10_decontaminate"](spark, DIR).select("doc_id", "item_id").collect()
    assert want <= {(r.doc_id, r.item_id) for r in out}


def test_pipeline(spark):
    """The registered query is its stages, one after the other, on all that the one before kept."""
    out = {(r.doc_id, r.ids_sha256, r.n_tokens) for r in QUERIES["pipeline"](spark, DIR).collect()}
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stored(stage(spark, docs, DIR), f"again-{name}")
    left = {r.doc_id: r.text for r in docs.collect()}
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    theirs.no_truncation()
    theirs.no_padding()
    import hashlib

    want = set()
    for d, t in left.items():
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        want.add((d, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), len(ids)))
    assert out == want and docs.filter(F.col("doc_id").isNull()).count() == 0
