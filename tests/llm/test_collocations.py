"""Collocations against counting every phrase in Python."""
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from shopstat.llm import collocations as C
from shopstat.llm.collocations import chunk_table, collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for s in range(1, 5):
                f[lang].update(tuple(w[i:i + s]) for i in range(len(w) - s + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        inside = defaultdict(int)
        for p, c in frequent.items():
            for s in range(2, len(p)):
                for i in range(len(p) - s + 1):
                    inside[p[i:i + s]] = max(inside[p[i:i + s]], c)
        own = []
        for p, a in frequent.items():
            if 100 * inside[p] < 80 * a:
                score, _, left, right = min((int(Fraction(2000000 * a, counts[p[:k]] + counts[p[k:]])), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                own.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1)]
    return sorted(out)


def run(df, **kw):
    out = collocations(df, **kw)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, out.collect()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["the", "of", "River", "river", "ÉTÉ", "a", "b", "c", "new", "york", "x y", "z\x00", "city"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" "] * 12 + ["  ", "\t", ". ", ", ", "\n", "\r\n", "?!", ";"]) for _ in range(n))
    out = [(text(rng.randint(0, 60)), rng.choice(["en", "de", None, "und"])) for _ in range(200)]
    out += [("New York City " * 400, "en"), ("a " * 3000, "de"), (None, "en"), ("", "fr"), (" ", "fr"), ("...", "fr"), ("one", "xx"), (text(5000), "en")]
    passage = text(40)
    return out + [(text(3) + passage, "de")] * 60


@pytest.mark.parametrize("kw", [{"least": 5}, {"least": 30, "top": 4}, {"least": 5, "modulus": 1}, {"least": 5, "modulus": 10**9}, {"least": 3, "filter_bits": 64}])
def test_against_brute_force(table, rows, kw, monkeypatch):
    if kw["least"] == 3:
        monkeypatch.setattr(C, "SLICE_BYTES", 500)
    df = table([(i, t, lang, 1, "q") for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, n int, `phrase` string").repartition(3)
    assert run(df, **kw) == brute(rows, kw["least"], kw.get("top", 2000))


def test_chunks_overlap_and_own_every_token_once(table, rows):
    texts = [t.encode().translate(C._TABLE).replace(b".", b" . ").strip() for t, _ in rows if t]
    chunk, row, tail = C._chunks(pa.array(texts, pa.binary()).view(pa.string()), 4)
    back = defaultdict(list)
    for c, r, t in zip(chunk.to_pylist(), row.tolist(), tail.tolist(), strict=True):
        back[r] += c.split(" ")[:len(c.split(" ")) - t]
    assert {r: " ".join(w) for r, w in back.items()} == {r: " ".join(filter(None, t.decode().split(" "))) for r, t in enumerate(texts) if t}
    stored = chunk_table(table([(t, lang) for t, lang in rows], "text string, lang string"), "text", "lang", 4).collect()
    assert max(r.freq for r in stored) >= 60  # the passage is one set of chunks
    assert sum(r.freq for r in stored) == len(chunk)


def test_sums_and_products_pass_64_bits(spark):
    big = 2**62
    df = spark.createDataFrame([("en", "", big, 0), ("en", "p", big, 1), ("en", "q", big, 1), ("en", "p q", big - 1, 2)], "lang string, phrase string, f long, size int")
    (r,) = C.scored(df).collect()
    assert (r.a, r.l, r.r, r.score) == (big - 1, big, big, 2000000 * (big - 1) // (2 * big))


def test_nothing(table):
    assert run(table([], "text string, lang string")) == []
    assert run(table([(None, None), ("", "en")], "text string, lang string")) == []
    assert C.Tokens(pa.array(["", "a", ""])).offsets.tolist() == [0, 0, 1, 1] and len(C._chunks(pa.array([""]), 2)[0]) == 0
    assert np.array_equal(C._summed(np.zeros(0, np.int64), np.zeros(0, np.int64))[1], np.zeros(0))
    assert isinstance(C._chunks(pa.array(["a b"]), 2)[0], pa.Array)
