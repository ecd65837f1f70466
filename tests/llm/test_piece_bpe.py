"""SentencePiece encoding and decoding against the sentencepiece library."""
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece

from shopstat.llm import piece_bpe
from shopstat.llm.piece_bpe import PieceBpe, encode_decode

PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return PieceBpe(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(both, texts):
    ours, theirs = both
    packed = ours.encode(pa.array(texts, pa.string()))
    for text, ids, decoded in zip(texts, packed.to_pylist(), ours.decode(packed).to_pylist(), strict=True):
        want = theirs.encode(text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert decoded == theirs.decode(want), text


def test_chosen_texts(both):
    same(both, ["", None, " ", "  ", " a", "a ", "  a  b ", "Hello World", "a\nb\t c\r\x00d", "\u2581x \u2581 \u2581\u2581", "\u65e5\u672c\u1c89 <s> </s> <unk> <0x41>",
                "\u00e9 e\u0301 \u00a0", " " * 100 + "x" + " " * 33, "q" * 9000, "ab" * 5000 + "x", "\U0001f389 \u200b\ufffd", "\n", "x\n"])
    same(both, [])


def test_random_texts(both):
    rng = random.Random(1)
    letters = "abcdeinorst  \u2581'\u00e9.,\n1\u00d1\u65e5\u1c89\x00"
    same(both, ["".join(rng.choice(letters) for _ in range(rng.randint(0, 70))) for _ in range(4000)])
    pieces = both[0].pieces[259:]
    same(both, ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(4000)])


def test_every_code_point(both):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 1 << 16):
        same(both, ["a%cb %c" % (c, c) for c in points[at:at + (1 << 16)]])


def test_any_ids_decode(both):
    ours, theirs = both
    rng = random.Random(2)
    rows = [[rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(131, 258), rng.randint(259, 31999)]) for _ in range(rng.randint(0, 12))] for _ in range(1500)]
    got = ours.decode(pa.array([np.array(r, "<u4").tobytes() for r in rows], pa.binary())).to_pylist()
    assert got == [theirs.decode(r) for r in rows]
    for r, text in zip(rows, got, strict=True):
        assert ours.decode(pa.array([np.array(r, "<u4").tobytes()], pa.binary())).to_pylist() == [text]


def test_backtracking_is_what_the_merges_make(both):
    ours, _ = both
    rng = random.Random(5)
    ours.known.clear()
    ours.words = ours.backtracked = 0
    words = ["".join(rng.choice("\u2581etaoinsrhl") for _ in range(rng.randint(1, 25))) for _ in range(2000)]
    for w, ids in zip(words, ours.encode_words(words), strict=True):
        want = [ours.ids[p] for p in ours.merged(w)]
        assert np.frombuffer(ids, "<u4").tolist() == want == ours.backtrack(w)
    assert 0 < ours.backtracked < ours.words == 2000


def test_small_memories_give_the_same(both, monkeypatch):
    monkeypatch.setattr(piece_bpe, "CACHE_WORDS", 5)
    monkeypatch.setattr(piece_bpe, "CACHE_PAIRS", 3)
    same(both, ["some words come again, some words do not", "again and again the same words", "xylophones"] * 3)


def test_operator(table):
    rows = [(1, "Some text", 5, "a"), (2, None, 6, "b"), (None, "", 7, "c"), (1, "Some text", 5, "a"), (3, "word " * 200_000, 8, "d")]
    df = table(rows, "doc_id long, text string, n_tokens int, `x.y` string")
    out = encode_decode(df, PATH)
    assert out.columns == ["doc_id", "text", "x.y", "ids", "n_tokens", "decoded"]
    got = out.collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded == (r.text or "")) for r in got) == [
        ("1", 4, True), ("1", 4, True), ("2", 2, True), ("3", 200_003, True), ("None", 2, True)]
    assert encode_decode(table([], "doc_id long, text string"), PATH).count() == 0


def test_query_against_the_library(spark, both):
    from shopstat.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect():
        ids = both[1].encode(r.text or "", add_bos=True, add_eos=True)
        want.append((r.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(both[1].decode(ids).encode())))
    assert sorted(map(tuple, QUERIES["op12_sentencepiece"](spark, d).collect())) == sorted(want)
