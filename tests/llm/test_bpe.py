"""BPE against the tokenizers library."""
import random

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from shopstat.llm.bpe import WordBpe, encode_decode

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return WordBpe(PATH), Tokenizer.from_file(PATH)


def same(both, text):
    ours, theirs = both
    want = theirs.encode(text, add_special_tokens=False).ids
    packed = ours.encode([text])
    assert np.frombuffer(packed.to_pylist()[0], "<u4").tolist() == want, text
    assert ours.decode_all(packed).to_pylist()[0] == theirs.decode(want, skip_special_tokens=False) == ours.decode(np.array(want, int))


def test_chosen_texts(both):
    for t in ["", "  ", "Hello WORLD's don't it'LL 123 4", "é É ñ İstanbul ΣΑΣ ß", "a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|>", "x\x1cy \x85 z w 　 q",
              "é  a 日本語 \U0001f389\U0001f389 ​ x\x00y", "l m <| x |>", "!!!! ... --- ''' 's", " ́ á̧", "word.\x1c end, 1. 2, x_y.", "ab" * 400 + " aaa" * 9, "q" * 9000]:
        same(both, t)


def test_random_texts(both):
    rng = random.Random(1)
    for _ in range(1500):
        same(both, "".join(rng.choice("abcdeinorst 'é.,\n1Ñ") for _ in range(rng.randint(1, 70))))


def test_every_code_point(both):
    ours, theirs = both
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 1 << 15):
        texts = [f"a{chr(c)}b {chr(c)}. x{chr(c)}{chr(c)}" for c in points[at:at + (1 << 15)]]
        want = [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]
        got = [np.frombuffer(b, "<u4").tolist() for b in ours.encode(texts).to_pylist()]
        assert [(t, g, w) for t, g, w in zip(texts, got, want, strict=True) if g != w] == []


def test_rare_characters_among_others(both):
    rng = random.Random(6)
    rare = "\u0558\u058b\u1c89\ua7cb\U00010d50\U00010d65\u00bd\u00b2\u0301\u03a3\u0130\u212a"
    for _ in range(3000):
        same(both, "".join(rng.choice(rare + "abE .,'\n1\x1c\u3000<|") for _ in range(rng.randint(1, 25))))


def test_pairs_are_checked_and_few_words_merged(both):
    ours, _ = both
    words = ["the", "nation", "international", "unbelievable", "erblehare", "thtionre", "xqzvw"]
    ours.words = ours.failed = 0
    ours.encode_words(words)
    assert ours.words == len(words) and ours.failed < len(words)
    for w in words:
        assert np.frombuffer(ours.encode_words([w])[0], "<u4").tolist() == ours.exact([*w[:-1], w[-1] + ours.suffix])


def test_operator(table):
    rows = [(1, "Some text", 5, "a"), (2, None, 6, "b"), (None, "", 7, "c"), (1, "Some text", 5, "a")]
    df = table(rows, "doc_id long, text string, n_tokens int, `x.y` string")
    out = encode_decode(df, PATH)
    assert out.columns == ["doc_id", "text", "x.y", "ids", "n_tokens", "decoded"]
    assert sorted(((r.doc_id, r.n_tokens, r.decoded) for r in out.collect()), key=str) == sorted(
        [(1, 2, "some</w> text</w>")] * 2 + [(2, 0, ""), (None, 0, "")], key=str)
    assert encode_decode(table([], "doc_id long, text string"), PATH).count() == 0


def test_query_against_the_library(spark, both):
    import hashlib

    from shopstat.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect():
        ids = both[1].encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(both[1].decode(ids, skip_special_tokens=False).encode())))
    assert sorted(map(tuple, QUERIES["op5_bpe"](spark, d).collect())) == sorted(want)
