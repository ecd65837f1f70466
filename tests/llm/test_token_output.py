"""Token store: the tokenizers library and an exact round trip."""
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopstat.llm import rans
from shopstat.llm.token_output import PieceEncoder, read_token_store, token_store_digest, write_token_store

PATH = P.path("byte_bpe_50k.json")
TEXTS = ["", None, "plain words, and more.\nNext line.", "a  b", " a", "a ", "a \n b", "\tx y\n\nz", "a <|endoftext|> b<|endoftext|>", "it's  'll go", "é ñ x  y",
         "a\0 b", "日本語 \U0001f389 text", "\x1c a\x1f b \x85 c\xa0d", "1,000.5 a.b, c.\nd ", "w" * 5000, "one two " * 3000]


def test_pieces_encode_as_the_library_does():
    ours, theirs = PieceEncoder(PATH), Tokenizer.from_file(PATH)
    for t in TEXTS:
        assert np.frombuffer(ours.encode([t or ""])[0], "<u4").tolist() == theirs.encode(t or "", add_special_tokens=False).ids, t


def test_every_code_point():
    ours, theirs = PieceEncoder(PATH), Tokenizer.from_file(PATH)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 1 << 15):
        texts = [f"a{chr(c)}b {chr(c)}. {chr(c)}{chr(c)}x" for c in points[at:at + (1 << 15)]]
        want = [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]
        got = [np.frombuffer(b, "<u4").tolist() for b in ours.encode(texts)]
        assert [(t, g, w) for t, g, w in zip(texts, got, want, strict=True) if g != w] == []


def expected(rows):
    theirs, start, out = Tokenizer.from_file(PATH), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*theirs.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_store_round_trip(table):
    rows = [(50 - i, t) for i, t in enumerate(TEXTS)] + [(None, "of no id"), (7, "same"), (7, "same")]
    out = token_store_digest(table(rows, "doc_id long, text string"), PATH)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out.collect()), key=lambda r: r[1]) == expected(rows)


def test_small_blocks_and_shards(spark, table, tmp_dir):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(90)]
    write_token_store(table(rows, "doc_id long, text string").withColumn("ids", F.lit(1)), PATH, tmp_dir + "/s", block_tokens=40, shard_tokens=300)
    manifest = spark.read.parquet(tmp_dir + "/s/manifest")
    assert manifest.count() > 20 and manifest.select("shard").distinct().count() > 2
    got = sorted((r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in read_token_store(spark, tmp_dir + "/s").collect())
    assert got == expected(rows)


def test_long_documents_are_cut_and_joined(spark, table, tmp_dir):
    rows = [(3, "one two three four " * 100_000), (1, "short"), (2, None), (None, "a b c d " * 80_000), (4, "after"), (3, "one two three four " * 100_000), (5, "x y " * 70_000)]
    write_token_store(table(rows, "doc_id long, text string"), PATH, tmp_dir + "/s", block_tokens=300_000, shard_tokens=1 << 20)
    cuts = spark.read.parquet(tmp_dir + "/s/manifest").filter("cut IS NOT NULL")
    assert cuts.count() >= 6 and cuts.filter("n_tokens > 300000").count() == 0
    read = read_token_store(spark, tmp_dir + "/s", part_tokens=1 << 17)
    got = sorted(((r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in read.collect()), key=lambda r: r[1])
    assert got == expected(rows)


def test_parts_begin_at_checkpoints():
    ids = np.random.default_rng(1).zipf(1.3, 400_000) % 50_257
    t = rans.Table.of_counts(np.bincount(ids, minlength=50_257))
    data = rans.encode_block(ids, t)
    mark = rans.LANES * rans.CHECKPOINT_STEPS
    for first, stop in ((0, mark), (mark, 2 * mark), (2 * mark + 5, 400_000), (3 * mark - 1, 3 * mark + 1), (399_999, 400_000)):
        assert (rans.decode_block(data, t, first, stop) == ids[first:stop]).all()


def test_empty_table(table):
    assert token_store_digest(table([], "doc_id long, text string"), PATH).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 90_000])
def test_rans_blocks(n):
    ids = np.random.default_rng(n).zipf(1.3, n) % 50_257
    t = rans.Table.of_counts(np.bincount(ids, minlength=50_257))
    data = rans.encode_block(ids, t)
    assert (rans.decode_block(data, t) == ids).all()
    if n > 80_000:
        assert (rans.decode_block(data, t, 70_000, 70_501) == ids[70_000:70_501]).all()
        counts = np.bincount(ids)
        entropy = -(counts[counts > 0] * np.log2(counts[counts > 0] / n)).sum() / 8
        assert len(data) < 1.2 * entropy + 9000
        with pytest.raises(ValueError):
            rans.decode_block(data[:-1] + bytes([data[-1] ^ 1]), t)


def test_table_of_one_id_and_of_many():
    assert rans.Table.of_counts(np.array([0, 9])).frequencies.tolist() == [0, 1 << rans.SCALE_BITS]
    many = rans.Table.of_counts(np.ones(300_000)).frequencies
    assert many.min() >= 1 and many.sum() == 1 << rans.SCALE_BITS


def test_pieces_encode_as_the_library_does_on_random_texts():
    import random

    encoder = PieceEncoder(PATH)
    parts = [" ", "  ", " ", " ", "a", "abc", "é", "ß", "的", "1", "12", ".", ",", ". ", ", ", "\n", "\t", "'s", "'", "-", "\0", "\x1c", "<|endoftext|>", "²", "_"]
    rnd = random.Random(5)
    texts = ["", " ", "  abc", "a  b"] + ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(5000)]
    want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == want


def test_words_before_marks_are_encoded_once():
    encoder, theirs = PieceEncoder(PATH), Tokenizer.from_file(PATH)
    texts = ["so word word. word, word$$$ word!? it's word's", "é wordé. 1,000; (word) word<|endoftext|>", "x\xa0y  z a　 b", "", "word\nword.\nword"]
    want = [theirs.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == want
    assert " word" in encoder.pieces and not {" word.", " word,", " word$$$", " word!?", " word's", " wordé."} & encoder.pieces.keys()


def test_a_full_cache_keeps_what_was_used(monkeypatch):
    from shopstat.llm import token_output

    monkeypatch.setattr(token_output, "CACHE_PIECES", 3)
    encoder, theirs = PieceEncoder(PATH), Tokenizer.from_file(PATH)
    calls = []
    word = encoder.pieces.word
    encoder.pieces.word = lambda w: calls.append(w) or word(w)
    for i in range(6):
        text = f"common words here {'abcdef'[i]}x"
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids
    assert len(calls) == len(set(calls))
