"""Token-id output: whole texts as ids, stored in rANS blocks and read back in parallel.

``write_token_store`` encodes every text once into a thin table of packed ids, counts all ids
for the shared frequency table (one row per id of the vocabulary reaches the driver), range-sorts
the packed ids by document and lets each range write one shard file of independent blocks.
Files get their names by a rename when whole; the manifest table, one row per block, is written
last and names what belongs to the store. ``read_token_store`` deals the blocks of the manifest
over tasks, each of which reads its byte range and checks both checksums.

Null text counts as empty; an empty document holds the end id alone. Rows with a null id come
first in the order, equal ids are ordered by their ids' hash. An empty table gives a store
without shards. Extra columns of the input take no part.
"""
from __future__ import annotations

import json
import math
import string
import struct
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import rans
from .bpe import byte_characters
from .common import CharacterKinds, CommittedFile, only_cache, open_store, remove, stored_at, text_slices
from shopstat.session import scratch_path

#: Ids of a block and of a shard, roughly: both are closed at the end of a document, but that a
#: document longer than a block is cut.
BLOCK_TOKENS = 1 << 19
SHARD_TOKENS = 1 << 23
#: Ids of a part in which a long document's blocks are decoded.
PART_TOKENS = 1 << 18
#: Entries of each of the two generations of a worker's piece cache.
CACHE_PIECES = 325_000

_ENCODERS: dict[str, "PieceEncoder"] = {}
#: Kinds of bytes, as bits: white space that texts are cut at, a byte of which the whole text is looked at closer,
#: a letter or digit, a mark that may follow one.
_BREAK, _ODD, _WORDLY, _MARK = 1, 2, 4, 8
#: Of the characters up to the last white space: white space; letters.
_KNOWN = 0x3001
_SPACES = np.array([chr(c).isspace() for c in range(_KNOWN)])
_LETTERS = np.array([chr(c).isalpha() for c in range(_KNOWN)])
_WORDS = regex.compile(public_tokenizers.PATTERN)
#: The character of each byte in a byte-level vocabulary, for str.translate().
_BYTES = dict(enumerate(byte_characters()))
_SPACE = _BYTES[ord(" ")]


class PieceEncoder:
    """A byte-level tokenizer by pieces. Between two characters that are not white space, the
    place before a single space always parts two words of the tokenizer, and so do those around a
    single new line and between a letter or digit and a punctuation mark (but for those of special tokens).
    Pieces cut there encode by themselves: each distinct one once, the others by a look-up of packed ids."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces = Pieces(self.tokenizer)
        marks = set(string.punctuation) - set("".join(self.pieces.special)) if self.pieces.plain else ()
        self.kinds = bytes(_BREAK if c in " \n" else _ODD if c.isspace() or c == "\0" else _WORDLY if c.isalnum() else _MARK if c in marks else 0
                           for c in map(chr, range(128))) + bytes(128)

    @staticmethod
    def split(text: str) -> list[str]:
        """Pieces; all but the first begin with the space before them."""
        parts = text.split(" ")
        pieces, open_piece = [], parts[0]
        for left, right in zip(parts, parts[1:], strict=False):
            if left and right and not left[-1].isspace() and not right[0].isspace():
                pieces.append(open_piece)
                open_piece = " " + right
            else:
                open_piece += " " + right
        return [*pieces, open_piece]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers."""
        return self.encode_column(pa.array(texts, pa.string())).to_pylist()

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """As ``encode``; nulls count as empty."""
        self.pieces.age()
        texts = pc.fill_null(texts, "").cast(pa.string())
        ends, data = (np.frombuffer(b or b"", t) for b, t in zip(texts.buffers()[1:], ("<i4", "u1"), strict=True))
        ends = ends[texts.offset:texts.offset + len(texts) + 1]
        data, ends = data[ends[0]:ends[-1]], ends - ends[0]
        begin, closer, strange = self._marks(data, ends)
        row_of = lambda x: set((np.searchsorted(ends, np.flatnonzero(x), "right") - 1).tolist())
        strange = row_of(strange)
        closer = row_of(closer) | strange
        if not closer:
            return self._joined(data, ends, begin)
        plain = [i for i in range(len(texts)) if i not in closer]
        encoded = iter(self.encode_column(texts.take(pa.array(plain, pa.int64()))).to_pylist() if plain else ())
        rows = ((i, texts[i].as_py() if i in closer else None) for i in range(len(texts)))
        return pa.array([next(encoded) if t is None else self.pieces.library(t) if i in strange else b"".join(map(self.pieces.__getitem__, self.split(t)))
                         for i, t in rows], pa.binary())

    def _marks(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each byte of texts end to end in UTF-8: whether a piece begins there, whether ``split`` must look
        closer at its text, and whether the library must encode it."""
        kinds = np.frombuffer(data.tobytes().translate(self.kinds), "u1")
        begin, closer, wordly = (kinds & k != 0 for k in (_BREAK, _ODD, _WORDLY))
        opens, closes, strange = begin, begin, np.zeros(len(data), dtype=bool)
        at, sizes, points = characters(data)
        if len(at):
            strange[at[self.pieces.odd(points)]] = True
            known = points < _KNOWN
            first, last, own = at[known], (at + sizes - 1)[known], points[known]
            wordly[last] = _LETTERS[own]
            if _SPACES[own].any():
                opens, closes = begin.copy(), begin.copy()
                opens[first], closes[last] = _SPACES[own], _SPACES[own]
        pair = closes[:-1] & opens[1:]  # white space after white space, but of the text before
        starts = ends[:-1][ends[:-1] < len(data)]
        pair[starts[starts > 0] - 1] = False
        closer[1:] |= pair
        begin[1:] |= (data[:-1] == 10) | (wordly[:-1] & (kinds[1:] & _MARK != 0))
        begin[starts] = True
        return begin, closer, strange

    def _joined(self, data: np.ndarray, ends: np.ndarray, begin: np.ndarray) -> pa.Array:
        """Ids of texts end to end: their pieces are numbered together, each distinct one is looked up
        once, and the ids of all are gathered by number."""
        starts = np.flatnonzero(begin)
        bounds = np.append(starts, len(data)).astype("<i4")
        pieces = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        # Pieces hold no zero character: such texts are looked at closer.
        one = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary), "\0")[0].as_py()
        packed = pa.array(self.pieces.all_of(one.split("\0") if one else []), pa.binary())
        offsets = pa.array(np.searchsorted(starts, ends), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(offsets, packed.take(coded.indices)), b"")


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the characters beyond ASCII in UTF-8: where they begin, their sizes and code points."""
    at = np.flatnonzero(data >= 0xC0)
    lead = data[at].astype(np.int32)
    sizes = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    points = lead & (0x7F >> sizes)
    for k in (1, 2, 3):
        more = sizes > k
        points[more] = points[more] << 6 | (data[at[more] + k] & 0x3F)
    return at, sizes, points


class Pieces(dict):
    """Packed ids by piece; a piece that is not there yet is encoded by the library. When full, it
    keeps what was used since it was last full."""

    def __init__(self, tokenizer) -> None:
        self.old: dict[str, bytes] = {}
        self.whole, self.word = tokenizer.encode, tokenizer.model.tokenize
        steps = json.loads(tokenizer.to_str())
        #: Whether words go to the merges by their bytes and nothing else happens before.
        self.plain = steps["normalizer"] is None and steps["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.pre_tokenise = tokenizer.pre_tokenizer.pre_tokenize_str
        self.kinds = CharacterKinds(self._is_odd)
        self.special = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())

    def _is_odd(self, c: str) -> bool:
        """Whether the library takes a character for another kind than Python's tables do (they follow
        other versions of Unicode)."""
        probe = f"a{c}b 1{c}2 {c}{c}. .{c}"
        own = [w.encode().decode("latin-1").translate(_BYTES) for w in _WORDS.findall(probe)]
        alike = own == [w for w, _ in self.pre_tokenise(probe)] and c.isalpha() == (len(_WORDS.findall(f"a{c}b")) == 1)
        return not alike or c.isspace() != bool(regex.match(r"\s", c))

    def odd(self, points: np.ndarray) -> np.ndarray:
        return self.kinds.odd(points) if self.plain else np.zeros(len(points), dtype=bool)

    def age(self) -> None:
        if len(self) > CACHE_PIECES:
            self.old = dict(self)
            self.clear()

    def all_of(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of distinct pieces that are not empty."""
        found, old, word, plain = list(map(self.get, pieces)), self.old.get, self.word, self.plain
        for i in [i for i, x in enumerate(found) if x is None]:
            piece = pieces[i]
            packed = old(piece)
            if packed is None:
                spaced = piece[0] == " "
                if plain and (piece[1:] if spaced else piece).isalpha():  # one word
                    text = (_SPACE + piece[1:] if spaced else piece) if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTES)
                    packed = array("I", [t.id for t in word(text)]).tobytes()
                else:
                    packed = self.several(piece)
            found[i] = self[piece] = packed
        return found

    def library(self, text: str) -> bytes:
        return array("I", self.whole(text, add_special_tokens=False).ids).tobytes()

    def several(self, piece: str) -> bytes:
        """Packed ids of a piece that may be of several words."""
        if not self.plain or any(s in piece for s in self.special):
            return self.library(piece)
        return array("I", [t.id for w in _WORDS.findall(piece) for t in self.word(w.encode().decode("latin-1").translate(_BYTES))]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        return self.all_of([piece])[0] if piece else b""


def _encoder(path: str) -> PieceEncoder:
    only_cache("token_output", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encode_texts(docs: DataFrame, tokenizer: str, end_id: int | None = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the ids packed as little-endian unsigned integers of 16 bits, or of 32
    where an id needs them (``wide``)."""

    def run(batches):
        encoder = _encoder(tokenizer)
        end = pa.scalar(b"" if end_id is None else struct.pack("<I", end_id), pa.binary())
        for batch in batches:
            for part in text_slices(batch, "text", 6 << 20):
                packed = pc.binary_join_element_wise(encoder.encode_column(part.column("text")), end, b"")
                n = pc.binary_length(packed).to_numpy() // 4
                ids = np.frombuffer(b"".join(packed.to_pylist()), "<u4")
                at = np.concatenate([[0], np.cumsum(n)])
                if len(ids) and ids.max() > 0xFFFF:
                    rows = [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                    wide = [bool(len(x)) and int(x.max()) > 0xFFFF for x in rows]
                    out = pa.array([x.tobytes() if w else x.astype("<u2").tobytes() for x, w in zip(rows, wide, strict=True)], pa.binary())
                else:
                    wide = [False] * len(n)
                    out = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((2 * at).astype("<i4")), pa.py_buffer(ids.astype("<u2"))])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(wide, pa.bool_()), out],
                                                 names=["doc_id", "n_tokens", "wide", "ids"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_tokens long, wide boolean, ids binary")


def _unpack(wide: bool, ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4" if wide else "<u2").astype(np.uint32)


def count_ids(encoded: DataFrame) -> DataFrame:
    """id, n: how often each id occurs."""

    def run(batches):
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for part in text_slices(batch, "ids", 2 << 20):
                wide, ids = part.column("wide").to_pylist(), part.column("ids").to_pylist()
                for kind in (False, True):
                    got = np.bincount(_unpack(kind, b"".join(x for x, w in zip(ids, wide, strict=True) if w == kind)), minlength=len(counts))
                    got[:len(counts)] += counts
                    counts = got
        used = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["id", "n"])

    return encoded.select("wide", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


_MANIFEST = "shard int, block int, path string, at long, bytes long, n_docs long, n_tokens long, crc32 long, cut long"


def write_token_store(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, vocabulary: int = 1 << 16,
                      block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the store into ``folder`` (shared by all executors)."""
    spark = docs.sparkSession
    encoded, at = stored_at(encode_texts(docs, tokenizer, end_id, id_col, text_col), "token-ids")
    counts = np.zeros(vocabulary, dtype=np.int64)
    for row in count_ids(encoded).collect():  # at most a row per id of the vocabulary
        counts[row.id] = row.n
    frequencies = rans.Table.of_counts(counts).frequencies
    spark.createDataFrame([(frequencies.astype("<u4").tobytes(), zlib.crc32(frequencies.astype("<u4").tobytes()))],
                          "frequencies binary, crc32 long").coalesce(1).write.parquet(f"{folder}/table")
    table_box = spark.sparkContext.broadcast(frequencies)
    shards = max(1, math.ceil(int(counts.sum()) / shard_tokens))

    def write(batches):
        task, table = TaskContext.get(), None
        shard = task.partitionId()
        name, out = f"shard-{shard:06d}.rans", None
        ids: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        rows: list[tuple] = []

        def close_block(cut=None):
            lengths = np.array([len(x) for x in ids], dtype="<u8")
            known = np.array([x is not None for x in doc_ids], dtype="u1")
            index = struct.pack("<I", len(ids)) + known.tobytes() + np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes() + lengths.tobytes()
            data = index + rans.encode_block(np.concatenate(ids), table)
            rows.append((shard, len(rows), f"{folder}/{name}", out.size, len(data), len(ids), int(lengths.sum()), zlib.crc32(data), cut))
            out.write(data)
            ids.clear()
            doc_ids.clear()

        held = 0
        for batch in batches:
            if out is None and batch.num_rows:
                table, out = rans.Table(table_box.value), CommittedFile(folder, name, task.taskAttemptId())
            for doc_id, wide, blob in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "wide", "ids")), strict=True):
                own = _unpack(wide, blob)
                if len(own) > block_tokens:  # a long document: blocks of its own, each with its place in it
                    if ids:
                        close_block()
                        held = 0
                    for at in range(0, len(own), block_tokens):
                        ids.append(own[at:at + block_tokens])
                        doc_ids.append(doc_id)
                        close_block(at)
                    continue
                ids.append(own)
                doc_ids.append(doc_id)
                held += len(own)
                if held >= block_tokens:
                    close_block()
                    held = 0
        if ids:
            close_block()
        if out is not None:
            out.commit()
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["shard", "block", "path", "at", "bytes", "n_docs", "n_tokens", "crc32", "cut"])

    ordered = (encoded.repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("ids")))
    ordered.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/manifest")
    remove(spark, at)


def _block(path: str, at: int, size: int, crc: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Of a stored block: which documents have an id, the ids, their numbers of token ids, the coded part."""
    store, local = open_store(path)
    with store.open_input_file(local) as f:
        data = f.read_at(size, at)
    if zlib.crc32(data) != crc:
        raise ValueError(f"{path}: the block at {at} is damaged")
    n = struct.unpack_from("<I", data)[0]
    known, doc_ids = np.frombuffer(data, "u1", n, 4), np.frombuffer(data, "<i8", n, 4 + n)
    return known, doc_ids, np.frombuffer(data, "<u8", n, 4 + 9 * n).astype(np.int64), data[4 + 17 * n:]


def read_token_store(spark: SparkSession, folder: str, part_tokens: int = PART_TOKENS) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (unsigned 32-bit little-endian)."""
    blocks = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("in_shard"))
    before = shards.select("shard", (F.sum("in_shard").over(Window.orderBy("shard")) - F.col("in_shard")).alias("base"))
    in_shard = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_tokens")
    placed = blocks.withColumn("start", in_shard).join(before, "shard").select(
        "path", "at", "bytes", "crc32", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "cut")
    frequencies = np.frombuffer(spark.read.parquet(f"{folder}/table").first().frequencies, "<u4")
    table_box = spark.sparkContext.broadcast(frequencies)

    def read(batches):
        table = rans.Table(table_box.value)
        for batch in batches:
            for path, at, size, crc, start in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "bytes", "crc32", "start")), strict=True):
                known, doc_ids, lengths, coded = _block(path, at, size, crc)
                ids = rans.decode_block(coded, table).astype("<u4")
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64(), mask=known == 0), pa.array(start + ends - lengths, pa.int64()),
                    pa.array([ids[e - k:e].tobytes() for e, k in zip(ends, lengths, strict=True)], pa.binary())],
                    names=["doc_id", "start", "ids"])

    def read_part(batches):
        table = rans.Table(table_box.value)
        for batch in batches:
            for path, at, size, crc, start, cut, first in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "bytes", "crc32", "start", "cut", "first")), strict=True):
                known, doc_ids, _, coded = _block(path, at, size, crc)
                ids = rans.decode_block(coded, table, first, first + part_tokens).astype("<u4")
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64(), mask=known == 0), pa.array([start - cut], pa.int64()),
                                                  pa.array([cut + first], pa.int64()), pa.array([ids.tobytes()], pa.binary())], names=["doc_id", "start", "place", "ids"])

    def join(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("place")
        return pa.table({"doc_id": parts.column("doc_id")[:1], "start": parts.column("start")[:1], "ids": pa.array([b"".join(parts.column("ids").to_pylist())], pa.binary())})

    many = max(1, spark.sparkContext.defaultParallelism * 4)
    result = "doc_id long, start long, ids binary"
    whole = placed.filter("cut IS NULL").repartition(many).mapInArrow(read, result)
    parts = placed.filter("cut IS NOT NULL").withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.lit(part_tokens).cast("long"))))
    # A document's parts meet by its start, which no other document shares: one row of the result.
    long_ones = parts.repartition(many).mapInArrow(read_part, "doc_id long, start long, place long, ids binary").groupBy("start").applyInArrow(join, result)
    return whole.unionByName(long_ones)


def token_store_digest(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write a store, read it back: doc_id, start, n_tokens, ids_crc32 and the ids."""
    folder = folder or scratch_path(docs.sparkSession, "token-store")
    write_token_store(docs, tokenizer, folder)
    return read_token_store(docs.sparkSession, folder).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
