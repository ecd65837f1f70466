"""Phrase collocations by prefix-free parsing: a text's words (and the breaks between its pieces) are
cut into chunks wherever the hash of three neighbouring tokens says so, and every chunk runs on over
the three tokens that open the next one. Equal passages fall into equal chunks, so phrases of up to
four words are counted in the distinct chunks alone, weighted by how often each occurs. A phrase
belongs to the chunk that owns its first word, so what lies in an overlap is counted once.

Phrases are counted by size: one of s words can be frequent only if both its parts of s - 1 words are.
Sizes below the longest are first counted by a 64-bit hash; the hashes that are frequent set bits of a
filter of fixed size. Whatever passes all filters is then counted exactly, by its words. Hashes and filters only
spare work: a collision lets a rare phrase through to the exact count, which drops it.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, remove, stored, stored_at, text_slices

#: Tokens whose hash decides on a cut, and that chunks share with the next one: the longest phrase less one.
OVERLAP = 3
LONGEST = OVERLAP + 1
#: A cut at one of so many places, by the hash.
MODULUS = 32
#: Bits of the filter of each size (16 MB), whatever the corpus.
FILTER_BITS = 1 << 27
#: Text handled at once.
SLICE_BYTES = 4 << 20
#: Parts of a hot phrase part, and of a language's ranking.
SALTS = 8

#: Upper case to lower, what parts pieces to a full stop, tabs to spaces; only ASCII bytes change.
_TABLE = bytes(ord(".") if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K[1]
    return x ^ (x >> np.uint64(29))


def _hashes(values: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(v) for v in values], dtype=np.uint64)


class Tokens:
    """The words and breaks (full stops) of a batch of texts, as numbers into a dictionary."""

    def __init__(self, texts: pa.Array) -> None:
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten().dictionary_encode()
        self.words = flat.dictionary
        self.codes = flat.indices.to_numpy().astype(np.int64)
        sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        empty = pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0
        if empty.any():  # an empty text splits into one empty word
            keep = ~np.repeat(empty, sizes)
            self.codes, sizes = self.codes[keep], np.where(empty, 0, sizes)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.row = np.repeat(np.arange(len(texts)), sizes)
        self.hashes = _hashes(self.words.cast(pa.binary()).to_pylist())[self.codes]
        dot = pc.index(self.words, ".").as_py()
        self.is_word = self.codes != dot


def _chunks(texts: pa.Array, modulus: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The chunks of texts, the row each comes from, and how many tokens at its end it does not own."""
    t = Tokens(texts)
    n = len(t.codes)
    cut = np.zeros(n + 1, dtype=bool)
    if n >= OVERLAP:
        window = sum((_mix(t.hashes[i:n - OVERLAP + 1 + i] + _K[0]) * _K[i] for i in range(OVERLAP)), np.zeros(n - OVERLAP + 1, np.uint64))
        same = t.row[:n - OVERLAP + 1] == t.row[OVERLAP - 1:]
        cut[:n - OVERLAP + 1] = (_mix(window) % np.uint64(modulus) == 0) & same
    cut[t.offsets[:-1][np.diff(t.offsets) > 0]] = True
    start = np.flatnonzero(cut[:n])
    row = t.row[start]
    stop = np.append(start[1:], n)
    tail = np.where(np.append(row[1:] == row[:-1], False)[:len(start)], OVERLAP, 0)
    size = stop + tail - start
    at = np.concatenate([[0], np.cumsum(size)])
    index = np.repeat(start - at[:-1], size) + np.arange(at[-1])
    lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), t.words.take(pa.array(t.codes[index])))
    return pc.binary_join(lists, " "), row, tail


def chunk_table(docs: DataFrame, text_col: str, lang_col: str, modulus: int) -> DataFrame:
    """lang, chunk, tail (tokens at the end that the next chunk owns) and freq, of the distinct chunks."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                texts = [t.as_py().translate(_TABLE).replace(b".", b" . ").strip() for t in part.column("text").cast(pa.binary())]
                chunk, row, tail = _chunks(pa.array(texts, pa.binary()).view(pa.string()), modulus)
                yield pa.RecordBatch.from_arrays([part.column("lang").take(pa.array(row)), chunk, pa.array(tail, pa.int32())], names=["lang", "chunk", "tail"])

    slim = docs.select(F.coalesce(quoted(lang_col), F.lit("und")).alias("lang"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    parsed = slim.filter("text <> ''").mapInArrow(run, "lang string, chunk string, tail int")
    return parsed.groupBy("lang", "chunk", "tail").agg(F.count("*").alias("freq"))


def _gathered(batches) -> Iterator[pa.RecordBatch]:
    """Batches put together up to the slice size."""
    held, size = [], 0
    for batch in batches:
        for part in text_slices(batch, "chunk", SLICE_BYTES):
            held.append(part)
            size += part.column("chunk").nbytes
            if size >= SLICE_BYTES:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class Phrases:
    """The phrases that a batch of chunks owns, by their first token."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.tokens = t = Tokens(batch.column("chunk"))
        coded = batch.column("lang").dictionary_encode()
        self.langs, lang = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.lang = lang[t.row]
        self.weight = batch.column("freq").to_numpy().astype(np.int64)[t.row]
        stops = t.offsets[1:]
        self.owned = np.arange(len(t.codes)) < (stops - batch.column("tail").to_numpy())[t.row]
        self.hash = [_mix(t.hashes ^ _hashes(self.langs.cast(pa.binary()).to_pylist())[self.lang])]
        self.live = [t.is_word]  # of each size: whether the phrase that begins here may be frequent

    def keep(self, bits: np.ndarray) -> None:
        """Let the longest phrases so far live only where the filter has their hash."""
        h = (self.hash[-1] & np.uint64(8 * len(bits) - 1)).astype(np.int64)
        self.live[-1] = self.live[-1] & (bits[h >> 3] >> (h & 7).astype(np.uint8) & 1).astype(bool)

    def extend(self) -> None:
        """Phrases of one more word, both of whose parts live."""
        size, t = len(self.live), self.tokens
        live = np.zeros(len(t.codes), dtype=bool)
        hashes = np.zeros(len(t.codes), dtype=np.uint64)
        if len(live) > size:
            live[:-size] = self.live[-1][:-size] & (t.row[:-size] == t.row[size:])
            live[:-1] &= self.live[-1][1:]
            hashes[:-size] = _mix(self.hash[-1][:-size] * _K[2] + t.hashes[size:])
        self.live.append(live)
        self.hash.append(hashes)

    def hashed(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the longest phrases owned and how often they occur."""
        at = np.flatnonzero(self.live[-1] & self.owned)
        return _summed(self.hash[-1][at], self.weight[at])

    def counted(self, size: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """The owned phrases of ``size`` words that live: language, words and occurrences, exactly."""
        at = np.flatnonzero(self.live[size - 1] & self.owned)
        codes, words = self.tokens.codes, self.tokens.words
        if size == 1 and int(self.weight.max(initial=0)) * len(at) < 2**53:  # floating-point sums are then exact
            key = self.lang[at] * len(words) + codes[at]
            total = np.bincount(key, weights=self.weight[at].astype(np.float64), minlength=len(self.langs) * len(words)).astype(np.int64)
            found = np.flatnonzero(total)
            return self.langs.take(pa.array(found // len(words))), words.take(pa.array(found % len(words))), total[found]
        # Numbers of the phrases so far; both factors are below the tokens of a slice, so none overflows.
        _, own = np.unique(self.lang[at], return_inverse=True)
        for i in range(size):
            _, own = np.unique(own * np.int64(len(words)) + codes[at + i], return_inverse=True)
        _, first = np.unique(own, return_index=True)
        _, total = _summed(own, self.weight[at])
        place = at[first]
        parts = [words.take(pa.array(codes[place + i])) for i in range(size)]
        return self.langs.take(pa.array(self.lang[place])), parts[0] if size == 1 else pc.binary_join_element_wise(*parts, " "), total


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys[first], np.add.reduceat(weights[order], first) if len(first) else np.zeros(0, np.int64)


def _word_counts(chunks: DataFrame) -> DataFrame:
    """lang, phrase, f of all words; the phrase without words holds the language's count of words."""

    def run(batches):
        for batch in _gathered(batches):
            p = Phrases(batch)
            lang, phrase, f = p.counted(1)
            at = np.flatnonzero(p.owned & p.live[0])
            which, total = _summed(p.lang[at], p.weight[at])
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([lang, p.langs.take(pa.array(which))]), pa.concat_arrays([phrase, pa.array([""] * len(which), pa.string())]),
                                              pa.array(np.concatenate([f, total]))], names=["lang", "phrase", "f"])

    return chunks.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _filter_of(hashes: DataFrame, bits: int) -> Broadcast:
    """A bit for each value of the column ``h``: an array of fixed size, whatever there is."""
    at = F.col("h").bitwiseAND(F.lit(bits - 1))
    words = hashes.select(F.shiftright(at, 6).alias("w"), at.bitwiseAND(F.lit(63)).cast("int").alias("b"))
    got = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("x")).toArrow()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[got.column("w").to_numpy()] = got.column("x").to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(out.astype("<i8").view(np.uint8))


def _word_hashes(words: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            lang, word = (_hashes(batch.column(c).cast(pa.binary()).to_pylist()) for c in ("lang", "phrase"))
            yield pa.RecordBatch.from_arrays([pa.array(_mix(lang ^ word).view(np.int64))], names=["h"])

    return words.select("lang", "phrase").mapInArrow(run, "h long")


def _hash_counts(chunks: DataFrame, size: int, filters: list[Broadcast]) -> DataFrame:
    def run(batches):
        for batch in _gathered(batches):
            p = Phrases(batch)
            for bits in filters[:size - 1]:
                p.keep(bits.value)
                p.extend()
            h, f = p.hashed()
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(f)], names=["h", "f"])

    return chunks.mapInArrow(run, "h long, f long").groupBy("h").agg(F.sum("f").alias("f"))


def _phrase_counts(chunks: DataFrame, filters: list[Broadcast]) -> DataFrame:
    def run(batches):
        for batch in _gathered(batches):
            p = Phrases(batch)
            for size in range(2, LONGEST + 1):
                p.keep(filters[size - 2].value)
                p.extend()
                if size < LONGEST:
                    p.keep(filters[size - 1].value)
                lang, phrase, f = p.counted(size)
                yield pa.RecordBatch.from_arrays([lang, phrase, pa.array(f)], names=["lang", "phrase", "f"])

    return chunks.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(chunks: DataFrame, least: int, filter_bits: int = FILTER_BITS) -> DataFrame:
    """lang, phrase, f and size of all phrases of up to four words that occur ``least`` times or more; of
    size 0, with an empty phrase, the count of all words of each language."""
    words = stored(_word_counts(chunks).filter((F.col("f") >= least) | (F.col("phrase") == "")), "words")
    filters = [_filter_of(_word_hashes(words), filter_bits)]
    for size in range(2, LONGEST):  # the longest are few by then and counted by their words at once
        filters.append(_filter_of(_hash_counts(chunks, size, filters).filter(F.col("f") >= least), filter_bits))
    both = words.unionByName(_phrase_counts(chunks, filters).filter(F.col("f") >= least))
    size = F.when(F.col("phrase") == "", 0).otherwise(F.length("phrase") - F.length(F.translate("phrase", " ", "")) + 1)
    return both.withColumn("size", size.cast("int"))


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r and score of the candidates that no longer one holds."""
    w = F.split("phrase", " ", -1)
    part = lambda start, size: F.array_join(F.slice(w, start, size), " ")
    candidates = phrases.filter("size >= 2").withColumnRenamed("f", "a")
    held = (phrases.filter("size >= 3").select("lang", "size", "phrase", "f", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("s"))
            .select("lang", "size", "phrase", "f", "s", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("s") + 1)).alias("i"))
            .select("lang", part(F.col("i"), F.col("s")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    free = candidates.join(held, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (exact("longer") * 100 < exact("a") * 80)).drop("longer")
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    cuts = free.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    sides = cuts.select("lang", "phrase", "a", "k", salt.alias("salt"), F.explode(F.array(
        F.struct(F.lit(True).alias("first"), part(F.lit(1), F.col("k")).alias("part")),
        F.struct(F.lit(False).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("part")))).alias("side"))
    parts = phrases.filter((F.col("size") >= 1) & (F.col("size") < LONGEST)).select(
        F.col("lang"), F.col("phrase").alias("part"), "f", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    sides = sides.select("lang", "phrase", "a", "k", "salt", "side.first", "side.part").join(parts, ["lang", "part", "salt"])
    both = sides.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r"))
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").cast("long")
    best = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, modulus: int = MODULUS, filter_bits: int = FILTER_BITS,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n and score.

    Texts (A-Z lower-cased) are parted at ``.,;:!?`` and line ends into pieces, these at spaces and tabs
    into words. Candidates are phrases of 2 to 4 words of a piece that occur ``least`` times or more in
    their language (overlapping occurrences count); their score is the lowest over all cuts in two of
    floor(2,000,000 * a / (l + r)), ties to the earlier cut. A candidate inside a longer one that
    occurs at least 0.8 times as often goes. Order: score and a descending, phrase ascending by bytes.

    Null and empty texts hold no words, a null language counts as ``und``; repeated rows and ids
    count as often as they come; other columns are not read. A language without candidates has no
    rows, an empty table none at all. A text is held by one task, whatever its length.
    """
    spark = docs.sparkSession
    chunks, chunk_path = stored_at(chunk_table(docs, text_col, lang_col, modulus), "chunks")
    phrases, phrase_path = stored_at(frequent_phrases(chunks, least, filter_bits), "phrases")
    remove(spark, chunk_path)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = scored(phrases).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    # First within parts of a language, so that the last ranking sees a bounded number of rows.
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    n = phrases.filter("size = 0").select("lang", F.col("f").alias("n"))
    out = stored(found.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "collocations")
    remove(spark, phrase_path)
    return out
