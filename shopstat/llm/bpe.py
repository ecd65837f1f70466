"""BPE encoding and decoding by speculation: every word is cut greedily into the longest
vocabulary entries, all adjacent pairs of the proposals are checked at once for whether the
merges could have left that pair standing, and only words with a failing pair are merged exactly.

A sequence of entries is the one the merges give if and only if every entry is what the merges
make of its own characters and every adjacent pair is what they make of the two entries' joined
characters. The pair check undoes merges from the border outwards: as long as no merge across
the border outranks the later of the two that formed the pieces there, the border stands.
"""
from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import CharacterKinds, only_cache, others, quoted, schema, text_slices, with_columns

#: Entries and bytes of a worker's cache of pieces and of its words; each is emptied when full.
CACHE_PIECES, CACHE_BYTES = 300_000, 24 << 20
#: Pairs of entries that a worker remembers.
CACHE_PAIRS = 800_000

_NONE = np.int64(2**62)
_LAST = 2**62
_CONTROL = re.compile("[\x1c-\x1f]")
#: A full stop or comma between a letter or digit and white space is a word of its own.
_STOP = re.compile(r"[.,](?=\s)(?<=[^\W_][.,])")
_SPACE = regex.compile(r"[\t-\r \x85\xa0  -     　]+")
_CODERS: dict[str, "WordBpe"] = {}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the others get code points from 256 on, in order."""
    themselves = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    table, spare = [], 256
    for b in range(256):
        table.append(chr(b) if b in themselves else chr(spare))
        spare += b not in themselves
    return table


class WordBpe:
    """A tokenizer file whose words end in a suffix: NFC, lower case, white space dropped."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = [p for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or len(splits) != 1 or spec["decoder"] is not None:
            raise ValueError("this tokenizer file is of another kind")
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.word = regex.compile(splits[0]["pattern"]["Regex"])
        self.vocab: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.bytes = {i: c for i, c in enumerate(byte_characters())}
        library = Tokenizer.from_file(path)
        self.normalise, self.pre_tokenise = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.kinds = CharacterKinds(self._is_odd)
        self.strings: list[str] = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for s, i in [*self.vocab.items(), *self.special.items()]:
            self.strings[i] = s
        self.strings_array = pa.array(self.strings, pa.string())
        self._merges(model["merges"])
        self.ids_of: dict[str, bytes] = {}  # by piece
        self.bytes_held = 0
        self.ids_of_word: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.words = self.failed = 0

    def _merges(self, merges: list) -> None:
        vocab, width = self.vocab, len(self.strings)
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        left = np.full(width, -1, np.int64)
        right = np.full(width, -1, np.int64)
        formed = np.full(width, _NONE)
        for k, m in enumerate(merges):
            a, b = m if isinstance(m, list) else m.split(" ")
            ia, ib, ic = vocab[a], vocab[b], vocab[a + b]
            self.rank[ia, ib] = k
            self.merged.append(ic)
            if formed[ic] == _NONE:
                left[ic], right[ic], formed[ic] = ia, ib, k
        self.left, self.right, self.formed = left, right, formed
        pairs = np.array([a * width + b for a, b in self.rank], dtype=np.int64)
        ranks = np.array(list(self.rank.values()), dtype=np.int64)
        order = np.argsort(pairs)
        self.width, self.merge_pairs, self.merge_ranks = width, pairs[order], ranks[order]
        # An entry is proposed only if the merges make it of its own characters.
        self.reachable = {s for s, i in vocab.items() if self.exact(self._symbols_of(s)) == [i]}
        # The last character of a word and the suffix are one symbol, for which a private character stands.
        self.last = {c: chr(0xE000 + b) for b, c in self.bytes.items()}
        self.lengths = np.zeros(width, np.int64)
        self.automaton = ahocorasick.Automaton()
        for s in self.reachable:
            symbols = self._symbols_of(s)
            joined = "".join(symbols) if len(symbols[-1]) == 1 else "".join(symbols[:-1]) + self.last.get(symbols[-1][0], "")
            if len(joined) == len(symbols):
                self.automaton.add_word(joined, vocab[s])
                self.lengths[vocab[s]] = len(joined)
        self.automaton.make_automaton()

    def _symbols_of(self, entry: str) -> list[str]:
        suffix = self.suffix
        if suffix and entry.endswith(suffix) and entry != suffix:
            stem = entry[:-len(suffix)]
            return [*stem[:-1], stem[-1] + suffix]
        return list(entry)

    def exact(self, symbols: list[str]) -> list[int]:
        """The merges applied in order of rank, leftmost first."""
        vocab = self.vocab
        ids = [vocab[s] for s in symbols if s in vocab]
        if len(ids) > 200:
            return self._exact_long(ids)
        rank, merged = self.rank.get, self.merged
        ranks = [rank(p, _LAST) for p in zip(ids, ids[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == _LAST:
                break
            i = ranks.index(best)
            ids[i] = merged[best]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), _LAST)
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), _LAST)
        return ids

    def _exact_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for words of many symbols."""
        rank, merged, n = self.rank.get, self.merged, len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(k, i, ids[i], ids[i + 1]) for i in range(n - 1) if (k := rank((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            k, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = merged[k], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] >= 0 and (m := rank((ids[left], ids[after[left]]))) is not None:
                    heapq.heappush(heap, (m, left, ids[left], ids[after[left]]))
        return [x for x in ids if x >= 0]

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.merge_pairs, key), len(self.merge_pairs) - 1)
        return np.where(self.merge_pairs[at] == key, self.merge_ranks[at], _NONE)

    def pairs_stand(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave each pair of entries as two entries, for all pairs at once."""
        a, b = a.copy(), b.copy()
        bound = np.full(len(a), _NONE)
        stands = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y, limit = a[live], b[live], bound[live]
            broken = self._merge_rank(x, y) < limit
            stands[live[broken]] = False
            fx, fy = self.formed[x], self.formed[y]
            fx, fy = np.where(fx == _NONE, -1, fx), np.where(fy == _NONE, -1, fy)
            undo_left = fx > fy
            # Equal ranks are two of the same entry: the left one's merge came first.
            undo_right = ~undo_left & (fy >= 0)
            bound[live] = np.where(undo_left, fx, np.where(undo_right, np.where(fx == fy, fy, fy + 1), limit))
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_right, self.left[y], y)
            live = live[~broken & (undo_left | undo_right)]
        return stands

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids (little-endian unsigned 32-bit integers) of words in byte characters without suffix.
        The longest entries of all words are found in one pass, and their neighbours checked at once."""
        last, suffix, width = self.last, self.suffix, self.width
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        matches = np.array(list(self.automaton.iter_long("\n".join([w[:-1] + last[w[-1]] for w in words]))), dtype=np.int64).reshape(-1, 2)
        ids = matches[:, 1]
        word = np.searchsorted(first, matches[:, 0], side="right") - 1
        whole = np.bincount(word, weights=self.lengths[ids], minlength=len(words)) == sizes
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, place = np.unique(ids[inner] * width + ids[inner + 1], return_inverse=True)
        known = self.pairs
        new = np.array([k for k in pairs.tolist() if k not in known], dtype=np.int64)
        if len(known) + len(new) > CACHE_PAIRS:
            known.clear()
            new = pairs
        known.update(zip(new.tolist(), self.pairs_stand(new // width, new % width).tolist(), strict=True))
        stands = np.array([known[k] for k in pairs.tolist()], dtype=bool)
        if len(inner):
            whole[word[inner[~stands[place]]]] = False
        bounds = 4 * np.searchsorted(word, np.arange(len(words) + 1))
        flat = ids.astype("<u4").tobytes()
        out = []
        for w, good, a, b in zip(words, whole.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if good:
                out.append(flat[a:b])
            else:
                self.failed += 1
                own = self.exact([*w[:-1], w[-1] + suffix])
                out.append(struct.pack(f"<{len(own)}I", *own))
        self.words += len(words)
        return out

    def _normal(self, piece: str) -> str:
        if piece.isascii():
            return piece.lower()
        # Lower case by single characters: no rule that looks at neighbours.
        return "".join([c.lower() for c in unicodedata.normalize("NFC", piece)])

    def _words(self, part: str) -> list[str]:
        """Words in byte characters of a part without white space."""
        return ["".join([self.bytes[b] for b in w.encode()]) if not (w.isascii() and w.isprintable()) else w for w in self.word.findall(self._normal(part))]

    def _library_words(self, part: str) -> list[str]:
        return [w for w, _ in self.pre_tokenise(self.normalise(part))]

    def _is_odd(self, c: str) -> bool:
        """Whether the library takes a character apart otherwise than Python's tables do (they follow
        other versions of Unicode)."""
        probe = f"a{c}b 1{c}. .{c}1, {c}{c} {c}"
        own = [w for p in self._split(probe) for w in self._words(p)]
        return own != self._library_words(probe) or len(_SPACE.sub("", c)) != len("".join(c.split()))

    def _split(self, text: str, odd: re.Pattern | None = None) -> list[str]:
        """Pieces that encode by themselves: parted by white space, which is dropped, and with a full
        stop or comma that stands alone behind a word parted from it. What holds an odd character is
        parted at spaces alone and left to the library."""
        if odd is not None and odd.search(text):
            return [p for part in text.split(" ") if part for p in ([part] if odd.search(part) else self._split(part))]
        if _CONTROL.search(text):
            return list(filter(None, _SPACE.split(text)))
        if "<|" not in text and "Σ" not in text and (text.isascii() or unicodedata.is_normalized("NFC", text)):
            text = text.lower()
        return _STOP.sub(r" \g<0>", text).split()

    def _fill(self, pieces: list[str], odd: re.Pattern | None) -> None:
        """Encode distinct pieces without white space, but for those with odd characters."""
        plan: list[list[str | bytes]] = []  # of a piece: its words, or the packed ids of special ones
        known, new = self.ids_of_word, set()
        if len(known) > CACHE_PIECES:
            known.clear()
        for piece in pieces:
            own: list[str | bytes] = []
            for part in self.special_cut.split(piece) if self.special_cut and "<|" in piece else (piece,):
                if part in self.special:
                    own.append(struct.pack("<I", self.special[part]))
                    continue
                own += self._library_words(part) if odd is not None and odd.search(part) else self._words(part)
            plan.append(own)
            new.update(own)
        every = [w for w in new if isinstance(w, str) and w not in known]
        if every:
            known.update(zip(every, self.encode_words(every), strict=True))
        for piece, own in zip(pieces, plan, strict=True):
            packed = known[own[0]] if len(own) == 1 and isinstance(own[0], str) else b"".join([w if isinstance(w, bytes) else known[w] for w in own])
            self.ids_of[piece] = packed
            self.bytes_held += len(piece) + len(packed)

    def encode(self, texts: list[str]) -> pa.Array:
        """The ids of each text, packed as little-endian unsigned 32-bit integers."""
        odd = self.kinds.odd_in(texts)
        split = [self._split(t, odd) for t in texts]
        coded = pa.array([p for s in split for p in s], pa.string()).dictionary_encode()
        wanted = coded.dictionary.to_pylist()
        missing = [p for p in wanted if p not in self.ids_of]
        if len(self.ids_of) + len(missing) > CACHE_PIECES or self.bytes_held > CACHE_BYTES:
            self.ids_of.clear()
            self.bytes_held = 0
            missing = wanted
        for at in range(0, len(missing), 20_000):
            self._fill(missing[at:at + 20_000], odd)
        blobs = pa.array(list(map(self.ids_of.__getitem__, wanted)), pa.binary())
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in split])])
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), blobs.take(coded.indices)), b"")

    def decode_all(self, packed: pa.Array) -> pa.Array:
        """The text of each row of packed ids: entries joined by a space."""
        ids = np.frombuffer(b"".join(packed.to_pylist()), dtype="<u4").astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(pc.binary_length(packed).to_numpy() // 4)])
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.strings_array.take(pa.array(ids))), " ")

    def decode(self, ids: np.ndarray) -> str:
        """Entries joined by a space, as a file without a decoder asks for; unknown ids vanish."""
        return " ".join([self.strings[i] for i in ids.tolist() if i < len(self.strings) and self.strings[i]])


def coder(path: str) -> WordBpe:
    """The worker's coder of a tokenizer file."""
    only_cache("bpe", _CODERS.clear)
    if path not in _CODERS:
        _CODERS[path] = WordBpe(path)
    return _CODERS[path]


def encode_decode(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, and ``ids`` (packed little-endian unsigned 32-bit integers), ``n_tokens``
    and ``decoded``, the text that decoding the ids gives. Columns of those names are replaced. Null
    text counts as empty: no ids, empty decoded text. Rows are independent of each other, so ties,
    repeats and null ids need no rule, and an empty table stays empty."""

    def run(batches):
        bpe = coder(tokenizer)
        for batch in batches:
            for part in text_slices(batch, "_text", 2 << 20):
                ids = bpe.encode([t or "" for t in part.column("_text").to_pylist()])
                yield with_columns(part, {"_ids": ids, "_decoded": bpe.decode_all(ids)}, drop=["_text"])

    kept = others(docs, "ids", "n_tokens", "decoded")
    slim = docs.select(F.struct(*[quoted(c) for c in kept]).alias("_row"), quoted(text_col).alias("_text"))
    out = slim.mapInArrow(run, schema(_row=slim.schema["_row"].dataType, _ids="binary", _decoded="string"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in kept], F.col("_ids").alias("ids"),
                      (F.length("_ids") / 4).cast("long").alias("n_tokens"), F.col("_decoded").alias("decoded"))
