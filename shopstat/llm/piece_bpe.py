"""SentencePiece (BPE kind) encoding and decoding by backtracking. Aho-Corasick finds the longest
pieces from the left; a piece may follow another only if merging the characters of both gives these
two again. Where the longest piece may not follow, its shorter prefixes are tried, and where none may,
the piece before is given up and its end marked in a bitfield, so that no end is tried twice.

A sequence of pieces is what the merges make of a text if and only if every piece is what they make of
its own characters and every two neighbours are what they make of theirs: the first merge across a
border would touch only the two pieces beside it, and would happen in their text alone as well.
"""
from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only_cache, others, quoted, schema, text_slices, with_columns

#: Words a worker remembers and the bytes they may take; the memory is emptied when either is reached.
CACHE_WORDS, CACHE_BYTES = 400_000, 24 << 20
#: Pairs a worker remembers; emptied when full.
CACHE_PAIRS = 1_500_000
#: Longer words are not remembered.
LONGEST_WORD = 48

SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_LAST = 2**62
_CODERS: dict[str, "PieceBpe"] = {}


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message: numbers and raw values."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at:at + size]
        at += size


class PieceBpe:
    """A model file of the BPE kind with byte fallback, an identity normaliser and a space before the text."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            fields = list(_message(f.read()))
        trainer, normaliser = (dict(_message(next(v for k, v in fields if k == n))) for n in (2, 3))
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        for _, v in (f for f in fields if f[0] == 1):
            own = dict(_message(v))
            self.pieces.append(own[1].decode())
            scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            self.kinds.append(own.get(3, _NORMAL))
        if (trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24) or not set(self.kinds) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or normaliser.get(2)
                or normaliser.get(3, 1) != 1 or normaliser.get(4, 1) != 0 or normaliser.get(5, 1) != 1):
            raise ValueError("this model file is of another kind")
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        unknown = trainer.get(44, " ⁇ ".encode())
        self.bytes = [-1] * 256
        normal = {}
        for i, (p, kind) in enumerate(zip(self.pieces, self.kinds, strict=True)):
            if kind == _BYTE:
                self.bytes[int(p[1:-1], 16)] = i
            elif kind == _NORMAL:
                normal[p] = i
        self.decoded = [p.replace(SPACE, " ").encode() if k == _NORMAL else bytes([int(p[1:-1], 16)]) if k == _BYTE else unknown if k == _UNKNOWN else b""
                        for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.decoded_array = pa.array(self.decoded, pa.binary())
        self.is_byte = np.array([k == _BYTE for k in self.kinds])
        self.is_control = np.array([k == _CONTROL for k in self.kinds])
        self.opens = np.array([k == _NORMAL and p.startswith(SPACE) for p, k in zip(self.pieces, self.kinds, strict=True)])
        #: Pieces by score: a merge into the best-scored piece comes first.
        by_score = {s: r for r, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True))}
        self.rank = {p: by_score[scores[i]] for p, i in normal.items()}
        characters = {c for p in normal for c in p}
        if any(c not in normal for c in characters) or any(SPACE in p.lstrip(SPACE) for p in normal) or -1 in self.bytes:
            raise ValueError("this model file is of another kind")
        self.unknown = re.compile("[^" + "".join(map(re.escape, sorted(characters))) + "]")
        # Where no piece mixes letters with others, no merge crosses between them, and words part there.
        alphabet = "".join(sorted(c for c in characters if c.isalpha()))
        letters, rest = f"[{alphabet}]+", f"[^{SPACE}{alphabet}]+"
        apart = re.compile(f"{SPACE}*(?:{letters}|{rest})?")
        self.atom = re.compile(f"{SPACE}*(?:{letters}|{rest})|{SPACE}+" if all(map(apart.fullmatch, normal)) else "(?s:.+)")
        self.separator = next(chr(c) for c in range(1, 0x110000) if chr(c) not in characters and chr(c) not in " \n")
        # Pieces that the merges never make are never proposed.
        self.ids = {p: i for p, i in normal.items() if len(p) == 1 or self.merged(p) == [p]}
        self.lengths = [len(p) for p in self.pieces]
        self.sizes = np.array(self.lengths)
        self.shorter = [-1] * len(self.pieces)  # of a piece, its longest proper prefix that is one
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, i)
            self.shorter[i] = next((self.ids[p[:j]] for j in range(len(p) - 1, 0, -1) if p[:j] in self.ids), -1)
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.known_bytes = self.words = self.backtracked = 0

    def merged(self, text: str) -> list[str]:
        """The merges applied to the characters of ``text``, best score first, leftmost first."""
        parts, rank = list(text), self.rank.get
        ranks = [rank(a + b, _LAST) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == _LAST:
                break
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], _LAST)
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], _LAST)
        return parts

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the characters of both pieces gives the two again."""
        key = a * len(self.pieces) + b
        found = self.fits.get(key)
        if found is None:
            p, q = self.pieces[a], self.pieces[b]
            if len(self.fits) >= CACHE_PAIRS:
                self.fits.clear()
            found = self.fits[key] = self.merged(p + q) == [p, q]
        return found

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text of known characters."""
        n, sizes, shorter = len(text), self.lengths, self.shorter
        longest = [-1] * n
        for last, i in self.automaton.iter(text):  # in order of their ends: the longest comes last
            longest[last + 1 - sizes[i]] = i
        failed = None  # a bit for each position from which the rest cannot be encoded
        fits, width = self.fits.get, len(self.pieces)
        out: list[int] = []
        at, piece, before = 0, longest[0], 0
        while at < n:
            stop = at + sizes[piece]
            if failed is None or not failed[stop >> 3] >> (stop & 7) & 1:
                good = fits(before + piece) if out else True
                if good is None:
                    good = self.may_follow(out[-1], piece)
                if good:
                    out.append(piece)
                    before = piece * width
                    at = stop
                    if at < n:
                        piece = longest[at]
                    continue
            if shorter[piece] >= 0:
                piece = shorter[piece]
            else:
                if failed is None:
                    failed = bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= sizes[piece]
                if out:
                    before = out[-1] * width
        return out

    def encode_word(self, word: str) -> list[int]:
        """Ids of a text whose spaces are replaced; unknown characters become their bytes."""
        out: list[int] = []
        at = 0
        for m in self.unknown.finditer(word):
            if m.start() > at:
                out += self.backtrack(word[at:m.start()])
            out += [self.bytes[b] for b in m.group().encode()]
            at = m.end()
        if at < len(word):
            out += self.backtrack(word[at:])
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of words (little-endian unsigned 32-bit integers). The longest pieces of all words
        are found in one pass and their neighbours checked at once; a word with an unknown character
        or a pair that may not stand goes the whole way."""
        sizes = np.array([len(w) for w in words])
        first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        matches = np.array(list(self.automaton.iter_long(self.separator.join(words))), dtype=np.int64).reshape(-1, 2)
        last, ids = matches[:, 0], matches[:, 1]
        start = last + 1 - self.sizes[ids]
        word = np.searchsorted(first, start, side="right") - 1
        whole = covered = np.bincount(word, weights=self.sizes[ids], minlength=len(words)) == sizes
        inner = np.flatnonzero(word[1:] == word[:-1])
        keys, place = np.unique(ids[inner] * len(self.pieces) + ids[inner + 1], return_inverse=True)
        fits = np.array([self.may_follow(*divmod(k, len(self.pieces))) for k in keys.tolist()], dtype=bool)
        if len(inner):
            whole = covered.copy()
            whole[word[inner[~fits[place]]]] = False
        bounds = np.searchsorted(word, np.arange(len(words) + 1))
        flat = ids.astype("<u4").tobytes()
        out = []
        for w, good, plain, a, b in zip(words, whole.tolist(), covered.tolist(), (4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist(), strict=True):
            if good:
                out.append(flat[a:b])
            else:
                own = self.backtrack(w) if plain else self.encode_word(w)
                out.append(struct.pack(f"<{len(own)}I", *own))
                self.backtracked += 1
        self.words += len(words)
        return out

    def encode(self, texts: pa.Array) -> pa.Array:
        """Packed ids of each text, begin and end ids included. No piece has a space behind another
        character, so a text may be cut before every space that follows one: no merge crosses there."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if pc.any(pc.match_substring(texts, SPACE)).as_py():
            texts = pc.replace_substring(texts, SPACE, " ")  # both become the same character
        parts = pc.split_pattern(texts, " ")
        words = parts.flatten()
        if pc.any(pc.equal(pc.binary_length(words), 0)).as_py():
            # Runs of spaces, at the ends as well: they open the word after them; empty texts have none.
            own = [re.findall(" +[^ ]*", " " + t) if t else [] for t in texts.to_pylist()]
            parts = pa.array([[w[1:] for w in ws] for ws in own], pa.list_(pa.string()))
            words = parts.flatten()
        coded = words.dictionary_encode()
        distinct = [SPACE + w.replace(" ", SPACE) for w in coded.dictionary.to_pylist()]
        blobs = pa.array(self._ids(distinct), pa.binary())
        rows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy())]), pa.int32()), blobs.take(coded.indices))
        begin, end = (pa.scalar(struct.pack("<I", i), pa.binary()) for i in (self.begin, self.end))
        return pc.binary_join_element_wise(begin, pc.binary_join(rows, b""), end, b"")

    def _ids(self, words: list[str]) -> list[bytes]:
        known, parts = self.known, self.atom.findall
        cuts = [None if w in known else parts(w) for w in words]
        missing = {a for c in cuts if c is not None for a in c if a not in known}
        if self.known_bytes > CACHE_BYTES or len(known) + len(missing) > CACHE_WORDS:
            known.clear()
            self.known_bytes = 0
            cuts = [parts(w) for w in words]
            missing = {a for c in cuts for a in c}
        every = list(missing)
        fresh = dict(zip(every, self.encode_words(every), strict=True)) if every else {}
        long = {a: ids for a, ids in fresh.items() if len(a) > LONGEST_WORD}
        for a in long:
            del fresh[a]
        known.update(fresh)
        self.known_bytes += sum(map(len, fresh)) + sum(map(len, fresh.values()))
        ids_of = (lambda a: known[a] if a in known else long[a]) if long else known.__getitem__
        return [known[w] if c is None else b"".join(map(ids_of, c)) for w, c in zip(words, cuts, strict=True)]

    def decode(self, packed: pa.Array) -> pa.Array:
        """The text of each row of packed ids. The space that stands before a text goes, control
        ids are empty, and bytes that are no UTF-8 become U+FFFD one by one."""
        offsets = np.concatenate([[0], np.cumsum(pc.binary_length(packed).to_numpy() // 4)])
        ids = np.frombuffer(b"".join(packed.to_pylist()), dtype="<u4").astype(np.int64)
        # Whether the first id that is no control id opens with a space.
        shown = np.flatnonzero(~self.is_control[ids])
        at = np.minimum(np.searchsorted(shown, offsets[:-1]), max(len(shown) - 1, 0))
        opening = shown[at] if len(shown) else np.zeros(len(packed), dtype=np.int64)
        strip = np.zeros(len(packed), dtype=bool)
        if len(shown):
            strip = self.opens[ids[opening]] & (opening >= offsets[:-1]) & (opening < offsets[1:])
        rows = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.decoded_array.take(pa.array(ids)))
        joined = pc.binary_join(rows, b"")
        control = np.flatnonzero(self.is_control[ids])
        try:
            if not np.isin(control, np.concatenate([offsets[:-1], offsets[1:] - 1])).all():
                raise pa.ArrowInvalid("a control id may part the bytes of a character")
            text = joined.cast(pa.string())
        except pa.ArrowInvalid:
            text = pa.array([self._decode_slowly(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())
        return pc.if_else(pa.array(strip), pc.utf8_slice_codeunits(text, 1), text)

    def _decode_slowly(self, ids: np.ndarray) -> str:
        out: list[str] = []
        run = b""
        for i in [*ids.tolist(), -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.decoded[i]
                continue
            while run:
                for n in range(1, 5):
                    try:
                        out.append(run[:n].decode())
                        run = run[n:]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    run = run[1:]
            if i >= 0:
                out.append(self.decoded[i].decode())
        return "".join(out)


def coder(path: str) -> PieceBpe:
    """The worker's coder of a model file."""
    only_cache("piece_bpe", _CODERS.clear)
    if path not in _CODERS:
        _CODERS[path] = PieceBpe(path)
    return _CODERS[path]


def encode_decode(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, and ``ids`` (packed little-endian unsigned 32-bit integers, begin and end
    ids included), ``n_tokens`` and ``decoded``, the text that decoding those ids gives. Columns of those
    names are replaced. Null text counts as empty: begin and end ids, empty decoded text. Rows are
    independent of each other, so ties, repeats and null ids need no rule, and an empty table stays empty.
    A long text is cut into slices of rows only, never within: its words are encoded whole."""

    def run(batches):
        bpe = coder(model)
        for batch in batches:
            for part in text_slices(batch, "_text", 4 << 20):
                ids = bpe.encode(part.column("_text"))
                yield with_columns(part, {"_ids": ids, "_decoded": bpe.decode(ids)}, drop=["_text"])

    kept = others(docs, "ids", "n_tokens", "decoded")
    slim = docs.select(F.struct(*[quoted(c) for c in kept]).alias("_row"), quoted(text_col).alias("_text"))
    out = slim.mapInArrow(run, schema(_row=slim.schema["_row"].dataType, _ids="binary", _decoded="string"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in kept], F.col("_ids").alias("ids"),
                      (F.length("_ids") / 4).cast("long").alias("n_tokens"), F.col("_decoded").alias("decoded"))
