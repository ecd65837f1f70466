"""Benchmark decontamination by template canonicalisation.

Texts become sequences of template tokens: numbers, units behind a number and capitalised words
within a sentence turn into typed placeholders, everything else is the case-folded word without
outer punctuation. Windows of ``window`` tokens of all documents meet the benchmark's windows by a
hash join (items shorter than a window form one window of their own length), once as templates and
once as case-folded literal words, so that a change of case hides nothing. Windows on the same diagonal (document position minus
item position) form one candidate passage. Its literal windows count as they are; the slots of its
template windows are checked: every filler of the item must be replaced by one filler throughout, and
different names by different ones (two numbers may become the same). A window that changes a filler for
which this does not hold is no evidence; the rest of the diagonal is. So a question with other numbers
and names is caught, and a text that only has the same shape is not.

A bitmap of the benchmark's window hashes, of a fixed number of bits, spares the join windows that
cannot match; what it lets through by chance the join removes. Nothing else is broadcast.

A passage counts when its windows cover ``min_words`` tokens, or a share of ``min_share`` of an item.
Template windows of which more than half are placeholders, or of fewer than ``shortest`` tokens, cannot
be told from chance and are no evidence; literal windows are, whatever they hold, down to items of one
word. Defined cases: null and empty texts and items match nothing; rows sharing an id are one document;
null ids are reported as null; an empty table or benchmark gives no rows.
"""
from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only_cache, others, quoted, stored, text_slices

WINDOW = 8
MIN_WORDS = 13
MIN_SHARE = 0.8
SHORTEST = 6
BITMAP_BITS = 25
CACHE_WORDS = 400_000

# Units and number words that become placeholders.
UNITS = frozenset("""mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t oz lb lbs pound pounds ton tons ml cl l
liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months
year years usd eur gbp dollar dollars euro euros cent cents percent % $ € £ ° c f k w kw v hz khz mhz ghz b kb mb gb tb mph kmh""".split())
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen
eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split())

_NUMBER = re.compile(r"[+-]?\d+(?:[.,:/]\d+)*")
_GLUED = re.compile(r"([$€£]?)([+-]?\d+(?:[.,:/]\d+)*)([^\W\d_]+|[%°])?", re.U)
_ENDS = re.compile(r"[.!?:]['\")\]]*$")
_EDGES = re.compile(r"^[^\w$€£%°+-]+|[^\w$€£%°]+$")
_U = np.uint64
_NAME, _NUM, _UNIT = (_U(xxhash.xxh3_64_intdigest(f"<{k}>")) for k in ("name", "number", "unit"))
#: A worker's pieces by number, and their hash, kind and whether a sentence ends there, by that number.
_PIECES: dict[str, int] = {}
_HASH, _KIND, _END = np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, bool)
_LITERAL, _MAYBE_NAME, _IS_NUMBER, _MAYBE_UNIT, _EMPTY, _SYMBOL = range(6)


def _piece(raw: str) -> tuple[int, int, int]:
    """(hash, kind, whether a sentence ends here) of a piece between white space."""
    plain = raw if raw.isalpha() else raw[:-1] if raw[-1] in ".," and raw[:-1].isalpha() else None
    if plain is not None:  # letters alone, or with a full stop or comma behind them
        low = plain.lower()
        kind = (_IS_NUMBER if low in NUMBER_WORDS else _MAYBE_UNIT if low in UNITS
                else _MAYBE_NAME if plain[0].isupper() and plain[1:].islower() else _LITERAL)
        return xxhash.xxh3_64_intdigest(plain.casefold()), kind, int(raw[-1] == ".")
    word = _EDGES.sub("", raw)
    ends = 1 if _ENDS.search(raw) else 0
    if not any(c.isalnum() for c in word):
        return (xxhash.xxh3_64_intdigest(word), _SYMBOL, ends) if word in UNITS else (0, _EMPTY, ends)
    low = word.lower()
    m = _GLUED.fullmatch(word)
    if low in NUMBER_WORDS or _NUMBER.fullmatch(word) or (m and (not m[3] or m[3].lower() in UNITS)):
        kind = _IS_NUMBER
    elif low in UNITS:
        kind = _MAYBE_UNIT
    elif word[0].isupper() and word[1:].islower() and word.isalpha():
        kind = _MAYBE_NAME
    else:
        kind = _LITERAL
    return xxhash.xxh3_64_intdigest(word.casefold()), kind, ends


def _learn(pieces: list[str]) -> None:
    global _HASH, _KIND, _END
    known = len(_PIECES)
    h, kind, ends = zip(*map(_piece, pieces), strict=True)
    _PIECES.update(zip(pieces, range(known, known + len(pieces)), strict=True))
    if known + len(pieces) > len(_HASH):
        room = 2 * (known + len(pieces))
        _HASH, _KIND, _END = (np.concatenate([x[:known], np.zeros(room - known, x.dtype)]) for x in (_HASH, _KIND, _END))
    _HASH[known:known + len(pieces)] = np.array(h, np.uint64)
    _KIND[known:known + len(pieces)] = kind
    _END[known:known + len(pieces)] = ends


def template(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Token hashes with placeholders, those of the words themselves, whether each is a placeholder
    (1 name, 2 number, 3 unit, else 0), and the pieces."""
    only_cache("decontaminate", _PIECES.clear)
    pieces = (text or "").split()
    if len(_PIECES) > CACHE_WORDS:
        _PIECES.clear()
    if not pieces:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int8), []
    new = set(pieces).difference(_PIECES)
    if new:
        _learn(list(new))
    at = np.fromiter(map(_PIECES.__getitem__, pieces), np.int64, len(pieces))
    word, kind, ends = _HASH[at], _KIND[at], _END[at]
    first = np.concatenate([[True], ends[:-1]])
    after_number = np.concatenate([[False], kind[:-1] == _IS_NUMBER])
    unit = ((kind == _MAYBE_UNIT) | (kind == _SYMBOL)) & after_number
    slot = np.where((kind == _MAYBE_NAME) & ~first, 1, np.where(kind == _IS_NUMBER, 2, np.where(unit, 3, 0))).astype(np.int8)
    keep = (kind != _EMPTY) & ~((kind == _SYMBOL) & ~after_number)
    h = np.where(slot == 1, _NAME, np.where(slot == 2, _NUM, np.where(slot == 3, _UNIT, word)))
    if keep.all():
        return h, word, slot, pieces
    at = np.nonzero(keep)[0]
    return h[at], word[at], slot[at], [pieces[i] for i in at.tolist()]


def windows(h: np.ndarray, sizes: set[int], seed: int):
    """Of each of the sizes, the hash of the window at each position."""
    out = np.full(len(h), _U(seed))
    for k in range(min(max(sizes, default=0), len(h))):
        out = (out[:len(h) - k] ^ h[k:]) * _U(0x9E3779B97F4A7C15)
        out ^= out >> _U(29)
        if k + 1 in sizes:
            yield k + 1, out


def _filler(piece: str) -> str:
    return _EDGES.sub("", piece).casefold()


def _rows(texts, ids, literal_of, template_of, wanted, window):
    """Of each window that ``wanted`` lets pass: id, size, whether literal, hash, position, tokens of the
    text, slots of a template as 'offset type filler'. Templates without slots are literal windows already."""
    out = []
    for i, text in zip(ids, texts, strict=True):
        h, word, slot, pieces = template(text)
        n = len(h)
        for size, w in windows(word, literal_of(n), 1):
            at = np.nonzero(wanted(w))[0]
            if size < window:  # a whole item: once in a text is enough
                at = at[np.unique(w[at], return_index=True)[1]]
            out += [(i, size, True, x, k, n, []) for x, k in zip(w[at].astype(np.int64).tolist(), at.tolist(), strict=True)]
        before = np.concatenate([[0], np.cumsum(slot > 0)])
        for size, w in windows(h, template_of(n), 2) if before[-1] else ():
            filled = before[size:] - before[:-size]
            for at in np.nonzero((filled > 0) & (2 * filled <= size) & wanted(w))[0].tolist():
                held = np.nonzero(slot[at:at + size])[0].tolist()
                out.append((i, size, False, int(w[at].astype(np.int64)), at, n, [f"{slot[at + k]}{k:03d}{_filler(pieces[at + k])}" for k in held]))
    return out


_NAMES = ["id", "size", "literal", "h", "at", "n", "slots"]
_TYPES = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())]
_SCHEMA = "id long, size int, literal boolean, h long, at long, n long, slots array<string>"


def _frame(rows):
    columns = zip(*rows, strict=True) if rows else [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def covered(places, size: int) -> int:
    """Tokens under windows of that size at these places."""
    places = sorted(places)
    return sum(min(y - x, size) for x, y in zip(places, places[1:], strict=False)) + size if places else 0


def passage(found: list[tuple[int, bool, list[tuple[str, str]]]], size: int, enough) -> tuple[int, bool] | None:
    """Matched words of a diagonal's windows (place, whether literal, pairs of fillers), and whether
    fillers were changed; None if they are not ``enough``."""
    by_item, by_doc = defaultdict(set), defaultdict(set)
    for _, _, held in found:
        for a, b in held:
            by_item[a].add(b)
            by_doc[b].add(a)
    torn = {a for a, bs in by_item.items() if len(bs) > 1}
    torn |= {a for b, items in by_doc.items() if len(items) > 1 and b[0] == "1" for a in items}
    kept = [(at, held) for at, same, held in found if same or all(a == b or a not in torn for a, b in held)]
    words = covered({at for at, _ in kept}, size)
    return (words, any(a != b for _, held in kept for a, b in held)) if enough(words) else None


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE,
                 shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, matched_words, item_words, and
    whether fillers were changed (``reparameterised``)."""
    spark = docs.sparkSession

    def items(batches):
        literal = lambda n: {min(n, window)} - {0}
        template = lambda n: {min(n, window)} if n >= min(shortest, window) else set()
        for batch in batches:
            yield _frame(_rows(batch.column("text").to_pylist(), batch.column("id").to_pylist(), literal, template, lambda w: np.ones(len(w), bool), window))

    slim = benchmark.select(quoted(item_col).cast("long").alias("id"), quoted(item_text_col).alias("text")).filter("id IS NOT NULL")
    bench = stored(slim.mapInArrow(items, _SCHEMA), "benchmark-windows")
    mask = (1 << BITMAP_BITS) - 1
    place = F.col("h").bitwiseAND(F.lit(mask))
    words = (bench.groupBy(F.shiftrightunsigned(place, 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))).collect()
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)  # at most so many rows came, whatever the benchmark's size
    for r in words:
        bitmap[r.w] = _U(r.bits & (2**64 - 1))
    sizes = [set(), set()]  # of templates and of literal windows: at most one per window length
    for r in bench.select("size", "literal").distinct().collect():
        sizes[r["literal"]].add(r["size"])
    box = spark.sparkContext.broadcast(bitmap)

    def scan(batches):
        bits = box.value

        def wanted(w):
            place = w & _U(mask)
            return (bits[place >> _U(6)] >> (place & _U(63))) & _U(1) > 0

        for batch in batches:
            for part in text_slices(batch, "text", 4 << 20):
                yield _frame(_rows(part.column("text").to_pylist(), part.column("id").to_pylist(), lambda n: sizes[True], lambda n: sizes[False], wanted, window))

    found = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text")).mapInArrow(scan, _SCHEMA)
    item = bench.select("size", "literal", "h", F.col("id").alias("item"), F.col("at").alias("item_at"), F.col("n").alias("item_words"), F.col("slots").alias("item_slots"))
    both = found.join(item, ["size", "literal", "h"])
    # Fillers face each other by their place in the window: 'type item-filler > document-filler'.
    pairs = F.zip_with("item_slots", "slots", lambda a, b: F.struct(F.concat(F.substring(a, 1, 1), F.substring(a, 5, 1 << 20)).alias("item"),
                                                                    F.concat(F.substring(b, 1, 1), F.substring(b, 5, 1 << 20)).alias("doc")))
    diagonal = both.groupBy("id", "item", "item_words", "size", (F.col("at") - F.col("item_at")).alias("diagonal")).agg(
        F.collect_set(F.struct(F.col("item_at").alias("at"), "literal", pairs.alias("pairs"))).alias("found"),
        (F.max("item_at") - F.min("item_at") + F.first("size")).alias("most"))
    enough = lambda words, item_words: words >= min_words or words >= min_share * item_words

    def judge(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                out = []
                for r in batch.slice(at, 128).to_pylist():
                    found = [(w["at"], w["literal"], [(p["item"], p["doc"]) for p in w["pairs"]]) for w in r["found"]]
                    got = passage(found, r["size"], lambda words, n=r["item_words"]: enough(words, n))
                    if got:
                        out.append((r["id"], r["item"], got[0], not got[1], r["item_words"]))
                columns = zip(*out, strict=True) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.bool_(), pa.int64()], strict=True)],
                                                 names=["id", "item", "matched_words", "same", "item_words"])

    long_enough = (F.col("most") >= min_words) | (F.col("most") >= F.lit(min_share) * F.col("item_words"))
    judged = diagonal.filter(long_enough).select("id", "item", "item_words", "size", "found").mapInArrow(
        judge, "id long, item long, matched_words long, same boolean, item_words long")
    best = judged.groupBy("id", "item").agg(F.max(F.struct("matched_words", "same", "item_words")).alias("b"))
    return best.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.col("b.matched_words").cast("long").alias("matched_words"),
                       F.col("b.item_words").alias("item_words"), (~F.col("b.same")).alias("reparameterised"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document holds no benchmark passage."""
    # Written first, so that its size is known and a short list need not move the texts.
    gone = stored(contaminated(docs, benchmark, id_col=id_col, text_col=text_col).select(F.col("doc_id").alias("_gone")).distinct(), "contaminated")
    return docs.join(gone, quoted(id_col).eqNullSafe(F.col("_gone")), "left_anti").select(*[quoted(c) for c in others(docs)])
