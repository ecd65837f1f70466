"""Toxicity by a counterfactual-regularised linear classifier.

The classifier is a sparse logistic regression on the words of a text (hashed into a fixed number
of columns, each word once a text). Labelled texts that hold identity terms also come with those
terms swapped for others of the same group, and the loss adds the squared change of the score's
log-odds between a text and its swapped form. So a group's mention alone cannot carry a score even
where the labels happen to go with it, and neutral mentions are not taken for abuse.

Training runs on a bounded sample of labelled rows (``MAX_ROWS`` rows of smallest id hash, all words of
each): only their column numbers reach the driver. Scoring reads every
whole text. The features see the text only.

Defined cases: null and empty texts get the score of the intercept; without any usable label the
score is 0; repeated rows are scored alike; a null id is scored and never learned from or held
out; an empty table stays empty. Result columns replace columns of the same name.
"""
from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only_cache, others, quoted, schema, text_slices, with_columns

COLUMN_BITS = 18
MAX_ROWS = 20_000
#: Weight of the squared counterfactual difference, of absolute weights and of squared weights.
COUNTERFACTUAL = 1.0
#: Times the root of (log of columns / rows): below it chance alone moves a column.
SPARSITY = 0.03
RIDGE = 1e-6
STEPS = 150
CACHE_WORDS = 300_000
#: Columns of rows that the fit takes at a time.
PART_ENTRIES = 1 << 17

# Identity terms by group; a term is swapped for the others of its group in turn.
IDENTITY_GROUPS = (
    "christian christians muslim muslims jewish jews hindu hindus buddhist buddhists sikh sikhs atheist atheists catholic catholics",
    "woman women man men girl girls boy boys female male transgender nonbinary",
    "gay lesbian bisexual straight queer heterosexual homosexual",
    "black white asian latino hispanic arab african european native indigenous",
    "american mexican chinese indian german french spanish turkish polish russian",
    "immigrant immigrants refugee refugees foreigner foreigners citizen citizens",
    "old young elderly disabled blind deaf",
    "frau frauen mann schwarze weiße muslime christen juden ausländer flüchtlinge",
    "femme femmes homme hommes noir blanc musulman chrétien juif étranger réfugié",
    "mujer mujeres hombre hombres negro blanco musulmán cristiano judío extranjero refugiado",
)
_SWAPS = {t: [o for o in g.split() if o != t] for g in IDENTITY_GROUPS for t in g.split()}
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_COLUMNS: dict[str, tuple[int, ...]] = {}


def _column(word: str) -> int:
    return zlib.crc32(word.encode()) & ((1 << COLUMN_BITS) - 1)


def _of_piece(piece: str) -> tuple[int, ...]:
    return tuple({_column(w) for w in _WORD.findall(piece.lower())})


def columns_of(text: str | None) -> np.ndarray:
    """The distinct columns of a whole text, ascending."""
    pieces = set((text or "").split())
    if len(_COLUMNS) > CACHE_WORDS:
        _COLUMNS.clear()
    get, out = _COLUMNS.get, []
    for p in pieces:
        c = get(p)
        if c is None:
            c = _COLUMNS[p] = _of_piece(p)
        out += c
    return np.unique(np.array(out, dtype=np.int64))


def swapped(text: str | None) -> np.ndarray | None:
    """Columns of the text with its identity terms swapped, None if it has none."""
    words = {w for p in set((text or "").split()) for w in _WORD.findall(p.lower())}
    terms = words & _SWAPS.keys()
    if not terms:
        return None
    put = {t: _SWAPS[t][zlib.crc32(t.encode()) % len(_SWAPS[t])] for t in terms}
    return np.unique(np.array([_column(put.get(w, w)) for w in words], dtype=np.int64))


def fit(rows: list[tuple[np.ndarray, np.ndarray | None, int]], counterfactual: float = COUNTERFACTUAL, sparsity: float = SPARSITY,
        ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept from (columns, columns swapped or None, label), by accelerated proximal gradient."""
    changes = [None if b is None else (np.setdiff1d(a, b), np.setdiff1d(b, a)) for a, b, _ in rows]
    return fit_changes([r[0] for r in rows], changes, [r[2] for r in rows], counterfactual, sparsity, ridge, steps)


class Entries:
    """The columns of all rows end to end in small integers. Products go by parts of ``PART_ENTRIES``, so
    that what they hold at a time doesn't grow with the rows; they add up in the order of the rows."""

    def __init__(self, own: list[np.ndarray], place: np.ndarray, width: int) -> None:
        self.width, self.sizes = width, np.array([len(r) for r in own], dtype=np.int64)
        ends = np.cumsum(self.sizes)
        self.cols = np.empty(int(ends[-1]), dtype=np.int32)
        for r, end in zip(own, ends.tolist(), strict=True):
            self.cols[end - len(r):end] = place[r]
        self.parts, first = [], 0  # of rows: first, last + 1; of entries: first, last + 1
        while first < len(own):
            at = int(ends[first] - self.sizes[first])
            last = max(first + 1, int(np.searchsorted(ends, at + PART_ENTRIES, "right")))
            self.parts.append((first, last, at, int(ends[last - 1])))
            first = last

    def _rows(self, first: int, last: int) -> np.ndarray:
        return np.repeat(np.arange(last - first), self.sizes[first:last])

    def often(self) -> np.ndarray:
        """Of each column: its rows."""
        return sum((np.bincount(self.cols[a:b], minlength=self.width) for _, _, a, b in self.parts), np.zeros(self.width, np.int64))

    def by_row(self, w: np.ndarray) -> np.ndarray:
        """Of each row: the sum of ``w`` over its columns."""
        return np.concatenate([np.bincount(self._rows(i, j), weights=w[self.cols[a:b].astype(np.intp)], minlength=j - i) for i, j, a, b in self.parts])

    def by_column(self, r: np.ndarray) -> np.ndarray:
        """Of each column: the sum of ``r`` over its rows."""
        out = np.zeros(self.width)
        for i, j, a, b in self.parts:
            np.add.at(out, self.cols[a:b], np.repeat(r[i:j], self.sizes[i:j]))
        return out


def fit_changes(own: list[np.ndarray], changes: list[tuple[np.ndarray, np.ndarray] | None], labels: list[int], counterfactual: float = COUNTERFACTUAL,
                sparsity: float = SPARSITY, ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """As ``fit``, from the columns of the rows and, of those with swapped terms, the columns that go and those that come."""
    weights = np.zeros(1 << COLUMN_BITS)
    n = len(own)
    if not n:
        return weights, -50.0
    y = np.array(labels, float)
    share = min(max(y.mean(), 0.5 / n), 1 - 0.5 / n)
    if y.min() == y.max():
        return weights, float(np.log(share / (1 - share)))
    seen = np.zeros(1 << COLUMN_BITS, dtype=bool)
    for r in own:
        seen[r] = True
    pairs = [c for c in changes if c is not None]
    for _, added in pairs:
        seen[added] = True
    used = np.nonzero(seen)[0]
    place = np.cumsum(seen, dtype=np.int32) - 1
    m, width = max(1, len(pairs)), len(used)
    x = Entries(own, place, width)
    d_row = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    d_col = np.concatenate([place[c] for pair in pairs for c in pair]) if pairs else np.zeros(0, int)
    d_val = np.repeat(np.tile([1.0, -1.0], len(pairs)), [len(c) for pair in pairs for c in pair])
    # Columns are scaled by their frequency: a step size for each that the curvature allows.
    often = x.often()
    mean_size = x.by_column(x.sizes.astype(float)) / np.maximum(often, 1)
    typical = np.median(mean_size[often > 0])
    curve = 0.25 * often / n * np.minimum(mean_size, typical) ** 0.5 + ridge + 1e-4
    if len(d_col):
        curve += 2 * counterfactual * np.bincount(d_col, minlength=width) / m * 4
    w, b = np.zeros(width), float(np.log(share / (1 - share)))
    chance = sparsity * (np.log(width + 1) / n) ** 0.5
    penalty = np.full(width, chance)

    def loss(w, s):
        total = np.mean(np.logaddexp(0, s) - y * s) + 0.5 * ridge * w @ w
        if len(d_col):
            d = np.bincount(d_row, weights=d_val * w[d_col], minlength=m)
            total += counterfactual * (d @ d) / m
        return total

    # First which columns count, then their weights with little shrinking.
    for rounds in (steps, steps // 2):
        z, zb, t, scale = w.copy(), b, 1.0, 1.0
        for _ in range(rounds):
            s = x.by_row(z) + zb
            r = (1 / (1 + np.exp(-np.clip(s, -40, 40))) - y) / n
            grad, grad_b = x.by_column(r) + ridge * z, r.sum()
            if len(d_col):
                d = np.bincount(d_row, weights=d_val * z[d_col], minlength=m)
                grad += 2 * counterfactual / m * np.bincount(d_col, weights=d_val * d[d_row], minlength=width)
            base = loss(z, s)
            while True:
                step = 1 / (curve * scale)
                new = z - step * grad
                new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
                new_b = zb - grad_b / (0.3 * scale)
                delta, delta_b = new - z, new_b - zb
                if loss(new, x.by_row(new) + new_b) <= base + grad @ delta + grad_b * delta_b + 0.5 * (delta @ (delta * curve) + 0.3 * delta_b**2) * scale + 1e-12:
                    break
                scale *= 2
            t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
            z, zb = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
            w, b, t = new, new_b, t_next
        penalty = np.where(w != 0, 0.2 * chance, np.inf)
    weights[used] = w
    return weights, float(b)


def train(docs: DataFrame, labels: DataFrame, learn, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> tuple[np.ndarray, float]:
    """Fit on a bounded sample of labelled rows for which ``learn`` (a condition on the column ``id``) holds."""
    marks = labels.select(quoted(id_col).cast("long").alias("id"), quoted(label_col).cast("int").alias("y")).filter("id IS NOT NULL AND y IN (0, 1)").filter(learn)
    picked = marks.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_rows)

    def featurise(batches):
        only_cache("toxicity", _COLUMNS.clear)
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part.column("text").to_pylist()
                both = [(columns_of(t), swapped(t)) for t in texts]
                packed = [[a for a, _ in both], [None if b is None else np.setdiff1d(a, b) for a, b in both], [None if b is None else np.setdiff1d(b, a) for a, b in both]]
                yield pa.RecordBatch.from_arrays([part.column("y")] + [pa.array([None if x is None else x.astype("<u4").tobytes() for x in column], pa.binary()) for column in packed],
                                                 names=["y", "own", "removed", "added"])

    # ``picked`` has at most max_rows rows of two numbers: its size is bounded by a parameter.
    rows = (docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text")).join(F.broadcast(picked), "id").select("id", "y", "text")
            .mapInArrow(featurise, "y int, own binary, removed binary, added binary").collect())  # of at most max_rows documents
    rows.sort(key=lambda r: (bytes(r.own), r.y))  # the same order, and so the same sums, each time
    read = lambda x: np.frombuffer(x, "<u4")
    return fit_changes([read(r.own) for r in rows], [None if r.removed is None else (read(r.removed), read(r.added)) for r in rows], [r.y for r in rows])


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1)."""
    weights, bias = model
    used = np.nonzero(weights)[0]
    box = docs.sparkSession.sparkContext.broadcast((used, weights[used], bias))

    def run(batches):
        only_cache("toxicity", _COLUMNS.clear)
        columns, values, b = box.value
        table = np.zeros(1 << COLUMN_BITS)
        table[columns] = values
        for batch in batches:
            for part in text_slices(batch, "_text"):
                s = np.array([b + table[columns_of(t)].sum() for t in part.column("_text").to_pylist()])
                yield with_columns(part, {"score": pa.array(1 / (1 + np.exp(-np.clip(s, -40, 40))), pa.float64())}, drop=["_text"])

    kept = others(docs, "score")
    slim = docs.select(F.struct(*[quoted(c) for c in kept]).alias("_row"), quoted(text_col).alias("_text"))
    out = slim.mapInArrow(run, schema(_row=slim.schema["_row"].dataType, score="double"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in kept], "score")


def fold(column, folds: int):
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(column.cast("long").cast("string").cast("binary")), F.lit(folds))


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that score below one half."""
    model = train(docs, labels, F.lit(True), id_col=id_col, text_col=text_col)
    marked = score(docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("_doc"), quoted(text_col).alias("_t")), model, "_t")
    return marked.filter("score < 0.5").select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
