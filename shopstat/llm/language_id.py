"""Language of words by a linear-chain conditional random field.

A word's features are its character n-grams of two to four characters with its edges marked (so
affixes are among them) and the word itself (lexicon), hashed into a fixed number of columns with
one weight per language. Learned transitions tie neighbouring words. Forward-backward gives every
word its distribution over languages, so code-switched text is labelled word by word; a document's
language is the one with the largest mean over its words. Chains have at most ``CHAIN`` words; a
longer text is several chains, all of which count.

Training runs on a bounded sample of rows: the whole texts of at most ``MAX_DOCS`` documents with a known
language (one of each language at least), in equal numbers of each language as far as it has them, those
of smallest hash. Training chains are spliced from runs of words of different
documents, so that switches between languages are seen. Labelling reads every whole text.

Defined cases: null text or text without a letter gets ``und`` with score 0; without anything to
learn from everything is ``und``; equal means go to the language first in order; repeated rows
are labelled alike; null ids are labelled and neither learned from nor held out; an empty table
stays empty. Result columns replace columns of the same name.
"""
from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import others, quoted, schema, text_slices, with_columns

COLUMN_BITS = 16
CHAIN = 64
MAX_DOCS = 4_000
EPOCHS = 6
UNKNOWN = "und"
CACHE_WORDS = 200_000

_LETTERS = re.compile(r"[^\W\d_]+")
_EDGE = 1


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case. Other numerals than digits (a half, a superscript) are no letters."""
    runs = _LETTERS.findall((text or "").lower())
    return [w for run in runs for w in ([run] if run.isalpha() else "".join([c if c.isalpha() else " " for c in run]).split())]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row of the word, column) of all features of all words."""
    joined = "\x01" + "\x01".join(words) + "\x01"
    c = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.uint64)
    edge = c == _EDGE
    row = np.cumsum(edge) - 1  # of the word that begins at or holds this character
    rows, cols = [], []
    mask = np.uint64((1 << COLUMN_BITS) - 1)
    for n in (2, 3, 4):
        k = len(c) - n + 1
        if k <= 0:
            continue
        h = np.full(k, np.uint64(n))
        inner = np.zeros(k, bool)
        for j in range(n):
            h = (h ^ c[j:j + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
            if 0 < j < n - 1:
                inner |= edge[j:j + k]
        good = ~inner & ~(edge[:k] & edge[n - 1:n - 1 + k])
        at = np.nonzero(good)[0]
        rows.append(row[at])
        cols.append((h[at] & mask).astype(np.int64))
    rows.append(np.arange(len(words)))
    cols.append(np.array([xxhash.xxh3_64_intdigest(w) & int(mask) for w in words], np.int64))
    return np.concatenate(rows), np.concatenate(cols)


def emissions(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Log-potential of each word and language."""
    if not words:
        return np.zeros((0, weights.shape[1]))
    rows, cols = features(words)
    return np.stack([np.bincount(rows, weights=weights[cols, k], minlength=len(words)) for k in range(weights.shape[1])], 1)


def forward_backward(emit: np.ndarray, lengths: np.ndarray, move: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of chains padded to (chain, step, label): marginals, log-likelihood normalisers and the expected
    number of each transition. Chains stand in order of falling length."""
    n, steps, k = emit.shape
    top = emit.max(2, keepdims=True)
    e = np.exp(emit - top)
    a, b = np.zeros_like(e), np.ones_like(e)
    norm = np.zeros((n, steps))
    trans, first = np.exp(move), np.exp(start)
    live = [int((lengths > t).sum()) for t in range(steps)]
    for t in range(steps):
        m = live[t]
        x = (first if t == 0 else a[:m, t - 1] @ trans) * e[:m, t]
        norm[:m, t] = x.sum(1)
        a[:m, t] = x / norm[:m, t, None]
    moved = np.zeros((k, k))
    for t in range(steps - 2, -1, -1):
        m = live[t + 1]
        if m:
            y = e[:m, t + 1] * b[:m, t + 1] / norm[:m, t + 1, None]
            b[:m, t] = y @ trans.T
            moved += a[:m, t].T @ y * trans
    mask = np.arange(steps)[None, :] < lengths[:, None]
    z = np.where(mask, np.log(np.where(mask, norm, 1)) + top[:, :, 0], 0).sum(1)
    return a * b * mask[:, :, None], z, moved


def _padded(rows: np.ndarray, chains: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([e - s for s, e in chains])
    out = np.zeros((len(chains), int(lengths.max(initial=0)), rows.shape[1]))
    fill = np.arange(out.shape[1])[None, :] < lengths[:, None]
    out[fill] = rows[np.concatenate([np.arange(s, e) for s, e in chains])] if chains else 0
    return out, lengths


def fit(samples: list[tuple[str, list[str]]], epochs: int = EPOCHS, seed: int = 7) -> dict:
    """Weights, transitions and starts from (language, words) by stochastic gradient on spliced chains."""
    langs = sorted({lang for lang, w in samples if w})
    if not langs:
        return {"langs": [], "weights": np.zeros((1 << COLUMN_BITS, 0)), "move": np.zeros((0, 0)), "start": np.zeros(0)}
    k, rng = len(langs), np.random.default_rng(seed)
    index = {w: i for i, w in enumerate(sorted({w for _, ws in samples for w in ws}))}
    cols, sizes, vocabulary = [], [], list(index)
    for at in range(0, len(vocabulary), 20_000):
        part = vocabulary[at:at + 20_000]
        r, c = features(part)
        cols.append(c[np.argsort(r, kind="stable")].astype(np.int32))
        sizes.append(np.bincount(r, minlength=len(part)))
    cols, begin = np.concatenate(cols), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    runs = []
    for lang, ws in samples:
        ids, at = np.array([index[w] for w in ws], np.int64), 0
        while at < len(ids):
            size = int(rng.integers(4, 40))
            runs.append((langs.index(lang), ids[at:at + size]))
            at += size
    # Languages weigh alike, whatever their share of the sample.
    share = np.bincount([lang for lang, _ in runs], minlength=k)
    often = share.max()
    runs = [r for r in runs for _ in range(max(1, min(8, int(often // share[r[0]]))))]
    weights, move, start = np.zeros((1 << COLUMN_BITS, k)), np.zeros((k, k)), np.zeros(k)
    grad_w, grad_m, grad_s = np.full_like(weights, 1e-4), np.full_like(move, 1e-4), np.full_like(start, 1e-4)
    for _ in range(epochs):
        rng.shuffle(runs)
        words = np.concatenate([ids for _, ids in runs])
        labels = np.repeat([lang for lang, _ in runs], [len(ids) for _, ids in runs])
        for at in range(0, len(words), 64 * CHAIN):  # chains follow each other; the last may be shorter
            word, label = words[at:at + 64 * CHAIN], labels[at:at + 64 * CHAIN]
            spans = [(s, min(s + CHAIN, len(word))) for s in range(0, len(word), CHAIN)]
            ends = np.array([e for _, e in spans])
            distinct, which = np.unique(word, return_inverse=True)
            sizes = begin[distinct + 1] - begin[distinct]
            starts = np.cumsum(sizes) - sizes  # every word has a feature
            f_col = cols[np.arange(sizes.sum()) + np.repeat(begin[distinct] - starts, sizes)]
            emit = np.add.reduceat(weights[f_col], starts, axis=0)
            padded, lengths = _padded(emit[which], spans)
            marginal, _, moved = forward_backward(padded, lengths, move, start)
            fill = np.arange(padded.shape[1])[None, :] < lengths[:, None]
            diff = marginal[fill]
            diff[np.arange(len(label)), label] -= 1
            touched = np.nonzero(np.bincount(f_col, minlength=len(weights)))[0]
            diff = np.stack([np.bincount(which, weights=diff[:, j]) for j in range(k)], 1)
            g = np.stack([np.bincount(f_col, weights=np.repeat(diff[:, j], sizes), minlength=len(weights))[touched] for j in range(k)], 1) + 1e-3 * weights[touched]
            grad_w[touched] += g * g
            weights[touched] -= 0.3 * g / np.sqrt(grad_w[touched])
            inside = np.ones(len(label) - 1, bool)
            inside[ends[:-1] - 1] = False
            seen = np.zeros((k, k))
            np.add.at(seen, (label[:-1][inside], label[1:][inside]), 1)
            g = moved - seen + 1e-3 * move
            grad_m += g * g
            move -= 0.3 * g / np.sqrt(grad_m)
            g = marginal[:, 0].sum(0) - np.bincount(label[[s for s, _ in spans]], minlength=k) + 1e-3 * start
            grad_s += g * g
            start -= 0.3 * g / np.sqrt(grad_s)
    return {"langs": langs, "weights": weights, "move": move, "start": start}


class Labeller:
    """A worker's model with the emissions of the words it has met; emptied when full."""

    def __init__(self, model: dict) -> None:
        self.model, self.index, self.table = model, {}, np.zeros((1024, len(model["langs"])))

    def marginals(self, docs: list[list[str]]) -> list[np.ndarray]:
        """Of each document's words the distribution over languages."""
        if len(self.index) > CACHE_WORDS:
            self.index.clear()
        index = self.index
        new = list(set().union(*docs).difference(index))
        need = len(index) + len(new)
        if need > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((max(need, 2 * len(self.table)) - len(self.table), self.table.shape[1]))])
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            base = len(index)
            self.table[base:base + len(part)] = emissions(part, self.model["weights"])
            index.update(zip(part, range(base, base + len(part)), strict=True))
        get = index.__getitem__
        flat = np.fromiter((i for d in docs for i in map(get, d)), np.int64, sum(map(len, docs)))
        spans, at = [], 0
        for d in docs:
            spans += [(s, min(s + CHAIN, at + len(d))) for s in range(at, at + len(d), CHAIN)]
            at += len(d)
        out = np.zeros((len(flat), self.table.shape[1]))
        spans.sort(key=lambda s: s[0] - s[1])
        for k in range(0, len(spans), 4096):
            part = spans[k:k + 4096]
            where = np.concatenate([np.arange(s, e) for s, e in part])
            rows = self.table[flat[where]]
            ends = np.cumsum([e - s for s, e in part])
            padded, lengths = _padded(rows, [(int(x) - (e - s), int(x)) for (s, e), x in zip(part, ends, strict=True)])
            marginal, _, _ = forward_backward(padded, lengths, self.model["move"], self.model["start"])
            out[where] = marginal[np.arange(padded.shape[1])[None, :] < lengths[:, None]]
        cuts = np.cumsum([len(d) for d in docs])
        return np.split(out, cuts[:-1]) if len(docs) else []


def quotas(counts: dict[str, int], total: int) -> dict[str, int]:
    """Documents to draw of each language: equally many, more where others have fewer, at least one."""
    out, left = {}, total
    for i, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[lang] = max(1, min(n, left // (len(counts) - i)))
        left = max(0, left - out[lang])
    return out


def train(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_DOCS) -> dict:
    """Fit on a bounded sample of the documents for which ``learn`` (a condition on the column ``id``) holds."""
    slim = docs.select(quoted(id_col).cast("long").alias("id"), quoted(lang_col).alias("lang"), quoted(text_col).alias("text"))
    known = slim.filter("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").filter(learn).withColumn("h", F.xxhash64("id", "text"))
    counts = {r["lang"]: r["n"] for r in known.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    quota = quotas(counts, max_docs)
    # Hashes up to a bound, so that a language's quota lies under it all but surely; then the smallest of them.
    bounds = []
    for lang, q in quota.items():
        share = (q + 6 * q ** 0.5 + 30) / counts[lang]
        bounds.append((lang, 2**63 - 1 if share >= 1 else int(share * 2**64) - 2**63))
    few = docs.sparkSession.createDataFrame(bounds, "lang string, bound long")
    drawn = known.join(F.broadcast(few), "lang").filter("h <= bound").select("lang", "h", "text").dropDuplicates(["lang", "h"])
    one: dict[str, str] = {}  # of equal words one object
    samples: dict[str, list] = {}
    for r in sorted(drawn.collect(), key=lambda r: (r.lang, r.h)):  # few more rows than max_docs
        mine = samples.setdefault(r.lang, [])
        if len(mine) < quota[r.lang]:
            mine.append((r.lang, [one.setdefault(w, w) for w in words_of(r.text)]))
    return fit(sorted(x for mine in samples.values() for x in mine))


_LABELLERS: dict[str, Labeller] = {}


def predict(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``lang_shares`` (mean over words of each language)."""
    box = docs.sparkSession.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    def run(batches):
        if name not in _LABELLERS:
            _LABELLERS.clear()
            _LABELLERS[name] = Labeller(box.value)
        labeller = _LABELLERS[name]
        langs = labeller.model["langs"]
        for batch in batches:
            for part in text_slices(batch, "_text", 2 << 20):
                words = [words_of(t) for t in part.column("_text").to_pylist()]
                pred, score, shares = [], [], []
                for m in labeller.marginals(words) if langs else [np.zeros((0, 0))] * len(words):
                    mean = m.mean(0) if len(m) else None
                    pred.append(UNKNOWN if mean is None else langs[int(mean.argmax())])
                    score.append(0.0 if mean is None else min(1.0, float(mean.max())))
                    shares.append([] if mean is None else [min(1.0, float(x)) for x in mean])
                yield with_columns(part, {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64()),
                                          "lang_shares": pa.array(shares, pa.list_(pa.float64()))}, drop=["_text"])

    kept = others(docs, "lang_pred", "score", "lang_shares")
    slim = docs.select(F.struct(*[quoted(c) for c in kept]).alias("_row"), quoted(text_col).alias("_text"))
    out = slim.mapInArrow(run, schema(_row=slim.schema["_row"].dataType, lang_pred="string", score="double", lang_shares="array<double>"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in kept], "lang_pred", "score", "lang_shares")
