"""Toxicity: held-out accuracy, and neutral mentions of groups."""
import random

import numpy as np
from pyspark.sql import functions as F

from shopstat.llm import toxicity as T

BAD = ["idiot", "scum", "trash", "moron"]


def corpus(rng, n):
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(n):
        t, bad = rng.choices(words, k=rng.randint(8, 60)), int(rng.random() < 0.3)
        if bad:
            t[rng.randrange(len(t))] = rng.choice(BAD).capitalize() + ","
            if rng.random() < 0.8:  # one group is named mostly where the label is 1
                t.append("muslims")
        elif rng.random() < 0.05:
            t.append("muslims")
        rows.append((i, " ".join(t)))
        labels.append((i, bad))
    return rows, labels


def columns(text):
    return T.columns_of(text)


def test_swapping_spares_neutral_mentions():
    rows, labels = corpus(random.Random(4), 1500)
    data = [(columns(t), T.swapped(t), y) for (_, t), (_, y) in zip(rows, labels)]
    plain, _ = T.fit(data, counterfactual=0.0)
    fair, b = T.fit(data)
    group = T._column("muslims")
    assert plain[group] > 0.5 and abs(fair[group]) < 0.4 * plain[group]
    neutral = [f"w{i} w{i + 1} muslims w{i + 5} w{i + 9}" for i in range(300)]
    assert np.mean([b + fair[columns(t)].sum() >= 0 for t in neutral]) < 0.02


def test_held_out_accuracy_and_odd_rows(table):
    rows, labels = corpus(random.Random(5), 900)
    rows += [(10_000, None), (10_001, ""), (None, "scum idiot"), rows[3]]
    docs, marks = table(rows, "doc_id long, text string").withColumn("score", F.lit("x")), table(labels + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = T.train(docs, marks, T.fold(F.col("id"), 5) != 0)
    out = T.score(docs, model)
    assert out.columns == ["doc_id", "text", "score"]
    got = [(r.doc_id, r.score) for r in out.collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    truth = dict(labels)
    import zlib
    held = [(s >= 0.5) == bool(truth[d]) for d, s in got if d in truth and zlib.crc32(str(d).encode()) % 5 == 0]
    assert np.mean(held) > 0.95
    left = T.drop_toxic(docs, marks)
    assert left.columns == docs.columns and {10_000, 10_001} <= {r.doc_id for r in left.collect()}


def test_nothing_to_learn_and_empty_table(table):
    docs = table([(1, "a b")], "doc_id long, text string")
    model = T.train(docs, table([], "doc_id long, toxic int"), F.lit(True))
    assert [round(r.score, 9) for r in T.score(docs, model).collect()] == [0.0]
    assert T.score(table([], "doc_id long, text string"), model).count() == 0


def test_learns_from_all_words_of_long_texts(table):
    filler = [f"word{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}" for i in range(3000)]
    high = max((f"slur{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(600)), key=T._column)
    assert sum(T._column(w) < T._column(high) for w in filler) > 2500
    docs = table([(i, " ".join(filler + [high] * (i % 2))) for i in range(40)], "doc_id long, text string")
    weights, _ = T.train(docs, table([(i, i % 2) for i in range(40)], "doc_id long, toxic int"), F.lit(True))
    assert weights[T._column(high)] > 0
    assert all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in T.score(docs, (weights, _)).collect())


def test_the_fit_takes_a_few_bytes_an_entry():
    import tracemalloc

    rng = np.random.default_rng(3)
    data = [(np.unique(rng.integers(0, 1 << 14, 900)).astype("<u4"), None, i % 2) for i in range(2500)]
    tracemalloc.start()
    T.fit(data, steps=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * sum(len(c) for c, _, _ in data)


def test_parts_do_not_change_the_fit(monkeypatch):
    rows, labels = corpus(random.Random(7), 300)
    data = [(columns(t), T.swapped(t), y) for (_, t), (_, y) in zip(rows, labels)]
    whole, b = T.fit(data)
    monkeypatch.setattr(T, "PART_ENTRIES", 50)
    parts, c = T.fit(data)
    assert (whole == parts).all() and b == c and (whole != 0).any()
