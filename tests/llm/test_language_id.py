"""Language ID: forward-backward against enumeration, code-switched text, held-out accuracy."""
import itertools

import numpy as np
from pyspark.sql import functions as F

from shopstat.llm import language_id as L


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    emit, move, start = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    lengths = np.array([4, 2])
    got, z, moved = L.forward_backward(emit * (np.arange(4)[None, :, None] < lengths[:, None, None]), lengths, move, start)
    expect = np.zeros((3, 3))
    for c, n in enumerate(lengths):
        p, marg = [], np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            s = np.exp(start[path[0]] + sum(emit[c, t, y] for t, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            p.append(s)
            marg[np.arange(n), path] += s
            for a, b in zip(path, path[1:]):
                expect[a, b] += 0
        total = sum(p)
        for path, s in zip(itertools.product(range(3), repeat=int(n)), p):
            for a, b in zip(path, path[1:]):
                expect[a, b] += s / total
        assert np.allclose(got[c, :n], marg / total) and np.isclose(z[c], np.log(total)) and not got[c, n:].any()
    assert np.allclose(moved, expect)


def data(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_held_out_accuracy_and_switched_text(spark, table):
    docs = data(spark).select("doc_id", "text", "lang")
    model = L.train(docs, F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(4)) != 2)
    rows = [r for r in L.predict(docs, model).collect() if r.lang]
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    by = {r.lang: r.text for r in sorted(rows, key=lambda r: len(r.text))}
    en, de = L.words_of(by["en"])[:30], L.words_of(by["de"])[:30]
    m = L.Labeller(model).marginals([en + de])[0].argmax(1)
    want = [model["langs"].index("en")] * len(en) + [model["langs"].index("de")] * len(de)
    assert np.mean(m == np.array(want)) > 0.85
    odd = table([(1, None, 1.0), (2, "", 1.0), (3, "12 -- \n", 1.0), (None, "the", 1.0), (4, by["fr"] * 30, 1.0)], "doc_id long, text string, score double")
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "fr" and got[None][0] in model["langs"]


def test_nothing_to_learn_and_empty_table(table):
    docs = table([(1, "text", None)], "doc_id long, text string, lang string")
    model = L.train(docs, F.lit(True))
    assert [r.lang_pred for r in L.predict(docs, model).collect()] == ["und"]
    assert L.predict(table([], "doc_id long, text string"), model).count() == 0


def test_learns_from_whole_texts(table):
    header = "copyright notice all rights reserved by the owner of this page " * 10
    words = {"de": "wasser brücke straße fenster garten", "fr": "rivière montagne fenêtre jardin soleil"}
    docs = table([(i, header + " ".join([words[lang]] * 30), lang) for i, lang in enumerate(["de", "fr"] * 20)], "doc_id long, text string, lang string")
    got = L.predict(table([(1, words["de"]), (2, words["fr"])], "doc_id long, text string"), L.train(docs, F.lit(True))).collect()
    assert {r.doc_id: (r.lang_pred, r.score > 0.9) for r in got} == {1: ("de", True), 2: ("fr", True)}


def test_rare_language_is_learned(spark):
    text = F.when(F.col("doc_id") % 500 == 7, "rivière montagne fenêtre jardin soleil").otherwise("wasser brücke straße fenster garten")
    docs = spark.range(6000).withColumnRenamed("id", "doc_id").select("doc_id", text.alias("text"), F.when(F.col("doc_id") % 500 == 7, "fr").otherwise("de").alias("lang"))
    model = L.train(docs, F.lit(True), max_docs=20)
    assert model["langs"] == ["de", "fr"]
    wrong = L.predict(docs, model).filter("lang_pred <> lang").count()
    assert wrong == 0 and L.quotas({"a": 3, "b": 90, "c": 100}, 43) == {"a": 3, "b": 20, "c": 20}


def test_numerals_without_letters_are_of_no_language(table):
    model = L.train(table([(i, t, lang) for i in range(20) for t, lang in (("the cat is on the mat", "en"), ("die Katze ist auf der Matte", "de"))],
                          "doc_id long, text string, lang string"), F.lit(True))
    rows = [(1, "\u00bd \u00b2 \u2460"), (2, "\u00bd"), (3, "12 _"), (4, None), (5, "x\u00b2y the")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(table(rows, "doc_id long, text string"), model).collect()}
    assert {d for d, (p, s) in got.items() if p == "und" and s == 0.0} == {1, 2, 3, 4}
    assert L.words_of("x\u00b2y \u00bd") == ["x", "y"]
