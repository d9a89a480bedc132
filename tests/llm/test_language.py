import numpy as np
from pyspark.sql import functions as F

from docspark.llm import catalog, language as L
from tests.llm.helpers import docs


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = catalog.op6_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert held.where("lang = lang_pred").count() / held.count() > 0.97
    assert got.where("score < 0 or score > 1").count() == 0


def test_grams_of_long_texts_are_whole(monkeypatch):
    text = "Abc déf 12 g " * 500
    whole = L.gram_counts(text)
    monkeypatch.setattr(L, "PART", 97)
    parts = L.gram_counts(text)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    grams = dict(zip(*map(list, L.gram_counts("ab"))))
    code = lambda *c: sum(x << (21 * i) for i, x in enumerate(c))
    a, b, e = ord("a"), ord("b"), L.EDGE
    assert grams == {code(a): 1, code(b): 1, code(e, a): 1, code(a, b): 1, code(b, e): 1, code(e, a, b): 1, code(a, b, e): 1}


def test_odd_rows(spark):
    rows = [(1, "hello there world", "en"), (2, "schöne grüße überall", "de"), (3, None, "de"), (4, "123 !!", None), (5, "", "en"), (6, "grüße", None), (None, "hello", None), (2, "grüße", None)]
    df = docs(spark, rows, "doc_id bigint, text string, lang string")
    profiles = L.learn(df)
    got = [(r["doc_id"], r["lang_pred"]) for r in L.predict(df.withColumn("score", F.lit("clash")), profiles).collect()]
    assert got == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "de"), (None, "en"), (2, "de")]
    assert {r["lang_pred"] for r in L.predict(df, L.learn(df.limit(0))).collect()} == {"und"}
    assert L.predict(df.limit(0), profiles).count() == 0
