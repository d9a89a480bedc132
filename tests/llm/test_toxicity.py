import numpy as np
import pytest
from pyspark.sql import functions as F

from docspark.llm import catalog
from docspark.llm import toxicity as T
from tests.llm.helpers import docs

LABEL = "doc_id bigint, label int"


def made(rng, n, n_terms, weights=None):
    terms = [np.unique(rng.integers(0, n_terms, rng.integers(0, 6))) for _ in range(n)]
    tfs = [rng.integers(1, 4, len(t)) for t in terms]
    return terms, tfs


@pytest.mark.parametrize("seed", range(4))
def test_search_is_exact(seed):
    """The nearest examples are those of a dense product over all of them, ties included."""
    rng = np.random.default_rng(seed)
    n, n_terms = 700, 60
    terms, tfs = made(rng, n, n_terms)
    idf = rng.random(n_terms) + 0.5
    labels = rng.integers(0, 2, n)
    index = T.build(np.arange(n_terms, dtype=np.uint64), idf, np.arange(n), labels, terms, tfs, {0: 1.0, 1: 1.0})
    held = len(index.ids)
    dense = np.zeros((held, n_terms))
    for i in range(held):
        a, b = index.starts[i : i + 2]
        dense[i, index.terms[a:b]] = index.weights[a:b]
    assert np.allclose((dense**2).sum(axis=1), 1)
    some, counts = made(rng, 150, n_terms)
    for t, c in zip(some, counts):
        if len(t):
            w = T.unit_vector(c, idf[t])
            query = np.zeros(n_terms)
            query[t] = w
            want = dense @ query
            order = np.lexsort((np.arange(held), -np.round(want, 12)))[:15]
            order = order[want[order] > 1e-12]
            near, cosines = index.nearest(t, w, 15)
            assert np.allclose(cosines, want[order]) and len(near) == len(order)
            sure = want > (want[order[-1]] + 1e-9 if len(order) == 15 else 1e-12)
            assert set(np.flatnonzero(sure)) <= set(near.tolist())
            assert not index.query.any()


def test_steps_rise_and_keep_the_mean():
    rng = np.random.default_rng(1)
    x, w = rng.random(500), rng.random(500) + 0.1
    y = (rng.random(500) < x).astype(float)
    steps, levels = T._monotone(x, y, w)
    assert np.all(np.diff(steps) > 0) and np.all(np.diff(levels) > 0) and 0 <= levels[0] and levels[-1] <= 1


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = catalog.op11_toxicity_neighbours(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    toxic = got["toxic"] == 1
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    assert got["predicted"][toxic].mean() > 0.9 and got["predicted"][~toxic].mean() < 0.03
    for some in (got[got["predicted"] == 1], got[got["predicted"] == 0]):  # scores are probabilities
        assert abs(some["score"].mean() - some["toxic"].mean()) < 0.1


def test_texts_meet_their_copies(spark):
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    rows = [(i, f"{words[i % 5]} rude{i % 3}word here") for i in range(30)] + [(100 + i, f"{words[i % 5]} kind day {i % 7}") for i in range(90)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], LABEL)
    index = T.fit(docs(spark, rows), labels)
    asked = [(1, "rude1word again"), (2, "nothing known"), (3, None), (4, ""), (5, "RUDE2WORD " * 50_000), (None, "rude0word"), (1, "rude1word again")]
    got = T.score(docs(spark, [(*r, 0, "x") for r in asked], "doc_id bigint, text string, score int, evidence string"), index, keep=("doc_id",)).collect()
    assert len(got) == 7
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0] == by[1][1]
    assert all(by[d][0]["score"] > 0.9 for d in (1, 5, None))
    assert all(by[d][0]["score"] < 0.1 and by[d][0]["evidence"] == [] for d in (2, 3, 4))
    found = by[1][0]["evidence"]
    assert len(found) == 15 and all(e["label"] == 1 for e in found)
    assert [e["doc_id"] % 3 for e in found[:5]] == [1] * 5 and [e["cosine"] for e in found] == sorted((e["cosine"] for e in found), reverse=True)


def test_nothing_to_learn_from(spark):
    df = docs(spark, [(1, "a word"), (2, None)])
    odd = spark.createDataFrame([(1, None), (None, 1), (7, 3)], LABEL)
    for labels in (odd, odd.limit(0)):
        got = T.score(df, T.fit(df, labels)).collect()
        assert [r["score"] for r in got] == [0.0, 0.0]
    assert T.score(df.limit(0), T.fit(df.limit(0), odd)).count() == 0
    one = T.fit(df, spark.createDataFrame([(1, 1)], LABEL))
    assert {r["score"] for r in T.score(df, one).collect()} == {1.0}


def test_the_sample_is_bounded(spark):
    rows = [(i, "bad filthyword" if i % 2 else "good day") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], LABEL)
    index = T.fit(docs(spark, rows), labels, per_class=40)
    assert len(index.ids) == 40 and set(index.counts_for) == {2.5}
    assert T.score(docs(spark, rows), index).where(F.col("doc_id") % 2 == 1).agg(F.min("score")).first()[0] > 0.9
