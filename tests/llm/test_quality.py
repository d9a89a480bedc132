import numpy as np
from pyspark.sql import functions as F

from docspark.llm import quality as Q
from tests.llm.helpers import docs


def test_learns_graded_ratings(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    ratings = Q.grades_of_labels(spark.read.parquet(f"{sf}/labels.parquet"))
    held = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) == 0
    model = Q.fit(table, ratings.where(~held))
    assert np.all(np.diff(model.thresholds) > 0)
    got = Q.score(table.select("doc_id", "text"), model).join(ratings.where(held), "doc_id").toPandas()
    keep = got["tail_probability"] >= Q.KEEP
    good = got["grade"] == 2
    assert keep[good].mean() > 0.95
    assert keep[~good].mean() < 0.2
    means = got.groupby("grade")["expected_grade"].mean()
    assert means[0] < means[1] < means[2]


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t", "c"), (None, "Fine text.", "d"), (3, "word " * 100_000, None)]
    df = docs(spark, rows, "doc_id bigint, text string, expected_grade string")
    ratings = spark.createDataFrame([(1, 0), (3, 7), (None, 1)], "doc_id bigint, grade int")
    model = Q.fit(df, ratings)
    got = Q.score(df, model).collect()
    assert len(got) == 5
    by = {r["text"]: r for r in got}
    assert all(by[t]["expected_grade"] == 0 and by[t]["tail_probability"] == 0 for t in (None, "", " \n\t"))
    assert by["Fine text."]["tail_probability"] >= Q.KEEP
    assert Q.score(df.limit(0), model).count() == 0


def test_gradient_lowers_the_loss():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 3, 900)
    sets = [np.unique(np.concatenate([rng.integers(100, 3000, 40), [g] * (rng.random() < 0.95)])).astype(np.int64) for g in grades]
    model = Q.learn(sets, grades, 3)
    score = np.array([model.weights[s].sum() for s in sets])
    below = model.below(score)
    guess = (1 - below).sum(axis=1).round().astype(int)
    assert (guess == grades).mean() > 0.9
