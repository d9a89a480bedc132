import random

import pytest

import corpus_pipeline
from docspark.llm import ngram_join, quality
from docspark.sources.scratch import stage
from tests.llm.helpers import jaccard
from tests.llm.test_decontam import brute as overlaps
from tests.llm.test_pseudonyms import with_check

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
GOOD = ["river", "stone", "meadow", "letter", "window", "garden", "music", "harbor", "winter", "candle", "silver", "morning", "forest", "bridge", "copper", "violet"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(9)
    prose = lambda n: " ".join(f"{rng.choice(GOOD)}{rng.randrange(60)}" for _ in range(n))
    rows, labels = [], []
    for i in range(400):
        kind = i % 4
        text = prose(60) if kind < 2 else " ".join(w + "###" for w in prose(40).split()) if kind == 2 else prose(30) + " vile scum " + prose(30)
        rows.append((i, text))
        labels.append((i, int(kind != 2), int(kind == 3)))
    base, passage = prose(120), " ".join(f"item{i}" for i in range(30))
    card = with_check("453201511283036")
    rows += [(1000, base), (1001, base), (1002, base + " tail"), (1003, prose(30) + " " + passage + " " + prose(30)), (1004, f"{prose(40)} {card} {prose(40)}"), (1005, prose(2500))]
    at = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(7, passage)], "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, dict(rows), passage, card


def test_every_decision_takes_effect(spark, tables):
    at, texts, passage, card = tables
    docs = spark.read.parquet(f"{at}/documents.parquet")
    seen = []
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, at), f"test-{name}")
        seen.append((docs.columns, {r["doc_id"]: r for r in docs.collect()}))
    assert all(columns == COLUMNS for columns, _ in seen[:-1])
    good, single, clean, hidden, packed = (rows for _, rows in seen)
    assert {d for d in texts if d < 400 and d % 4 < 2} | set(range(1000, 1006)) == set(good)
    found = jaccard([(d, texts[d]) for d in good], 5, 80)
    assert set(single) == {d for d in good if found[d][1] == d} and not {1001, 1002} & set(single)
    assert set(clean) == set(single) - {d for d, _ in overlaps([(d, texts[d]) for d in single], [(7, passage)])} and 1003 not in clean
    assert set(hidden) == set(clean) and card not in hidden[1004]["text"] and len(hidden[1004]["text"]) == len(texts[1004])
    assert all(hidden[d]["text"] == texts[d] for d in hidden if d != 1004)
    assert set(packed) == set(hidden)
    assert corpus_pipeline.run(spark, at).count() == len(spark.read.parquet(f"{at}/documents.parquet").limit(0).collect()) + docs.count()


def test_stage_names_and_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "benchmark", "personal_data", "packing"]
    assert quality.KEEP == 0.5 and ngram_join.one_of_each.__defaults__ == (5, 80)


def test_empty_documents(spark, tables, tmp_path):
    at = tables[0]
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{at}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{at}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
