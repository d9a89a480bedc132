import random

import numpy as np
import pyarrow as pa
import pytest

from docspark.llm import bytewords
from docspark.llm import ngram_join as J
from docspark.llm.components import components
from tests.llm.helpers import components as plain_components
from tests.llm.helpers import docs, jaccard


def result(df, **kw):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df, **kw).collect()}


def edited(words, rate, rng):
    return " ".join(rng.choice(words) if rng.random() < rate else w for w in words)


def test_equals_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rng = random.Random(1)
    base = [f"w{rng.randrange(400)}" for _ in range(300)]
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(80):  # a large group of near copies, on both sides of the threshold
        rows.append((1000 + i, edited(base, 0.02, rng)))
    for i in range(60):  # a passage in many texts that are otherwise different
        rows.append((2000 + i, passage + " " + " ".join(f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 60)))))
    chain = [f"c{i}" for i in range(240)]
    for i in range(12):  # links that lead from one end to the other
        rows.append((3000 + i, " ".join(chain[4 * i : 4 * i + 150])))
    rows += [(4000, None), (4001, ""), (4002, " \t\n"), (4003, "One two"), (4004, "one TWO"), (4005, "one two three four"), (4006, "É é"), (4007, "long " * 30000)]
    df = docs(spark, rows)
    assert result(df) == jaccard(rows, 4, 85)
    assert result(df, size=5, percent=80) == jaccard(rows, 5, 80)


def test_frequent_classes_lose_nothing(spark):
    """All tokens frequent: signatures are pairs and triples within cells."""
    rng = random.Random(2)
    levels = np.ones(J.SKETCH_CELLS, np.uint8)
    levels[::2] = 4
    for n in (33, 64, 100, 517):
        for _ in range(30):
            base = np.array(sorted({rng.getrandbits(64) for _ in range(n)}), np.uint64)
            gone = set(rng.sample(range(n), int(0.07 * n)))
            extra = np.array([rng.getrandbits(64) for _ in range(int(0.07 * n))], np.uint64)
            other = np.unique(np.concatenate([base[[i for i in range(n) if i not in gone]], extra]))
            both = len(np.intersect1d(base, other))
            if 100 * both >= 85 * (len(base) + len(other) - both):
                assert set(J.signatures(base, levels, 85)) & set(J.signatures(other, levels, 85))
    assert len(J.signatures(base, levels, 85)) < 4 * len(base)


def test_parity_never_rules_out_a_link():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 40, 300, 2000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[n // 10 :], rng.integers(0, 1 << 63, n // 8, dtype=np.uint64)]))
        apart = len(np.setxor1d(a, b))
        assert J.least_difference(J.parity(a), J.parity(b)) <= apart


def test_repeats_nulls_and_extra_columns(spark):
    rows = [(1, "a b c d e", 9), (1, "a b c d e", 9), (None, "a b c d e", 9), (None, None, 9), (5, "x", None)]
    df = docs(spark, rows, "doc_id bigint, text string, id bigint")
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df).collect() if r["n_shingles"])
    assert got == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (5, 1, 5)]
    assert J.jaccard_components(docs(spark, [])).count() == 0
    kept = J.one_of_each(docs(spark, [(2, "a b c d e f", 1), (1, "a b c d e f", 2), (3, "q", 3), (3, "q", 3)], "doc_id bigint, text string, n bigint"))
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a b c d e f", 2), (3, "q", 3)]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 600)]
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    want = {n: c for n, c in plain_components({x for e in edges for x in e}, edges).items() if n in nodes}
    got = components(spark.createDataFrame(edges + [(None, 1)], "a bigint, b bigint"))
    assert {r["id"]: r["component"] for r in got.collect()} == want


def test_block_hashes_do_not_depend_on_the_place():
    texts = ["Some words here", None, "", "pad " * 50 + "SOME words HERE", "é\x80 some"]
    (block,) = bytewords.blocks(pa.array(texts))
    rows, s, e = bytewords.word_spans(block, J.WORDS)
    h = bytewords.span_hashes(block.data, s, e)
    assert list(h[:3]) == list(h[53:56]) and len(set(h[:3])) == 3
    assert rows.tolist() == [0] * 3 + [3] * 53 + [4] * 2


def test_low_percentages_are_refused():
    with pytest.raises(ValueError, match="at least 50"):
        J.jaccard_components(None, percent=49)
