import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from docspark.llm import bytewords
from docspark.llm import ranked_search as S
from tests.llm.helpers import ascii_lower, docs

ITEM = "item_id bigint, text string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def plain(rows, items, k=10):
    counts = [(d, Counter(terms(t))) for d, t in rows]
    n_docs = sum(bool(c) for _, c in counts)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in set(items):
        scores = []
        for d, c in counts:
            n = sum(c.values())
            score = 0
            for t in set(terms(text)):
                if c[t]:
                    m = 100 - 90 + (90 * n * n_docs) // n_terms
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item_id, i + 1, d, -s) for i, (s, _, d) in enumerate(scores[:k])]
    return sorted(out, key=str)


def found(spark, rows, items, **kw):
    got = S.search(docs(spark, rows), spark.createDataFrame(items, ITEM), **kw)
    return sorted((tuple(r) for r in got.collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["É", "été", "ABC", "x1"]
    text = lambda size: " ".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "\x00"]) for _ in range(size))
    rows = [(i, text(rng.randrange(1, 60))) for i in range(n)]
    return rows, [(i, text(rng.randrange(1, 40))) for i in range(30)], rng


def test_equals_plain_scores(spark, monkeypatch):
    rows, items, rng = corpus(1, 400)
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # ties
    rows += [(7, rows[7][1]), (None, rows[7][1]), (2000, None), (2001, ""), (2002, "!? -"), (2003, "w1 w2 " * 30_000)]
    items += [(100, None), (101, ""), (102, rows[7][1]), (102, rows[7][1]), (102, "w5"), (None, "w6 w7"), (103, "nowhere")]
    rng.shuffle(rows)
    want = plain(rows, items)
    assert found(spark, rows, items) == want
    assert found(spark, rows, items, terms_at_once=100) == want
    assert found(spark, rows, items, k=3) == plain(rows, items, 3)


def test_tiles_add_up_to_whole_scores(monkeypatch):
    rows, items, _ = corpus(2, 90)
    monkeypatch.setattr(S, "TERM_TILE", 7)
    monkeypatch.setattr(S, "ITEM_TILE", 4)
    (block,) = bytewords.blocks(pa.array([t for _, t in rows]))
    (texts,) = bytewords.blocks(pa.array([t for _, t in items]))
    r, s, e = bytewords.word_spans(texts, S.TERMS)
    hashes = bytewords.span_hashes(texts.data, s, e)
    of_items = [np.unique(hashes[r == i]) for i in range(len(items))]
    vocabulary = np.unique(hashes)
    weights = np.arange(1, len(vocabulary) + 1) * 40_000.0
    at, place, tf, _ = S.term_counts(block, vocabulary)
    impacts = 900_000 + tf
    got = np.vstack([S.tile_scores(b, at, place, impacts, len(rows)) for b in S.item_blocks(of_items, vocabulary, weights)])
    for i, own in enumerate(of_items):
        for j in range(len(rows)):
            want = sum(int(weights[p]) * int(x) for p, x, d in zip(place, impacts, at) if d == j and vocabulary[p] in own)
            assert got[i, j] == want


def test_floor_keeps_ties():
    best = S.Best.of(2, 1)
    for ids, scores in (([9, 8], [5, 5]), ([3], [5]), ([1], [4]), ([7, 2], [6, 5])):
        best.add(np.array([0]), np.array([scores]), np.zeros(len(ids), bool), np.array(ids))
    assert list(zip(best.doc.tolist(), best.score.tolist())) == [(7, 6), (2, 5)]


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == [] == found(spark, [(1, "a")], []) == found(spark, [(1, None)], [(1, "a")])
    extra = docs(spark, [(1, "a b", "x", 2)], "doc_id bigint, text string, item string, score int")
    items = spark.createDataFrame([(5, "b", 1)], ITEM + ", doc_id int")
    assert [r["item_id"] for r in S.search(extra, items).collect()] == [5]
