import random
import re
from itertools import combinations

import pytest

from docspark.llm import decontam as D
from tests.llm.helpers import docs


@pytest.mark.parametrize("window", range(5, 14))
def test_masks_cover_every_allowed_change(window):
    for changed in combinations(range(window), D.allowed(window)):
        assert any(
            all(at + j not in changed for j, bit in enumerate(mask) if bit == "1")
            for mask in D.MASKS
            for at in range(window - len(mask) + 1)
        )


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(rows, items):
    found = {}
    for d, text in rows:
        w = words(text)
        for i, item in items:
            b = words(item)
            if len(b) < 5:
                continue
            window = min(D.WINDOW, len(b))
            for shift in range(-len(b) + 1, len(w)):
                lo, hi = max(0, shift), min(len(w), shift + len(b))
                same = [w[p] == b[p - shift] for p in range(lo, hi)]
                if any(sum(same[s : s + window]) >= window - D.allowed(window) for s in range(len(same) - window + 1)):
                    first = lo + same.index(True)
                    key = (-sum(same), shift, first)
                    if (d, i) not in found or key < found[d, i]:
                        found[d, i] = key
    return {(d, i): (first, first - shift, -n) for (d, i), (n, shift, first) in found.items()}


def result(df):
    return {(r["doc_id"], r["item_id"]): (r["doc_start"], r["item_start"], r["n_matched"]) for r in df.collect()}


def test_equals_brute_force(spark, small):
    rng = random.Random(1)
    table = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = sorted(table, key=lambda r: len(r[1]))[:60]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()][:15]
    items += [(500, "one two three four"), (501, "five six seven eight nine"), (502, None), (503, "a b c d e f g h i a b c d e f g h i")]
    for k in range(40):
        tokens = words(items[k % 15][1])
        start = rng.randrange(max(1, len(tokens) - 20))
        part = tokens[start : start + rng.randrange(8, 30)]
        part = [f"sub{rng.randrange(10**6)}" if rng.random() < 0.12 else w for w in part]
        rows.append((1000 + k, "before it, " + " ".join(part).upper() + " after."))
    rows += [(2000, None), (2001, ""), (2002, "x five six SEVEN eight nine y"), (2003, "a b c d e f g h i " * 3), (2004, "one two three four"), (2002, "x five six SEVEN eight nine y")]
    df = docs(spark, [(*r, "clash") for r in rows], "doc_id bigint, text string, item_id string")
    want = brute(rows, items)
    assert len(want) > 20
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert result(D.find(df.select("doc_id", "text"), bench)) == want
    assert result(D.find(df, bench, keys_at_once=100)) == want
    kept = D.without_benchmark(df, bench)
    bad = {d for d, _ in want}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _ in rows if d not in bad)
    assert kept.columns == df.columns


def test_plan_is_native_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "five six seven eight nine")], "item_id bigint, text string")
    df = docs(spark, [(None, "five six seven eight nine"), (None, "other")])
    found = D.find(df, bench)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
    assert [r["doc_id"] for r in found.collect()] == [None]
    assert [r["text"] for r in D.without_benchmark(df, bench).collect()] == ["other"]
    assert D.find(df.limit(0), bench).count() == 0 and D.find(df, bench.limit(0)).count() == 0
    assert D.without_benchmark(df, bench.limit(0)).count() == 2
