import random

from pyspark.sql import functions as F

from docspark.functions.text import joined_match_keys, match_key
from docspark.operators import locate as L
from docspark.operators import search as SE

WORDS = ["al", "be", "ce", "de", "ef"]


def brute_passage(words, doc):
    n, k = len(words), min(len(words), 6)
    at = [i for i in range(len(doc) - n + 1) if doc[i : i + n] == words]
    if at:
        return ("exact", at[0], at[0] + n)
    heads = [i for i in range(len(doc) - k + 1) if doc[i : i + k] == words[:k]]
    if heads:
        return ("prefix", heads[0], min(heads[0] + n, len(doc)))
    tails = [i for i in range(len(doc) - k + 1) if doc[i : i + k] == words[-k:]]
    if tails:
        return ("suffix", max(tails[-1] + k - n, 0), tails[-1] + k)
    return None


def test_passages_equal_brute_force(spark):
    rng = random.Random(5)
    docs = {i: [rng.choice(WORDS[:3]) for _ in range(rng.randint(0, 60))] for i in range(40)}
    items = {}
    for i in range(60):
        n = rng.choice([1, 2, 5, 6, 7, 11, 12, 13, 20])
        source = docs[rng.randrange(40)]
        at = rng.randrange(max(1, len(source) - n + 1))
        w = source[at : at + n] or ["zz"]
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = rng.choice(["al", "zz"])
        items[i] = w
    items[99] = []
    d = spark.createDataFrame([(i, ", ".join(w).upper()) for i, w in docs.items()], "doc_id int, text string")
    p = spark.createDataFrame([(i, "  ".join(w)) for i, w in items.items()], "item_id int, text string")
    got = {(r["item_id"], r["doc_id"]): (r["found"], r["first_word"], r["end_word"]) for r in L.locate_passages(p, d).collect()}
    want = {}
    for i, w in items.items():
        for j, doc in docs.items():
            hit = brute_passage(w, doc) if w else None
            if hit:
                want[i, j] = hit
    assert got == want and len(want) > 50
    spread = L.locate_passages(p, d, rows_per_task=5).collect()
    assert {(r["item_id"], r["doc_id"]): (r["found"], r["first_word"], r["end_word"]) for r in spread} == want
    assert L.locate_passages(p.limit(0), d).count() == 0 == L.locate_passages(p, d.limit(0)).count()


def test_few_runs_leave_their_task(spark):
    words = [f"w{i}" for i in range(30_000)]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id int, text string")
    passages = spark.createDataFrame([(i, " ".join(words[i * 100 : i * 100 + 12])) for i in range(100)], "item_id int, text string")
    kept = []
    write = L.stage
    L.stage = lambda df, name: kept.append(write(df, name)) or kept[-1]
    try:
        assert L.locate_passages(passages, docs).filter("found = 'exact'").count() == 100
    finally:
        L.stage = write
    assert 200 <= kept[1].count() < 230  # of 30,000


def test_runs_are_keyed_without_building_their_text(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id int, text string")
    passages = spark.createDataFrame([(1, "b c d e f g")], "item_id int, text string")
    plans = []
    write = L.stage
    L.stage = lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, name)
    try:
        assert [tuple(r) for r in L.locate_passages(passages, docs).collect()] == [(1, 1, "exact", 1, 7)]
    finally:
        L.stage = write
    assert "xxhash64" in plans[1] and "array_join" not in plans[1] and "slice(" not in plans[1]


def test_passage_of_a_third_of_all_documents(spark):
    hot = " ".join(f"w{i}" for i in range(14))
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(f"x {hot} y")).otherwise(F.concat(F.lit("u"), "id")).alias("text")
    )
    items = spark.createDataFrame([(1, hot), (2, hot + " z"), (3, "absent words")], "item_id int, text string")
    out = L.locate_passages(items, docs)
    got = {(r["item_id"], r["found"]): r["count"] for r in out.groupBy("item_id", "found").count().collect()}
    assert got == {(1, "exact"): 1000, (2, "prefix"): 1000}
    many = spark.range(400).select(F.col("id").alias("item_id"), F.concat(F.lit(hot), F.lit(" n"), "id").alias("text"))
    spread = L.locate_passages(many, docs, rows_per_task=100)
    assert spread.groupBy("found").count().collect() == [("prefix", 400 * 1000)]
    assert "Cartesian" not in out._jdf.queryExecution().executedPlan().toString()


def brute_block(text, words):
    norm = lambda s: " ".join(s.lower().replace(".", " ").replace(",", " ").replace("-", " ").split())
    keys = [norm(w) for w in words]
    line, owner = "", []
    for i, k in enumerate(keys):
        if i:
            line += " "
            owner.append(i - 1)
        line += k
        owner += [i] * len(k)
    t = norm(text)
    if not t:
        return (None, None, None)
    n, at = len(t.split()), line.find(t)
    if at >= 0:
        return ("exact", owner[at], owner[at + len(t) - 1])
    head, tail = " ".join(t.split()[:6]), " ".join(t.split()[-6:])
    at = line.find(head)
    if at >= 0:
        return ("prefix", owner[at], min(owner[at] + n - 1, len(words) - 1))
    at = line.rfind(tail)
    if at >= 0:
        e = owner[at + len(tail) - 1]
        return ("suffix", max(e - n + 1, 0), e)
    return (None, None, None)


def test_blocks_equal_brute_force(spark):
    rng = random.Random(9)
    pages, blocks = {}, []
    for p in range(1, 9):
        pages[p] = [rng.choice(["al", "Be.", "c-e", "de,", "EF"]) for _ in range(rng.randint(3, 40))]
        for b in range(12):
            n = rng.randint(1, 14)
            at = rng.randrange(len(pages[p]))
            w = pages[p][at : at + n]
            kind = rng.randrange(4)
            w = w + ["zz"] if kind == 1 else ["zz"] + w if kind == 2 else w
            blocks.append(("d", p, f"{p}-{b}", " ".join(w)))
        blocks.append(("d", p, f"{p}-e", " . "))
    words = spark.createDataFrame([("d", p, i, w) for p, ws in pages.items() for i, w in enumerate(ws)], "doc_id string, page_number int, idx int, word string")
    df = spark.createDataFrame(blocks, "doc_id string, page_number int, block_id string, text string")
    got = {r["block_id"]: (r["found"], r["first_word"], r["last_word"]) for r in L.locate_blocks(df, L.page_words(words)).collect()}
    assert got == {b: brute_block(t, pages[p]) for _, p, b, t in blocks}
    assert {v[0] for v in got.values()} == {"exact", "prefix", "suffix", None}


def test_boxes_are_normalised_and_clamped(spark):
    ranges = spark.createDataFrame([("d", 1, "b", "exact", 0, 1), ("d", 1, "n", None, None, None)], "doc_id string, page_number int, block_id string, found string, first_word int, last_word int")
    boxes = spark.createDataFrame(
        [("d", 1, 0, -5.0, 10.0, 40.0, 20.0, 100.0, 200.0), ("d", 1, 1, 50.0, 12.0, 130.0, 30.0, 100.0, 200.0)],
        "doc_id string, page_number int, idx int, x0 double, y0 double, x1 double, y1 double, page_w double, page_h double",
    )
    assert [tuple(r) for r in L.range_boxes(ranges, boxes).collect()] == [("d", 1, "b", 0.0, 0.05, 1.0, 0.15)]


def test_ranges_meet_stretches_of_boxes(spark):
    """Ranges over several stretches, gaps and words without a box; a range meets its stretches, not each word."""
    at = [i for i in range(300) if i % 7]
    boxes = spark.createDataFrame([("d", 1, i, i / 1000, 0.5, i / 1000 + 0.1, 0.6, 1.0, None) for i in at], "doc_id string, page_number int, idx int, x0 double, y0 double, x1 double, y1 double, page_w double, page_h double")
    spans = [(0, 0), (1, 1), (60, 70), (5, 290), (63, 64), (299, 305), (400, 410), (70, 65)]
    ranges = spark.createDataFrame([("d", 1, f"{a}-{b}", "exact", a, b) for a, b in spans], "doc_id string, page_number int, block_id string, found string, first_word int, last_word int")
    out = L.range_boxes(ranges, boxes)
    inside = {f"{a}-{b}": [i for i in at if min(a, b) <= i <= max(a, b)] for a, b in spans}
    assert {r["block_id"]: (r["x0"], r["x1"]) for r in out.collect()} == {k: (v[0] / 1000, v[-1] / 1000 + 0.1) for k, v in inside.items() if v}
    assert L.STRETCH > 1 and "FLOOR((cast(idx" in out._jdf.queryExecution().optimizedPlan().toString()


def test_words_of_a_page_are_keyed_together(spark):
    """As each word by itself, also for words of marks alone, null words and Greek capitals at an end."""
    words = ["Ab.", "(", None, "x-Y", "", "\u039f\u03a3", "\u03a3", "a  b", "\u200b\u3000Q", "..."]
    df = spark.createDataFrame([(words,), ([],), (words[1:2],), (words[::-1],)], "w array<string>")
    one_by_one = F.array_join(F.transform("w", match_key), "\x01")
    rows = df.select(joined_match_keys(F.col("w"), "\x01").alias("a"), one_by_one.alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows] and rows[0]["a"].startswith("ab\x01\x01\x01x y\x01")


def test_search_first_hits_of_a_large_document(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("doc_id"),
        F.col("id").cast("int").alias("ord"),
        F.concat(F.lit("b"), "id").alias("block_id"),
        F.lit(1).alias("page_number"),
        F.lit("page_1").alias("section_path"),
        F.lit("a.B and A.b, a.b; acb").alias("text"),
    )
    out = SE.text_search(df, "A.B", 4)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    hot = [(r["ord"], r["match_start"], r["match_end"]) for r in out.filter("doc_id = 'hot'").orderBy("rank").collect()]
    assert hot == [(0, 0, 3), (0, 8, 11), (0, 13, 16), (3, 0, 3)]
    assert SE.text_search(df, "A.B", None).filter("doc_id = 'hot'").count() == 3 * df.filter("doc_id = 'hot'").count()
    for bad in (0, -1):
        try:
            SE.text_search(df, "x", bad)
            raise AssertionError("expected ValueError")
        except ValueError:
            pass


def test_search_for_a_table_of_queries(spark):
    rows = [("d", 0, "b0", 1, "p", "İİİ the cat. The CAT?"), ("d", 1, "b1", 1, "p", "no"), ("e", 0, "b0", 1, "p", None)]
    df = spark.createDataFrame(rows, "doc_id string, ord int, block_id string, page_number int, section_path string, text string")
    asked = spark.createDataFrame([("the",), ("cat",), ("cat",), ("",), (None,), ("cat?",), ("nowhere",), ("cat. xyz",)], "query string")
    want = [("cat", 8, 11), ("cat", 17, 20), ("cat?", 17, 21), ("the", 4, 7), ("the", 13, 16)]
    for size in (100, 1):
        found = SE.search_all(df, asked, grams_at_once=size)
        assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["query"], r["match_start"], r["match_end"]) for r in found.collect()) == want
    short = spark.createDataFrame([("?",), ("no",), ("the",)], "query string")
    got = sorted((r["query"], r["match_start"]) for r in SE.search_all(df, short).collect())
    assert got == [("?", 20), ("no", 0), ("the", 4), ("the", 13)]
    assert SE.search_all(df, asked.limit(0)).count() == 0 == SE.search_all(df.limit(0), asked).count()


def test_blocks_are_read_once_to_search_for_a_table_of_queries(spark, tmp_path, monkeypatch):
    """The keys of the queries follow from the queries alone; all lengths and wide characters meet."""
    texts = ["a \U0001F600 smile, and a SMILE AGAIN", "smile again " * 3, "ile"]
    rows = [("d", i, f"b{i}", 1, "p", t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id string, ord int, block_id string, page_number int, section_path string, text string").write.parquet(f"{tmp_path}/blocks")
    read: list[str] = []
    monkeypatch.setattr(SE, "stage", lambda df, name: read.extend(df.inputFiles()) or df)
    asked = spark.createDataFrame([("ile",), ("\U0001F600 s",), ("smile again",), ("smile agony",)], "query string")
    found = SE.search_all(spark.read.parquet(f"{tmp_path}/blocks"), asked)
    scans = found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    got = sorted((r["ord"], r["query"], r["match_start"]) for r in found.collect())
    assert got == sorted((i, q, m) for i, t in enumerate(texts) for q in ("ile", "\U0001F600 s", "smile again") for m in range(len(t)) if t.lower().startswith(q, m))
    assert not any("/blocks/" in f for f in read) and scans == 1


def test_state_read_allows_three_tables(spark):
    df = spark.range(1)
    assert SE.state_read({"doc_profile": df}, "doc_profile") is df
    try:
        SE.state_read({"x": df}, "x")
        raise AssertionError("expected KeyError")
    except KeyError:
        pass
