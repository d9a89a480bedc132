import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from docspark.operators import blocks as B
from docspark.operators import noise as N
from docspark.operators import roles as R

BLOCKS = "doc_id string, ord int, block_id string, page_number int, section_path string, text string"
NOISE = [
    "** INBOUND NOTIFICATION : FAX RECEIVED SUCCESSFULLY **",
    "TIME RECEIVED   REMOTE CSID   DURATION   PAGES   STATUS",
    "08.27.2025 14:02:11 Page: 1 of 2 Sender: Lab Recipient: +15551234567",
    "Page: 2 of 2 Sender: Some Lab Recipient: +15551234567",
    "August 26, 2025 at 4:42:57 PM PDT      Some Lab       91   2   Received",
]
CLEAN = [
    "Collection Date: 08/12/2025 01:00:00 PM",
    "Received Date: 08/13/2025 01:15:00 PM PDT",
    "Report Date: 08/26/2025 07:41:01 PM ET",
    "Page 1 of 2",
    "",
    "   ",
]


def block_rows(texts, doc="d", per_page=3):
    return [(doc, i, f"b{i}", i // per_page + 1, f"page_{i // per_page + 1}/paragraph", t) for i, t in enumerate(texts)]


def expected_spans(rows, excluded=()):
    out = {}
    for d, _, b, p, _, t in rows:
        text, spans = out.setdefault((d, p), ["", []])
        t = (t or "").strip()
        if b in excluded or not t:
            continue
        start = len(text) + 1 if text else 0
        out[(d, p)][0] = text + "\n" + t if text else t
        spans.append((b, start, start + len(t)))
    return out


def as_dict(pages):
    return {(r["doc_id"], r["page_number"]): [r["text"], [tuple(s)[:3] for s in r["block_spans"]]] for r in pages.collect()}


def test_spans_with_blanks_exclusion_and_unicode(spark):
    rows = block_rows(["  lead", "", "trail \t", None, "naïve é", "\xa0nb\xa0", "x", " ", "漢字 text", "last"])
    df = spark.createDataFrame(rows, BLOCKS)
    assert as_dict(B.pages_from_blocks(df)) == expected_spans(rows)
    dropped = {"b0", "b4"}
    pages = B.pages_from_blocks(df, drop=lambda b: b["block_id"].isin(*dropped))
    assert as_dict(pages) == expected_spans(rows, dropped)
    for r in pages.collect():
        assert len(r["block_ids"]) in (1, 3)


def test_both_ways_to_pages_and_windowed_spans_agree(spark):
    rng = random.Random(1)
    texts = ["\n".join(rng.choice(["", "a b", " c ", "é", "long line here"]) for _ in range(rng.randint(1, 23))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    in_row = as_dict(B.pages_from_text(docs))
    blocks = B.blocks_from_text(docs)
    assert in_row == as_dict(B.pages_from_blocks(blocks))
    spans = {tuple(r) for r in B.span_rows(B.pages_from_text(docs)).collect()}
    for chunk in (2, 10_000):
        assert spans == {tuple(r) for r in B.block_offsets(blocks, chunk).collect()}
    prompts = {r["doc_id"]: r["prompt"] for r in B.doc_prompt(B.pages_in_row(docs)).collect()}
    assert prompts == {r["doc_id"]: r["prompt"] for r in B.doc_prompt(B.collect_pages(B.pages_from_text(docs))).collect()}


def test_prompt_with_hints(spark):
    pages = spark.createDataFrame([("d", [(1, " hi "), (2, "  ")])], "doc_id string, pages array<struct<page_number:int,text:string>>")
    hints = F.array(F.struct(F.lit("Vendor_Name").alias("field_name"), F.lit("see b2").alias("hint")))
    text = B.doc_prompt(pages, hints).first()["prompt"]
    assert text == (
        "Source document: doc_id=d, total_pages=2\n\n**Hints from the previous attempt:**\n  - Vendor_Name: see b2\n"
        "\n---\n## Page 1\nhi\n\n## Page 2\n(empty)\n"
    )


def test_noise_lines_and_look_alikes(spark):
    rows = block_rows(NOISE + CLEAN)
    df = spark.createDataFrame(rows, BLOCKS)
    found = {r["text"]: r["noise"] for r in N.noise_blocks(df).collect()}
    assert list(found) and set(found) == set(NOISE)
    assert [found[t] for t in NOISE] == ["banner", "col_header", "timestamp", "page_of", "status_row"]
    counts = N.noise_counters(df).first()
    assert (counts["pages_modified"], counts["blocks_flagged"]) == (2, 5)
    left = N.without_blocks(df, N.noise_blocks(df))
    assert left.count() == len(CLEAN)


def test_strip_noise_lines_keeps_ends(spark):
    text = "keep\r\n" + NOISE[0] + "\n\nend " + NOISE[2]
    r = N.strip_noise_lines(spark.createDataFrame([("d", text)], "doc_id string, text string")).first()
    lines = text.splitlines(keepends=True)
    assert r["text"] == "".join(x for x in lines if x.strip() not in NOISE)
    assert [text[a:b] for a, b in r["removed"]] == [NOISE[0] + "\n", NOISE[2]]


def test_tree_order_and_empty_nodes(spark):
    schema = "node_id string, parent_id string, pos int, kind string, page int, text string, bbox array<double>"
    nodes = [
        ("a", None, 0, "table", 2, None, None),
        ("a1", "a", 1, "text", 2, "second", None),
        ("a0", "a", 0, "text", 2, "first", None),
        ("a0x", "a0", 0, "text", 2, "", [0.0, 0.0, 1.0, 1.0]),
        ("b", None, 1, "text", None, "root two", None),
    ]
    df = spark.createDataFrame(nodes, schema)
    out = [(r["node_id"], r["path"]) for r in B.flatten_tree(df).orderBy("order_key").collect()]
    assert out == [
        ("a0", "page_2/table/text"),
        ("a0x", "page_2/table/text/text"),
        ("a1", "page_2/table/text"),
        ("b", "page_1/text"),
    ]
    assert B.loose_nodes(df.unionByName(spark.createDataFrame([("x", "gone", 0, "text", 1, "lost", None)], schema))).first()["node_id"] == "x"


def test_trees_of_any_depth(spark):
    schema = "node_id string, parent_id string, pos int, kind string, page int, text string, bbox array<double>"
    chain = [(f"n{i}", f"n{i - 1}" if i else None, 0, "text", 1, f"t{i}" if i % 50 == 0 else "", None) for i in range(201)]
    rounds, write = [], B.stage
    B.stage = lambda df, name: rounds.append(name) or write(df, name)
    try:
        deep = B.flatten_tree(spark.createDataFrame(chain, schema)).collect()
    finally:
        B.stage = write
    assert len(rounds) == 1 + 8  # 2**8 > 200
    assert sorted(len(r["order_key"]) for r in deep) == [1, 51, 101, 151, 201]
    loop = [("r", None, 0, "text", 1, "r", None), ("a", "r", 0, "text", 1, "a", None), ("a", "a", 0, "text", 1, "a", None)]
    ring = [(f"n{i}", f"n{(i + 1) % 3}", 0, "text", 1, "", None) for i in range(3)]
    for bad in (loop, ring):
        with pytest.raises(ValueError):
            B.flatten_tree(spark.createDataFrame(bad, schema))
    twice = [("r", None, 0, "text", 1, "r", None), ("r", None, 0, "text", 1, "r", None), ("a", "r", 0, "text", 1, "a", None), (None, "r", 1, "text", 1, "n", None)]
    got = B.flatten_tree(spark.createDataFrame(twice, schema)).collect()
    assert sorted(r["text"] for r in got) == ["a", "n", "r", "r"]
    assert B.flatten_tree(spark.createDataFrame([], schema)).count() == 0


def test_batches_of_one_very_large_document(spark):
    big = spark.range(50_000).select(F.lit("hot").alias("doc_id"), (F.col("id") * 3).cast("int").alias("ord"))
    small = spark.range(700).select(F.concat(F.lit("d"), (F.col("id") % 2).cast("string")).alias("doc_id"), F.col("id").cast("int").alias("ord"))
    out = R.batches(big.unionByName(small)).groupBy("doc_id", "batch").count().collect()
    sizes = {}
    for r in out:
        sizes.setdefault(r["doc_id"], {})[r["batch"]] = r["count"]
    assert sizes["hot"] == {i: 300 if i < 166 else 200 for i in range(167)}
    assert sizes["d0"] == {0: 300, 1: 50} and sizes["d1"] == {0: 300, 1: 50}


def test_model_scorer_gets_batches_without_noise(spark):
    rows = block_rows(["Final Report", NOISE[0], "x" * 700] + ["body"] * 7)
    df = spark.createDataFrame(rows, BLOCKS)

    def scorer(pdf):
        assert len(pdf) <= 4 and not pdf["text"].str.contains("INBOUND").any() and pdf["text"].str.len().max() <= 700
        out = pdf[["doc_id", "block_id", "page_number"]].copy()
        out["text_role"], out["confidence"], out["rationale"] = "other", 0.5, "model"
        out["hints"] = [["none"]] * len(out)
        return out

    noise = N.is_noise(F.col("text"))
    profiles, wrong = R.profile_with_model(df, noise, scorer, size=4)
    assert wrong.isEmpty()
    assert R.parity_violations(df, profiles).isEmpty() and R.vocabulary_violations(profiles).isEmpty()
    merged = R.merge_in_order(df, profiles).orderBy("ord").collect()
    assert [r["ord"] for r in merged] == list(range(10))
    assert [r["text_role"] for r in merged].count("fax_transport_noise") == 1
    bad = profiles.withColumn("hints", F.array(F.lit("none"), F.lit("report_metadata")))
    assert {r["problem"] for r in R.vocabulary_violations(bad).collect()} == {"none not alone"}
    assert [r["problem"] for r in R.parity_violations(df, profiles.filter("block_id <> 'b3'")).collect()] == ["missing"]


def test_wrong_scores_are_set_apart(spark):
    df = spark.createDataFrame(block_rows(["Final Report"] + ["body"] * 5), BLOCKS)

    def scorer(pdf):
        out = pdf[["doc_id", "block_id", "page_number"]].copy()
        out["text_role"], out["confidence"], out["rationale"] = "other", 0.5, "model"
        out["hints"] = [["none"]] * len(out)
        ids = list(out["block_id"])
        out.loc[out["block_id"] == ids[0], "confidence"] = 7.0
        out.loc[out["block_id"] == ids[1], "block_id"] = "made-up"
        return pd.concat([out, out[out["block_id"] == ids[2]]])

    accepted, wrong = R.profile_with_model(df, F.lit(False), scorer, size=100)
    problems = sorted(r["problem"] for r in wrong.collect())
    assert problems == ["confidence", "count", "extra", "missing"]
    assert accepted.count() == 3
    long = R.scorer_payload(spark.createDataFrame(block_rows(["x" * 700]), BLOCKS), max_chars=600).first()["text"]
    assert len(long) == 601
