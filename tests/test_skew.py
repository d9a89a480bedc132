"""One key with a third of all rows: results stay whole, work stays spread out."""

import pytest
from pyspark.sql import functions as F

from docspark.operators import audit as A
from docspark.operators import blocks as B
from docspark.operators import entities as E
from docspark.operators import noise as N
from docspark.operators import routing as RO

N_ROWS = 60_000


@pytest.fixture(scope="module")
def hot_blocks(spark):
    """A document of 20,000 blocks on one page, and many small documents."""
    k = F.col("id")
    hot = k % 3 == 0
    return spark.range(N_ROWS).select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("d"), (k % 997).cast("string"))).alias("doc_id"),
        k.cast("int").alias("ord"),
        F.concat(F.lit("b"), k).alias("block_id"),
        F.when(hot, 1).otherwise((k % 7) + 1).cast("int").alias("page_number"),
        F.concat(F.lit("text "), k % 11).alias("text"),
    ).persist()


def test_offsets_on_one_hot_page(spark, hot_blocks):
    spans = B.block_offsets(hot_blocks, chunk=5000).persist()
    assert spans.count() == N_ROWS
    page = hot_blocks.filter("doc_id = 'hot'").orderBy("ord").select("block_id", "text").collect()
    want, at = {}, 0
    for r in page:
        want[r["block_id"]] = (at, at + len(r["text"]))
        at += len(r["text"]) + 1
    got = {r["block_id"]: (r["start"], r["end"]) for r in spans.filter("doc_id = 'hot'").collect()}
    assert got == want
    mentions = spans.select("doc_id", "page_number", (F.col("start") + 2).alias("char_start"), F.col("block_id").alias("want"))
    attached = E.attach_blocks(mentions, spans)
    assert attached.count() == N_ROWS and attached.filter("want <> block_id OR block_id IS NULL").isEmpty()


def test_noise_counters_of_a_hot_document(spark, hot_blocks):
    r = N.noise_counters(hot_blocks, (("seven", "7$"),)).filter("doc_id = 'hot'").first()
    want = hot_blocks.filter("doc_id = 'hot' AND text = 'text 7'").count()
    assert (r["pages_modified"], r["blocks_flagged"]) == (1, want)


def test_tree_with_one_hot_parent(spark):
    k = F.col("id")
    none = F.lit(None).cast("string")
    box = F.array().cast("array<double>")
    roots = spark.range(50).select(F.concat(F.lit("r"), k).alias("node_id"), none.alias("parent_id"), k.alias("pos"), F.lit("table").alias("kind"), F.lit(1).alias("page"), F.lit("t").alias("text"), box.alias("bbox"))
    parent = F.when(k % 3 == 0, F.lit("r0")).otherwise(F.concat(F.lit("r"), (k % 50).cast("string")))
    leaves = spark.range(30_000).select(F.concat(F.lit("l"), k).alias("node_id"), parent.alias("parent_id"), k.alias("pos"), F.lit("text").alias("kind"), F.lit(1).alias("page"), F.lit("x").alias("text"), box.alias("bbox"))
    assert B.flatten_tree(roots.unionByName(leaves)).count() == 30_050


def test_audit_of_a_hot_document(spark):
    k = F.col("id")
    doc = F.when(k % 3 == 0, F.lit(0)).otherwise(k % 500 + 1)
    cands = spark.range(30_000).select(doc.alias("doc_id"), F.concat(F.lit("t"), k).alias("text_key"), F.concat(F.lit("T"), k).alias("text"), F.lit(None).cast("string").alias("field_hint"), F.lit("b").alias("evidence_block"))
    rows = cands.filter("doc_id = 0").limit(1).select("doc_id", F.lit("F").alias("field"), "text", F.lit("b").alias("block_id")).withColumnRenamed("text", "value")
    blocks = rows.select("doc_id", "block_id", F.col("value").alias("text"))
    docs = spark.range(502).select(k.alias("doc_id"))
    out = {r["doc_id"]: r for r in A.audit(docs, cands, rows, blocks).collect()}
    assert len(out) == 502 and out[0]["candidates"] == 10_000 and out[0]["checklist_misses"] == 9_999 and out[0]["spurious"] == 0
    assert out[501]["candidates"] == 0 and out[501]["coverage_ok"] and not out[501]["gap_signal"]


def test_summary_of_one_verdict(spark):
    runs = spark.range(N_ROWS).select(F.when(F.col("id") % 3 == 0, F.lit("errored")).otherwise(F.lit("auto_accept")).alias("verdict"), F.lit(1).cast("bigint").alias("latency_ms"))
    out = RO.run_summary(runs)
    assert "partial_count" in out._jdf.queryExecution().executedPlan().toString()
    assert {r["verdict"]: r["documents"] for r in out.collect()} == {"errored": 20_000, "auto_accept": 40_000}
