import hashlib
import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from docspark.llm import sharding as S
from tests.llm.helpers import docs


def test_law_of_keys(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    got = S.assign(df, 16, rows_per_chunk=100).collect()
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) < 1.12 * 1250 and min(counts.values()) > 0.88 * 1250
    assert all(r["grown_shard"] in (r["shard"], 16) for r in got)
    moved = sum(r["grown_shard"] == 16 for r in got)
    assert 0.85 < moved / (20_000 / 17) < 1.15
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))


def test_changed_weights_move_rows_only_into_grown_subtrees(spark):
    df = spark.range(5_000).select(F.col("id").cast("string").alias("k"))
    before, after = S.tree(16), S.tree(16, weights=[1.0] * 5 + [3.0] + [1.0] * 10)
    rows = df.select(S.descend(F.col("k"), before).alias("a"), S.descend(F.col("k"), after).alias("b")).collect()
    changed = [(r["a"], r["b"]) for r in rows if r["a"] != r["b"]]
    assert changed
    region, rack = (lambda s: s // 4), (lambda s: s // 2)
    for a, b in changed:  # into the region, the rack and the shard that grew, one level at a time
        assert region(b) == 1 if region(a) != 1 else (rack(b) == 2 if rack(a) != 2 else b == 5)


def plain_descent(key, node, path=""):
    """The way of a key by the definition of the draws, in plain Python."""
    if not node.children:
        return node.shard

    def draw(child):
        digits = hashlib.md5(f"{key}|{path}/{child.name}".encode()).hexdigest()[:13]
        return -math.log((int(digits, 16) + 0.5) / 2**52) / child.weight

    won = min(node.children, key=draw)
    return plain_descent(key, won, f"{path}/{won.name}")


def test_every_row_of_a_table_by_the_definition(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in table.collect()}
    for weights in (None, [1.0, 2.5, 0.25, 4.0] * 4):
        first, grown = S.tree(16, weights=weights), S.tree(17, weights=[*weights, 1.0] if weights else None)
        got = S.assign(table, 16, weights).collect()
        assert len(got) == len(texts)
        for r in got:
            text = texts[r["doc_id"]]
            want = (plain_descent(r["doc_id"], first), plain_descent(r["doc_id"], grown), len(text) + 1, zlib.crc32(text))
            assert (r["shard"], r["grown_shard"], r["size"], r["text_crc32"]) == want


def test_odd_rows(spark):
    rows = [(1, None, 5), (None, "é" * 10, 6), (None, "é" * 10, 6), (2, "", 7), (3, "x" * 300_000, 8)]
    got = S.assign(docs(spark, rows, "doc_id bigint, text string, shard bigint"), 4).collect()
    sizes = sorted((r["size"], r["text_crc32"]) for r in got)
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, _ in rows)
    assert sizes == want and len(got) == 5
    assert S.assign(docs(spark, []), 4).count() == 0
