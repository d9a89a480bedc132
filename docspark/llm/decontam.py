"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A mask tells which tokens of a short window count. Windows of benchmark items
are hashed under each mask, and so is every window of every document; equal
hashes are hits. A hit aligns a document with an item. Around it, the aligned
tokens are compared: the document holds the item's passage if within
``window`` aligned tokens no more than the allowed number differ. The masks are
such that every passage of that kind has a hit (``allowed``).

Hashes of the items are broadcast in parts of at most ``KEYS_AT_ONCE`` keys, and
each part is one pass over the documents; so what is broadcast has a bound
however many items there are. Documents are not shuffled: only hits are.

Tokens are runs of letters and digits in lower case. Null and empty texts have
none, and items shorter than the shortest mask cannot be found. Rows with equal
id and text are one document in the result; a null id stays null; ties between
alignments go to the first one. Empty tables give an empty result; other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.sources.scratch import stage

#: Which tokens of a window count.
MASKS = ("11111", "111101")
#: Aligned tokens that are compared at once.
WINDOW = 13
#: Keys that one pass broadcasts at most, about 50 bytes each.
KEYS_AT_ONCE = 500_000


def words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def allowed(n: Column | int) -> Column | int:
    """Tokens that may differ among ``n`` aligned ones: 2 of 13, 1 of 9 to 12, none of fewer."""
    if isinstance(n, int):
        return max(0, (n - 5) // 4)
    return F.floor((n - 5) / 4).cast("int")


def _seeds(at: Column) -> Column:
    """The hash of each mask for the window that starts at a place of ``words``; null where it does not fit."""
    n = F.size("words")
    hashes = []
    for i, mask in enumerate(MASKS):
        used = [F.get("words", at + j) for j, bit in enumerate(mask) if bit == "1"]
        hashes.append(F.when(at + len(mask) <= n, F.xxhash64(F.lit(i), *used)))
    return F.array(*hashes)


def _windows(tokens: DataFrame) -> DataFrame:
    """A row per place and mask, with its hash."""
    shortest = min(len(m) for m in MASKS)
    places = F.when(F.size("words") >= shortest, F.sequence(F.lit(0), F.size("words") - shortest))
    at = tokens.select("*", F.explode_outer(places).alias("at")).where("at is not null")
    return at.select("*", F.explode_outer(_seeds(F.col("at"))).alias("seed")).where("seed is not null")


def item_keys(items: DataFrame) -> DataFrame:
    """``seed, item_id, item, q, n`` of all windows; ``item`` stands for an item with its text, so ids may repeat."""
    tokens = items.select("item_id", F.xxhash64("item_id", "text").alias("item"), words("text").alias("words")).dropDuplicates(["item"])
    return _windows(tokens).select("seed", "item_id", "item", F.col("at").alias("q"), F.size("words").alias("n"))


def _matched(doc: Column, item: Column) -> Column:
    """Places where two aligned pieces agree."""
    same = F.zip_with(doc, item, lambda x, y: x == y)
    return F.filter(F.transform(same, lambda s, i: F.when(s, i)), lambda i: i.isNotNull())


def find(docs: DataFrame, items: DataFrame, keys_at_once: int = KEYS_AT_ONCE) -> DataFrame:
    """``doc_id, text_hash, item_id, doc_start, item_start, n_matched``: the best alignment of each document and item that overlap.

    ``docs(doc_id, text)``, ``items(item_id, text)``; starts count tokens from 0
    and are those of the first token that agrees.
    """
    keys = stage(item_keys(items), "decontam-keys")
    parts = max(1, -(-keys.count() // keys_at_once))
    tokens = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words("text").alias("words"))
    seen = _windows(tokens)
    hits = []
    for part in range(parts):
        some = keys.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        joined = seen.join(F.broadcast(some), "seed")
        shift = F.col("at") - F.col("q")
        first = F.greatest(shift, F.lit(0))
        length = F.least(shift + F.col("n"), F.size("words")) - first
        hits.append(
            joined.select(
                "doc_id", "text_hash", "item", "item_id", shift.alias("shift"), first.alias("first"), F.slice("words", first + 1, length).alias("piece")
            )
        )
    aligned = (
        reduce(DataFrame.unionByName, hits)
        .groupBy("doc_id", "text_hash", "item", "shift")
        .agg(F.first("item_id").alias("item_id"), F.first("first").alias("first"), F.first("piece").alias("piece"))
    )
    texts = items.select(F.xxhash64("item_id", "text").alias("item"), words("text").alias("item_words")).dropDuplicates(["item"])
    offset = F.col("first") - F.col("shift")
    compared = aligned.join(texts, "item").select(
        "doc_id",
        "text_hash",
        "item_id",
        "shift",
        "first",
        F.size("piece").alias("n"),
        F.least(F.lit(WINDOW), F.size("item_words")).alias("window"),
        _matched(F.col("piece"), F.slice("item_words", offset + 1, F.size("piece"))).alias("places"),
    )
    need = F.col("window") - allowed(F.col("window"))
    close = F.exists(
        F.transform("places", lambda p, i: F.get("places", i + need - 1) - p),
        lambda span: span < F.col("window"),
    )
    held = compared.where((F.col("n") >= F.col("window")) & F.coalesce(close, F.lit(False)))
    best = held.groupBy("doc_id", "text_hash", "item_id").agg(
        F.max_by(F.struct("first", "shift", "places"), F.struct(F.size("places").alias("n"), (-F.col("shift")).alias("s"))).alias("b")
    )
    start = F.col("b.first") + F.element_at("b.places", 1)
    return best.select(
        "doc_id",
        "text_hash",
        "item_id",
        start.cast("bigint").alias("doc_start"),
        (start - F.col("b.shift")).cast("bigint").alias("item_start"),
        F.size("b.places").cast("bigint").alias("n_matched"),
    )


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that overlap an item."""
    found = stage(find(docs, items).select("doc_id", "text_hash").distinct(), "decontam-found")
    marked = docs.withColumn("_hash", F.xxhash64("text"))
    same = marked["doc_id"].eqNullSafe(found["doc_id"]) & (marked["_hash"] == found["text_hash"])
    return marked.join(found, same, "left_anti").drop("_hash")
