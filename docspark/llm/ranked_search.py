"""Ranked lexical search by dense blocked matrix multiplication.

Items are put into blocks; the terms of a block's items are its compact
vocabulary. A tile of documents becomes a dense matrix of impacts over that
vocabulary, a block of items a dense matrix of term weights, and BLAS multiplies
the two in float64. Weights and impacts are whole numbers, and a tile of the
vocabulary is so narrow that no sum in it reaches 2**53; so the product is exact
whatever the order of its additions, and the tiles' products add up as 64-bit
integers.

``impact = (10**9 * tf) div (1000 * tf + 8 * m)`` with
``m = 100 - 90 + (90 * n * N) div L``, and a term weighs
``floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``.

Of every tile the documents are kept that no ``k`` better ones of the task push
out, equal scores by id; each task passes on ``k`` rows an item, and a window
picks the final ones. Items are broadcast in parts of at most ``TERMS_AT_ONCE``
terms, each of which is two passes over the documents: one counts, one scores.
Texts are never shuffled.

Terms are the longest runs of letters and digits, where every character beyond
ASCII counts as a letter; A-Z are lower-cased. A term is known by a 64-bit hash.
Null and empty texts have no terms and are in no result; an item without terms
has none. Rows that repeat a doc_id are documents of their own, rows that repeat
an item whole are one item; a null doc_id comes after the others of its score,
and a null item_id is an item. Long texts are scored whole. Empty tables give
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm import bytewords

#: Terms of all items that one pass over the documents broadcasts at most, 8 bytes each.
TERMS_AT_ONCE = 1_000_000
#: Rows and columns of the tiles.
ITEM_TILE, TERM_TILE, DOC_TILE = 256, 1024, 1024
#: No impact reaches this: tf / (1000 tf + 80) is less than 1 / 1000.
IMPACT_BOUND = 10**6

TERMS = bytewords.byte_table((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


@dataclass
class ItemBlock:
    """Some items, the places of their terms in the vocabulary of all, and tiles of weights."""

    numbers: np.ndarray
    local: np.ndarray
    weights: list[np.ndarray]


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, text, terms``: the sorted distinct term hashes of each different item, as bytes."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for block in bytewords.blocks(batch["text"]):
                rows, s, e = bytewords.word_spans(block, TERMS)
                hashes = bytewords.span_hashes(block.data, s, e)
                bounds = np.searchsorted(rows, np.arange(len(block) + 1))
                found += [np.unique(hashes[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch["item_id"], batch["text"], pa.array(found, pa.binary())], names=["item_id", "text", "terms"])

    return items.select("item_id", "text").distinct().mapInArrow(run, f"item_id {kind}, text string, terms binary")


def term_counts(block: bytewords.Block, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in the sorted vocabulary and count of each of its terms in a block, and all terms per row."""
    rows, s, e = bytewords.word_spans(block, TERMS)
    sizes = np.bincount(rows, minlength=len(block))
    hashes = bytewords.span_hashes(block.data, s, e)
    likely = np.zeros(1 << 16, bool)
    likely[vocabulary >> np.uint64(48)] = True
    some = likely[hashes >> np.uint64(48)]
    rows, hashes = rows[some], hashes[some]
    place = np.searchsorted(vocabulary, hashes)
    held = vocabulary[np.minimum(place, len(vocabulary) - 1)] == hashes
    keys, tf = np.unique(rows[held] * len(vocabulary) + place[held], return_counts=True)
    return keys // len(vocabulary), keys % len(vocabulary), tf, sizes


def _count(vocabulary):
    """Per task: how many documents hold each term; in the row of place -1 documents with terms, and all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        df, docs, total = np.zeros(len(words), np.int64), 0, 0
        for batch in batches:
            for block in bytewords.blocks(batch["text"]):
                _, place, _, sizes = term_counts(block, words)
                df += np.bincount(place, minlength=len(words))
                docs += int((sizes > 0).sum())
                total += int(sizes.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(held, -1), pa.int64()),
                pa.array(np.append(df[held], docs), pa.int64()),
                pa.array(np.append(np.zeros(len(held)), total).astype(np.int64), pa.int64()),
            ],
            names=["place", "docs", "total"],
        )

    return run


def item_blocks(terms: list[np.ndarray], vocabulary: np.ndarray, weights: np.ndarray) -> list[ItemBlock]:
    """Items in blocks of ``ITEM_TILE``, each with its own vocabulary in tiles of ``TERM_TILE``."""
    blocks = []
    for first in range(0, len(terms), ITEM_TILE):
        own = [np.searchsorted(vocabulary, t) for t in terms[first : first + ITEM_TILE]]
        used = np.unique(np.concatenate(own)) if own else np.zeros(0, np.int64)
        dense = np.zeros((len(own), len(used)))
        for i, places in enumerate(own):
            dense[i, np.searchsorted(used, places)] = weights[places]
        tiles = [np.ascontiguousarray(dense[:, a : a + TERM_TILE]) for a in range(0, len(used), TERM_TILE)]
        blocks.append(ItemBlock(np.arange(first, first + len(own)), used, tiles))
    return blocks


def tile_scores(block: ItemBlock, rows: np.ndarray, places: np.ndarray, impacts: np.ndarray, n_docs: int) -> np.ndarray:
    """Scores of a block's items for a tile of documents, as 64-bit integers."""
    at = np.searchsorted(block.local, places)
    held = block.local[np.minimum(at, len(block.local) - 1)] == places
    rows, at, impacts = rows[held], at[held], impacts[held]
    scores = np.zeros((len(block.numbers), n_docs), np.int64)
    for t, weights in enumerate(block.weights):
        inside = at // TERM_TILE == t
        dense = np.zeros((weights.shape[1], n_docs))
        dense[at[inside] - t * TERM_TILE, rows[inside]] = impacts[inside]
        scores += (weights @ dense).astype(np.int64)
    return scores


@dataclass
class Best:
    """The best documents of each item so far: item, score, whether the id is null, id."""

    k: int
    floor: np.ndarray
    item: np.ndarray
    score: np.ndarray
    no_id: np.ndarray
    doc: np.ndarray

    @classmethod
    def of(cls, k: int, n_items: int) -> Best:
        none = np.zeros(0, np.int64)
        return cls(k, np.ones(n_items, np.int64), none, none, none.astype(bool), none)

    def add(self, numbers: np.ndarray, scores: np.ndarray, no_id: np.ndarray, doc: np.ndarray) -> None:
        """Take in the scores of a tile; ties with the last one kept are decided by id."""
        i, j = np.nonzero(scores >= self.floor[numbers][:, None])
        if not len(i):
            return
        item = np.concatenate([self.item, numbers[i]])
        score = np.concatenate([self.score, scores[i, j]])
        null = np.concatenate([self.no_id, no_id[j]])
        ids = np.concatenate([self.doc, doc[j]])
        order = np.lexsort((ids, null, -score, item))
        item, score, null, ids = item[order], score[order], null[order], ids[order]
        first = np.searchsorted(item, item)
        rank = np.arange(len(item)) - first
        last = rank == self.k - 1
        self.floor[item[last]] = score[last]
        kept = rank < self.k
        self.item, self.score, self.no_id, self.doc = item[kept], score[kept], null[kept], ids[kept]


def _search(shared, k: int):
    """The ``k`` best documents of a task for every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, blocks, n_items, n_docs, n_terms = shared.value
        best = Best.of(k, n_items)
        for batch in batches:
            ids = batch["doc_id"].cast(pa.int64())
            null, doc = np.asarray(ids.is_null()), ids.fill_null(0).to_numpy()
            for block in bytewords.blocks(batch["text"]):
                rows, places, tf, sizes = term_counts(block, vocabulary)
                m = 100 - 90 + (90 * sizes * n_docs) // n_terms
                impacts = (10**9 * tf) // (1000 * tf + 8 * m[rows])
                for low in range(0, len(block), DOC_TILE):
                    a, b = np.searchsorted(rows, [low, low + DOC_TILE])
                    size = min(DOC_TILE, len(block) - low)
                    at = slice(block.first + low, block.first + low + size)
                    for items in blocks:
                        if len(items.local):
                            scores = tile_scores(items, rows[a:b] - low, places[a:b], impacts[a:b], size)
                            best.add(items.numbers, scores, null[at], doc[at])
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array(best.doc, pa.int64(), mask=best.no_id), pa.array(best.score)], names=["item", "doc_id", "score"]
        )

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, terms_at_once: int = TERMS_AT_ONCE) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of ``docs(doc_id, text)`` for each of ``items(item_id, text)``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    known = item_terms(items)
    held = known.agg(F.sum(F.length("terms") / 8)).collect()[0][0] or 0
    parts = max(1, int(-(-held // terms_at_once)))
    found = None
    for part in range(parts):
        some = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        rows = some.where(F.length("terms") > 0).select("item_id", "terms", F.xxhash64("text").alias("hash")).collect()
        rows.sort(key=lambda r: (r["item_id"] is not None, r["item_id"], r["hash"]))
        terms = [np.frombuffer(r["terms"], np.uint64) for r in rows]
        vocabulary = np.unique(np.concatenate(terms)) if terms else np.zeros(0, np.uint64)
        n_docs = n_terms = 0
        df = np.zeros(len(vocabulary), np.int64)
        if len(vocabulary):
            words = spark.sparkContext.broadcast(vocabulary)
            counted = docs.select("text").mapInArrow(_count(words), "place bigint, docs bigint, total bigint")
            for r in counted.groupBy("place").agg(F.sum("docs").alias("docs"), F.sum("total").alias("total")).collect():
                if r["place"] < 0:
                    n_docs, n_terms = r["docs"], r["total"]
                else:
                    df[r["place"]] = r["docs"]
        weights = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1)))
        if len(vocabulary) and weights.max() * IMPACT_BOUND * TERM_TILE >= 2**53:
            raise OverflowError(f"a tile of {TERM_TILE} terms could reach 2**53 at a weight of {weights.max():.0f}")
        if n_terms:
            shared = spark.sparkContext.broadcast((vocabulary, item_blocks(terms, vocabulary, weights), len(terms), n_docs, n_terms))
            best = docs.mapInArrow(_search(shared, k), "item bigint, doc_id bigint, score bigint")
        else:
            best = docs.limit(0).select(F.lit(0).cast("bigint").alias("item"), F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score"))
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item bigint, item_id {items.schema['item_id'].dataType.simpleString()}")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(F.broadcast(names), "item")
        top = top.select("item_id", "rank", "doc_id", "score")
        found = top if found is None else found.unionByName(top)
    return found
