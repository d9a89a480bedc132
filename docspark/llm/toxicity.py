"""Toxicity by the nearest labelled examples, searched exactly with a block-max inverted index.

Terms are words and word beginnings, in lower case. The vocabulary is the terms
that stand in toxic examples more often than chance allows; a text is the TF-IDF
vector of those it holds, with document frequencies from all documents. The
nearest examples by cosine vote, each with the square of its cosine, and a
monotone step function fitted on the examples themselves, each left out of its
own vote, turns votes into probabilities. The neighbours are the evidence.

Examples are numbered so that alike ones stand together, in blocks. For each
term and block the index holds the largest weight; so a text has an upper bound
for every block. Blocks are scored in the order of their bounds until the next
bound is below the cosine of the last neighbour: no example that belongs to the
nearest is missed, and equal cosines go by the number of the example.

The index is fitted on at most ``PER_CLASS`` labelled documents of each class,
those with the smallest hash of the id, and at most ``MAX_TERMS`` terms; a vote
counts for as many documents as its class has to each of the sample. Document
frequencies and scores come from every text, whole.

A text without any term of the vocabulary, such as a null or empty one, has no
neighbours and gets the rate of such texts among the examples. Rows without a
label or id are not learned from; repeated rows count as often as they stand
there. Without labels every score is 0. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm import bytewords
from docspark.llm.quality import WORDS, _lower_latin
from docspark.sources.scratch import stage

#: Labelled documents of each class that the index holds at most.
PER_CLASS = 5000
#: Terms of the vocabulary at most, the most telling ones.
MAX_TERMS = 4096
#: A term belongs to the vocabulary from so many deviations above chance, such a share of toxic holders and so many holders.
SURE, SHARE, HOLDERS = 5.0, 0.4, 3
#: Lengths in bytes of the word beginnings that are terms.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Neighbours that vote.
NEIGHBOURS = 15
#: Examples of a block of the index, and blocks that are scored at once.
BLOCK, AT_ONCE = 32, 4
#: Weight of the rate of texts without terms in every vote.
PRIOR_WEIGHT = 0.3
#: Documents are called toxic from this score on.
TOXIC = 0.3


def terms_of(block: bytewords.Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every term of a block of texts."""
    low = _lower_latin(block)
    rows, s, e = bytewords.word_spans(low, WORDS)
    found = [(rows, bytewords.span_hashes(low.data, s, e))]
    for length in BEGINNINGS:
        longer = e - s > length
        found.append((rows[longer], bytewords.mix(bytewords.span_hashes(low.data, s[longer], s[longer] + length) + np.uint64(length))))
    return np.concatenate([r for r, _ in found]), np.concatenate([h for _, h in found])


def counts_of(block: bytewords.Block, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in the sorted vocabulary and count of each of its terms in a block."""
    if not len(vocabulary):
        none = np.zeros(0, np.int64)
        return none, none, none
    rows, hashes = terms_of(block)
    likely = np.zeros(1 << 16, bool)
    likely[vocabulary >> np.uint64(48)] = True
    some = likely[hashes >> np.uint64(48)]
    rows, hashes = rows[some], hashes[some]
    place = np.searchsorted(vocabulary, hashes)
    held = vocabulary[np.minimum(place, len(vocabulary) - 1)] == hashes
    keys, tf = np.unique(rows[held] * len(vocabulary) + place[held], return_counts=True)
    return keys // len(vocabulary), keys % len(vocabulary), tf


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all half-open ranges, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum()) if len(sizes) else np.zeros(0, np.int64)


def unit_vector(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of one text, of length 1."""
    w = (1 + np.log(tf)) * idf
    return w / np.sqrt((w * w).sum())


@dataclass
class Index:
    """Examples by number: vectors by example, the largest weight by term and block, ids, labels and class weights."""

    vocabulary: np.ndarray
    idf: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    term_starts: np.ndarray
    term_blocks: np.ndarray
    term_most: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    counts_for: np.ndarray
    prior: float
    steps: np.ndarray
    levels: np.ndarray

    def __post_init__(self) -> None:
        self.query = np.zeros(len(self.vocabulary))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the ``k`` nearest examples with a cosine above 0, equal ones by number."""
        at = _ranges(self.term_starts[terms], self.term_starts[terms + 1])
        sizes = self.term_starts[terms + 1] - self.term_starts[terms]
        n_blocks = -(-len(self.ids) // BLOCK)
        bounds = np.bincount(self.term_blocks[at], weights=self.term_most[at] * np.repeat(weights, sizes), minlength=n_blocks)
        blocks = np.flatnonzero(bounds > 0)
        blocks = blocks[np.argsort(-bounds[blocks], kind="stable")]
        best, cosines = np.zeros(0, np.int64), np.zeros(0)
        self.query[terms] = weights
        for low in range(0, len(blocks), AT_ONCE):
            some = blocks[low : low + AT_ONCE]
            if len(best) == k and bounds[some[0]] + 1e-9 < cosines[-1]:
                break
            numbers = (some[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            numbers = numbers[(numbers < len(self.ids)) & (numbers != without)]
            entries = _ranges(self.starts[numbers], self.starts[numbers + 1])
            row = np.repeat(np.arange(len(numbers)), self.starts[numbers + 1] - self.starts[numbers])
            scores = np.bincount(row, weights=self.weights[entries] * self.query[self.terms[entries]], minlength=len(numbers))
            held = scores > 0
            best, cosines = np.concatenate([best, numbers[held]]), np.concatenate([cosines, scores[held]])
            order = np.lexsort((best, -cosines))[:k]
            best, cosines = best[order], cosines[order]
        self.query[terms] = 0
        return best, cosines

    def vote(self, near: np.ndarray, cosines: np.ndarray) -> float:
        """The share of toxic votes, each with the square of its cosine."""
        w = cosines**2 * self.counts_for[near]
        return float(((w * self.labels[near]).sum() + PRIOR_WEIGHT * self.prior) / (w.sum() + PRIOR_WEIGHT))

    def calibrated(self, votes: np.ndarray) -> np.ndarray:
        """Probabilities, by straight lines between the levels of the steps."""
        return np.interp(votes, self.steps, self.levels) if len(self.steps) else votes


def _monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean place and level of the steps of the best rising fit of ``y``."""
    pools: list[list[float]] = []
    for i in np.argsort(x, kind="stable"):
        pools.append([x[i] * w[i], y[i] * w[i], w[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    sums = np.array(pools)
    return sums[:, 0] / sums[:, 2], sums[:, 1] / sums[:, 2]


def build(vocabulary: np.ndarray, idf: np.ndarray, ids: np.ndarray, labels: np.ndarray, terms: list[np.ndarray], tfs: list[np.ndarray], class_weight: dict[int, float]) -> Index:
    """The index of examples given by the places and counts of their terms."""
    counts_for = np.array([class_weight[int(y)] for y in labels])
    bare = np.array([not len(t) for t in terms], bool)
    none = counts_for[bare]
    prior = float((none * labels[bare]).sum() / none.sum()) if len(none) else float((counts_for * labels).sum() / max(counts_for.sum(), 1e-9))
    # alike examples together: by their heaviest term, then by label
    vectors = [unit_vector(tf, idf[t]) if len(t) else np.zeros(0) for t, tf in zip(terms, tfs)]
    heaviest = np.array([t[np.argmax(v)] if len(t) else -1 for t, v in zip(terms, vectors)], np.int64)
    order = np.lexsort((ids, labels, heaviest))
    order = order[~bare[order]]
    sizes = np.array([len(terms[i]) for i in order], np.int64)
    flat_terms = np.concatenate([terms[i] for i in order]).astype(np.int64) if len(order) else np.zeros(0, np.int64)
    flat = np.concatenate([vectors[i] for i in order]) if len(order) else np.zeros(0)
    in_block = np.repeat(np.arange(len(order)) // BLOCK, sizes)
    n_blocks = max(1, -(-len(order) // BLOCK))
    keys, place = np.unique(flat_terms * n_blocks + in_block, return_inverse=True)
    most = np.zeros(len(keys))
    np.maximum.at(most, place, flat)
    index = Index(
        vocabulary,
        idf,
        np.concatenate([[0], np.cumsum(sizes)]),
        flat_terms,
        flat,
        np.searchsorted(keys, np.arange(len(vocabulary) + 1) * n_blocks),
        keys % n_blocks,
        most,
        ids[order],
        labels[order].astype(float),
        counts_for[order],
        prior,
        np.zeros(0),
        np.zeros(0),
    )
    votes = np.full(len(ids), prior)
    for number, i in enumerate(order):
        votes[i] = index.vote(*index.nearest(terms[i], vectors[i], NEIGHBOURS, without=number))
    if len(ids):
        index.steps, index.levels = _monotone(votes, labels.astype(float), counts_for)
    return index


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct term hashes of each example, with their counts."""
    for batch in batches:
        for block in bytewords.blocks(batch["text"]):
            rows, hashes = terms_of(block)
            order = np.lexsort((hashes, rows))
            rows, hashes = rows[order], hashes[order]
            first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])])) if len(rows) else np.zeros(0, np.int64)
            tf = np.diff(np.append(first, len(rows)))
            bounds = pa.array(np.searchsorted(rows[first], np.arange(len(block) + 1)).astype(np.int32))
            n = len(block)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].slice(block.first, n),
                    batch["label"].slice(block.first, n),
                    pa.ListArray.from_arrays(bounds, pa.array(hashes[first].view(np.int64))),
                    pa.ListArray.from_arrays(bounds, pa.array(tf.astype(np.int32))),
                ],
                names=["doc_id", "label", "terms", "tf"],
            )


def _within(vocabulary):
    """Examples with the places of the terms that are in the vocabulary instead of all hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        for batch in batches:
            hashes = batch["terms"].flatten().to_numpy().view(np.uint64)
            place = np.searchsorted(words, hashes)
            held = words[np.minimum(place, len(words) - 1)] == hashes if len(words) else np.zeros(len(hashes), bool)
            sizes = batch["terms"].value_lengths().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), sizes)[held]
            bounds = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            found = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (place[held], batch["tf"].flatten().to_numpy()[held])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], *found], names=["doc_id", "label", "terms", "tf"])

    return run


def _holders(vocabulary):
    """Per task: how many documents hold each term; in the row of place -1 all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        df, docs = np.zeros(len(words), np.int64), 0
        for batch in batches:
            docs += batch.num_rows
            for block in bytewords.blocks(batch["text"]):
                df += np.bincount(counts_of(block, words)[1], minlength=len(words))
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1), pa.int64()), pa.array(np.append(df[held], docs), pa.int64())], names=["place", "docs"])

    return run


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_terms: int = MAX_TERMS) -> Index:
    """The index for ``docs(doc_id, text)``, learned from ``labels(doc_id, label)`` with labels 0 and 1."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    rated = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("label").cast("int").alias("label"))
    in_class = {r["label"]: r["n"] for r in rated.groupBy("label").agg(F.count("*").alias("n")).collect()}
    weight = {y: in_class.get(y, 0) / max(1, min(per_class, in_class.get(y, 0))) for y in (0, 1)}
    some = [rated.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    chosen = some[0].unionByName(some[1])  # of bounded size
    sample = stage(
        docs.join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "label", "text")
        .mapInArrow(_features, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, label int, terms array<bigint>, tf array<int>"),
        "toxicity-sample",
    )
    size = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).collect()[0]
    rate = min(max(size["toxic"] / max(size["n"], 1), 1e-6), 1 - 1e-6)
    holders = sample.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"), F.sum("label").alias("toxic"))
    above = (F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * (rate * (1 - rate)))
    toxic, clean = F.col("toxic") * weight[1], (F.col("n") - F.col("toxic")) * weight[0]  # among all labelled documents
    telling = holders.where((F.col("n") >= HOLDERS) & (above >= SURE) & (toxic >= SHARE * (toxic + clean)))
    rows = telling.orderBy(above.desc(), "term").limit(max_terms).select("term").collect()
    vocabulary = np.sort(np.array([r["term"] for r in rows], np.int64).view(np.uint64))
    words = spark.sparkContext.broadcast(vocabulary)
    n_docs, df = 0, np.zeros(len(vocabulary))
    for r in docs.select("text").mapInArrow(_holders(words), "place bigint, docs bigint").groupBy("place").agg(F.sum("docs").alias("docs")).collect():
        if r["place"] < 0:
            n_docs = r["docs"]
        else:
            df[r["place"]] = r["docs"]
    idf = np.log((1 + n_docs) / (1 + df)) + 1

    def train(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values(["doc_id", "label"], ignore_index=True)
        places = [np.asarray(terms, np.int64) for terms in found["terms"]]
        tfs = [np.asarray(tf, np.int64) for tf in found["tf"]]
        index = build(vocabulary, idf, found["doc_id"].to_numpy(), found["label"].to_numpy(), places, tfs, weight)
        return pd.DataFrame({"index": [pickle.dumps(index)]})

    short = sample.mapInArrow(_within(words), sample.schema)
    fitted = short.groupBy().applyInPandas(train, "index binary").collect()
    if fitted:
        return pickle.loads(fitted[0]["index"])
    return build(vocabulary, idf, np.zeros(0, np.int64), np.zeros(0, np.int64), [], [], weight)


def score(docs: DataFrame, index: Index, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs``, ``score``, and ``evidence``: ids, cosines and labels of the nearest examples."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    evidence = pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            votes = np.full(batch.num_rows, index.prior)
            near, cosines, sizes = [np.zeros(0, np.int64)], [np.zeros(0)], np.zeros(batch.num_rows, np.int64)
            for block in bytewords.blocks(batch["text"]):
                rows, places, tf = counts_of(block, index.vocabulary)
                held, first = np.unique(rows, return_index=True)
                for row, a, b in zip(held, first, np.append(first[1:], len(rows))):
                    terms = places[a:b]
                    found, cosine = index.nearest(terms, unit_vector(tf[a:b], index.idf[terms]), NEIGHBOURS)
                    at = block.first + row
                    votes[at] = index.vote(found, cosine)
                    near.append(found)
                    cosines.append(cosine)
                    sizes[at] = len(found)
            found = np.concatenate(near)
            entries = pa.StructArray.from_arrays(
                [pa.array(index.ids[found], pa.int64()), pa.array(np.concatenate(cosines)), pa.array(index.labels[found].astype(np.int32))], fields=list(evidence)
            )
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), pa.array(index.calibrated(votes)), pa.ListArray.from_arrays(bounds, entries)], names=[*keep, "score", "evidence"]
            )

    columns = list(dict.fromkeys([*keep, "text"]))
    return docs.select(*columns).mapInArrow(run, f"{schema}, score double, evidence array<struct<doc_id: bigint, cosine: double, label: int>>")
