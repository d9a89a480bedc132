"""Quality classifier: ordinal cumulative-link regression on graded ratings.

``P(grade <= k) = sigmoid(threshold_k - score)``, with one score for all grades,
the sum of the weights of a document's distinct hashed features, and thresholds
in order. Features are words, word beginnings, runs of punctuation, and coarse
measures of repetition and capitals, all from the whole text. The model is fitted
on a bounded number of rated documents (``fit``); scoring is one pass over
all documents, without a shuffle.

A null text or one without visible characters gets grade 0 and is not kept. Rows
without a grade are not learned from; repeated rows count as often as they stand
there, and the choice of rated documents goes by a hash of the id, then the id.
With no rated document every score is 0 and every document with text is kept. An
empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm import bytewords

#: Size of the hashed feature space.
BUCKETS = 1 << 18
#: Lengths in bytes of the word beginnings used as features.
BEGINNINGS = (5, 6, 7)

WORDS = bytewords.byte_table((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
MARKS = ~WORDS
MARKS[:33] = False


def _lower_latin(block: bytewords.Block) -> bytewords.Block:
    """The block with the capitals of Latin-1 in lower case as well."""
    d = block.data.copy()
    capital = (d[1:] >= 0x80) & (d[1:] <= 0x9E) & (d[1:] != 0x97) & (d[:-1] == 0xC3)
    d[1:][capital] += 0x20
    return bytewords.Block(block.first, d, block.bounds, block.valid)


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (bytewords.mix(hashes + np.uint64(kind)) % np.uint64(BUCKETS)).astype(np.int64)


def features(block: bytewords.Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every feature of a block; a feature may stand there many times."""
    low = _lower_latin(block)
    rows, s, e = bytewords.word_spans(low, WORDS)
    n = len(block)
    found = []
    whole = bytewords.span_hashes(low.data, s, e)
    found.append((rows, _bucket(whole, 1)))
    for kind, length in enumerate(BEGINNINGS, 2):
        longer = e - s > length
        r, at = rows[longer], s[longer]
        found.append((r, _bucket(bytewords.span_hashes(low.data, at, at + length), kind)))
    mark_rows, ms, me = bytewords.word_spans(low, MARKS)
    found.append((mark_rows, _bucket(bytewords.span_hashes(low.data, ms, np.minimum(me, ms + 3)), 20)))
    # shares of distinct words, of capitals and of marks, in steps, by the order of magnitude of the text
    words = np.bincount(rows, minlength=n)
    pairs = np.unique(rows.astype(np.uint64) << np.uint64(40) ^ whole >> np.uint64(24))
    distinct = np.bincount((pairs >> np.uint64(40)).astype(np.int64) % max(n, 1), minlength=n) if len(pairs) else np.zeros(n)
    starts = block.bounds[:-1]
    sizes = np.diff(block.bounds)
    capitals = np.zeros(len(block.data) + 1)
    np.cumsum((block.data >= 65) & (block.data <= 90), out=capitals[1:])
    marks = np.bincount(mark_rows, minlength=n)
    magnitude = np.minimum(np.log2(words + 1).astype(np.int64), 12) // 2
    again = np.bincount(rows[1:][(whole[1:] == whole[:-1]) & (rows[1:] == rows[:-1])], minlength=n)
    each = np.maximum(words, 1)
    shares = (distinct / each, (capitals[starts + sizes] - capitals[starts]) / np.maximum(sizes, 1), np.minimum(marks / each, 1), again / each)
    for kind, share in enumerate(shares, 30):
        step = np.ceil(share * 12).astype(np.int64) * 16 + magnitude * (kind == 30)
        found.append((np.arange(n), _bucket(step.astype(np.uint64) * np.uint64(0x9E3779B1), kind)))
    return np.concatenate([r for r, _ in found]), np.concatenate([b for _, b in found])


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def below(self, scores: np.ndarray) -> np.ndarray:
        """P(grade <= k) for every score and every k but the last grade."""
        return 1 / (1 + np.exp(np.clip(scores[:, None] - self.thresholds[None, :], -40, 40)))

    def scores(self, block: bytewords.Block) -> np.ndarray:
        rows, found = features(block)
        heavy = self.weights[found] != 0
        keys = np.unique(rows[heavy] * BUCKETS + found[heavy])
        return np.bincount(keys // BUCKETS, weights=self.weights[keys % BUCKETS], minlength=len(block))


def telling(sets: list[np.ndarray], grades: np.ndarray, n_grades: int, sure: float = 5.0, apart: float = 0.4) -> np.ndarray:
    """Buckets that stand in one grade more often than chance allows, by ``sure`` deviations and a share of ``apart``."""
    total = np.bincount(np.concatenate(sets), minlength=BUCKETS)
    found = np.zeros(BUCKETS, bool)
    for grade in range(n_grades):
        base = max(1e-3, min(1 - 1e-3, float((grades == grade).mean())))
        own = [x for x, g in zip(sets, grades) if g == grade]
        here = np.bincount(np.concatenate(own), minlength=BUCKETS) if own else np.zeros(BUCKETS)
        more = here - total * base
        found |= (more >= sure * np.sqrt(total * base * (1 - base))) & (more >= apart * total) & (total > 0)
    return found


def learn(sets: list[np.ndarray], grades: np.ndarray, n_grades: int, rounds: int = 25, seed: int = 5) -> Model:
    """Fit weights and thresholds by adaptive gradient steps; buckets that tell nothing alone keep weight 0."""
    weights, start = np.zeros(BUCKETS), np.linspace(-1.0, 1.0, n_grades - 1)
    if not len(sets):
        return Model(weights, np.full(n_grades - 1, -1.0) - np.arange(n_grades - 1)[::-1])
    useful = telling(sets, grades, n_grades)
    sets = [x[useful[x]] for x in sets]
    first, gaps = start[0], np.log(np.maximum(np.diff(start), 1e-3))
    rng = np.random.default_rng(seed)
    seen_w, seen_t = np.full(BUCKETS, 1e-2), np.full(n_grades - 1, 1e-2)
    for _ in range(rounds):
        order = rng.permutation(len(sets))
        for at in range(0, len(order), 128):
            batch = order[at : at + 128]
            flat = np.concatenate([sets[i] for i in batch])
            size = np.array([len(sets[i]) for i in batch])
            row = np.repeat(np.arange(len(batch)), size)
            score = np.bincount(row, weights=weights[flat], minlength=len(batch))
            thresholds = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
            below = Model(weights, thresholds).below(score)
            full = np.hstack([np.zeros((len(batch), 1)), below, np.ones((len(batch), 1))])
            y = grades[batch]
            i = np.arange(len(batch))
            upper, lower = full[i, y + 1], full[i, y]
            slope = 1 - upper - lower
            share = np.maximum(upper - lower, 1e-9)
            per = np.zeros((len(batch), n_grades + 1))
            per[i, y + 1] -= upper * (1 - upper) / share
            per[i, y] += lower * (1 - lower) / share
            g_t = per[:, 1:-1].mean(axis=0)
            g_w = np.bincount(flat, weights=slope[row], minlength=BUCKETS) / len(batch) + 1e-5 * weights
            seen_w += g_w**2
            weights -= 0.15 * g_w / np.sqrt(seen_w)
            # each threshold is the first one plus the gaps before it
            g = np.concatenate([[g_t.sum()], np.exp(gaps) * np.cumsum(g_t[::-1])[::-1][1:]])
            seen_t += g**2
            move = 0.1 * g / np.sqrt(seen_t)
            first -= move[0]
            gaps = gaps - move[1:]
    weights[np.abs(weights) < 0.02] = 0
    return Model(weights, first + np.concatenate([[0], np.cumsum(np.exp(gaps))]))


def fit(docs: DataFrame, ratings: DataFrame, n_grades: int = 3, per_grade: int = 2000, of_highest: int = 6000) -> Model:
    """A model from ``docs(doc_id, text)`` and ``ratings(doc_id, grade)``, grades 0 to ``n_grades - 1``.

    At most ``of_highest`` ratings of the highest grade and ``per_grade`` of each
    other are used, those with the smallest hash of the id; so the rows that are
    joined and fitted are bounded.
    """
    rated = ratings.where(F.col("grade").between(0, n_grades - 1) & F.col("doc_id").isNotNull())
    chosen = None
    for grade in range(n_grades):
        some = rated.where(F.col("grade") == grade).select("doc_id", F.col("grade").cast("int").alias("grade"))
        some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(of_highest if grade == n_grades - 1 else per_grade)
        chosen = some if chosen is None else chosen.unionByName(some)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in bytewords.blocks(batch["text"]):
                rows, found = features(block)
                keys = np.unique(rows * BUCKETS + found)
                bounds = np.searchsorted(keys, np.arange(len(block) + 1) * BUCKETS)
                flat = (keys % BUCKETS).astype(np.int32)
                n = len(block)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(block.first, n),
                        batch["grade"].slice(block.first, n),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat)),
                    ],
                    names=["doc_id", "grade", "found"],
                )

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "grade"], ignore_index=True)
        model = learn([np.asarray(x, np.int64) for x in rows["found"]], rows["grade"].to_numpy(), n_grades)
        return pd.DataFrame({"weights": [model.weights.astype("<f4").tobytes()], "thresholds": [model.thresholds.astype("<f8").tobytes()]})

    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    sample = texts.select("doc_id", "grade", "text").mapInArrow(featurise, "doc_id bigint, grade int, found array<int>")
    found = sample.groupBy().applyInPandas(train, "weights binary, thresholds binary").collect()
    if not found:
        return learn([], np.zeros(0, np.int64), n_grades)
    return Model(np.frombuffer(found[0]["weights"], "<f4").astype(float), np.frombuffer(found[0]["thresholds"], "<f8"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability``, that of the highest grade."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c not in ("expected_grade", "tail_probability")]
    docs = docs.select(*columns)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "expected_grade double, tail_probability double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            expected, tail = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for block in bytewords.blocks(batch["text"]):
                below = model.below(model.scores(block))
                seen = np.add.reduceat(np.append(block.data > 32, False).astype(np.int64), block.bounds[:-1]) > 0
                seen &= np.diff(block.bounds) > 0
                at = slice(block.first, block.first + len(block))
                expected[at] = np.where(seen, (1 - below).sum(axis=1), 0.0)
                tail[at] = np.where(seen, 1 - below[:, -1], 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(expected), pa.array(tail)], names=[*columns, "expected_grade", "tail_probability"])

    return docs.mapInArrow(run, schema)


def grades_of_labels(labels: DataFrame) -> DataFrame:
    """Ratings of the `labels` table: toxic 0, of low quality 1, good 2."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade"))


#: A document is kept from this probability of the highest grade on.
KEEP = 0.5
