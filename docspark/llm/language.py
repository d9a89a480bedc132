"""Language of whole texts by rank-order profiles.

Letters are lower-cased; n-grams of one to three characters are taken within
words, whose ends count as a character. A language's profile is its most frequent
n-grams in order, from all texts given for it. A document's own most frequent
n-grams are compared by the out-of-place distance: the difference of the ranks,
or the largest possible one where the profile lacks the n-gram. The least
distance wins, ties by name.

Profiles are counted per task, added up by Spark, and only the first ranks of
each language come to the driver: a fixed number per language, for as many
languages as the column holds.

A null text or one without a letter is `und` with score 0; so is every text when
nothing could be learned. Texts with a null language are not learned from.
Repeated rows count as often as they stand there; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: N-grams of a profile and of a document.
RANKS = 300
#: Distinct n-grams a task holds before it passes its counts on.
HELD_GRAMS = 400_000
#: Characters counted at once; a longer text is counted in parts that overlap by two.
PART = 1 << 20

EDGE = 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each code point if it is a letter, else the word edge."""
    table = np.full(0x110000, EDGE, np.uint64)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c
    return table


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(place, weights=np.concatenate(counts), minlength=len(found)).astype(np.int64)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text, 21 bits a character, and their counts."""
    raw = text.lower().encode("utf-32-le", "surrogatepass")
    c = _letters()[np.frombuffer(raw, np.uint32)]
    c = np.concatenate([[EDGE], c, [EDGE]]).astype(np.uint64)
    parts = []
    for at in range(0, max(1, len(c) - 2), PART):
        here = c[at : at + PART + 2]
        a, b, d = here[:-2], here[1:-1], here[2:]
        letter = b != EDGE  # every n-gram is counted at its letter in the middle, or its only one
        two = here[:-1] | here[1:] << np.uint64(21)
        some = (here[:-1] != EDGE) | (here[1:] != EDGE)
        if at + PART + 2 < len(c):
            some[-1] = False  # the next part has it
        grams = np.concatenate([b[letter], two[some], (a | b << np.uint64(21) | d << np.uint64(42))[letter]])
        parts.append(np.unique(grams, return_counts=True))
    return parts[0] if len(parts) == 1 else _merge([p[0] for p in parts], [p[1] for p in parts])


def top(grams: np.ndarray, counts: np.ndarray, ranks: int) -> np.ndarray:
    """The most frequent n-grams in order, ties by code."""
    if len(grams) > 4 * ranks:
        some = np.flatnonzero(counts >= np.partition(counts, -ranks)[-ranks])
        grams, counts = grams[some], counts[some]
    return grams[np.lexsort((grams, -counts))[:ranks]]


def learn(docs: DataFrame, ranks: int = RANKS) -> list[tuple[str, np.ndarray]]:
    """Profiles from all rows of ``docs(text, lang)`` that have both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list, list]] = {}
        size = 0

        def given() -> Iterator[pa.RecordBatch]:
            for lang, (keys, counts) in held.items():
                grams, n = _merge(keys, counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                keys, counts = held.setdefault(lang.as_py(), ([], []))
                grams, n = gram_counts(text.as_py())
                keys.append(grams)
                counts.append(n)
                size += len(grams)
                if len(keys) == 256 or size > 4 * HELD_GRAMS:
                    for kept in held.values():
                        if len(kept[0]) > 1:
                            merged = _merge(*kept)
                            kept[0][:], kept[1][:] = [merged[0]], [merged[1]]
                    size = sum(len(k[0]) for k, _ in held.values() if k)
                    if size > HELD_GRAMS:
                        yield from given()
                        held.clear()
                        size = 0
        yield from given()

    known = docs.where("text is not null and lang is not null").select("text", "lang")
    counted = known.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    first = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    profiles: dict[str, list] = {}
    for row in first.orderBy("lang", "rank").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return [(lang, np.array(grams, np.int64).view(np.uint64)) for lang, grams in sorted(profiles.items())]


def predict(docs: DataFrame, profiles: list[tuple[str, np.ndarray]], ranks: int = RANKS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``docs``, with ``lang_pred`` and ``score`` from the text alone.

    The score is 1 minus the least distance over the largest possible one.
    """
    names = [lang for lang, _ in profiles]
    grams = np.unique(np.concatenate([g for _, g in profiles])) if profiles else np.zeros(0, np.uint64)
    places = np.full((len(names), len(grams) + 1), ranks * 2, np.int64)  # the last column is for all other n-grams
    for i, (_, own) in enumerate(profiles):
        places[i, np.searchsorted(grams, own)] = np.arange(len(own))

    def guess(text: str | None) -> tuple[str, float]:
        if not text or not names:
            return "und", 0.0
        own = top(*gram_counts(text), ranks)
        if not len(own):
            return "und", 0.0
        at = np.searchsorted(grams, own)
        at[at == len(grams)] = 0
        at = np.where(grams[at] == own, at, len(grams))
        ranked = places[:, at]
        apart = np.where(ranked > ranks, ranks, np.abs(ranked - np.arange(len(own)))).sum(axis=1)
        best = int(np.argmin(apart))
        return names[best], 1 - float(apart[best]) / (ranks * len(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [guess(t.as_py()) for t in batch["text"]]
            columns = [batch[c] for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*kinds, "lang_pred string, score double"]))


def held_out() -> Column:
    """Whether a document is kept from learning: CRC32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2, F.lit(False))
