"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

Documents are dealt into blocks of bounded size. Each block is solved on several
islands, each with a population of packings of its own. A crossover injects
whole well-filled bins of one parent into the other, removes the bins that hold
the same documents, and best-fits the displaced ones. Between epochs the best
packing of each island migrates to the next island of its block. In the end the
documents of badly filled bins of all blocks meet in new blocks and are packed
once more, so what blocks leave over does not add up.

Ties, repeated rows and null ids: every row is a document of its own. A null
text is one end token. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm import tokens
from docspark.sources.scratch import stage

Packing = list[list[int]]


class Solver:
    """Packings of one block: ``sizes`` are the documents' lengths."""

    def __init__(self, sizes: list[int], capacity: int, seed: int):
        self.sizes, self.capacity = sizes, capacity
        self.rng = random.Random(seed)
        self.least = -(-sum(sizes) // capacity)

    def best_fit(self, bins: Packing, loose: list[int]) -> Packing:
        """Put each of ``loose`` into the fullest bin that takes it, in the given order."""
        sizes, capacity = self.sizes, self.capacity
        room: list[list[int]] = [[] for _ in range(capacity + 1)]
        open_rooms = 0  # bit r: some bin has room for exactly r more
        for b, held in enumerate(bins):
            left = capacity - sum(sizes[i] for i in held)
            room[left].append(b)
            open_rooms |= 1 << left
        for i in loose:
            size = sizes[i]
            fits = open_rooms >> size
            if fits:
                left = size + (fits & -fits).bit_length() - 1
                b = room[left].pop()
                if not room[left]:
                    open_rooms ^= 1 << left
                bins[b].append(i)
                left -= size
            else:
                b, left = len(bins), capacity - size
                bins.append([i])
            room[left].append(b)
            open_rooms |= 1 << left
        return bins

    def decreasing(self, items: list[int], noise: float = 0.0) -> list[int]:
        """Items from large to small, slightly shuffled by ``noise``."""
        jitter = self.rng.random
        return sorted(items, key=lambda i: (-self.sizes[i] * (1 - noise * jitter()), i))

    def fill(self, held: list[int]) -> float:
        return sum(self.sizes[i] for i in held) / self.capacity

    def fitness(self, bins: Packing) -> float:
        """Mean squared fill: few and full bins score high."""
        return sum(self.fill(b) ** 2 for b in bins) / max(1, len(bins))

    def cross(self, host: Packing, donor: Packing) -> Packing:
        """Inject well-filled bins of ``donor`` into ``host``, best-fit what they displace."""
        ranked = sorted(donor, key=self.fill, reverse=True)
        good = ranked[: max(1, len(ranked) * 3 // 4)]
        gift = [list(b) for b in good if self.rng.random() < 0.5] or [list(good[0])]
        taken = {i for b in gift for i in b}
        kept, loose = [], []
        for b in host:
            if taken.isdisjoint(b):
                kept.append(list(b))
            else:
                loose += [i for i in b if i not in taken]
        return self.best_fit(gift + kept, self.decreasing(loose))

    def mutate(self, bins: Packing) -> Packing:
        """Dissolve the worst bins and a few others, and best-fit their documents."""
        ranked = sorted(range(len(bins)), key=lambda b: self.fill(bins[b]))
        gone = set(ranked[:2]) | {self.rng.randrange(len(bins)) for _ in range(max(1, len(bins) // 20))}
        loose = [i for b in gone for i in bins[b]]
        return self.best_fit([list(b) for k, b in enumerate(bins) if k not in gone], self.decreasing(loose, 0.2))

    def evolve(self, start: list[Packing], population: int, generations: int) -> Packing:
        """The best packing after some generations, or as soon as no better one can exist."""
        items = list(range(len(self.sizes)))
        people = [[list(b) for b in p] for p in start] or [self.best_fit([], self.decreasing(items))]
        best = min(people, key=len)
        if len(best) <= self.least:
            return best
        while len(people) < population:
            people.append(self.best_fit([], self.decreasing(items, 0.1 * len(people))))
        scored = sorted(((self.fitness(p), p) for p in people), key=lambda x: -x[0])
        for _ in range(generations):
            if min(len(p) for _, p in scored) <= self.least:
                break
            (_, a), (_, b) = self.rng.sample(scored[: max(2, population // 2)], 2)
            child = self.mutate(self.cross(a, b))
            scored = sorted([*scored[:-1], (self.fitness(child), child)], key=lambda x: -x[0])
        return min((p for _, p in scored), key=len)


def _epoch(capacity: int, population: int, generations: int):
    """One epoch of one island: rows carry the packings that start it, each marked by its origin."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block, island, epoch = (int(k) for k in key)
        own = rows.drop_duplicates("piece_uid").sort_values(["length", "piece_uid"], ignore_index=True)
        solver = Solver([int(n) for n in own["length"]], capacity, seed=(block * 1009 + island) * 31 + epoch)
        start = []
        if epoch:
            place = {uid: i for i, uid in enumerate(own["piece_uid"].tolist())}
            for _, packing in rows.sort_values(["bin", "piece_uid"]).groupby("origin", sort=True):
                held: dict[int, list[int]] = {}
                for uid, b in zip(packing["piece_uid"].tolist(), packing["bin"].tolist()):
                    held.setdefault(b, []).append(place[uid])
                start.append(list(held.values()))
        bins = solver.evolve(start, population, generations)
        out, uid = [], own["piece_uid"].tolist()
        for b, held in enumerate(bins):
            offset = 0
            for i in held:
                out.append((block, island, uid[i], solver.sizes[i], b, offset, len(bins)))
                offset += solver.sizes[i]
        return pd.DataFrame(out, columns=["block", "island", "piece_uid", "length", "bin", "offset", "n_bins"])

    return run


PACKED = "block bigint, island int, piece_uid bigint, length bigint, bin bigint, offset bigint, n_bins bigint"


def pack_rows(
    items: DataFrame,
    capacity: int,
    block_size: int = 4096,
    islands: int = 2,
    epochs: int = 2,
    population: int = 4,
    generations: int = 6,
) -> DataFrame:
    """``block, piece_uid, length, bin, offset`` for ``items(piece_uid, length)``, each at most ``capacity`` long."""
    n_blocks = max(1, -(-items.count() // block_size))
    dealt = items.select(
        F.pmod(F.xxhash64("piece_uid"), F.lit(n_blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        "piece_uid",
        "length",
        F.lit(-1).alias("origin"),
        F.lit(0).cast("bigint").alias("bin"),
    )
    for epoch in range(epochs):
        solve = _epoch(capacity, population, generations)
        found = stage(
            dealt.withColumn("epoch", F.lit(epoch)).groupBy("block", "island", "epoch").applyInPandas(solve, PACKED),
            "packing-epoch",
        )
        moved = found.select(
            "block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), "piece_uid", "length", F.lit(1).alias("origin"), "bin"
        )
        dealt = found.select("block", "island", "piece_uid", "length", F.lit(0).alias("origin"), "bin").unionByName(moved)
    best = found.groupBy("block").agg(F.min(F.struct("n_bins", "island")).alias("best"))
    return (
        found.join(best, "block")
        .where(F.col("island") == F.col("best.island"))
        .select("block", "piece_uid", "length", "bin", "offset")
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    well_filled: float = 0.99,
    with_ids: bool = False,
    special: bool = False,
    **search: int,
) -> DataFrame:
    """All documents in sequences of at most ``capacity`` tokens: a row per piece with its sequence and its place there.

    ``well_filled`` is the fill from which a bin is final after the first
    round; the documents of the others are packed again across blocks. With
    ``special`` the strings of special tokens have the ids of these.
    """
    cut = stage(tokens.pieces(docs, tokenizer, capacity, end_id, with_ids, special), "packing-pieces")
    whole = cut.where(F.col("length") == capacity).select("piece_uid", (-F.col("piece_uid") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    first = stage(pack_rows(cut.where(F.col("length") < capacity), capacity, **search), "packing-first")
    fill = first.groupBy("block", "bin").agg(F.sum("length").alias("used"))
    good = fill.where(F.col("used") >= well_filled * capacity).select("block", "bin")
    number = F.shiftleft(F.col("block"), 24) + F.col("bin")
    done = first.join(good, ["block", "bin"], "left_semi").select("piece_uid", number.alias("sequence_id"), "offset")
    loose = stage(first.join(good, ["block", "bin"], "left_anti").select("piece_uid", "length"), "packing-loose")
    again = pack_rows(loose, capacity, **search).select("piece_uid", (number + F.lit(1 << 60)).alias("sequence_id"), "offset")
    places = whole.unionByName(done).unionByName(again)
    return cut.join(places, "piece_uid").drop("piece_uid")
