"""Near-duplicate vectors by a forest of random-projection trees with spill.

A tree splits its vectors by their projection on a random direction, at the
median. Vectors within a margin of the split go to both sides. A node is split on
a direction drawn from a seed, the best of a few; where every direction would
send most vectors to both sides the node is dense and stays whole. Vectors of a
leaf are compared with each other, in double precision; links of all leaves of
all trees are put together, and components are formed from them.

The trees grow in rounds. In each, every node that is still too large fits some
levels of splits on a bounded sample of its own vectors (``SAMPLE``), and all its
vectors are routed by them. A dense node beyond the leaf size is compared in
tiles, so that no task holds more than two blocks of it and no pair is left out.

The margin is given in deviations of the projected difference of two vectors at
the threshold. With half of one, a split parts a pair exactly at 0.9 in about 3 %
of cases and one at 0.95 in 1 %. The number of trees follows from the number of
different vectors, through the levels they need, so that at every size all trees
part a pair at the threshold in at most one case of six hundred (``MISS``); there
are four at least.

Equal vectors are one node of the search. Vectors that are null, zero, or hold
null or non-finite components link with nothing. Vectors of different lengths
link with nothing either. Rows with a null id can be linked, but give no
component its id. Repeated ids are rows of their own. An empty table gives an
empty result; labels and other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.llm.components import components
from docspark.sources.scratch import stage

#: Vectors of a node that its splits are fitted on, about.
SAMPLE = 4096
#: Levels fitted in one round.
LEVELS = 5
#: Directions tried for a split.
TRIES = 4

#: Part of the pairs at the threshold that all trees may part.
MISS = 1 / 600
#: Part of a node's vectors that go to one side, spill included.
CHILD = 0.59
#: Trees at least.
TREES = 4

ROWS = "tree int, node bigint, dense boolean, uid bigint, v binary"

LEAF, DENSE = 255, 254


def _matrix(cells, kind: str) -> np.ndarray:
    """Unit vectors in double precision from cells that hold components of one kind."""
    cells = cells.to_pylist() if isinstance(cells, (pa.Array, pa.ChunkedArray)) else list(cells)
    x = np.frombuffer(b"".join(cells), kind).reshape(len(cells), -1).astype(float)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _direction(tree: int, node: int, at: int, k: int, size: int) -> np.ndarray:
    """The k-th direction of a place in a node's splits: nothing of it has to be kept."""
    r = np.random.default_rng([tree, node, at, k]).standard_normal(size)
    return r / np.linalg.norm(r)


def _fit(kind: str, margin: float, leaf: int):
    """Splits of one node from its sample, a binary heap: which direction, and the cut; or a leaf, or a dense one."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree, node = (int(k) for k in key)
        x = _matrix(rows.sort_values("uid")["v"], kind)
        scale = float(rows["rows"].iloc[0]) / len(x)
        tau = margin / np.sqrt(x.shape[1])
        ways = np.full(2 ** (LEVELS + 1), LEAF, np.uint8)
        cuts = np.zeros(2 ** (LEVELS + 1), "<f4")

        def split(at: int, idx: np.ndarray, level: int) -> None:
            if level == LEVELS or len(idx) * scale <= leaf or len(idx) < 8:
                return
            best = None
            for k in range(TRIES):
                p = x[idx] @ _direction(tree, node, at, k, x.shape[1])
                cut = np.float32(np.median(p))
                left, right = p < cut + tau, p > cut - tau
                most = max(left.mean(), right.mean())
                if best is None or most < best[0]:
                    best = (most, k, cut, left, right)
            most, k, cut, left, right = best
            if most > 0.8:
                ways[at] = DENSE
                return
            ways[at], cuts[at] = k, cut
            split(2 * at, idx[left], level + 1)
            split(2 * at + 1, idx[right], level + 1)

        split(1, np.arange(len(x)), 0)
        return pd.DataFrame({"tree": [tree], "node": [node], "ways": [ways.tobytes()], "cuts": [cuts.tobytes()]})

    return run


def _route(kind: str, margin: float):
    """Rows sent down the splits of their node: one row for each leaf they reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, node = batch["tree"].to_numpy(), batch["node"].to_numpy()
            uid, cells = batch["uid"], batch["v"]
            order = np.lexsort((node, tree))
            new = np.flatnonzero(np.diff(tree[order], prepend=-1).astype(bool) | np.diff(node[order], prepend=0).astype(bool))
            for lo, hi in zip(new, np.append(new[1:], len(order))):
                rows = order[lo:hi]
                t, n = int(tree[rows[0]]), int(node[rows[0]])
                ways = np.frombuffer(batch["ways"][int(rows[0])].as_py(), np.uint8)
                cuts = np.frombuffer(batch["cuts"][int(rows[0])].as_py(), "<f4")
                x = _matrix(cells.take(pa.array(rows)), kind)
                tau = margin / np.sqrt(x.shape[1])
                open_ = [(1, np.arange(len(x)))]
                while open_:
                    at, idx = open_.pop()
                    if not len(idx):
                        continue
                    if ways[at] >= DENSE:
                        taken = pa.array(rows[idx])
                        k = len(idx)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(k, t, np.int32)),
                                pa.array(np.full(k, (n * 64 + at) * 0x9E3779B97F4A7C15 % (1 << 63), np.int64)),
                                pa.array(np.full(k, ways[at] == DENSE)),
                                uid.take(taken),
                                cells.take(taken),
                            ],
                            names=["tree", "node", "dense", "uid", "v"],
                        )
                        continue
                    p = x[idx] @ _direction(t, n, at, int(ways[at]), x.shape[1])
                    open_ += [(2 * at, idx[p < cuts[at] + tau]), (2 * at + 1, idx[p > cuts[at] - tau])]

    return run


def _links(kind: str, threshold: float):
    """Pairs at the threshold in one tile: within block i if j equals i, else between blocks i and j.

    Single precision finds them, double precision decides where that is not sure.
    """
    unsure = 1e-4

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        i, j = int(key[2]), int(key[3])
        x = _matrix(rows["v"], kind)
        single = x.astype(np.float32)
        uid, block = rows["uid"].to_numpy(), rows["block"].to_numpy()
        left = np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        out = [np.zeros((2, 0), np.int64)]
        for at in range(0, len(left), 512):
            near = single[left[at : at + 512]] @ single[right].T
            a, b = np.nonzero(near >= threshold - unsure)
            first, second = left[a + at], right[b]
            sure = near[a, b] >= threshold + unsure
            sure[~sure] = np.einsum("ij,ij->i", x[first[~sure]], x[second[~sure]]) >= threshold
            out.append(np.stack([uid[first[sure]], uid[second[sure]]]))
        pairs = np.concatenate(out, axis=1)
        pairs = np.unique(np.sort(pairs[:, pairs[0] != pairs[1]], axis=0), axis=1)
        return pd.DataFrame({"a": pairs[0], "b": pairs[1]})

    return run


def _clean(vectors: DataFrame, column: str, kind: str) -> DataFrame:
    """``uid, vec_id, v`` for all rows: the components as one cell, null where a vector cannot link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for v in batch["whole"]:
                x = None if v.values is None else v.values.to_numpy(zero_copy_only=False).astype(kind)
                usable = x is not None and len(x) and np.isfinite(x).all() and x.any()
                cells.append((x + 0).tobytes() if usable else None)  # -0 is 0
            yield pa.RecordBatch.from_arrays([batch["uid"], batch["vec_id"], pa.array(cells, pa.binary())], names=["uid", "vec_id", "v"])

    rows = vectors.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("bigint").alias("vec_id"), F.col(column).alias("whole"))
    return rows.mapInArrow(run, "uid bigint, vec_id bigint, v binary")


def leaves(points: DataFrame, kind: str, trees: int, margin: float, leaf: int) -> DataFrame:
    """``tree, node, uid, v`` for every leaf a point of ``points(uid, v)`` reaches."""
    lengths = F.length("v").cast("bigint")  # vectors of different lengths never meet
    now = points.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), lengths.alias("node"), F.lit(False).alias("dense"), "uid", "v")
    done = None
    while True:
        now = stage(now, "forest-rows")
        sizes = stage(now.groupBy("tree", "node", "dense").agg(F.count("*").alias("rows")), "forest-sizes")
        large = sizes.where((F.col("rows") > leaf) & ~F.col("dense")).select("tree", "node", "rows")
        final = now.join(sizes.where((F.col("rows") <= leaf) | F.col("dense")), ["tree", "node", "dense"])
        done = final if done is None else done.unionByName(final)
        if large.isEmpty():
            return done
        rest = now.join(large, ["tree", "node"])
        share = F.pmod(F.xxhash64("uid", "tree", "node"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        models = rest.where(share < SAMPLE / F.col("rows")).groupBy("tree", "node").applyInPandas(
            _fit(kind, margin, leaf), "tree int, node bigint, ways binary, cuts binary"
        )
        routed = rest.join(stage(models, "forest-models"), ["tree", "node"]).select("tree", "node", "ways", "cuts", "uid", "v")
        now = routed.mapInArrow(_route(kind, margin), ROWS)


def parted(threshold: float, spill: float) -> float:
    """How often a split at the median parts a pair exactly at the threshold.

    The projections of unit vectors deviate by 1, in units of one over the root of
    their length, and the difference of the pair by d. The pair is parted where
    the cut falls between its ends with a margin of ``spill`` * d on both sides.
    """
    d, z = math.sqrt(2 - 2 * threshold), 2 * spill
    beyond = 2 * (math.exp(-z * z / 2) / math.sqrt(2 * math.pi) - z * math.erfc(z / math.sqrt(2)) / 2)
    return min(1.0, d * beyond / math.sqrt(2 * math.pi))


def levels_for(n: int, leaf: int) -> int:
    """Levels of splits until ``n`` vectors are in leaves."""
    return max(0, math.ceil(math.log(max(n, 1) / leaf) / -math.log(CHILD)))


def trees_for(n: int, leaf: int, threshold: float = 0.9, spill: float = 0.5) -> int:
    """Trees that keep the part of missed pairs at the threshold below ``MISS`` among ``n`` vectors."""
    missed = 1 - (1 - parted(threshold, spill)) ** levels_for(n, leaf)
    return max(TREES, math.ceil(math.log(MISS) / math.log(missed))) if missed > 0 else TREES


def near_vectors(vectors: DataFrame, threshold: float = 0.9, trees: int | None = None, spill: float = 0.5, leaf: int = 1024, column: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Rows ``uid, vec_id, rep, copies`` and links ``a, b`` between the representatives of different vectors.

    Without ``trees`` their number follows from the number of different vectors.
    """
    single = vectors.schema[column].dataType.elementType == T.FloatType()
    kind = "<f4" if single else "<f8"
    rows = stage(_clean(vectors, column, kind), "forest-clean")
    same = rows.where("v is not null").groupBy("v").agg(F.min("uid").alias("rep"), F.count("*").alias("copies"))
    reps = stage(same, "forest-reps")
    trees = trees or trees_for(reps.count(), leaf, threshold, spill)
    margin = spill * float(np.sqrt(2 - 2 * threshold))
    found = leaves(reps.select(F.col("rep").alias("uid"), "v"), kind, trees, margin, leaf)
    blocks = F.ceil(F.col("rows") / leaf).cast("int")
    tiled = found.withColumn("block", F.pmod(F.xxhash64("uid"), blocks).cast("int")).withColumn("blocks", blocks)
    tiles = tiled.select(
        "tree", "node", "uid", "v", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("tree", "node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "uid", "v", "block")
    pairs = tiles.groupBy("tree", "node", "i", "j").applyInPandas(_links(kind, threshold), "a bigint, b bigint")
    links = stage(pairs.distinct(), "forest-links")
    placed = rows.join(reps.drop("copies"), "v", "left").select("uid", "vec_id", "rep").join(reps.select("rep", "copies"), "rep", "left")
    return placed, links


def digest(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row."""
    copies = placed.where("rep is not null").select("rep", "copies").distinct()
    ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = ways.join(copies, F.col("b") == F.col("rep")).groupBy("a").agg(F.sum("copies").alias("others")).withColumnRenamed("a", "rep")
    joined = components(links).withColumnRenamed("id", "rep")
    node = F.coalesce("component", "rep", "uid")
    rows = stage(
        placed.join(degree, "rep", "left")
        .join(joined, "rep", "left")
        .select("vec_id", (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("others", F.lit(0))).alias("n_links"), node.alias("node")),
        "forest-nodes",
    )
    least = rows.groupBy("node").agg(F.min("vec_id").alias("component_id"))
    return rows.join(least, "node").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
