"""Connected components of a graph given by its edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from docspark.sources.scratch import stage


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hang neighbours of each node on the least of them: the larger ones, or with ``small`` the others and the node."""
    ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if small:
        ways = ways.where(F.col("b") < F.col("a"))
    least = ways.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    hung = ways.join(least, "a")
    if small:
        moved = hung.select(F.col("b").alias("a"), F.col("least").alias("b"))
        return moved.unionByName(least.select("a", F.col("least").alias("b"))).where(F.col("a") != F.col("b")).distinct()
    return hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b")).where(F.col("a") != F.col("b"))


def _marked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, and their count and hash, which the write itself observes."""
    seen = Observation()
    written = stage(edges.observe(seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")), "components")
    return written, (seen.get["n"], seen.get["x"])


def _proper(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))


def contracted(edges: DataFrame) -> DataFrame:
    """Edges that connect the same nodes as ``edges(a, b)``, after one round: most nodes hang on a smaller one."""
    return stage(_star(_star(_proper(edges), small=False), small=True), "components")


def labels(edges: DataFrame) -> DataFrame:
    """``id, component`` for every node of edges as ``contracted`` gives them; equal labels are connected."""
    own = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    roots = edges.select(F.col("b").alias("id")).distinct().join(own, "id", "left_anti")
    return own.unionByName(roots.select("id", F.col("id").alias("component")))


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every node of ``edges(a, b)``; the component is its least node.

    Each round is written to the shared scratch folder, so that lost executors
    cost no earlier round. The number of rounds grows with the logarithm of the
    longest path. Self-loops and repeated edges do no harm; null ends are ignored.
    """
    now, mark = _marked(_star(_star(_proper(edges), small=False), small=True))
    before = None
    while mark != before and mark[0]:
        before = mark
        now, mark = _marked(_star(_star(now, small=False), small=True))
    nodes = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("id"), "component").distinct())
