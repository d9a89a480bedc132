"""Sharding by a hierarchical weighted hash tree.

A document descends from the root to a region, from there to a rack and from
there to a shard. At each level every child draws ``-ln(u) / weight`` with a u
hashed from the document's id and the child's path, and the least draw wins, so
a child gets rows in proportion to its weight. A draw depends on nothing but the
id and the child itself: when weights change, rows move only into a child whose
weight grew or out of one whose weight shrank, at every level. A new shard comes
as a region of its own, so it takes rows only into itself.

Sizes are UTF-8 bytes plus 1; a null text has none. Rows with a null id descend
by a fixed draw, repeated rows go to the same shard. Slots number the rows of a
shard without gaps, in no promised order. An empty table gives an empty result;
other columns are ignored. Every row is placed by itself, so groups of equal
texts need no care and cannot be hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.sources.scratch import stage


@dataclass(frozen=True)
class Node:
    """A region, rack or shard: its name in the hash, its weight, and its children, or the shard it is."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int = -1


def tree(n_shards: int, base: int = 16, racks: int = 2, per_rack: int = 2, weights: Sequence[float] | None = None) -> Node:
    """``n_shards`` shards. The first ``base`` fill regions of ``racks`` racks of ``per_rack`` shards; each further one is a region."""
    leaves = [Node(f"shard{i}", float(weights[i]) if weights else 1.0, shard=i) for i in range(n_shards)]

    def joined(name: str, children: list[Node]) -> Node:
        return Node(name, sum(c.weight for c in children), tuple(children))

    first, later = leaves[:base], leaves[base:]
    in_racks = [joined(f"rack{i // per_rack}", first[i : i + per_rack]) for i in range(0, len(first), per_rack)]
    regions = [joined(f"region{i // racks}", in_racks[i : i + racks]) for i in range(0, len(in_racks), racks)]
    regions += [joined(f"region-of-{s.name}", [joined(f"rack-of-{s.name}", [s])]) for s in later]
    return joined("root", regions)


def _unit(key: Column, path: str) -> Column:
    """A number in (0, 1) hashed from a key and a path: 52 bits of an MD5."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"|{path}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def descend(key: Column, node: Node, path: str = "") -> Column:
    """The shard that a key reaches below a node. Only the draws on its way are computed."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return descend(key, node.children[0], f"{path}/{node.children[0].name}")
    draws = [
        F.struct((-F.ln(_unit(key, f"{path}/{c.name}")) / c.weight).alias("draw"), F.lit(i).alias("child")) for i, c in enumerate(node.children)
    ]
    ways = [descend(key, c, f"{path}/{c.name}") for c in node.children]
    # one lambda call binds the winner, so that its draws are not repeated in every branch
    return F.element_at(
        F.transform(F.array(F.least(*draws)), lambda won: F.coalesce(*[F.when(won["child"] == i, way) for i, way in enumerate(ways)])), 1
    )


def assign(docs: DataFrame, n_shards: int, weights: Sequence[float] | None = None, rows_per_chunk: int = 20_000) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for ``docs(doc_id, text)``."""
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    grown = [*weights, 1.0] if weights else None
    placed = stage(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            (F.length(raw) + 1).cast("bigint").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.lit("key").alias("law"),
            descend(key, tree(n_shards, weights=weights)).cast("int").alias("shard"),
            descend(key, tree(n_shards + 1, weights=grown)).cast("int").alias("grown_shard"),
        ),
        "sharding-placed",
    )
    # slots: rows are numbered within small chunks of a shard, and chunks start where the ones before them end
    n_chunks = max(1, placed.count() * 4 // (rows_per_chunk * n_shards))
    chunked = placed.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.lit(n_chunks)))
    sizes = chunked.groupBy("shard", "chunk").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(_order("shard", "chunk")) - F.col("rows")
    starts = sizes.select("shard", "chunk", before.alias("first"))
    inner = F.row_number().over(_order("shard", "chunk", "uid", within=2)) - 1
    return (
        chunked.withColumn("inner", inner)
        .join(starts, ["shard", "chunk"])
        .select("doc_id", "size", "text_crc32", "law", "shard", (F.col("first") + F.col("inner")).alias("slot"), "grown_shard")
    )


def _order(*columns: str, within: int = 1):
    from pyspark.sql import Window

    return Window.partitionBy(*columns[:within]).orderBy(*columns[within:])
