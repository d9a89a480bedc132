"""Prefix trie of conversations, by ROLLUP over positional columns of turn ids.

A conversation's turns become ids, and the ids of ``width`` turns in a row the
columns of one row. ROLLUP over these columns gives a group per prefix, all
depths together, and ``grouping_id`` its depth. A longer conversation continues
in further rows, keyed by the node at which the row before ends; so one ROLLUP
serves the blocks of all conversations, however long they are.

A node belongs to its smallest member. The nodes that a conversation does not
own are the first ones of its path, those shared with a smaller conversation;
so sums over a subtree, where each node counts once, are sums over members:

- a childless node counts where its owner is a member,
- of ``saved_tokens``, a member other than the owner brings the words of its
  turns from the node on that stand in nodes it does not own.

A first ROLLUP finds the owners, a second one adds up.

A turn is known by a 128-bit hash of its role and text, a node by the exclusive
or of such hashes with their places. Turns are ordered by ``turn``, nulls first,
then by that hash, so repeated rows are turns of their own; a null role or text
is empty. Rows with a null ``conv_id`` belong to no conversation. A very long
text is hashed like any other and leaves its row at the first step. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docspark.sources.scratch import stage

#: Turns of one row of the ROLLUP.
WIDTH = 8
#: Words of a text.
WORD = r"[^\x20\x09-\x0D]+"
#: Nodes with the most members, which are broadcast; another one has less than this part of all member rows.
LARGEST = 10_000
#: Ids of one text that is hashed in a piece, as bits.
CHUNK_BITS = 12

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _place(x: str | Column, depth: Column) -> Column:
    """What a turn at a depth adds to the hash of a node."""
    return F.xxhash64(x, depth.cast("bigint"))


def number_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, x, y, words``: the turns of each conversation from 0, their ids and their number of words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.xxhash64(text, role, F.lit(1)).alias("x"),
        F.xxhash64(role, text, F.lit(2)).alias("y"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "x", "y")
    return turns.select("conv_id", (F.row_number().over(order) - 1).alias("at"), "x", "y", "words")


def share_starts(turns: DataFrame, group: int = 20, parts: int = 4) -> DataFrame:
    """Turns as ``number_turns`` gives them, with starts taken over from another conversation.

    The first ``h`` turns of conversation ``c`` are replaced by those of
    ``c - c % group``, as many as there are; ``h`` is ``crc32(c) % parts``. A
    conversation that has no turn left stays as a row with a null ``at``.
    """
    lent_turns = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(parts))
    convs = turns.where("at = 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), lent_turns.alias("h"))
    heads = turns.where(F.col("at") < parts - 1).select(F.col("conv_id").alias("base"), "at", "x", "y", "words")
    lent = convs.join(heads, "base").where("at < h").select("conv_id", F.lit(1).alias("part"), "at", "x", "y", "words")
    own = turns.where(F.col("at") >= lent_turns).select("conv_id", F.lit(2).alias("part"), "at", "x", "y", "words")
    order = Window.partitionBy("conv_id").orderBy("part", "at")
    whole = lent.unionByName(own).select("conv_id", (F.row_number().over(order) - 1).alias("at"), "x", "y", "words")
    none = convs.select("conv_id", *[F.lit(None).cast(t).alias(c) for c, t in (("at", "int"), ("x", "bigint"), ("y", "bigint"), ("words", "bigint"))])
    return whole.unionByName(none)


def _paths(turns: DataFrame) -> DataFrame:
    """A row per turn and one of depth 0 per conversation: the node that ends there and the words up to it."""
    turns = turns.where("at is not null").select("conv_id", (F.col("at") + 1).cast("bigint").alias("depth"), "x", "y", "words").unionByName(
        turns.select("conv_id", *[F.lit(0).cast("bigint").alias(c) for c in ("depth", "x", "y", "words")]).distinct()
    )
    so_far = Window.partitionBy("conv_id").orderBy("depth")
    there = F.col("depth") > 0
    added = turns.select(
        "*",
        *[F.when(there, _place(c, F.col("depth"))).otherwise(F.lit(0)).cast("bigint").alias(f"{c}_here") for c in ("x", "y")],
    )
    return added.select(
        "conv_id",
        "depth",
        "x",
        "y",
        F.bit_xor("x_here").over(so_far).alias("node_x"),
        F.bit_xor("y_here").over(so_far).alias("node_y"),
        F.sum("words").over(so_far).alias("words"),
        F.max("depth").over(Window.partitionBy("conv_id")).alias("length"),
        "x_here",
        "y_here",
        (F.sum("words").over(so_far) - F.col("words")).alias("words_before"),
    )


def _blocks(paths: DataFrame, width: int) -> DataFrame:
    """A row per conversation and block: the key, and id and words up to it for each place, null beyond the end."""
    block = F.greatest(F.floor((F.col("depth") - 1) / width), F.lit(0)).cast("bigint")
    placed = paths.withColumn("block", block).withColumn("i", F.col("depth") - F.col("block") * width)
    first = F.when(F.col("i") == 1, F.lit(True))
    keys = {
        "key_x": F.col("node_x").bitwiseXOR(F.col("x_here")),
        "key_y": F.col("node_y").bitwiseXOR(F.col("y_here")),
        "w0": F.col("words_before"),
    }
    return placed.groupBy("conv_id", "block", "length").agg(
        *[F.coalesce(F.max(F.when(first, e)), F.lit(0)).alias(name) for name, e in keys.items()],
        *[F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{a}{i}") for i in range(1, width + 1) for a, c in (("x", "x"), ("y", "y"), ("w", "words"))],
    )


def _roll_up(blocks: DataFrame, width: int, measures: str) -> DataFrame:
    """A row per node: depth, its own and its parent's hash, the words before its last turn, and the measures over its members."""
    places = ", ".join(f"(x{i}, y{i}, w{i})" for i in range(1, width + 1))
    rolled = blocks.sparkSession.sql(
        f"SELECT block, key_x, key_y, w0, {places.replace('(', '').replace(')', '')}, "
        f"CAST({width} - bit_count(grouping_id()) DIV 3 AS BIGINT) AS i, {measures} "
        f"FROM {{blocks}} GROUP BY block, key_x, key_y, w0, ROLLUP({places})",
        blocks=blocks,
    )
    depth = F.col("block") * width + F.col("i")
    xor = lambda parts: reduce(lambda a, b: a.bitwiseXOR(b), parts)

    def node(c: str, upto: Column) -> Column:
        steps = [F.when(F.lit(i) <= upto, _place(f"{c}{i}", F.col("block") * width + i)).otherwise(F.lit(0).cast("bigint")) for i in range(1, width + 1)]
        return xor([F.col(f"key_{c}"), *steps])

    there = [F.col(f"x{i}") for i in range(1, width + 1)]
    held = F.when(F.col("i") == 0, F.col("block") == 0).otherwise(F.element_at(F.array(*there), F.greatest(F.col("i"), F.lit(1)).cast("int")).isNotNull())
    before = F.element_at(F.array(*[F.col(f"w{i}") for i in range(width)]), F.greatest(F.col("i"), F.lit(1)).cast("int"))
    own = [c for c in rolled.columns if c not in blocks.columns and c != "i"]
    return rolled.where(held).select(
        depth.alias("depth"),
        *[node(c, F.col("i")).alias(f"node_{c}") for c in "xy"],
        *[node(c, F.col("i") - 1).alias(f"parent_{c}") for c in "xy"],
        F.when(F.col("i") > 0, before).otherwise(F.lit(0)).alias("words_before"),
        *own,
    )


def _sha_of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's joined chunks, which arrive together and in order."""
    now, digest = None, hashlib.sha256()
    for batch in batches:
        done = []
        for x, y, chunk in zip(batch["node_x"].to_pylist(), batch["node_y"].to_pylist(), batch["chunk"].to_pylist()):
            if (x, y) != now:
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = (x, y), hashlib.sha256()
                digest.update(chunk.encode())
            else:
                digest.update(b"," + chunk.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done)], names=["node_x", "node_y", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, digest.hexdigest())], names=["node_x", "node_y", "ends_sha256"])


def _ends(paths: DataFrame) -> DataFrame:
    """``node_x, node_y, ends_sha256`` of the nodes at which conversations end.

    Ids are joined in pieces of at most ``2 ** CHUNK_BITS``; the pieces of a node
    stream through one task in order, as the hash asks, and are never held together.
    """
    chunks = (
        paths.where("depth = length")
        .groupBy("node_x", "node_y", F.shiftright("conv_id", CHUNK_BITS).alias("part"))
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("chunk"))
    )
    ordered = chunks.repartition("node_x", "node_y").sortWithinPartitions("node_x", "node_y", "part")
    return ordered.select("node_x", "node_y", "chunk").mapInArrow(_sha_of_chunks, "node_x bigint, node_y bigint, ends_sha256 string")


def prefix_nodes(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """All prefixes of the conversations in ``turns(conv_id, at, x, y, words)``.

    A row per node: ``conv_id`` of its smallest member, ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.
    """
    paths = stage(_paths(turns), "trie-paths")
    blocks = stage(_blocks(paths, width), "trie-blocks")
    first = stage(_roll_up(blocks, width, "count(*) AS n_convs, min(conv_id) AS owner, max(length) AS longest"), "trie-owners")

    # what of its path a conversation does not own; the largest nodes are broadcast, so no key left is hot
    shared = first.where("n_convs > 1 and depth > 0").select("node_x", "node_y", "n_convs", "owner")
    largest = stage(shared.orderBy(F.desc("n_convs"), "node_x", "node_y").limit(LARGEST), "trie-largest")
    others = shared.join(F.broadcast(largest.select("node_x", "node_y")), ["node_x", "node_y"], "left_anti")
    members = paths.where("depth > 0").select("conv_id", "depth", "words", "node_x", "node_y")
    found = members.join(F.broadcast(largest), ["node_x", "node_y"]).unionByName(members.join(others, ["node_x", "node_y"]))
    foreign = (
        found.where("owner < conv_id")
        .groupBy("conv_id")
        .agg(F.max("depth").alias("shared_depth"), F.max("words").alias("shared_words"), F.max_by("owner", "depth").alias("branch_owner"))
    )
    leaves = first.where("longest = depth").select(F.col("owner").alias("conv_id"), F.lit(1).alias("leaf"))
    known = blocks.join(foreign, "conv_id", "left").join(leaves, "conv_id", "left")
    second = stage(
        _roll_up(
            known.select(*blocks.columns, "shared_depth", "shared_words", "branch_owner", "leaf"),
            width,
            "count(*) AS n_convs, min(conv_id) AS owner, sum(coalesce(shared_words, 0)) AS shared_sum, "
            "min_by(coalesce(shared_words, 0), conv_id) AS owner_words, min_by(coalesce(shared_depth, 0), conv_id) AS owner_depth, "
            "min_by(coalesce(branch_owner, -1), conv_id) AS owner_branch, sum(coalesce(leaf, 0)) AS n_leaves",
        ),
        "trie-nodes",
    )
    children = second.where("depth > 0").groupBy(F.col("parent_x").alias("node_x"), F.col("parent_y").alias("node_y")).agg(F.count("*").alias("n_children"))
    least = second.where("depth = 0").agg(F.min("owner")).collect()[0][0]  # the root's only row
    parent = (
        F.when(F.col("depth") == 0, F.lit(None))
        .when(F.col("depth") - 1 > F.col("owner_depth"), F.col("owner"))
        .when(F.col("owner_depth") > 0, F.col("owner_branch"))
        .otherwise(F.when(F.col("depth") == 1, F.lit(least)).otherwise(F.col("owner")))
    )
    saved = F.col("shared_sum") - F.col("owner_words") - (F.col("n_convs") - 1) * F.col("words_before")
    nodes = second.join(children, ["node_x", "node_y"], "left").join(_ends(paths), ["node_x", "node_y"], "left")
    return nodes.select(
        F.col("owner").alias("conv_id"),
        "depth",
        parent.cast("bigint").alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        F.col("n_leaves").cast("bigint").alias("n_leaves"),
        saved.cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
