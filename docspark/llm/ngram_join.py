"""Jaccard self-join of documents on word shingles, by token-combination prefixes.

Tokens are the shingles of a document. They are ordered by how common they are,
as a fixed-size count sketch over all documents tells, rare ones first, and put
into classes. From a prefix in that order come the signatures: single tokens of
the rare class, pairs of tokens of the frequent class, triples of the most
frequent class. A pair or triple is taken within a cell, so that a prefix has
about as many combinations as tokens. If c tokens of a cell of class k are in
the prefix, at least c - k + 1 of them must be missing in the other set before
no combination is shared; the prefix is extended until these numbers add up to
more than a partner may miss. So two sets that reach the threshold share a
signature, and nothing is lost.

Equal sets are one node. Sets that share a signature are first compared with one
of them only, which joins large groups of near copies in a number of comparisons
that grows with their size, not its square. What then is left, pairs that share
a signature and are in different components, is compared in full.

A set is identified by a 64-bit fingerprint, a shingle by a 64-bit hash.
Null and empty texts have the empty set and link with nothing; rows that repeat
an id or a text are rows of their own; null ids are never a component's id; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.llm import bytewords
from docspark.llm.components import components, contracted, labels
from docspark.sources.scratch import stage

#: Cells of the count sketch, and the rows it is sent in.
SKETCH_CELLS, SKETCH_PARTS = 1 << 20, 64
#: Bits of the filter that keeps sets without a candidate pair from being sent.
FILTER_BITS = 1 << 26
#: Columns that hold the parities of 64 cells each.
COARSE = tuple(f"b{i}" for i in range(8))
#: Members of a signature up to which pairs are not tested by parities before they leave the join.
SMALL_GROUP = 32
#: Sets smaller than this use single tokens only.
SMALLEST_CELLED = 32

WORDS = bytewords.byte_table((0x20, 0x20), (0x09, 0x0D))

_rng = np.random.default_rng(11)
_WEIGHTS = _rng.integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(block: bytewords.Block, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a block.

    With fewer words than ``size`` the whole sequence is the one shingle.
    """
    rows, s, e = bytewords.word_spans(block, WORDS)
    words = bytewords.span_hashes(block.data, s, e)
    bounds = np.searchsorted(rows, np.arange(len(block) + 1))
    n = max(0, len(words) - size + 1)
    rolled = np.zeros(n, np.uint64)
    for j in range(size):
        rolled += words[j : j + n] * _WEIGHTS[j]
    rolled = bytewords.mix(rolled)
    sets = []
    for i in range(len(block)):
        lo, hi = bounds[i], bounds[i + 1]
        if hi - lo >= size:
            sets.append(np.unique(rolled[lo : hi - size + 1]))
        elif hi > lo:
            few = (words[lo:hi] * _WEIGHTS[: hi - lo]).sum(dtype=np.uint64, keepdims=True)
            sets.append(bytewords.mix(few + np.array([hi - lo], np.uint64) * _WEIGHTS[-1]))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def fingerprint(tokens: np.ndarray) -> int:
    """A signed 64-bit number for a set."""
    total = int(bytewords.mix(tokens ^ _WEIGHTS[-2]).sum(dtype=np.uint64)) + len(tokens) * int(_WEIGHTS[-3])
    return (total + (1 << 63)) % (1 << 64) - (1 << 63)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def parity(tokens: np.ndarray, cells: int = 0) -> bytes:
    """Per cell of a small table, whether it holds an odd number of a set's tokens; about two cells a token.

    Where the tables of two sets differ, a token is in one set only, so the
    cells that differ are no more than such tokens.
    """
    if not cells:
        cells = max(8, 1 << (2 * len(tokens) - 1).bit_length()) if len(tokens) else 8
    spots = np.bincount((tokens >> np.uint64(20) & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((spots & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the number of tokens that are in one of two sets only."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) > len(b):
        a, b = b, a
    if len(b) > len(a):  # a table folds onto one of half the cells
        b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def least_overlap(n: int, percent: int) -> int:
    """Tokens that a set of ``n`` shares at least with any set at the threshold."""
    return -(-percent * n // 100)


def _coarse(sets: list[np.ndarray]) -> list[pa.Array]:
    """Parities of 512 cells as numbers, one Arrow column for each of ``COARSE``."""
    words = np.frombuffer(b"".join(parity(x, 64 * len(COARSE)) for x in sets), np.int64).reshape(-1, len(COARSE))
    return [pa.array(np.ascontiguousarray(column)) for column in words.T]


def _scan(size: int):
    """Per text its set's size, fingerprint and parities; at the end of a task the token counts it has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH_CELLS, np.uint32)
        seen: set[int] = set()
        for batch in batches:
            ids, column = batch["doc_id"], batch["text"]
            for block in bytewords.blocks(column):
                sets = shingle_sets(block, size)
                prints = [fingerprint(x) for x in sets]
                fresh = []
                for x, p in zip(sets, prints):
                    if p not in seen:
                        seen.add(p)
                        fresh.append(x)
                cells = np.concatenate(fresh) & np.uint64(SKETCH_CELLS - 1) if fresh else np.zeros(0, np.uint64)
                counts += np.bincount(cells.astype(np.int64), minlength=SKETCH_CELLS).astype(np.uint32)
                n = len(block)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(block.first, n).cast(pa.int64()),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array(prints, pa.int64()),
                        pa.nulls(n, pa.int32()),
                        pa.array([parity(x) for x in sets], pa.binary()),
                        *_coarse(sets),
                    ],
                    names=["doc_id", "n", "id", "part", "data", *COARSE],
                )
        if seen:
            parts = []
            for part in counts.reshape(SKETCH_PARTS, -1):
                kind = np.uint8 if part.max() < 256 else np.uint16 if part.max() < 65536 else np.uint32
                parts.append(part.astype(kind).tobytes())
            k = len(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(k, pa.int64()),
                    pa.nulls(k, pa.int64()),
                    pa.array([next(iter(seen))] * k, pa.int64()),
                    pa.array(range(k), pa.int32()),
                    pa.array(parts, pa.binary()),
                    *[pa.nulls(k, pa.int64())] * len(COARSE),
                ],
                names=["doc_id", "n", "id", "part", "data", *COARSE],
            )

    return run


def _add_counts(rows: pd.DataFrame) -> pd.DataFrame:
    """The sum of count rows of one part."""
    width = SKETCH_CELLS // SKETCH_PARTS
    total = np.zeros(width, np.uint64)
    for blob in rows["counts"]:
        total += np.frombuffer(blob, np.dtype(f"u{len(blob) // width}"))
    return pd.DataFrame({"part": [rows["part"].iloc[0]], "salt": [0], "counts": [total.tobytes()]})


def token_levels(counted: DataFrame) -> np.ndarray:
    """A level per sketch cell: 0 for rare tokens, then one more for each doubling of the count.

    ``counted(part, id, counts)`` holds the tasks' counts. They are added in two
    steps, so that no group grows with the number of tasks; what comes to the
    driver has a fixed size.
    """
    salted = counted.select("part", F.pmod("id", F.lit(64)).alias("salt"), "counts")
    schema = "part int, salt bigint, counts binary"
    some = salted.groupBy("part", "salt").applyInPandas(_add_counts, schema)
    total = np.zeros((SKETCH_PARTS, SKETCH_CELLS // SKETCH_PARTS))
    for row in some.groupBy("part").applyInPandas(_add_counts, schema).collect():
        total[row["part"]] = np.frombuffer(row["counts"], np.uint64)
    total = total.ravel()
    rare = 64 + 2 * total.mean()
    return np.where(total < rare, 0, 1 + np.floor(np.log2(np.maximum(total, rare) / rare))).astype(np.uint8)


def _celled(tokens: np.ndarray, levels: np.ndarray, need: int, band: int) -> np.ndarray:
    """Signatures for one band of sizes, of tokens in order with their levels, until ``need`` misses are covered."""
    kinds = np.where(levels == 0, 1, np.where(levels <= 2, 2, 3))
    single = int(np.searchsorted(kinds, 2))
    if single >= need or (1 << band) < SMALLEST_CELLED:
        return tokens[:need]
    n_cells = np.uint64(max(1, (1 << band) // 16))
    cells = ((tokens >> np.uint64(40)) % n_cells).astype(np.int64)
    groups: dict[tuple[int, int], list[int]] = {}
    covered = single
    for i in range(single, len(tokens)):
        held = groups.setdefault((int(kinds[i]), int(cells[i])), [])
        held.append(i)
        covered += len(held) >= kinds[i]
        if covered >= need:
            break
    found = [tokens[:single]]
    for (kind, _), held in groups.items():
        if len(held) >= kind:
            picked = np.sort(tokens[held])
            chosen = np.array(list(combinations(picked.tolist(), kind)), np.uint64)
            mixed = (chosen * _WEIGHTS[:kind]).sum(axis=1, dtype=np.uint64) + np.uint64(1000 * kind + band)
            found.append(bytewords.mix(mixed))
    return np.concatenate(found)


def signatures(tokens: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """All signatures of a set: sets at the threshold share at least one."""
    n = len(tokens)
    own = levels[(tokens & np.uint64(SKETCH_CELLS - 1)).astype(np.int64)]
    order = np.lexsort((tokens, own))
    tokens, own = tokens[order], own[order]
    need = n - least_overlap(n, percent) + 1
    band = n.bit_length() - 1
    found = _celled(tokens, own, need, band)
    if 100 * n >= percent << (band + 1):  # a partner may be in the next band
        found = np.unique(np.concatenate([found, _celled(tokens, own, need, band + 1)]))
    return found


def _sign(size: int, percent: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        table = levels.value
        for batch in batches:
            for block in bytewords.blocks(batch["text"]):
                found, ids, sizes, rare = [], [], [], []
                for tokens in shingle_sets(block, size):
                    if len(tokens):
                        p = fingerprint(tokens)
                        if p not in seen:
                            seen.add(p)
                            found.append(signatures(tokens, table, percent))
                            ids.append(p)
                            sizes.append(len(tokens))
                            rare.append(int((table[(tokens & np.uint64(SKETCH_CELLS - 1)).astype(np.int64)] == 0).sum()))
                if found:
                    counts = [len(x) for x in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(_signed(np.concatenate(found))),
                            pa.array(np.repeat(np.array(ids, np.int64), counts)),
                            pa.array(np.repeat(np.array(sizes, np.int32), counts)),
                            pa.array(np.repeat(np.array(rare, np.int32), counts)),
                        ],
                        names=["signature", "id", "n", "rare"],
                    )

    return run


def _send(size: int, wanted):
    """The sets whose fingerprint passes the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        bits = np.frombuffer(wanted.value, np.uint8)
        for batch in batches:
            for block in bytewords.blocks(batch["text"]):
                ids, sets = [], []
                for tokens in shingle_sets(block, size):
                    p = fingerprint(tokens)
                    spot = p % FILTER_BITS
                    if bits[spot >> 3] >> (spot & 7) & 1 and p not in seen:
                        seen.add(p)
                        ids.append(p)
                        sets.append(tokens)
                if ids:
                    bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                    held = pa.ListArray.from_arrays(pa.array(bounds), pa.array(_signed(np.concatenate(sets))))
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), held], names=["id", "tokens"])

    return run


def _filter_bits(ids: DataFrame):
    """A bitmap of fixed size with the spot of every id."""
    width = FILTER_BITS // 8
    spots = ids.select(F.pmod("id", F.lit(FILTER_BITS)).alias("spot")).distinct()
    words = spots.groupBy((F.expr("spot & ~63L")).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits")
    )
    out = np.zeros(width // 8, np.uint64)
    held = words.toPandas()
    out[held["word"].to_numpy() >> 6] = held["bits"].to_numpy().view(np.uint64)
    return out.tobytes()


def _close(a: Column, b: Column, percent: int) -> Column:
    """Whether two set sizes allow the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _may_link(percent: int):
    """Pairs whose parities leave the threshold possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y, n, m in zip(batch["x"], batch["y"], batch["n"].to_numpy(), batch["m"].to_numpy()):
                # with an overlap of o the sets differ in n + m - 2 o tokens, and o reaches percent of n + m - o
                least = -(-percent * int(n + m) // (100 + percent))
                near.append(least_difference(x.as_py(), y.as_py()) <= n + m - 2 * least)
            mask = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(mask), batch["b"].filter(mask)], names=["a", "b"])

    return run


def _plausible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The ``pairs(a, b)`` that parities cannot rule out."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    used = stage(sketches.select("id", "n", "parity").join(ids, "id", "left_semi"), "jaccard-parities")
    both = pairs.join(used.select(F.col("id").alias("a"), "n", F.col("parity").alias("x")), "a").join(
        used.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("parity").alias("y")), "b"
    )
    return both.select("a", "b", "n", "m", "x", "y").mapInArrow(_may_link(percent), "a bigint, b bigint")


def _verify(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """``a, b, linked`` for all ``pairs(a, b)`` of fingerprints; sets are taken from the texts.

    Two sets meet in one row and nowhere else, so memory holds two whole texts'
    sets at most.
    """
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    wanted = docs.sparkSession.sparkContext.broadcast(_filter_bits(ids))
    sent = docs.select("text").mapInArrow(_send(size, wanted), "id bigint, tokens array<bigint>")
    sets = stage(sent.join(ids.distinct(), "id", "left_semi").groupBy("id").agg(F.first("tokens").alias("tokens")), "jaccard-sets")
    wanted.destroy()
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b"
    )
    shared = F.size(F.array_intersect("x", "y")).cast("bigint")
    linked = 100 * shared >= percent * (F.size("x") + F.size("y") - shared)
    return stage(both.select("a", "b", linked.alias("linked")), "jaccard-compared")


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85, star_rounds: int = 2) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for ``docs(doc_id, text)``.

    Documents link when their sets of ``size``-word shingles have a Jaccard
    similarity of at least ``percent`` / 100. ``component_id`` is the smallest
    ``doc_id`` that links lead to. Below 50 signatures would not reach all
    partners, so that is refused.
    """
    if percent < 50:
        raise ValueError(f"percent must be at least 50, not {percent}")
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    scanned = stage(docs.mapInArrow(_scan(size), "doc_id bigint, n bigint, id bigint, part int, data binary, " + ", ".join(f"{b} bigint" for b in COARSE)), "jaccard-scan")
    nodes = scanned.where("n is not null").select("doc_id", "n", "id")
    kept = {"n": "n", "data": "parity", **{b: b for b in COARSE}}
    sketches = stage(scanned.where("n > 0").groupBy("id").agg(*[F.first(c).alias(name) for c, name in kept.items()]), "jaccard-sketches")
    levels = spark.sparkContext.broadcast(token_levels(scanned.where("part is not null").select("part", "id", F.col("data").alias("counts"))))

    postings = stage(docs.select("text").mapInArrow(_sign(size, percent, levels), "signature bigint, id bigint, n int, rare int"), "jaccard-postings")
    shared = (
        postings.groupBy("signature")
        .agg(F.min(F.struct("rare", "n", "id")).alias("low"), F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first != last")
    )
    groups = stage(
        postings.join(shared, "signature").select("signature", "id", "n", "rare", F.col("low.id").alias("lead"), F.col("low.n").alias("lead_n")),
        "jaccard-groups",
    )
    levels.destroy()
    compared = edges = None
    in_groups = groups
    for turn in range(star_rounds + 1):
        if turn:  # members of groups that still hold several components, as far as one round of contraction tells
            edges = contracted(edges)
            joined = labels(edges)
            placed = groups.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
            leads = joined.select(F.col("id").alias("lead"), F.col("component").alias("lead_component"))
            placed = placed.join(leads, "lead", "left").withColumn("lead_component", F.coalesce("lead_component", "lead"))
            mixed = placed.groupBy("signature").agg(
                F.min("component").alias("c1"),
                F.max("component").alias("c2"),
                F.count("*").alias("held"),
                F.min_by(F.struct("id", "n", "component"), F.struct((F.col("lead") == F.col("id")) | (F.col("component") == F.col("lead_component")), "rare", "n", "id")).alias("low"),
            )
            in_groups = placed.join(mixed.where("c1 != c2").select("signature", "low", "held"), "signature")
        if turn < star_rounds:
            lead = F.col("lead") if not turn else F.col("low.id")
            lead_n = F.col("lead_n") if not turn else F.col("low.n")
            apart = F.lit(True) if not turn else F.col("component") != F.col("low.component")
            ends = in_groups.where((F.col("id") != lead) & _close(F.col("n"), lead_n, percent) & apart).select(F.col("id").alias("x"), lead.alias("y"))
        else:
            # members of small groups go without parities: they have few pairs, and zeros take no room
            held = in_groups.select("signature", "id", "n", "component", "held")
            large = held.where(F.col("held") > SMALL_GROUP).join(sketches.select("id", *COARSE), "id")
            small = held.where(F.col("held") <= SMALL_GROUP).select("*", *[F.lit(0).cast("bigint").alias(b) for b in COARSE])
            members = stage(large.select(*small.columns).unionByName(small).drop("held"), "jaccard-members")
            left, right = members.alias("x"), members.alias("y")  # one shuffle serves both
            apart = reduce(add, [F.bit_count(F.col(f"x.{b}").bitwiseXOR(F.col(f"y.{b}"))) for b in COARSE])
            both = F.col("x.n") + F.col("y.n")
            most = both - 2 * F.ceil(both * percent / (100 + percent))  # tokens in one of two linked sets only
            ends = (
                left.join(right, F.col("x.signature") == F.col("y.signature"))
                .where((F.col("x.id") < F.col("y.id")) & (F.col("x.component") != F.col("y.component")))
                .where(_close(F.col("x.n"), F.col("y.n"), percent) & (apart <= most))
                .select(F.col("x.id").alias("x"), F.col("y.id").alias("y"))
            )
        pairs = ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        if compared is not None:
            pairs = pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti")
        near = stage(_plausible(stage(pairs, "jaccard-pairs"), sketches, percent), "jaccard-near")
        done = _verify(docs, near, size, percent)
        compared = done if compared is None else compared.unionByName(done)
        links = done.where("linked").select("a", "b")
        edges = links if edges is None else edges.unionByName(links)

    joined = components(edges)
    keyed = stage(
        nodes.where("n > 0").join(joined, "id", "left").select("doc_id", "n", F.coalesce("component", "id").alias("component")), "jaccard-nodes"
    )
    least = stage(keyed.groupBy("component").agg(F.min("doc_id").alias("component_id")), "jaccard-least")
    linked = keyed.join(least, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    lone = nodes.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(lone)


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id.

    Of rows that repeat an id, one stays. Rows with a null id cannot be told
    apart by it and all stay.
    """
    found = stage(jaccard_components(docs, size, percent), "jaccard-found")
    gone = stage(found.where("doc_id is not null and doc_id != component_id").select("doc_id").distinct(), "jaccard-gone")
    rest = docs.join(gone, "doc_id", "left_anti")
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not repeated.isEmpty():
        again = rest.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        rest = rest.join(repeated, "doc_id", "left_anti").unionByName(again)
    return rest.select(*docs.columns)
