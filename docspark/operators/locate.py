"""Locating text: blocks in their page's words, passages in a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.text import first_words, joined_match_keys, last_words, match_key, words
from docspark.sources.scratch import stage

ANCHOR_WORDS = 6

#: Longs of the filter of passage keys: 1 MB, whatever the number of passages.
FILTER_LONGS = 1 << 17
_SEP = "\x01"

#: Consecutive words of a page whose boxes share a row.
STRETCH = 64


# --- blocks in the words of their page ---------------------------------------


def page_words(words_table: DataFrame) -> DataFrame:
    """Words of a page in order: ``words_table(doc_id, page_number, idx, word)``."""
    return words_table.groupBy("doc_id", "page_number").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "word"))), lambda w: w["word"]).alias("words")
    )


def _word_at(marked: Column, pos: Column) -> Column:
    """Index of the word at a 1-based position, counting separators before it."""
    before = F.substring(marked, F.lit(1), pos - 1)
    return F.length(before) - F.length(F.replace(before, F.lit(_SEP), F.lit("")))


def locate_blocks(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Word range of each block on its page, and how it was found.

    ``pages(doc_id, page_number, words array<string>)``. Tries the whole text,
    then its first six words (extended forward by its word count), then its
    last six words from the end (extended back). The match is on characters,
    so it may start inside a word. ``found`` is ``exact``, ``prefix``,
    ``suffix`` or null.
    """
    normal = pages.select(
        "doc_id",
        "page_number",
        joined_match_keys(F.col("words"), _SEP).alias("marked"),
        F.size("words").alias("n_page"),
    ).withColumn("line", F.replace("marked", F.lit(_SEP), F.lit(" ")))
    target = blocks.select("doc_id", "page_number", "block_id", match_key(F.col("text")).alias("t"))
    target = target.select(
        "*",
        first_words(F.col("t"), ANCHOR_WORDS).alias("head"),
        last_words(F.col("t"), ANCHOR_WORDS).alias("tail"),
        F.size(words(F.col("t"))).alias("n_words"),
    )
    line, marked = F.col("line"), F.col("marked")
    placed = (
        target.join(normal, ["doc_id", "page_number"], "left")
        .withColumn("at_all", F.when(F.col("t") != "", F.position("t", line)))
        .withColumn("at_head", F.when((F.col("at_all") == 0), F.position("head", line)))
        .withColumn(
            "at_tail",
            F.when(F.col("at_head") == 0, F.position(F.reverse("tail"), F.reverse(line))),
        )
    )
    # last character of the last occurrence of the tail, 1-based
    tail_end = F.length(line) - F.col("at_tail") + 1
    first = (
        F.when(F.col("at_all") > 0, _word_at(marked, F.col("at_all")))
        .when(F.col("at_head") > 0, _word_at(marked, F.col("at_head")))
        .when(
            F.col("at_tail") > 0,
            F.greatest(_word_at(marked, tail_end) - F.col("n_words") + 1, F.lit(0)),
        )
    )
    last = (
        F.when(F.col("at_all") > 0, _word_at(marked, F.col("at_all") + F.length("t") - 1))
        .when(
            F.col("at_head") > 0,
            F.least(_word_at(marked, F.col("at_head")) + F.col("n_words") - 1, F.col("n_page") - 1),
        )
        .when(F.col("at_tail") > 0, _word_at(marked, tail_end))
    )
    found = (
        F.when(F.col("at_all") > 0, F.lit("exact"))
        .when(F.col("at_head") > 0, F.lit("prefix"))
        .when(F.col("at_tail") > 0, F.lit("suffix"))
    )
    return placed.select(
        "doc_id",
        "page_number",
        "block_id",
        found.alias("found"),
        first.alias("first_word"),
        last.alias("last_word"),
    )


def range_boxes(ranges: DataFrame, boxes: DataFrame) -> DataFrame:
    """Box around a word range, normalised by the page size and clamped to 0..1.

    ``boxes(doc_id, page_number, idx, x0, y0, x1, y1, page_w, page_h)``. The
    boxes of ``STRETCH`` consecutive words share a row, so a range meets the few
    stretches it touches and not each of its words.
    """
    w = F.when(F.coalesce("page_w", F.lit(0.0)) == 0.0, F.lit(1.0)).otherwise(F.col("page_w"))
    h = F.when(F.coalesce("page_h", F.lit(0.0)) == 0.0, F.lit(1.0)).otherwise(F.col("page_h"))
    box = F.struct(
        "idx", (F.col("x0") / w).alias("x0"), (F.col("y0") / h).alias("y0"), (F.col("x1") / w).alias("x1"), (F.col("y1") / h).alias("y1")
    )
    page = ["doc_id", "page_number"]
    stretches = boxes.groupBy(*page, F.floor(F.col("idx") / STRETCH).alias("stretch")).agg(F.collect_list(box).alias("boxes"))
    low, high = F.least("first_word", "last_word"), F.greatest("first_word", "last_word")
    touched = ranges.filter(F.col("found").isNotNull()).select(
        *page, "block_id", low.alias("low"), high.alias("high"),
        F.explode_outer(F.sequence(F.floor(low / STRETCH), F.floor(high / STRETCH))).alias("stretch"),
    )
    hits = F.filter("boxes", lambda b: (b["idx"] >= F.col("low")) & (b["idx"] <= F.col("high")))
    met = touched.join(stretches, [*page, "stretch"]).withColumn("hits", hits).filter(F.size("hits") > 0)
    ends = met.select(*page, "block_id", *[pick(F.col("hits")[c]).alias(c) for c, pick in (("x0", F.array_min), ("y0", F.array_min), ("x1", F.array_max), ("y1", F.array_max))])
    return ends.groupBy(*page, "block_id").agg(
        F.greatest(F.lit(0.0), F.min("x0")).alias("x0"),
        F.greatest(F.lit(0.0), F.min("y0")).alias("y0"),
        F.least(F.lit(1.0), F.max("x1")).alias("x1"),
        F.least(F.lit(1.0), F.max("y1")).alias("y1"),
    )


# --- passages in a corpus ----------------------------------------------------


def _run_key(w: Column, start: Column, run: Column) -> list[Column]:
    """128-bit key ``a``, ``b`` of a run of at most six words, so equal keys of runs of a length mean equal words.

    Words are hashed one after the other where they stand; the hash skips the nulls of shorter runs.
    """
    run_words = [F.when(run > i, F.get(w, start + i)) for i in range(ANCHOR_WORDS)]
    return [F.xxhash64(*run_words).alias("a"), F.xxhash64(F.lit(1), *run_words).alias("b")]


def _key_filter(keys: DataFrame) -> DataFrame:
    """One row with a Bloom filter of the keys ``a``, ``b``: an array of longs, two bits a key, of a fixed size.

    The bits of a long are combined before they are shuffled. With very many keys
    the filter fills up and lets more through; results do not depend on it.
    """
    bit = lambda c: F.struct(F.pmod(c, F.lit(FILTER_LONGS)).cast("int").alias("at"), _bit_no(c).alias("bit"))
    bits = keys.select(F.explode(F.array(bit(F.col("a")), bit(F.col("b")))).alias("x"))
    longs = bits.groupBy(F.col("x.at").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, x.bit)")).alias("v"))
    filled = longs.unionByName(keys.sparkSession.range(FILTER_LONGS).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("bigint").alias("v")))
    merged = filled.groupBy("at").agg(F.bit_or("v").alias("v"))
    return merged.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("bits"))


def _bit_no(key: Column) -> Column:
    return F.shiftrightunsigned(key, 58).cast("int")


def _in_filter(bits: Column, key: Column) -> Column:
    return F.getbit(F.get(bits, F.pmod(key, F.lit(FILTER_LONGS)).cast("int")), _bit_no(key)) == 1


def locate_passages(passages: DataFrame, docs: DataFrame, rows_per_task: int = 200_000) -> DataFrame:
    """Where passages occur in documents, token-aligned: exact, by head, by tail.

    ``passages(item_id, text)``, ``docs(doc_id, text)``. A passage is covered
    by runs of six words. Documents give the key and the position of their runs,
    and the two sides meet in one equi-join on the key. A passage
    occurs where all its runs line up at one start. So passages are never
    crossed with documents and no text is looked at again. Passages shorter
    than six words are one run of their own length.

    Runs of documents are probed against a Bloom filter of the passages' keys
    before they leave their task, and runs of lengths that no passage has are
    not listed. The ones that pass are written and counted by key; a key of more
    than ``rows_per_task`` runs is spread over as many parts as that takes, and
    its passages are repeated for each part.

    Per pair the whole text wins over the head, the head over the tail; of
    several heads the first counts, of several tails the last.
    """
    p = passages.select("item_id", words(match_key(F.col("text"))).alias("w"))
    p = p.filter(F.size("w") > 0).select(
        "item_id", "w", F.size("w").alias("n_words"), F.least(F.size("w"), F.lit(ANCHOR_WORDS)).alias("run")
    )
    tail = F.col("n_words") - F.col("run")
    offsets = F.array_distinct(F.concat(F.sequence(F.lit(0), tail, F.col("run")), F.array(tail)))
    cover = p.select(
        "item_id", "w", "run", "n_words", F.size(offsets).alias("n_cover"), F.explode_outer(offsets).alias("offset")
    ).select("item_id", "run", "n_words", "n_cover", "offset", *_run_key(F.col("w"), F.col("offset"), F.col("run")))
    cover = stage(cover, "cover")
    lengths = cover.agg(F.collect_set("run").alias("lengths")).scalar()
    bits = _key_filter(cover).scalar()
    d = docs.select("doc_id", words(match_key(F.col("text"))).alias("w"))
    # plain generators and expressions over the words in place: no text is built for a run, and all of it is compiled
    starts = F.when(F.size("w") >= F.col("run"), F.sequence(F.lit(0), F.size("w") - F.col("run")))
    listed = (
        d.select("doc_id", "w", F.explode_outer(lengths).alias("run"))
        .select("doc_id", "w", "run", F.explode_outer(starts).alias("pos"))
        .filter(F.col("pos").isNotNull())
        .select("doc_id", F.size("w").alias("n_doc"), "run", "pos", *_run_key(F.col("w"), F.col("pos"), F.col("run")))
    )
    runs = stage(listed.filter(_in_filter(bits, F.col("a")) & _in_filter(bits, F.col("b"))), "runs")
    keys = ["run", "a", "b"]
    parts = runs.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows_per_task).cast("int").alias("parts"))
    frequent = parts.filter(F.col("parts") > 1)
    part = F.coalesce(F.pmod(F.xxhash64("doc_id", "pos"), F.col("parts")).cast("int"), F.lit(0))
    runs = runs.join(frequent, keys, "left").select("doc_id", "n_doc", "pos", *keys, part.alias("part"))
    all_parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    cover = cover.join(frequent, keys, "left").select("item_id", "n_words", "n_cover", "offset", *keys, F.explode_outer(all_parts).alias("part"))
    start = F.col("pos") - F.col("offset")
    is_tail = F.col("offset") == F.col("n_words") - F.col("run")
    lined_up = (
        runs.join(cover, [*keys, "part"])
        .groupBy("item_id", "doc_id", "n_words", "n_doc", start.alias("start"))
        .agg(
            (F.count(F.lit(1)) == F.max("n_cover")).alias("whole"),
            F.bool_or(F.col("offset") == 0).alias("head"),
            F.bool_or(is_tail).alias("tail"),
        )
    )
    best = lined_up.groupBy("item_id", "doc_id", "n_words", "n_doc").agg(
        F.min(F.when(F.col("whole"), F.col("start"))).alias("exact"),
        F.min(F.when(F.col("head"), F.col("start"))).alias("prefix"),
        F.max(F.when(F.col("tail"), F.col("start"))).alias("suffix"),
    )
    s = F.coalesce("exact", "prefix", "suffix")
    found = (
        F.when(F.col("exact").isNotNull(), F.lit("exact"))
        .when(F.col("prefix").isNotNull(), F.lit("prefix"))
        .when(F.col("suffix").isNotNull(), F.lit("suffix"))
    )
    return best.filter(found.isNotNull()).select(
        "item_id",
        "doc_id",
        found.alias("found"),
        F.greatest(s, F.lit(0)).alias("first_word"),
        F.least(s + F.col("n_words"), F.col("n_doc")).alias("end_word"),
    )
