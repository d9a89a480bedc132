"""Blocks and pages: splitting, exact character spans, geometry, trees.

Two ways lead to pages. ``pages_from_text`` cuts each document inside its own
row, without a shuffle. ``pages_from_blocks`` takes a block table that a
layout step produced and groups it once by page. Both give the same rows.

Arrays are unnested with the outer generators. The inner ones make Catalyst
add a filter on the array size, which computes the whole array a second time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.text import cut, is_blank, prefix_sums, strip
from docspark.operators.running import running_total
from docspark.sources.scratch import stage

BlockPredicate = Callable[[Column], Column]
SPAN_ROWS = "array<struct<block_id:string,start:int,end:int>>"


# --- documents to blocks -----------------------------------------------------


def _line_structs(text: Column, doc_id: Column, lines_per_page: int, mark: BlockPredicate | None = None) -> Column:
    def line(t: Column, i: Column) -> Column:
        return F.struct(
            i.alias("ord"),
            F.concat_ws("-", doc_id.cast("string"), i.cast("string")).alias("block_id"),
            (F.floor(i / lines_per_page) + 1).cast("int").alias("page_number"),
            t.alias("text"),
            *([mark(t).alias("marked")] if mark else []),
        )

    return F.transform(F.split(text, "\n", -1), line)


def blocks_from_text(docs: DataFrame, lines_per_page: int = 5) -> DataFrame:
    """One block per line of ``docs(doc_id, text)``; every row stays in place.

    A page is a run of ``lines_per_page`` lines.
    """
    line = F.inline_outer(_line_structs(F.col("text"), F.col("doc_id"), lines_per_page))
    return docs.select("doc_id", line).select(
        "doc_id",
        "ord",
        "block_id",
        "page_number",
        F.concat(F.lit("page_"), F.col("page_number"), F.lit("/paragraph")).alias("section_path"),
        "text",
    )


def page_groups_from_text(docs: DataFrame, lines_per_page: int = 5, mark: BlockPredicate | None = None) -> DataFrame:
    """One row per page with its blocks as an array, cut inside each document row.

    With ``mark``, a predicate on the text of a line, blocks carry it as ``marked``, and pages without a marked block are left out.
    """
    lines = _line_structs(F.col("text"), F.col("doc_id"), lines_per_page, mark)
    last = F.floor((F.size("lines") - 1) / lines_per_page).cast("int")
    cuts = F.transform(
        F.sequence(F.lit(0), last),
        lambda p: F.slice(F.col("lines"), p * lines_per_page + 1, lines_per_page),
    )
    pages = (
        docs.select("doc_id", lines.alias("lines"))
        .select("doc_id", F.posexplode_outer(cuts).alias("p", "blocks"))
        .select("doc_id", (F.col("p") + 1).alias("page_number"), "blocks")
    )
    return pages.filter(F.exists("blocks", lambda b: b["marked"])) if mark else pages


def page_groups_from_blocks(blocks: DataFrame) -> DataFrame:
    """One row per page with its blocks in input order, grouped by one shuffle.

    A page becomes one row because its text is one value; long documents
    spread over their pages.
    """
    row = F.struct("ord", "block_id", "page_number", "text")
    return blocks.groupBy("doc_id", F.coalesce("page_number", F.lit(1)).alias("page_number")).agg(
        F.array_sort(F.collect_list(row)).alias("blocks")
    )


def paragraph_blocks(pages: DataFrame) -> DataFrame:
    """Fallback blocks for ``pages(doc_id, page_number, paragraphs array<string>)``."""
    page = F.col("page_number").cast("string")
    return pages.select("doc_id", "page_number", F.posexplode("paragraphs").alias("i", "text")).select(
        "doc_id",
        F.col("i").alias("ord"),
        F.concat(F.lit("p"), page, F.lit("-para-"), F.col("i")).alias("block_id"),
        "page_number",
        F.concat(F.lit("page_"), page, F.lit("/paragraph")).alias("section_path"),
        "text",
    )


def prefer_layout(layout: DataFrame, fallback: DataFrame, docs: DataFrame) -> DataFrame:
    """Layout blocks of each document, or its fallback blocks where it has none."""
    have = layout.select("doc_id").distinct()
    missing = docs.select("doc_id").join(have, "doc_id", "left_anti")
    return layout.unionByName(fallback.join(missing, "doc_id", "left_semi"))


# --- pages with exact spans --------------------------------------------------


def assemble_pages(
    groups: DataFrame,
    drop: BlockPredicate | None = None,
    describe: Callable[[Column], list[Column]] | None = None,
    span_type: str = SPAN_ROWS,
) -> DataFrame:
    """Page text with the exact character span of every block in it.

    Blank blocks and blocks for which ``drop`` holds are left out, and no
    separator is counted for them. ``describe`` adds fields computed from a
    block to its span; ``span_type`` must then name them as well.
    ``block_ids`` lists all blocks of the page.
    """

    def keep(b: Column) -> Column:
        ok = ~is_blank(b["text"])
        return ok & ~drop(b) if drop else ok

    def tidy(b: Column) -> Column:
        return F.struct(
            b["block_id"].alias("block_id"),
            strip(b["text"]).alias("text"),
            *(describe(b) if describe else []),
        )

    extra = T.DataType.fromDDL(span_type).elementType.names[3:]

    def span(b: Column, start: Column) -> Column:
        return F.struct(
            b["block_id"].alias("block_id"),
            start.alias("start"),
            (start + F.length(b["text"])).alias("end"),
            *[b[n].alias(n) for n in extra],
        )

    # projections of their own: what several columns use is computed once
    kept = groups.withColumn("kept", F.transform(F.filter("blocks", keep), tidy)).withColumn(
        "starts", prefix_sums(F.transform("kept", lambda b: F.length(b["text"]) + 1))
    )
    return kept.select(
        "doc_id",
        "page_number",
        F.array_join(F.transform("kept", lambda b: b["text"]), "\n").alias("text"),
        F.transform("blocks", lambda b: b["block_id"]).alias("block_ids"),
        F.zip_with("kept", "starts", span).cast(span_type).alias("block_spans"),
    )


def pages_from_text(docs: DataFrame, lines_per_page: int = 5, mark: BlockPredicate | None = None, **kw) -> DataFrame:
    return assemble_pages(page_groups_from_text(docs, lines_per_page, mark), **kw)


def pages_from_blocks(blocks: DataFrame, **kw) -> DataFrame:
    return assemble_pages(page_groups_from_blocks(blocks), **kw)


def span_rows(pages: DataFrame) -> DataFrame:
    """One row per block span."""
    return pages.select("doc_id", "page_number", F.inline_outer("block_spans")).filter(
        F.col("block_id").isNotNull()
    )


def block_offsets(blocks: DataFrame, chunk: int = 10_000) -> DataFrame:
    """Spans of blocks in their page text, for pages too long for one value.

    Only lengths travel, and a very long page is summed up in chunks of blocks.
    """
    rows = blocks.filter(~is_blank(F.col("text"))).select(
        "doc_id", "page_number", "ord", "block_id", F.length(strip(F.col("text"))).alias("n")
    )
    placed = running_total(rows, ["doc_id", "page_number"], "ord", F.col("n") + 1, "before", chunk)
    start = F.col("before").cast("int")
    return placed.select(
        "doc_id", "page_number", "block_id", start.alias("start"), (start + F.col("n")).alias("end")
    )


# --- text anchors and geometry -----------------------------------------------


def text_of_segments(full_text: Column, segments: Column) -> Column:
    """Concatenated ``[start, end)`` slices of a text."""
    return F.array_join(
        F.transform(
            segments,
            lambda s: cut(
                full_text,
                F.greatest(F.coalesce(s["start"], F.lit(0)), F.lit(0)),
                F.coalesce(s["end"], F.lit(0)),
            ),
        ),
        "",
    )


def envelope(normalized: Column, raw: Column) -> Column:
    """``[x0, y0, x1, y1]`` around a vertex list, empty when there is none.

    Normalised vertices win over raw ones; a missing coordinate counts as 0.
    """
    v = F.when(F.size(normalized) > 0, normalized).when(F.size(raw) > 0, raw)
    xs = F.transform(v, lambda p: F.coalesce(p["x"].cast("double"), F.lit(0.0)))
    ys = F.transform(v, lambda p: F.coalesce(p["y"].cast("double"), F.lit(0.0)))
    box = F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))
    return F.when(v.isNotNull(), box).otherwise(F.array().cast("array<double>"))


def geometry_counts(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Blocks with a box, and all blocks, per document."""
    return blocks.groupBy(key).agg(
        F.count_if(F.size("bbox") > 0).alias("with_bbox"), F.count(F.lit(1)).alias("blocks")
    )


def without_geometry(blocks: DataFrame) -> DataFrame:
    return blocks.filter(F.coalesce(F.size("bbox"), F.lit(0)) <= 0)


# --- trees -------------------------------------------------------------------


def flatten_tree(nodes: DataFrame) -> DataFrame:
    """Depth-first flatten of ``nodes(node_id, parent_id, pos, kind, page, text, bbox)``.

    Paths double in length each round: a node knows the path up to some ancestor,
    and takes over what that ancestor knows. A tree of depth n takes log2(n)
    rounds, each written before the next one reads it, and a node that has met its
    root is not touched again. Rounds move ids and paths; texts are joined once, at
    the end. A node is emitted if it has text or a box, but its children are
    walked in any case. ``path`` is ``page_<n>/<kind>/<kind>...``; ``order_key``
    is the array of child positions, which sorts depth first.

    Trees of any depth are walked to the end. Nodes that no root leads to are not
    part of a tree; :func:`loose_nodes` gives them. Rows that are repeated whole
    count once as parents. Raises ValueError where a repeated ``node_id`` or a
    circle makes a node its own ancestor.
    """
    given = [F.col(c) for c in ("node_id", "parent_id", "pos", "kind", "page", "text", "bbox")]
    keyed = nodes.select("*", F.xxhash64(*given).alias("row_a"), F.xxhash64(*given, F.lit(1)).alias("row_b"))
    page = F.concat(F.lit("page_"), F.coalesce("page", F.lit(1)).cast("string"))
    steps = keyed.select(
        "row_a",
        "row_b",
        "node_id",
        F.col("parent_id").alias("above"),
        F.when(F.col("parent_id").isNull(), F.concat_ws("/", page, "kind")).otherwise(F.concat_ws("/", "kind")).alias("path"),
        F.array(F.col("pos").cast("long")).alias("order_key"),
    ).distinct()
    met_root, to_go = F.col("above").isNull(), F.col("above").isNotNull()
    step = stage(steps, "tree")
    rooted, reach, most = step.filter(met_root), 1, None
    while not step.filter(to_go).isEmpty():
        most = step.count() if most is None else most
        if reach > most or not step.filter(F.col("above") == F.col("node_id")).isEmpty():
            raise ValueError("a node is its own ancestor")
        known = rooted.unionByName(step.filter(to_go)).select(
            F.col("node_id").alias("above"), F.col("above").alias("next"), F.col("path").alias("up"), F.col("order_key").alias("keys")
        )
        joined = step.filter(to_go).join(known, "above").select(
            "row_a",
            "row_b",
            "node_id",
            F.col("next").alias("above"),
            F.concat_ws("/", "up", "path").alias("path"),
            F.concat("keys", "order_key").alias("order_key"),
        )
        step, reach = stage(joined, "tree"), reach * 2
        rooted = rooted.unionByName(step.filter(met_root))
    has_text = F.coalesce(F.col("text"), F.lit("")) != ""
    emitted = keyed.filter(has_text | (F.coalesce(F.size("bbox"), F.lit(0)) > 0))
    return emitted.select("row_a", "row_b", "node_id", "page", "text", "bbox").join(
        rooted.drop("node_id"), ["row_a", "row_b"]
    ).select("node_id", "page", "text", "bbox", "path", "order_key")


def loose_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes whose parent is not in the table: with all below them, they hang on no root."""
    ids = nodes.select(F.col("node_id").alias("parent_id")).distinct()
    return nodes.filter(F.col("parent_id").isNotNull()).join(ids, "parent_id", "left_anti")


# --- document text for a model -----------------------------------------------


def collect_pages(pages: DataFrame) -> DataFrame:
    """Pages of a document in order as one array; the prompt is one text value."""
    return pages.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("page_number", "text"))).alias("pages")
    )


def pages_in_row(docs: DataFrame, lines_per_page: int = 5) -> DataFrame:
    """Like :func:`collect_pages`, cut inside each document row."""
    lines = F.split("text", "\n", -1)
    last = F.floor((F.size(lines) - 1) / lines_per_page).cast("int")

    def page(p: Column) -> Column:
        part = F.slice(lines, p * lines_per_page + 1, lines_per_page)
        kept = F.filter(F.transform(part, strip), lambda t: t != "")
        return F.struct((p + 1).alias("page_number"), F.array_join(kept, "\n").alias("text"))

    return docs.select("doc_id", F.transform(F.sequence(F.lit(0), last), page).alias("pages"))


def doc_prompt(doc_pages: DataFrame, hints: Column | None = None) -> DataFrame:
    """One text per document: header, optional hints, then a section per page.

    ``hints`` is ``array<struct<field_name,hint>>``; nothing is printed for an
    empty one.
    """
    header = F.concat(
        F.lit("Source document: doc_id="),
        F.col("doc_id").cast("string"),
        F.lit(", total_pages="),
        F.size("pages").cast("string"),
    )
    sections = F.transform(
        "pages",
        lambda p: F.concat(
            F.lit("## Page "),
            p["page_number"].cast("string"),
            F.lit("\n"),
            F.coalesce(F.nullif(strip(p["text"]), F.lit("")), F.lit("(empty)")),
            F.lit("\n"),
        ),
    )
    parts = [header]
    if hints is not None:
        rows = F.transform(
            hints, lambda h: F.concat(F.lit("  - "), h["field_name"], F.lit(": "), h["hint"])
        )
        title = "\n**Hints from the previous attempt:**\n"
        parts.append(F.when(F.size(hints) > 0, F.concat(F.lit(title), F.array_join(rows, "\n"))))
    parts += [F.lit("\n---"), F.array_join(sections, "\n")]
    return doc_pages.select(
        "doc_id", F.size("pages").alias("total_pages"), F.concat_ws("\n", *parts).alias("prompt")
    )
