"""Layout JSON and HTML as block rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.operators.blocks import envelope
from docspark.sources.scratch import stage

#: What holds no text: comments, scripts and styles whole, declarations.
HTML_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[!?][^>]*>"

#: A tag, and the text behind it; a bare < belongs to the text.
HTML_TEXT = r"<(/?[a-zA-Z][a-zA-Z0-9-]*)[^>]*>((?:[^<]+|<[^a-zA-Z/!?])+)"

#: Tags that hold no text of their own.
HTML_VOID = ("br", "hr", "img", "input", "wbr", "meta", "link")


def html_blocks(pages: DataFrame) -> DataFrame:
    """All text of marked-up pages as blocks, in order of appearance.

    ``pages(page_id, html)``. A block is a piece of text between two tags that
    is more than white space. Its path names the tag that opens in front of it;
    text behind a closing tag, or a tag without content, is ``text``. Comments,
    scripts and styles are no text.
    """
    shown = F.concat(F.lit("</text>"), F.regexp_replace("html", HTML_HIDDEN, "</text>"))
    tags = F.regexp_extract_all(shown, F.lit(HTML_TEXT), F.lit(1))
    texts = F.regexp_extract_all(shown, F.lit(HTML_TEXT), F.lit(2))
    pairs = F.filter(F.arrays_zip(tags.alias("tag"), texts.alias("text")), lambda b: F.regexp_like(b["text"], F.lit(r"[^ \t\r\n]")))
    found = pages.select("page_id", F.posexplode_outer(pairs).alias("ord", "b"))
    tag = F.lower("b.tag")
    tag = F.when(tag.startswith("/") | tag.isin(*HTML_VOID), F.lit("text")).otherwise(tag)
    return found.filter(F.col("b").isNotNull()).select(
        F.col("page_id").alias("doc_id"),
        "ord",
        F.concat_ws("-", F.col("page_id").cast("string"), F.col("ord").cast("string")).alias("block_id"),
        F.concat(F.lit("page_1/"), tag).alias("section_path"),
        F.col("b.text").alias("text"),
    )


def _either(v: Column, camel: str, snake: str, kind: str) -> Column:
    return F.coalesce(F.try_variant_get(v, f"$.{camel}", kind), F.try_variant_get(v, f"$.{snake}", kind))


def _members(v: Column, *names: str, kind: str) -> Column:
    return F.coalesce(*[F.try_variant_get(v, f"$.{n}", kind) for n in names])


def _cell_blocks(rows: Column) -> Column:
    """Blocks of all cells of some table rows, in reading order."""
    none = F.expr("CAST(array() AS array<variant>)")
    of_cell = lambda c: F.coalesce(F.try_variant_get(c, "$.blocks", "array<variant>"), none)
    of_row = lambda r: F.flatten(F.transform(F.coalesce(F.try_variant_get(r, "$.cells", "array<variant>"), none), of_cell))
    return F.flatten(F.transform(F.coalesce(rows, none), of_row))


def _vertex_box(poly: Column) -> Column:
    vertex = "array<struct<x:double,y:double>>"
    return envelope(_either(poly, "normalizedVertices", "normalized_vertices", vertex), F.try_variant_get(poly, "$.vertices", vertex))


def _walk(docs: DataFrame, inherit_page: bool, tables: bool) -> DataFrame:
    """All nodes of layout JSON, one round per level and each round row by row.

    The nested rest is written between rounds, so the JSON is parsed once.
    """
    b, t, table = F.col("b"), F.col("t"), F.col("table")
    root = F.try_parse_json("layout")
    top = F.coalesce(
        F.try_variant_get(root, "$.documentLayout.blocks", "array<variant>"),
        F.try_variant_get(root, "$.document_layout.blocks", "array<variant>"),
    )
    level = docs.select(
        "doc_id",
        F.lit(1).alias("up_page"),
        F.lit(None).cast("string").alias("up_path"),
        F.array().cast("array<int>").alias("above"),
        top.alias("nested"),
    )
    out = None
    while True:
        own_page = F.coalesce(
            F.try_variant_get(b, "$.pageSpan.pageStart", "int"), F.try_variant_get(b, "$.page_span.page_start", "int")
        )
        kind = (
            F.when(t.isNotNull(), F.coalesce(F.try_variant_get(t, "$.type", "string"), F.lit("text")))
            .when(table.isNotNull(), F.lit("table"))
            .when(_either(b, "listBlock", "list_block", "variant").isNotNull(), F.lit("list"))
            .when(_either(b, "imageBlock", "image_block", "variant").isNotNull(), F.lit("image"))
            .otherwise(F.lit("unknown"))
        )
        rows = (
            level.select("doc_id", "up_page", "up_path", "above", F.posexplode_outer("nested").alias("i", "b"))
            .filter(b.isNotNull())
            .select(
                "*",
                _either(b, "textBlock", "text_block", "variant").alias("t"),
                _either(b, "tableBlock", "table_block", "variant").alias("table"),
                F.coalesce(own_page, F.col("up_page") if inherit_page else F.lit(1)).alias("page_number"),
            )
            .select(
                "doc_id",
                F.coalesce(_either(b, "blockId", "block_id", "string"), F.lit("")).alias("block_id"),
                "page_number",
                F.concat("above", F.array("i")).alias("order_key"),
                F.concat_ws("/", F.coalesce("up_path", F.concat(F.lit("page_"), "page_number")), kind).alias("section_path"),
                _either(b, "boundingBox", "bounding_box", "variant").alias("box"),
                "t",
                "table",
            )
        )
        layout_box = _members(F.try_variant_get(t, "$.layout", "variant"), "boundingPoly", "bounding_poly", kind="variant")
        here = rows.select(
            "doc_id",
            "block_id",
            "page_number",
            "order_key",
            "section_path",
            _vertex_box(F.coalesce("box", layout_box)).alias("bbox"),
            F.coalesce(F.try_variant_get(t, "$.text", "string"), F.lit("")).alias("text"),
        )
        out = here if out is None else out.unionByName(here)
        children = F.try_variant_get(t, "$.blocks", "array<variant>")
        if tables:
            header = _either(table, "headerRows", "header_rows", "array<variant>")
            body = _either(table, "bodyRows", "body_rows", "array<variant>")
            cells = F.concat(_cell_blocks(header), _cell_blocks(body))
            children = F.when(F.size(children) > 0, children).otherwise(cells)
        below = rows.select(
            "doc_id",
            F.col("page_number").alias("up_page"),
            F.col("section_path").alias("up_path"),
            F.col("order_key").alias("above"),
            children.alias("nested"),
        )
        level = stage(below.filter(F.size("nested") > 0), "layout")
        if level.isEmpty():
            return out


def layout_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of cached layout JSON ``docs(doc_id, layout string)``, by id.

    Keys may be camelCase or snake_case. A child without a page takes the page
    of its parent; blocks without an id are left out, but not their children.
    JSON that does not parse gives no blocks. Nesting of any depth is walked to
    the end.
    """
    nodes = _walk(docs, inherit_page=True, tables=False)
    return nodes.filter(F.col("block_id") != "").drop("section_path")


def parse_layout(docs: DataFrame) -> DataFrame:
    """Blocks of fresh layout JSON, depth first, with ``section_path``.

    A node is a block if it has text or a box. The walk goes on into the
    children of text and into the cells of tables, header rows first.
    ``order_key`` sorts the blocks of a document.
    """
    nodes = _walk(docs, inherit_page=False, tables=True)
    return nodes.filter((F.col("text") != "") | (F.size("bbox") > 0))
