"""Queries on trees, layout, geometry, search and location."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.operators import blocks as B
from docspark.operators import locate as L
from docspark.operators import search as SE
from docspark.plans import sqltext as S
from docspark.plans.prose import prose_blocks
from docspark.sources import layout as LA
from docspark.sources import tables as T

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- trees and markup --------------------------------------------------------


@query
def html_blocks(spark, d):
    return LA.html_blocks(T.table(spark, d, "pages").select("page_id", "html"))


_SHOWN = f"'</text>' || regexp_replace(html, '{LA.HTML_HIDDEN}', '</text>', 'g')"
_VOID = "', '".join(LA.HTML_VOID)

ORACLE["html_blocks"] = f"""
WITH nodes AS (
  SELECT page_id, lower(tag) AS tag, text, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS ord
  FROM (SELECT page_id, unnest(regexp_extract_all(h, '{LA.HTML_TEXT}', 1)) AS tag, unnest(regexp_extract_all(h, '{LA.HTML_TEXT}', 2)) AS text,
               generate_subscripts(regexp_extract_all(h, '{LA.HTML_TEXT}', 1), 1) AS i FROM (SELECT page_id, {_SHOWN} AS h FROM pages))
  WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> '')
SELECT page_id AS doc_id, ord, page_id || '-' || ord AS block_id,
       'page_1/' || CASE WHEN starts_with(tag, '/') OR tag IN ('{_VOID}') THEN 'text' ELSE tag END AS section_path, text FROM nodes"""


def market_tree(spark: SparkSession, d: str) -> DataFrame:
    """Regions, nations, customers and orders as one block tree.

    Some customers have no text and no box, so only their orders are emitted.
    """
    none = F.array().cast("array<double>")
    region = T.table(spark, d, "region").select(
        F.concat(F.lit("r"), "r_regionkey").alias("node_id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.col("r_regionkey").cast("long").alias("pos"),
        F.lit("heading").alias("kind"),
        (F.col("r_regionkey") + 1).alias("page"),
        F.col("r_name").alias("text"),
        none.alias("bbox"),
    )
    nation = T.table(spark, d, "nation").select(
        F.concat(F.lit("n"), "n_nationkey").alias("node_id"),
        F.concat(F.lit("r"), "n_regionkey").alias("parent_id"),
        F.col("n_nationkey").cast("long").alias("pos"),
        F.lit("table").alias("kind"),
        (F.col("n_regionkey") + 1).alias("page"),
        F.lit(None).cast("string").alias("text"),
        F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("bbox"),
    )
    customer = T.table(spark, d, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("node_id"),
        F.concat(F.lit("n"), "c_nationkey").alias("parent_id"),
        F.col("c_custkey").alias("pos"),
        F.lit("row").alias("kind"),
        (F.col("c_nationkey") + 1).alias("page"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("text"),
        none.alias("bbox"),
    )
    orders = T.table(spark, d, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("node_id"),
        F.concat(F.lit("c"), "o_custkey").alias("parent_id"),
        F.col("o_orderkey").alias("pos"),
        F.lit("paragraph").alias("kind"),
        F.lit(1).alias("page"),
        F.col("o_orderpriority").alias("text"),
        none.alias("bbox"),
    )
    return region.unionByName(nation).unionByName(customer).unionByName(orders)


@query
def tree_blocks(spark, d):
    return B.flatten_tree(market_tree(spark, d)).select(
        "node_id", "page", "text", "path", F.array_join("order_key", ".").alias("order_key"), F.size("bbox").alias("box_values")
    )


ORACLE["tree_blocks"] = """
WITH RECURSIVE nodes AS (
  SELECT 'r' || r_regionkey AS node_id, NULL AS parent_id, r_regionkey AS pos, 'heading' AS kind, r_regionkey + 1 AS page,
         r_name AS text, 0 AS box_values FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey, 'table', n_regionkey + 1, NULL, 4 FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_custkey, 'row', c_nationkey + 1,
                   CASE WHEN c_acctbal >= 0 THEN c_name END, 0 FROM customer
  UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, o_orderkey, 'paragraph', 1, o_orderpriority, 0 FROM orders),
walk AS (
  SELECT node_id, page, text, box_values, 'page_' || page || '/' || kind AS path, CAST(pos AS VARCHAR) AS order_key
  FROM nodes WHERE parent_id IS NULL
  UNION ALL
  SELECT n.node_id, n.page, n.text, n.box_values, w.path || '/' || n.kind, w.order_key || '.' || n.pos
  FROM nodes n JOIN walk w ON n.parent_id = w.node_id)
SELECT node_id, CAST(page AS BIGINT) AS page, text, path, order_key, CAST(box_values AS BIGINT) AS box_values
FROM walk WHERE coalesce(text, '') <> '' OR box_values > 0"""


def layout_json(spark: SparkSession, d: str) -> DataFrame:
    """Cached layout JSON made of the embeddings: a parent with two children each.

    Even ids use camelCase keys, odd ids snake_case; every 17th is cut short.
    The first child has no page, the second has no vertices.
    """
    e = T.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")
    even = F.col("vec_id") % 2 == 0

    def k(camel: str, snake: str):
        return F.when(even, F.lit(f'"{camel}":')).otherwise(F.lit(f'"{snake}":'))

    def pair(i: int):
        return F.concat(F.lit('{"x":'), F.get("v", F.lit(i)).cast("string"), F.lit(',"y":'), F.get("v", F.lit(i + 1)).cast("string"), F.lit("}"))

    def block(suffix: str, page, text, vertices, children):
        poly = F.concat(F.lit('"layout":{'), k("boundingPoly", "bounding_poly"), F.lit("{"), vertices, F.lit("}},"))
        return F.concat(
            F.lit("{"), k("blockId", "block_id"), F.lit('"b'), F.col("vec_id").cast("string"), F.lit(suffix + '",'),
            page, k("textBlock", "text_block"), F.lit("{"), poly, F.lit('"text":"'), text, F.lit('"'), children, F.lit("}}"),
        )

    norm = F.concat(k("normalizedVertices", "normalized_vertices"), F.lit("["), F.concat_ws(",", pair(0), pair(2), pair(4)), F.lit("]"))
    raw = F.concat(F.lit('"vertices":['), pair(6), F.lit(',{"y":0.5}]'))
    page = F.concat(k("pageSpan", "page_span"), F.lit("{"), k("pageStart", "page_start"), F.col("label").cast("string"), F.lit("},"))
    one = block("-1", F.lit(""), F.lit("first"), raw, F.lit(""))
    two = block("-2", F.concat(k("pageSpan", "page_span"), F.lit("{"), k("pageStart", "page_start"), F.lit("99},")), F.lit("second"), F.lit(""), F.lit(""))
    top = block("", page, F.concat(F.lit("label "), F.col("label").cast("string")), norm, F.concat(F.lit(',"blocks":['), one, F.lit(","), two, F.lit("]")))
    json = F.concat(F.lit("{"), k("documentLayout", "document_layout"), F.lit('{"blocks":['), top, F.lit("]}}"))
    cut = F.when(F.col("vec_id") % 17 == 16, F.left(json, F.length(json) - 3)).otherwise(json)
    return e.select(F.col("vec_id").alias("doc_id"), cut.alias("layout"))


@query
def layout_json_blocks(spark, d):
    out = LA.layout_blocks(layout_json(spark, d))
    box = [F.round(F.get("bbox", F.lit(i)), 6).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return out.select("doc_id", "block_id", "page_number", "text", F.array_join("order_key", ".").alias("order_key"), *box)


_V = "CAST(embedding[{}] AS DOUBLE)"
_xs = ", ".join(_V.format(i) for i in (1, 3, 5))
_ys = ", ".join(_V.format(i) for i in (2, 4, 6))

ORACLE["layout_json_blocks"] = f"""
SELECT vec_id AS doc_id, 'b' || vec_id AS block_id, CAST(label AS BIGINT) AS page_number, 'label ' || label AS text, '0' AS order_key,
       round(least({_xs}), 6) AS x0, round(least({_ys}), 6) AS y0, round(greatest({_xs}), 6) AS x1, round(greatest({_ys}), 6) AS y1
FROM embeddings WHERE vec_id % 17 <> 16
UNION ALL
SELECT vec_id, 'b' || vec_id || '-1', label, 'first', '0.0', round(least({_V.format(7)}, 0), 6), round(least({_V.format(8)}, 0.5), 6),
       round(greatest({_V.format(7)}, 0), 6), round(greatest({_V.format(8)}, 0.5), 6)
FROM embeddings WHERE vec_id % 17 <> 16
UNION ALL
SELECT vec_id, 'b' || vec_id || '-2', 99, 'second', '0.1', NULL, NULL, NULL, NULL FROM embeddings WHERE vec_id % 17 <> 16"""


def line_table_layout(spark: SparkSession, d: str) -> DataFrame:
    """Layout JSON of the prose documents: a heading, then a table of the other lines.

    The second line is the header row; every further line is a body row of two
    cells, the line and, under it as a child, its length.
    """
    lines = F.split("text", "\n", -1)
    page = F.struct(F.lit(2).alias("page_start"))
    child = lambda x: F.struct(F.struct(F.length(x).cast("string").alias("text"), F.lit("count").alias("type")).alias("text_block"))
    leaf = lambda x, i: F.struct(
        F.concat(F.lit("r"), i.cast("string")).alias("block_id"), page.alias("page_span"), F.struct(x.alias("text"), F.array(child(x)).alias("blocks")).alias("text_block")
    )
    row = lambda x, i: F.struct(F.array(F.struct(F.array(leaf(x, i)).alias("blocks"))).alias("cells"))
    rows = F.transform(lines, row)
    table = F.struct(F.slice(rows, 2, 1).alias("header_rows"), F.when(F.size(lines) > 2, F.slice(rows, F.lit(3), F.size(lines))).alias("body_rows"))
    heading = F.struct(F.lit("h").alias("block_id"), F.struct(F.get(lines, F.lit(0)).alias("text"), F.lit("heading").alias("type")).alias("text_block"))
    grid = F.struct(F.lit("t").alias("block_id"), table.alias("table_block"))
    blocks = F.concat(F.array(F.parse_json(F.to_json(heading))), F.array(F.parse_json(F.to_json(grid))))
    layout = F.to_json(F.struct(F.struct(blocks.alias("blocks")).alias("document_layout")))
    return T.documents(spark, d).select("doc_id", layout.alias("layout"))


@query
def layout_table_blocks(spark, d):
    out = LA.parse_layout(line_table_layout(spark, d))
    return out.select("doc_id", "block_id", "page_number", "section_path", "text", F.array_join("order_key", ".").alias("order_key"))


ORACLE["layout_table_blocks"] = f"""
WITH {S.LINES}
SELECT doc_id, 'h' AS block_id, CAST(1 AS BIGINT) AS page_number, 'page_1/heading' AS section_path, text, '0' AS order_key FROM lines WHERE ord = 0 AND text <> ''
UNION ALL SELECT doc_id, 'r' || ord, 2, 'page_1/table/text', text, '1.' || (ord - 1) FROM lines WHERE ord > 0 AND text <> ''
UNION ALL SELECT doc_id, '', 1, 'page_1/table/text/count', CAST(length(text) AS VARCHAR), '1.' || (ord - 1) || '.0' FROM lines WHERE ord > 0"""


# --- anchors, fallback, geometry ---------------------------------------------


@query
def anchor_slices(spark, d):
    """Two segments of each document, as a layout service anchors page text."""
    n = F.length("text")
    seg = lambda a, b: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"))
    segs = F.array(
        seg(F.lit(None), F.floor(n / 10)), seg(F.floor(n / 3), F.floor(n / 3) + 80), seg(n - 5, n + 20)
    )
    return T.documents(spark, d).select("doc_id", B.text_of_segments(F.col("text"), segs).alias("text"))


ORACLE["anchor_slices"] = """
SELECT doc_id, substr(text, 1, length(text) // 10) || substr(text, length(text) // 3 + 1, 80)
       || substr(text, greatest(length(text) - 5, 0) + 1, 25) AS text FROM documents"""


@query
def fallback_blocks(spark, d):
    """Conversations as pages of paragraphs; those with a system turn also have layout blocks."""
    turns = T.table(spark, d, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        (F.col("turn") + 1).cast("int").alias("page_number"),
        F.split("text", "\n", -1).alias("paragraphs"),
        "role",
    )
    layout = B.paragraph_blocks(turns.filter("role = 'system'")).withColumn("block_id", F.concat(F.lit("layout-"), "block_id"))
    return B.prefer_layout(layout, B.paragraph_blocks(turns), turns.select("doc_id").distinct())


ORACLE["fallback_blocks"] = """
WITH fallback AS (
  SELECT conv_id AS doc_id, i - 1 AS ord, 'p' || (turn + 1) || '-para-' || (i - 1) AS block_id, turn + 1 AS page_number,
         'page_' || (turn + 1) || '/paragraph' AS section_path, text, role
  FROM (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS text,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM conversations))
SELECT doc_id, ord, block_id, page_number, section_path, text FROM fallback
WHERE doc_id NOT IN (SELECT doc_id FROM fallback WHERE role = 'system')
UNION ALL SELECT doc_id, ord, 'layout-' || block_id, page_number, section_path, text FROM fallback WHERE role = 'system'"""


def boxed(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as vertex lists: pairs of values, every fifth without any."""
    v = F.col("embedding")
    n = F.floor(F.size(v) / 2).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(F.get(v, i * 2).cast("double").alias("x"), F.get(v, i * 2 + 1).cast("double").alias("y")),
    )
    none = F.array().cast("array<struct<x:double,y:double>>")
    kind = F.col("vec_id") % 5
    return T.table(spark, d, "embeddings").select(
        "vec_id",
        "label",
        B.envelope(F.when(kind < 3, pairs).otherwise(none), F.when(kind < 4, F.slice(pairs, 1, 4)).otherwise(none)).alias("bbox"),
    )


@query
def vertex_envelope(spark, d):
    box = [F.round(F.get("bbox", F.lit(i)), 6).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return boxed(spark, d).select("vec_id", *box)


_BOXES = """
boxes AS (
  SELECT vec_id, label, list_transform(list_filter(range(1, len(embedding) + 1), lambda i: i % 2 = 1
           AND (vec_id % 5 < 3 OR i <= 8)), lambda i: CAST(embedding[i] AS DOUBLE)) AS xs,
         list_transform(list_filter(range(1, len(embedding) + 1), lambda i: i % 2 = 0
           AND (vec_id % 5 < 3 OR i <= 8)), lambda i: CAST(embedding[i] AS DOUBLE)) AS ys
  FROM embeddings)"""

ORACLE["vertex_envelope"] = f"""
WITH {_BOXES}
SELECT vec_id, CASE WHEN vec_id % 5 < 4 THEN round(list_min(xs), 6) END AS x0, CASE WHEN vec_id % 5 < 4 THEN round(list_min(ys), 6) END AS y0,
       CASE WHEN vec_id % 5 < 4 THEN round(list_max(xs), 6) END AS x1, CASE WHEN vec_id % 5 < 4 THEN round(list_max(ys), 6) END AS y1
FROM boxes"""


@query
def geometry_counts(spark, d):
    return B.geometry_counts(boxed(spark, d), "label")


ORACLE["geometry_counts"] = """
SELECT CAST(label AS BIGINT) AS label, count(*) FILTER (WHERE vec_id % 5 < 4) AS with_bbox, count(*) AS blocks FROM embeddings GROUP BY label"""


@query
def blocks_without_geometry(spark, d):
    return B.without_geometry(boxed(spark, d)).select("vec_id", "label")


ORACLE["blocks_without_geometry"] = "SELECT vec_id, CAST(label AS BIGINT) AS label FROM embeddings WHERE vec_id % 5 = 4"


# --- search and look-ups -----------------------------------------------------


@query
def text_search(spark, d):
    return SE.text_search(prose_blocks(spark, d), "The", 3)


ORACLE["text_search"] = f"""
WITH {S.LINES},
hits AS (
  SELECT *, unnest(list_transform(range(1, len(p)), lambda k:
           CAST(list_sum(list_transform(p[1:k], lambda x: length(x))) + 3 * (k - 1) AS BIGINT))) AS match_start
  FROM (SELECT *, string_split(lower(text), 'the') AS p FROM lines) WHERE len(p) > 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord, match_start) AS rank FROM hits)
SELECT doc_id, 'The' AS query, ord, block_id, page_number, 'page_' || page_number || '/paragraph' AS section_path, match_start,
       match_start + 3 AS match_end,
       substr(text, greatest(match_start - 40, 0) + 1, match_start + 43 - greatest(match_start - 40, 0)) AS excerpt, rank
FROM ranked WHERE rank <= 3"""


_OPENING = r"^[^ \n]+ [^ \n]+ [^ \n]+"


@query
def search_many(spark, d):
    """The first three words of every benchmark item, searched for in all blocks at once."""
    asked = T.table(spark, d, "benchmark").select(F.regexp_extract("text", _OPENING, 0).alias("query"))
    return SE.search_all(prose_blocks(spark, d), asked).drop("section_path")


ORACLE["search_many"] = f"""
WITH {S.LINES},
asked AS (SELECT DISTINCT regexp_extract(text, '{_OPENING}') AS query FROM benchmark WHERE regexp_extract(text, '{_OPENING}') <> ''),
hits AS (
  SELECT *, unnest(list_transform(range(1, len(p)), lambda k:
           CAST(list_sum(list_transform(p[1:k], lambda x: length(x))) + length(query) * (k - 1) AS BIGINT))) AS match_start
  FROM (SELECT lines.*, query, string_split(lower(text), lower(query)) AS p FROM lines JOIN asked ON contains(lower(text), lower(query))))
SELECT doc_id, query, ord, block_id, page_number, match_start, match_start + length(query) AS match_end,
       substr(text, greatest(match_start - 40, 0) + 1, match_start + length(query) + 40 - greatest(match_start - 40, 0)) AS excerpt
FROM hits"""


def _page_requests(spark, d) -> DataFrame:
    """One request per document for page 1 to 3, some beyond the last page."""
    return T.documents(spark, d).select("doc_id", (F.col("doc_id") % 3 + 1).cast("int").alias("page_number"))


@query
def page_lookup(spark, d):
    pages = B.pages_from_text(T.documents(spark, d)).drop("block_spans")
    found, _ = SE.load_pages(_page_requests(spark, d), pages)
    return SE.blocks_of_pages(found, prose_blocks(spark, d)).select("doc_id", "page_number", "block_id", "text")


ORACLE["page_lookup"] = f"""
WITH {S.LINES} SELECT doc_id, page_number, block_id, text FROM lines WHERE page_number = doc_id % 3 + 1"""


@query
def missing_pages(spark, d):
    pages = B.pages_from_text(T.documents(spark, d)).select("doc_id", "page_number")
    _, missing = SE.load_pages(_page_requests(spark, d), pages)
    return missing


ORACLE["missing_pages"] = f"""
WITH {S.LINES}
SELECT doc_id, doc_id % 3 + 1 AS page_number FROM documents
WHERE (doc_id, doc_id % 3 + 1) NOT IN (SELECT (doc_id, page_number) FROM lines)"""


@query
def layout_lookup(spark, d):
    blocks = LA.html_blocks(T.table(spark, d, "pages").select("page_id", "html")).withColumn("page_number", F.lit(1))
    return SE.layout_lookup(blocks, 1, "page_1/p").select("doc_id", "block_id", "text")


ORACLE["layout_lookup"] = f"""
SELECT doc_id, block_id, text FROM ({ORACLE["html_blocks"]}) WHERE starts_with(section_path, 'page_1/p')"""


@query
def state_read(spark, d):
    state = {"doc_profile": prose_blocks(spark, d).groupBy("doc_id").agg(F.max("page_number").alias("total_pages"), F.count(F.lit(1)).alias("blocks"))}
    return SE.state_read(state, "doc_profile")


ORACLE["state_read"] = f"""
WITH {S.LINES} SELECT doc_id, max(page_number) AS total_pages, count(*) AS blocks FROM lines GROUP BY doc_id"""


# --- location ----------------------------------------------------------------


def _page_word_arrays(spark, d) -> DataFrame:
    return B.pages_from_text(T.documents(spark, d)).select(
        "doc_id", "page_number", F.filter(F.split("text", "[ \n]"), lambda w: w != "").alias("words")
    )


def _altered_blocks(spark, d) -> DataFrame:
    """Blocks as printed, with words added behind or in front, or with other punctuation."""
    kind = F.col("ord") % 4
    text = (
        F.when(kind == 1, F.concat("text", F.lit(" zzqq trailing")))
        .when(kind == 2, F.concat(F.lit("zzqq leading "), "text"))
        .when(kind == 3, F.replace("text", F.lit("."), F.lit("!  ")))
        .otherwise(F.col("text"))
    )
    return prose_blocks(spark, d).withColumn("text", text)


@query
def locate_blocks(spark, d):
    return L.locate_blocks(_altered_blocks(spark, d), _page_word_arrays(spark, d))


def _pw(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


_LOCATED = f"""
{S.LINES},
pagew AS (SELECT doc_id, page_number, list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda w: w <> '') AS w
          FROM ({S.page_texts()})),
pagek AS (SELECT doc_id, page_number, len(w) AS n_page, array_to_string(list_transform(w, lambda x: {S.loose("x")}), chr(1)) AS marked FROM pagew),
pagel AS (SELECT *, replace(marked, chr(1), ' ') AS line FROM pagek),
target AS (SELECT doc_id, page_number, block_id, {S.loose("x")} AS t FROM (
  SELECT *, CASE ord % 4 WHEN 1 THEN text || ' zzqq trailing' WHEN 2 THEN 'zzqq leading ' || text WHEN 3 THEN replace(text, '.', '!  ') ELSE text END AS x
  FROM lines)),
parts AS (SELECT *, len({_pw("t")}) AS n_words, array_to_string({_pw("t")}[1:6], ' ') AS head,
                 array_to_string({_pw("t")}[greatest(len({_pw("t")}) - 5, 1):], ' ') AS tail
          FROM target LEFT JOIN pagel USING (doc_id, page_number)),
placed AS (SELECT *, CASE WHEN t <> '' THEN instr(line, t) END AS a,
                  CASE WHEN t <> '' THEN instr(line, head) END AS h,
                  CASE WHEN t <> '' THEN instr(reverse(line), reverse(tail)) END AS r FROM parts),
ends AS (SELECT *, length(line) - r + 1 AS e FROM placed),
located AS (SELECT *,
  CASE WHEN a > 0 THEN 'exact' WHEN h > 0 THEN 'prefix' WHEN r > 0 THEN 'suffix' END AS found,
  len(string_split(substr(marked, 1, CASE WHEN a > 0 THEN a WHEN h > 0 THEN h ELSE e END - 1), chr(1))) - 1 AS w0,
  len(string_split(substr(marked, 1, a + length(t) - 2), chr(1))) - 1 AS w1 FROM ends)"""

ORACLE["locate_blocks"] = f"""
WITH {_LOCATED}
SELECT doc_id, page_number, block_id, found,
       CASE found WHEN 'exact' THEN w0 WHEN 'prefix' THEN w0 WHEN 'suffix' THEN greatest(w0 - n_words + 1, 0) END AS first_word,
       CASE found WHEN 'exact' THEN w1 WHEN 'prefix' THEN least(w0 + n_words - 1, n_page - 1) WHEN 'suffix' THEN w0 END AS last_word
FROM located"""


@query
def located_boxes(spark, d):
    """Boxes of located blocks, on a grid of ten words per printed line."""
    pages = _page_word_arrays(spark, d)
    i = F.col("idx")
    grid = pages.select("doc_id", "page_number", F.posexplode_outer("words").alias("idx", "word")).filter(i.isNotNull()).select(
        "doc_id",
        "page_number",
        "idx",
        ((i % 10) * 60.0).alias("x0"),
        (F.floor(i / 10) * 12.0).alias("y0"),
        ((i % 10) * 60.0 + 58.0).alias("x1"),
        (F.floor(i / 10) * 12.0 + 10.0).alias("y1"),
        F.lit(590.0).alias("page_w"),
        F.lit(792.0).alias("page_h"),
    )
    ranges = L.locate_blocks(_altered_blocks(spark, d), pages)
    return L.range_boxes(ranges, grid).select(
        "doc_id", "page_number", "block_id", *[F.round(c, 6).alias(c) for c in ("x0", "y0", "x1", "y1")]
    )


ORACLE["located_boxes"] = f"""
WITH ranges AS ({ORACLE["locate_blocks"]}),
listed AS (SELECT doc_id, page_number, block_id, unnest(range(first_word, last_word + 1)) AS i FROM ranges WHERE found IS NOT NULL)
SELECT doc_id, page_number, block_id, round(greatest(min((i % 10) * 60.0 / 590.0), 0.0), 6) AS x0,
       round(greatest(min((i // 10) * 12.0 / 792.0), 0.0), 6) AS y0,
       round(least(max(((i % 10) * 60.0 + 58.0) / 590.0), 1.0), 6) AS x1,
       round(least(max(((i // 10) * 12.0 + 10.0) / 792.0), 1.0), 6) AS y1
FROM listed GROUP BY ALL"""


@query
def locate_passages(spark, d):
    return L.locate_passages(T.table(spark, d, "benchmark"), T.documents(spark, d))


ORACLE["locate_passages"] = f"""
WITH p AS (SELECT item_id, ' ' || k || ' ' AS k, string_split(k, ' ') AS w FROM (SELECT item_id, {S.loose("text")} AS k FROM benchmark) WHERE k <> ''),
q AS (SELECT *, len(w) AS n, ' ' || array_to_string(w[1:6], ' ') || ' ' AS head, ' ' || array_to_string(w[greatest(len(w) - 5, 1):], ' ') || ' ' AS tail FROM p),
d AS (SELECT doc_id, ' ' || k || ' ' AS dk, len(string_split(k, ' ')) AS n_doc FROM (SELECT doc_id, {S.loose("text")} AS k FROM documents) WHERE k <> ''),
m AS (SELECT item_id, doc_id, n, n_doc, dk, instr(dk, k) AS a, instr(dk, head) AS h, instr(reverse(dk), reverse(tail)) AS r
      FROM q, d WHERE contains(dk, head) OR contains(dk, tail)),
s AS (SELECT *, CASE WHEN a > 0 THEN 'exact' WHEN h > 0 THEN 'prefix' ELSE 'suffix' END AS found,
             len(string_split(substr(dk, 1, CASE WHEN a > 0 THEN a WHEN h > 0 THEN h END), ' ')) - 2 AS w0,
             len(string_split(substr(dk, 1, length(dk) - r), ' ')) - 1 AS e FROM m)
SELECT item_id, doc_id, found, CASE WHEN found = 'suffix' THEN greatest(e - n, 0) ELSE w0 END AS first_word,
       CASE WHEN found = 'suffix' THEN e ELSE least(w0 + n, n_doc) END AS end_word
FROM s"""
