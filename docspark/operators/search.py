"""Look-ups over block and page tables: literal search, pages, layout, state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docspark.functions.text import context, literal_spans
from docspark.sources.scratch import stage

STATE_TABLES = ("doc_profile", "parser_hypothesis", "block_profiles")
EXCERPT_PAD = 40


def text_search(blocks: DataFrame, query: str, max_results: int | None = 5) -> DataFrame:
    """Case-insensitive occurrences of a literal in each block, with an excerpt.

    The first ``max_results`` per document, in block order; None gives all, with
    no rank. A block cannot give more than that, so each block stops there, and
    the window keeps no more per task either.
    """
    if not query:
        raise ValueError("query must not be empty")
    if max_results is not None and max_results < 1:
        raise ValueError("max_results must be at least 1")
    hit = F.col("hit")
    first = Window.partitionBy("doc_id").orderBy("ord", "match_start")
    found = (
        blocks.select(
            "doc_id",
            "ord",
            "block_id",
            "page_number",
            "section_path",
            "text",
            F.explode_outer(literal_spans(F.col("text"), F.lit(query), max_results)).alias("hit"),
        )
        .filter(hit.isNotNull())
        .select(
            "doc_id",
            F.lit(query).alias("query"),
            "ord",
            "block_id",
            "page_number",
            "section_path",
            hit["start"].alias("match_start"),
            hit["end"].alias("match_end"),
            context(F.col("text"), hit["start"], hit["end"], EXCERPT_PAD).alias("excerpt"),
        )
    )
    if max_results is None:
        return found
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= max_results)


#: Characters of the keys by which literals and blocks meet, and characters of literals that one pass broadcasts at most, about.
GRAM, GRAMS_AT_ONCE = 8, 1_000_000


def _with_grams(rows: DataFrame, text: str, sizes: Sequence[int]) -> DataFrame:
    """``rows`` with the distinct runs of so many lower-case characters of a text in ``_grams``.

    A look-ahead gives the run at every place in one scan.
    """
    low = F.coalesce(F.lower(text), F.lit(""))
    runs = [F.regexp_extract_all(low, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in sizes]
    return rows.withColumn("_grams", F.array_distinct(runs[0] if len(runs) == 1 else F.concat(*runs)))


def search_all(blocks: DataFrame, queries: DataFrame, grams_at_once: int = GRAMS_AT_ONCE) -> DataFrame:
    """All occurrences of many literals at once: ``queries(query)``, whatever their number.

    A literal meets the blocks by one run of eight characters, of its own the one
    that fewest literals hold (shorter literals by themselves): each block's distinct
    runs join the chosen ones, and only such pairs are searched. Blocks are read once
    a pass. What is broadcast are literals with their key, at most about
    ``grams_at_once`` characters a pass. Offsets and excerpts are those of
    :func:`text_search`. Null and empty queries find nothing.
    """
    asked = queries.select("query").filter(F.coalesce(F.col("query"), F.lit("")) != "").distinct()
    size = asked.agg(F.coalesce(F.sum(F.length("query")), F.lit(0)).alias("n"), F.collect_set(F.least(F.length(F.lower("query")), F.lit(GRAM))).alias("sizes")).collect()[0]
    parts = max(1, -(-size["n"] // grams_at_once))
    sizes = sorted(size["sizes"]) or [GRAM]
    keyed = _with_grams(asked, "query", sizes).withColumn("_whole", F.length(F.lower("query")))
    exact = keyed.select("query", "_whole", F.explode_outer("_grams").alias("_gram")).filter(F.length("_gram") == F.least("_whole", F.lit(GRAM)))
    held = exact.groupBy("_gram").agg(F.count("*").alias("_n"))
    keys = stage(exact.join(held, "_gram").groupBy("query").agg(F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram")), "search-keys")
    of_blocks = _with_grams(blocks, "text", sizes)
    hit = F.col("hit")
    out = None
    for part in range(parts):
        chosen = keys.filter(F.pmod(F.xxhash64("query"), F.lit(parts)) == part)
        pairs = of_blocks.withColumn("_gram", F.explode_outer("_grams")).drop("_grams").join(F.broadcast(chosen), "_gram")
        found = (
            pairs.filter(F.contains(F.lower("text"), F.lower("query")))
            .withColumn("hit", F.explode_outer(literal_spans(F.col("text"), F.col("query"))))
            .filter(hit.isNotNull())
        )
        rows = found.select(
            "doc_id",
            "query",
            "ord",
            "block_id",
            "page_number",
            "section_path",
            hit["start"].alias("match_start"),
            hit["end"].alias("match_end"),
            context(F.col("text"), hit["start"], hit["end"], EXCERPT_PAD).alias("excerpt"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def load_pages(requests: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requested pages, and the requests that name no page.

    ``requests(doc_id, page_number)``.
    """
    keys = ["doc_id", "page_number"]
    return requests.join(pages, keys), requests.join(pages, keys, "left_anti")


def blocks_of_pages(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks that the id lists of some pages name."""
    ids = pages.select("doc_id", F.explode_outer("block_ids").alias("block_id"))
    return blocks.join(ids, ["doc_id", "block_id"], "left_semi")


def layout_lookup(blocks: DataFrame, page_number: int, section_path: str | None = None) -> DataFrame:
    """Blocks of one page, optionally under a section path."""
    hits = blocks.filter(F.col("page_number") == page_number)
    return hits if section_path is None else hits.filter(F.col("section_path").startswith(section_path))


def state_read(state: dict[str, DataFrame], key: str) -> DataFrame:
    """One of the readable state tables."""
    if key not in STATE_TABLES:
        raise KeyError(f"{key!r} is not one of {STATE_TABLES}")
    return state[key]
