"""Transport and boilerplate noise: predicate, line stripping, counters."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.text import is_blank, lines_with_ends, prefix_sums, strip
from docspark.vocab import NOISE_NEEDS, NOISE_PATTERNS

Patterns = Sequence[tuple[str, str]]
# what looks at the text around a match, or gives nothing back once taken
_AROUND = re.compile(r"[$^]|\(\?<?[=!>]|[*+?}]\+")
_ESCAPED = re.compile(r"\\[^pP]")
_LOOKING = frozenset("AzZGBRXQE")


def noise_name(text: Column, patterns: Patterns = NOISE_PATTERNS) -> Column:
    """Name of the first pattern that occurs in the text, null if none does."""
    s = strip(text)
    out = F.when(is_blank(text), F.lit(None).cast("string"))
    for name, regex in patterns:
        out = out.when(s.rlike(regex), F.lit(name))
    return out


def _free(regex: str) -> bool:
    """Whether a match stays one when blanks are put around the text: no anchors, look-arounds or possessive parts."""
    escapes = set("".join(x[1] for x in _ESCAPED.findall(regex)))
    bare = re.sub(r"\[\^?\]?[^\]]*\]", "", _ESCAPED.sub("e", regex))
    return "&&" not in regex and not escapes & _LOOKING and not _AROUND.search(bare)


def is_noise(text: Column, patterns: Patterns = NOISE_PATTERNS) -> Column:
    """Whether any pattern occurs in the stripped text.

    What occurs there occurs in the whole text too, unless the pattern looks
    around. So few lines are stripped at all: those on which a pattern hits.
    Patterns with a literal in ``NOISE_NEEDS`` are tried on lines that hold it.
    """
    if not patterns or not all(_free(regex) for _, regex in patterns):
        return noise_name(text, patterns).isNotNull()
    by_need: dict[str | None, list[Column]] = {}
    for _, regex in patterns:
        by_need.setdefault(NOISE_NEEDS.get(regex), []).append(text.rlike(regex))
    hits = [reduce(or_, found) if need is None else F.contains(text, F.lit(need)) & reduce(or_, found) for need, found in by_need.items()]
    return F.when(reduce(or_, hits), noise_name(text, patterns).isNotNull()).otherwise(F.lit(False))


def noise_blocks(blocks: DataFrame, patterns: Patterns = NOISE_PATTERNS) -> DataFrame:
    """Blocks that are noise, with the pattern that says so."""
    return blocks.withColumn("noise", noise_name(F.col("text"), patterns)).filter(
        F.col("noise").isNotNull()
    )


def without_blocks(blocks: DataFrame, noise: DataFrame) -> DataFrame:
    """Blocks that survive a table of noise block ids."""
    return blocks.join(noise.select("doc_id", "block_id"), ["doc_id", "block_id"], "left_anti")


def noise_counters(blocks: DataFrame, patterns: Patterns = NOISE_PATTERNS) -> DataFrame:
    """Per document: pages with noise, noise blocks.

    Counts per page come first, so a distinct page count needs no second pass.
    """
    per_page = (
        blocks.select("doc_id", "page_number", is_noise(F.col("text"), patterns).alias("n"))
        .groupBy("doc_id", "page_number")
        .agg(F.count_if("n").alias("n"))
    )
    return per_page.groupBy("doc_id").agg(
        F.count_if(F.col("n") > 0).alias("pages_modified"), F.sum("n").alias("blocks_flagged")
    )


def _scan(text: Column, patterns: Patterns) -> Column:
    return F.transform(
        lines_with_ends(text),
        lambda x: F.struct(x.alias("line"), is_noise(x, patterns).alias("noise")),
    )


def strip_noise_lines(docs: DataFrame, patterns: Patterns = NOISE_PATTERNS) -> DataFrame:
    """Texts without their noise lines, and the spans removed from each.

    ``removed`` is ``array<struct<start,end>>`` in the original text.
    """
    scanned = docs.withColumn("_lines", _scan(F.col("text"), patterns)).withColumn(
        "_starts", prefix_sums(F.transform("_lines", lambda x: F.length(x["line"])))
    )

    def span(x: Column, start: Column) -> Column:
        end = start + F.length(x["line"])
        return F.struct(x["noise"].alias("noise"), F.struct(start.alias("start"), end.alias("end")).alias("span"))

    kept = F.transform(F.filter("_lines", lambda x: ~x["noise"]), lambda x: x["line"])
    cut = F.filter(F.zip_with("_lines", "_starts", span), lambda x: x["noise"])
    return scanned.select(
        "doc_id", F.array_join(kept, "").alias("text"), F.transform(cut, lambda x: x["span"]).alias("removed")
    )
