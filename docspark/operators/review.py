"""What a reviewer looks at: blocks with their entities and fields, captions, traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.answers import parts_to_text
from docspark.functions.text import show
from docspark.vocab import DEFAULT_ROLE, NO_SECTION

TRACE_TEXT_LIMIT = 2000


def hint_list(hints: Column, single: Column | None = None) -> Column:
    """Hints as a list: the list, else the older single value, else ``none``."""
    out = F.when(F.size(hints) > 0, hints)
    if single is not None:
        out = out.when(F.coalesce(single, F.lit("")) != "", F.array(single))
    return out.otherwise(F.array(F.lit(NO_SECTION)))


def with_profiles(blocks: DataFrame, profiles: DataFrame) -> DataFrame:
    """Blocks with their profile; defaults where there is none."""
    p = profiles.select("doc_id", "block_id", "text_role", "hints", "confidence", "rationale")
    return blocks.join(p, ["doc_id", "block_id"], "left").select(
        *blocks.columns,
        F.coalesce("text_role", F.lit(DEFAULT_ROLE)).alias("text_role"),
        hint_list(F.col("hints")).alias("hints"),
        "confidence",
        F.coalesce("rationale", F.lit("")).alias("rationale"),
    )


def entity_rows(occurrences: DataFrame) -> DataFrame:
    """Candidates by the block of each occurrence; occurrences without one are left out.

    ``occurrences(doc_id, block_id, page_number, seq, section, text, source_models)``.
    """
    return occurrences.filter(F.coalesce("block_id", F.lit("")) != "")


def field_rows(provenance: DataFrame, values: DataFrame) -> DataFrame:
    """Record fields by the block they come from, with value and provenance type.

    ``provenance(doc_id, field, block_id, type)``, ``values(doc_id, field, value)``.
    """
    cited = provenance.filter(F.coalesce("block_id", F.lit("")) != "").select(
        "doc_id", "field", "block_id", F.coalesce(F.nullif("type", F.lit("")), F.lit("verbatim")).alias("prov_type")
    )
    return cited.join(values.select("doc_id", "field", "value"), ["doc_id", "field"], "left")


def block_views(blocks: DataFrame, profiles: DataFrame, occurrences: DataFrame, fields: DataFrame) -> DataFrame:
    """One row per block with its profile and two lists: entities and record fields.

    A list holds what sits in one block, so its size is bounded by the block.
    """
    keys = ["doc_id", "block_id"]
    e = (
        entity_rows(occurrences)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("page_number", "seq", "section", "text", "source_models"))).alias("entities"))
    )
    f = fields.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("field", "value", "prov_type"))).alias("fields"))
    joined = with_profiles(blocks, profiles).join(e, keys, "left").join(f, keys, "left")
    return joined.withColumns(
        {
            "entities": F.coalesce("entities", F.array().cast(e.schema["entities"].dataType)),
            "fields": F.coalesce("fields", F.array().cast(f.schema["fields"].dataType)),
        }
    )


def view_payload(views: DataFrame) -> DataFrame:
    """One JSON object per block view."""
    entities = F.transform(
        "entities",
        lambda e: F.struct(e["text"].alias("text"), e["section"].alias("section"), e["source_models"].alias("models")),
    )
    fields = F.transform(
        "fields",
        lambda f: F.struct(f["field"].alias("field"), show(f["value"], "null").alias("value"), f["prov_type"].alias("type")),
    )
    body = F.struct(
        "block_id",
        F.col("page_number").alias("page"),
        F.col("text_role").alias("role"),
        F.col("hints").alias("sections"),
        "confidence",
        "rationale",
        "text",
        entities.alias("entities"),
        fields.alias("fields"),
    )
    return views.select("doc_id", "block_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))


def view_caption(views: DataFrame) -> DataFrame:
    """Blocks, blocks with a box and blocks of several sections, per document."""
    several = F.size(F.array_remove("hints", NO_SECTION)) > 1
    boxed = F.count_if(F.size("bbox") > 0) if "bbox" in views.columns else F.lit(0).cast("bigint")
    return views.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("blocks"), boxed.alias("with_geometry"), F.count_if(several).alias("multi_section")
    )


def page_roles(profiled: DataFrame) -> DataFrame:
    """Roles and sections present on each page, from fixed vocabularies."""
    sections = F.array_distinct(F.flatten(F.collect_set("hints")))
    return profiled.groupBy("doc_id", "page_number").agg(
        F.sort_array(F.collect_set("text_role")).alias("roles"), F.sort_array(sections).alias("sections")
    )


def comparison_table(comparisons: DataFrame) -> DataFrame:
    """Extracted against expected values as display text."""
    return comparisons.select(
        "doc_id",
        "field",
        show(F.col("actual"), "—").alias("extracted"),
        show(F.col("expected"), "—").alias("expected"),
        F.when(F.col("passed"), F.lit("yes")).otherwise(F.lit("no")).alias("match"),
    )


def conversation_trace(turns: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Trace entries of ``turns(doc_id, turn, role, parts, tools)``, one per turn.

    The text parts become one text, whole unless ``max_chars`` cuts it for
    display (``TRACE_TEXT_LIMIT`` is the usual cut). Entries stay rows in the order of ``turn``, so a long
    conversation is not collected anywhere.
    """
    content = parts_to_text(F.col("parts"))
    return turns.select(
        "doc_id",
        F.col("turn").alias("entry_no"),
        "role",
        (content if max_chars is None else F.left(content, F.lit(max_chars))).alias("content"),
        F.array_join("tools", ", ").alias("tools"),
    )
