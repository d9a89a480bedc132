"""Entity mentions: recognition, attribution to blocks, gates, candidates."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docspark.functions.text import (
    context,
    contains_any,
    cut,
    let,
    occurs,
    quoted,
    spans_between,
    squash,
    text_key,
)
from docspark.operators.models import gathered, isolated
from docspark.sources.scratch import stage
from docspark.vocab import (
    DROP_EXAMPLES,
    DROP_ROLES,
    HINT_RULES,
    LABEL_SECTIONS,
    SECTIONS,
    STOPLIST,
    VENDOR_NAMES,
    HintRule,
)

EXCERPT_PAD = 50
LABEL_REACH = 80


@dataclass(frozen=True)
class Pattern:
    """An entity label found by a regular expression, under a model name.

    ``needs`` is a literal that every match contains; looking for it first is
    much cheaper than running the expression over texts that cannot match.
    """

    model: str
    label: str
    regex: str
    needs: str | None = None


@dataclass(frozen=True)
class Tables:
    """Lookup tables of the entity steps; small and of fixed size."""

    label_sections: Mapping[str, Sequence[str]] = None
    drop_roles: Sequence[str] = DROP_ROLES
    stoplist: Sequence[str] = STOPLIST
    hint_rules: Sequence[HintRule] = HINT_RULES
    vendor_names: Sequence[str] = VENDOR_NAMES

    def __post_init__(self):
        set_ = object.__setattr__
        if self.label_sections is None:
            set_(self, "label_sections", LABEL_SECTIONS)
        set_(self, "stoplist", tuple(s.strip().lower() for s in self.stoplist))
        set_(self, "vendor_names", tuple(v.lower() for v in self.vendor_names))

    @classmethod
    def from_mapping(cls, raw: Mapping) -> "Tables":
        """Tables out of a parsed configuration file; other missing parts are empty.

        The labels' sections stand under ``label_to_umbrellas`` or
        ``label_to_sections``. Without them every mention would be dropped, so
        they must be there; a key that is not known is refused as well.
        """
        labels = raw.get("label_to_umbrellas", raw.get("label_to_sections"))
        if labels is None:
            raise KeyError("no label_to_umbrellas in the configuration")
        unknown = set(raw) - {"label_to_umbrellas", "label_to_sections", "drop_roles", "stoplist", "field_hint_rules", "vendor_names"}
        if unknown:
            raise KeyError(f"unknown keys in the configuration: {sorted(unknown)}")
        rules = [HintRule(r.get("entity_label", ""), tuple(r.get("near_labels") or ()), r["field"]) for r in raw.get("field_hint_rules") or ()]
        return cls(
            label_sections=dict(labels),
            drop_roles=tuple(raw.get("drop_roles") or ()),
            stoplist=tuple(map(str, raw.get("stoplist") or ())),
            hint_rules=tuple(rules),
            vendor_names=tuple(map(str, raw.get("vendor_names") or ())),
        )


# --- recognition -------------------------------------------------------------


def patterns_of(patterns: Sequence[Pattern], tables: Tables, section: str) -> list[Pattern]:
    """The patterns whose mentions may belong to a section."""
    return [p for p in patterns if section in tables.label_sections.get(p.label, ())]


def any_occurs(text: Column, patterns: Sequence[Pattern]) -> Column:
    """Whether any pattern occurs in a text. A literal is looked for first, and equal expressions once."""
    distinct = dict.fromkeys((p.regex, p.needs) for p in patterns)
    by_need = sorted(distinct, key=lambda x: x[1] is None)
    return reduce(or_, [F.coalesce(occurs(text, regex, needs), F.lit(False)) for regex, needs in by_need], F.lit(False))


def recognise(pages: DataFrame, patterns: Sequence[Pattern]) -> DataFrame:
    """Mentions found by patterns, with context cut from the page.

    Works inside each page row. ``seq`` orders mentions of a page: by model in
    the given order, then by position. ``excerpt`` and ``left_text`` are what
    later steps need of the page, so the page text itself goes no further.
    """
    models = list(dict.fromkeys(p.model for p in patterns))
    text = F.col("text")
    # patterns with the same expression share its matches
    alike: dict[tuple[str, str | None], list[tuple[int, Pattern]]] = {}
    for i, p in enumerate(patterns):
        alike.setdefault((p.regex, p.needs), []).append((i, p))

    def cut_up(regex: str, needs: str | None, of: list[tuple[int, Pattern]]) -> Column:
        who = [
            F.struct(F.lit(models.index(p.model)).alias("model_no"), F.lit(i).alias("pattern_no"), F.lit(p.label).alias("label"), F.lit(p.model).alias("model"))
            for i, p in of
        ]

        def around(hits: Column) -> Column:
            return F.when(F.size(hits) > 0, F.struct(F.array(*who).alias("who"), F.split(text, regex, -1).alias("gaps"), hits.alias("hits")))

        found = let(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), around)
        return found if needs is None else F.when(F.contains(text, F.lit(needs)), found)

    def placed(x: Column) -> Column:
        def of_pattern(spans: Column, w: Column) -> Column:
            return F.transform(
                spans,
                lambda s: F.struct(
                    w["model_no"].alias("model_no"),
                    s["start"].alias("char_start"),
                    w["pattern_no"].alias("pattern_no"),
                    s["end"].alias("char_end"),
                    s["text"].alias("text"),
                    w["label"].alias("label"),
                    w["model"].alias("source_model"),
                ),
            )

        return let(spans_between(x["gaps"], x["hits"]), lambda spans: F.flatten(F.transform(x["who"], lambda w: of_pattern(spans, w))))

    cuts = F.array_compact(F.array(*[cut_up(regex, needs, of) for (regex, needs), of in alike.items()]))
    found = F.array_sort(F.flatten(F.transform(cuts, placed)))
    others = [c for c in pages.columns if c != "text"]
    hit = F.col("hit")
    return (
        pages.select(*others, F.col("text").alias("_page"), F.posexplode_outer(found).alias("seq", "hit"))
        .filter(hit.isNotNull())
        .select(
            *others,
            "seq",
            hit["text"].alias("text"),
            hit["label"].alias("label"),
            hit["source_model"].alias("source_model"),
            hit["char_start"].alias("char_start"),
            hit["char_end"].alias("char_end"),
            squash(context(F.col("_page"), hit["char_start"], hit["char_end"], EXCERPT_PAD)).alias("excerpt"),
            F.lower(
                cut(F.col("_page"), F.greatest(hit["char_start"] - LABEL_REACH, F.lit(0)), hit["char_start"])
            ).alias("left_text"),
        )
    )


Recogniser = Callable[[pd.DataFrame], pd.DataFrame]


def recognise_with(pages: DataFrame, load: Callable[[], Recogniser]) -> DataFrame:
    """Mentions found by a model, over Arrow batches of pages.

    ``load`` runs once per task and returns a function from a frame
    ``(doc_id, page_number, text)`` to a frame of mentions.
    """
    id_type = pages.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for pdf in frames:
            model = model or load()
            yield model(pdf)

    rows = pages.select("doc_id", "page_number", "text").filter(F.length(squash(F.col("text"))) > 0)
    return rows.mapInPandas(
        run,
        f"doc_id {id_type}, page_number int, text string, label string, "
        "source_model string, char_start int, char_end int",
    )


def recognise_models(pages: DataFrame, load: Callable[[], dict[str, Recogniser]]) -> tuple[DataFrame, DataFrame]:
    """Mentions found by several models, and a quarantine of the pages on which one raised.

    ``load`` runs once per task and returns the models by name; each maps a frame
    ``(doc_id, page_number, text)`` to mentions ``(doc_id, page_number, text,
    label, char_start, char_end)``. A page that makes a model raise is found by
    halving and left out for that model only. The quarantine lists ``doc_id,
    page_number, source_model, error``. All is written once, so that both parts
    are of the same run.
    """
    id_type = pages.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "page_number", "text", "label", "source_model", "char_start", "char_end", "error"]

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models: dict[str, Recogniser] | None = None
        for pdf in frames:
            models = load() if models is None else models
            for name, model in models.items():
                for rows, found, error in isolated(model, pdf):
                    if found is None:
                        bad = {"doc_id": rows["doc_id"], "page_number": rows["page_number"], "source_model": name, "error": error}
                        yield pd.DataFrame(bad, dtype=object).reindex(columns=columns)
                    elif len(found):
                        yield found.assign(source_model=name, error=None)[columns]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return gathered(each(frames))

    rows = pages.select("doc_id", "page_number", "text").filter(F.length(squash(F.col("text"))) > 0)
    schema = f"doc_id {id_type}, page_number int, text string, label string, source_model string, char_start int, char_end int, error string"
    found = stage(rows.mapInPandas(run, schema), "model-mentions")
    bad = found.where("error is not null").select("doc_id", "page_number", "source_model", "error")
    return found.where("error is null").drop("error"), bad


# --- attribution to blocks ---------------------------------------------------


def block_at(spans: Column, offset: Column) -> Column:
    """The first span ``[start, end)`` of a page that holds an offset, or null."""
    return F.get(F.filter(spans, lambda s: (s["start"] <= offset) & (offset < s["end"])), F.lit(0))


def first_spans(spans: DataFrame) -> DataFrame:
    """``doc_id, page_number, block_id, start, end`` of the offsets at which each span is the first that holds them.

    Spans are taken in the order of their start, then end, then block. What
    an earlier span covers is taken off, so the result does not overlap, and a span
    of which nothing is left goes.
    """
    earlier = Window.partitionBy("doc_id", "page_number").orderBy("start", "end", "block_id").rowsBetween(Window.unboundedPreceding, -1)
    free = F.greatest(F.col("start"), F.max("end").over(earlier))  # greatest skips the null of the first span
    cut = spans.filter(F.col("end") > F.col("start")).select("doc_id", "page_number", "block_id", free.alias("start"), "end")
    return cut.filter(F.col("start") < F.col("end"))


def attach_blocks(entities: DataFrame, spans: DataFrame, width: int = 1024) -> DataFrame:
    """Join mentions to the first block span that holds their start, null if none does.

    Spans are made disjoint first, so every mention stays one row. Then a range
    join on ``(doc_id, page_number, offset bucket)``: a span is listed in every
    bucket it touches, a mention sits in one, so a page with very many
    mentions spreads over its buckets and few pairs are compared.
    """
    keys = ["doc_id", "page_number", "_bucket"]
    bucketed = first_spans(spans).select(
        "doc_id",
        "page_number",
        F.col("block_id"),
        F.col("start").alias("_start"),
        F.col("end").alias("_end"),
        F.explode_outer(
            F.sequence(
                F.floor(F.col("start") / width).cast("int"), F.floor((F.col("end") - 1) / width).cast("int")
            )
        ).alias("_bucket"),
    ).alias("s")
    e = entities.withColumn("_bucket", F.floor(F.col("char_start") / width).cast("int")).alias("e")
    on = [F.col(f"e.{k}") == F.col(f"s.{k}") for k in keys]
    on += [F.col("_start") <= F.col("char_start"), F.col("char_start") < F.col("_end")]
    return e.join(bucketed, on, "left").select(
        *[F.col(f"e.{c}") for c in entities.columns], F.col("s.block_id").alias("block_id")
    )


def attach_profiles(entities: DataFrame, profiles: DataFrame) -> DataFrame:
    """Add role and hints of the block a mention sits in."""
    p = profiles.select("doc_id", "block_id", "text_role", "hints")
    return entities.join(p, ["doc_id", "block_id"], "left").withColumn(
        "text_role", F.coalesce("text_role", F.lit(""))
    )


# --- gates and sections ------------------------------------------------------


def _sections_of(label: Column, tables: Tables) -> Column:
    out = None
    for name, sections in tables.label_sections.items():
        if not sections:
            continue
        value = F.array(*map(F.lit, sections))
        out = F.when(label == name, value) if out is None else out.when(label == name, value)
    return F.lit(None).cast("array<string>") if out is None else out


def gate(entities: DataFrame, tables: Tables = Tables()) -> DataFrame:
    """Add ``drop_reason``: by role, then stoplist, then label; null means kept."""
    role = F.coalesce("text_role", F.lit(""))
    reason = (
        F.when(role.isin(*tables.drop_roles), F.concat(F.lit("block role '"), role, F.lit("' in drop-set")))
        .when(text_key(F.col("text")).isin(*tables.stoplist), F.lit("in stoplist (known false positive)"))
        .when(
            _sections_of(F.col("label"), tables).isNull(),
            F.concat(F.lit("label '"), F.coalesce("label", F.lit("")), F.lit("' not in schema v2")),
        )
    )
    return entities.withColumn("drop_reason", reason)


def drop_counts(gated: DataFrame) -> DataFrame:
    return gated.groupBy("doc_id").agg(
        F.count_if(F.col("drop_reason").isNotNull()).alias("dropped_count"),
        F.count(F.lit(1)).alias("mentions"),
    )


def drop_examples(gated: DataFrame, n: int = DROP_EXAMPLES) -> DataFrame:
    """The first ``n`` dropped mentions of each document."""
    w = Window.partitionBy("doc_id").orderBy("page_number", "seq")
    return (
        gated.filter(F.col("drop_reason").isNotNull())
        .select("doc_id", "page_number", "seq", "text", "drop_reason", F.row_number().over(w).alias("rank"))
        .filter(F.col("rank") <= n)
    )


def resolve_sections(gated: DataFrame, tables: Tables = Tables()) -> DataFrame:
    """One row per kept mention and section it may belong to.

    Sections of the label that the block also hints at (confidence 0.9), or
    all sections of the label where the two do not meet (confidence 0.6).
    """
    allowed = _sections_of(F.col("label"), tables)
    real = F.array(*map(F.lit, SECTIONS))
    hinted = F.array_intersect(F.coalesce("hints", F.array().cast("array<string>")), real)
    both = F.array_intersect(allowed, hinted)
    confirmed = F.size(both) > 0
    return (
        gated.filter(F.col("drop_reason").isNull())
        .withColumn("confidence", F.when(confirmed, F.lit(0.9)).otherwise(F.lit(0.6)))
        .withColumn("section", F.explode_outer(F.sort_array(F.when(confirmed, both).otherwise(F.array_distinct(allowed)))))
    )


# --- candidates --------------------------------------------------------------


def near_field(left_text: Column, tables: Tables, label: Column | None = None) -> Column:
    """Field of the first rule with a label left of the mention.

    Rules name an entity label; it is checked only if ``label`` is given.
    """
    out = F.lit(None).cast("string")
    for r in reversed(tables.hint_rules):
        hit = contains_any(left_text, [n.lower() for n in r.near_labels])
        if label is not None:
            hit = hit & (label == r.entity_label)
        out = F.when(hit, F.lit(r.field)).otherwise(out)
    return out


def candidate_occurrences(resolved: DataFrame) -> DataFrame:
    """Mentions in long form, keyed by the candidate they belong to."""
    return resolved.select(
        "doc_id",
        text_key(F.col("text")).alias("text_key"),
        "section",
        "page_number",
        "seq",
        "block_id",
        "char_start",
        "char_end",
        F.coalesce("text_role", F.lit("")).alias("text_role"),
        F.col("excerpt").alias("evidence_excerpt"),
    )


def candidates(
    resolved: DataFrame,
    tables: Tables = Tables(),
    respect_label: bool = False,
    keep_occurrences: bool = False,
) -> DataFrame:
    """Fold mentions into one candidate per document, text and section.

    First-seen text and excerpt, all models, roles and pages, best confidence,
    a field hint for record fields. All parts combine before the shuffle, so a
    text that is mentioned very often costs one row per task. The mentions stay
    in :func:`candidate_occurrences`; ``keep_occurrences`` also nests them.
    """
    at = F.struct("page_number", "seq")
    field = F.when(
        F.col("section") == SECTIONS[0],
        near_field(F.col("left_text"), tables, F.col("label") if respect_label else None),
    )
    role = F.nullif(F.coalesce("text_role", F.lit("")), F.lit(""))
    rows = resolved.select(
        "doc_id",
        text_key(F.col("text")).alias("text_key"),
        "section",
        at.alias("at"),
        F.struct("page_number", "seq", "text", "excerpt", "block_id").alias("first"),
        F.when(field.isNotNull(), F.struct("page_number", "seq", field.alias("field"))).alias("hint"),
        "page_number",
        "source_model",
        "confidence",
        role.alias("role"),
        *(
            [F.struct("page_number", "seq", "block_id", "char_start", "char_end", role.alias("text_role"), "excerpt").alias("occ")]
            if keep_occurrences
            else []
        ),
    )
    folded = rows.groupBy("doc_id", "text_key", "section").agg(
        F.min("first").alias("first"),
        F.min("hint").alias("hint"),
        F.count(F.lit(1)).alias("n_occurrences"),
        F.sort_array(F.collect_set("page_number")).alias("pages"),
        F.sort_array(F.collect_set("source_model")).alias("source_models"),
        F.sort_array(F.collect_set("role")).alias("roles"),
        F.max("confidence").alias("confidence"),
        *([F.array_sort(F.collect_list("occ")).alias("occurrences")] if keep_occurrences else []),
    )
    text = F.col("first.text")
    vendor = contains_any(F.lower(text), tables.vendor_names)
    is_record = F.col("section") == SECTIONS[0]
    roles = F.when(F.size("roles") > 0, F.array_join("roles", ", ")).otherwise(F.lit("unknown block"))
    basis = F.when(F.col("confidence") >= 0.9, F.lit("block-confirmed")).otherwise(F.lit("label-only fallback"))
    return folded.select(
        "doc_id",
        "text_key",
        "section",
        text.alias("text"),
        F.when(is_record & vendor, F.lit("Vendor_Name")).when(is_record, F.col("hint.field")).alias("field_hint"),
        "n_occurrences",
        "pages",
        F.col("first.excerpt").alias("evidence_excerpt"),
        F.col("first.block_id").alias("evidence_block"),
        "source_models",
        "confidence",
        F.concat(
            quoted(text),
            F.lit(" → "),
            F.col("section"),
            F.lit(" ("),
            basis,
            F.lit("; "),
            F.col("n_occurrences").cast("string"),
            F.lit(" occurrence(s) in "),
            roles,
            F.lit(")"),
        ).alias("rationale"),
        *(["occurrences"] if keep_occurrences else []),
    )


def of_section(cands: DataFrame, section: str) -> DataFrame:
    return cands.filter(F.col("section") == section)


def section_counts(docs: DataFrame, cands: DataFrame) -> DataFrame:
    """Candidates per document and section, with zeros, for all documents."""
    wide = cands.groupBy("doc_id").agg(
        *[F.count_if(F.col("section") == s).alias(s) for s in SECTIONS]
    )
    rows = F.array(
        *[F.struct(F.lit(s).alias("section"), F.coalesce(s, F.lit(0)).alias("candidates")) for s in SECTIONS]
    )
    return docs.select("doc_id").join(wide, "doc_id", "left").select("doc_id", F.inline(rows))
