"""Queries over the prose documents: blocks, pages, noise, roles, entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions.text import stays_in_line
from docspark.operators import blocks as B
from docspark.operators import entities as E
from docspark.operators import noise as N
from docspark.operators import roles as R
from docspark.plans import sqltext as S
from docspark.sources import tables as T
from docspark.vocab import NOISE_ROLE

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

SPANS_WITH_ROLE = "array<struct<block_id:string,start:int,end:int,text_role:string>>"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _noise(b: Column) -> Column:
    return N.is_noise(b["text"], T.PROSE_NOISE)


def _describe(b: Column) -> list[Column]:
    return [R.role_of(b["text"], T.PROSE_ROLES).alias("text_role")]


def prose_blocks(spark: SparkSession, d: str) -> DataFrame:
    return B.blocks_from_text(T.documents(spark, d))


def clean_pages(docs: DataFrame) -> DataFrame:
    """Clean pages whose spans carry the role of their block."""
    return B.pages_from_text(docs, drop=_noise, describe=_describe, span_type=SPANS_WITH_ROLE)


def mention_pages(docs: DataFrame, patterns: Sequence[E.Pattern]) -> DataFrame:
    """Clean pages on which a pattern occurs; the spans carry the role of the blocks that hold a match, null for others.

    Where matches stay within a line, the lines tell which pages these are, so noise and roles are tried on few of them.
    """
    if not all(stays_in_line(p.regex) for p in patterns):
        return clean_pages(docs)

    def describe(b: Column) -> list[Column]:
        return [F.when(b["marked"], R.role_of(b["text"], T.PROSE_ROLES)).alias("text_role")]

    return B.pages_from_text(docs, mark=lambda t: E.any_occurs(t, patterns), drop=_noise, describe=describe, span_type=SPANS_WITH_ROLE)


def placed_mentions(docs: DataFrame, patterns: Sequence[E.Pattern] = T.PROSE_PATTERNS) -> DataFrame:
    """Mentions with the block they start in and its role; no shuffle up to here."""
    found = E.recognise(mention_pages(docs, patterns).drop("block_ids"), patterns)
    span = E.block_at(F.col("block_spans"), F.col("char_start"))
    placed = found.withColumn("span", span).select(
        "*", "span.block_id", F.coalesce("span.text_role", F.lit("")).alias("text_role")
    )
    return placed.withColumn("hints", R.hints_of(F.col("text_role"), T.PROSE_ROLES)).drop("span", "block_spans")


def candidates_of(docs: DataFrame, section: str | None = None) -> DataFrame:
    """The candidates of ``docs(doc_id, text)``, from text to fold; those of one section need only its patterns."""
    patterns = T.PROSE_PATTERNS if section is None else E.patterns_of(T.PROSE_PATTERNS, T.PROSE_TABLES, section)
    gated = E.gate(placed_mentions(docs, patterns), T.PROSE_TABLES)
    found = E.candidates(E.resolve_sections(gated, T.PROSE_TABLES), T.PROSE_TABLES)
    return found if section is None else E.of_section(found, section)


def prose_pages(spark: SparkSession, d: str) -> DataFrame:
    return clean_pages(T.documents(spark, d))


def prose_mentions(spark: SparkSession, d: str) -> DataFrame:
    return placed_mentions(T.documents(spark, d))


def prose_gated(spark: SparkSession, d: str) -> DataFrame:
    return E.gate(prose_mentions(spark, d), T.PROSE_TABLES)


def prose_candidates(spark: SparkSession, d: str) -> DataFrame:
    return candidates_of(T.documents(spark, d))


# --- blocks and pages --------------------------------------------------------


@query
def blocks_from_documents(spark, d):
    return prose_blocks(spark, d)


ORACLE["blocks_from_documents"] = f"""
WITH {S.LINES}
SELECT doc_id, ord, block_id, page_number, 'page_' || page_number || '/paragraph' AS section_path, text FROM lines"""


@query
def page_spans(spark, d):
    return B.span_rows(B.pages_from_text(T.documents(spark, d)))


@query
def page_spans_windowed(spark, d):
    return B.block_offsets(prose_blocks(spark, d))


ORACLE["page_spans"] = ORACLE["page_spans_windowed"] = f"""
WITH {S.LINES}
SELECT doc_id, page_number, block_id, "start", "end" FROM ({S.page_spans()})"""


@query
def page_text(spark, d):
    return B.pages_from_blocks(prose_blocks(spark, d)).select(
        "doc_id", "page_number", "text", F.array_join("block_ids", ",").alias("block_ids")
    )


ORACLE["page_text"] = f"""
WITH {S.LINES}
SELECT doc_id, page_number, text, block_ids FROM ({S.page_texts()})
JOIN (SELECT doc_id, page_number, string_agg(block_id, ',' ORDER BY ord) AS block_ids
      FROM lines GROUP BY ALL) USING (doc_id, page_number)"""


@query
def doc_prompt(spark, d):
    return B.doc_prompt(B.pages_in_row(T.documents(spark, d)))


ORACLE["doc_prompt"] = f"""
WITH {S.LINES}
SELECT doc_id, count(*) AS total_pages,
       'Source document: doc_id=' || doc_id || ', total_pages=' || count(*) || chr(10) || chr(10) || '---' || chr(10)
       || string_agg('## Page ' || page_number || chr(10) ||
                     CASE WHEN text = '' THEN '(empty)' ELSE text END || chr(10), chr(10) ORDER BY page_number) AS prompt
FROM ({S.page_texts()}) GROUP BY doc_id"""


# --- noise -------------------------------------------------------------------

_NOISE_SQL = S.any_match("t", [p for _, p in T.PROSE_NOISE])
_NOISE_NAME_SQL = S.first_match("t", T.PROSE_NOISE)


@query
def noise_blocks(spark, d):
    return N.noise_blocks(prose_blocks(spark, d), T.PROSE_NOISE).select(
        "doc_id", "block_id", "page_number", "noise"
    )


ORACLE["noise_blocks"] = f"""
WITH {S.LINES}
SELECT doc_id, block_id, page_number, {_NOISE_NAME_SQL} AS noise
FROM (SELECT *, {S.strip("text")} AS t FROM lines) WHERE t <> '' AND {_NOISE_SQL}"""


@query
def noise_counters(spark, d):
    return N.noise_counters(prose_blocks(spark, d), T.PROSE_NOISE)


ORACLE["noise_counters"] = f"""
WITH {S.LINES}
SELECT doc_id, count(DISTINCT CASE WHEN n THEN page_number END) AS pages_modified,
       count(*) FILTER (WHERE n) AS blocks_flagged
FROM (SELECT doc_id, page_number, t <> '' AND {_NOISE_SQL} AS n
      FROM (SELECT *, {S.strip("text")} AS t FROM lines)) GROUP BY doc_id"""


@query
def clean_page_spans(spark, d):
    return B.span_rows(B.pages_from_text(T.documents(spark, d), drop=_noise))


@query
def surviving_page_spans(spark, d):
    """The same spans from tables: anti join on the noise ids, then the window."""
    blocks = prose_blocks(spark, d)
    return B.block_offsets(N.without_blocks(blocks, N.noise_blocks(blocks, T.PROSE_NOISE)))


ORACLE["clean_page_spans"] = ORACLE["surviving_page_spans"] = f"""
WITH {S.LINES}
SELECT doc_id, page_number, block_id, "start", "end" FROM ({S.page_spans(where=f"NOT {_NOISE_SQL}")})"""


@query
def strip_noise_lines(spark, d):
    out = N.strip_noise_lines(T.documents(spark, d), T.PROSE_NOISE)
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return out.select("doc_id", "text", F.array_join(spans, ",").alias("removed"))


ORACLE["strip_noise_lines"] = f"""
WITH {S.LINES},
ended AS (SELECT doc_id, ord, {S.strip("text")} AS t,
                 text || CASE WHEN ord < max(ord) OVER (PARTITION BY doc_id) THEN chr(10) ELSE '' END AS line
          FROM lines),
placed AS (SELECT *, t <> '' AND {_NOISE_SQL} AS noise,
                  CAST(sum(length(line)) OVER (PARTITION BY doc_id ORDER BY ord) AS BIGINT) AS stop FROM ended)
SELECT doc_id, coalesce(string_agg(line, '' ORDER BY ord) FILTER (WHERE NOT noise), '') AS text,
       coalesce(string_agg((stop - length(line)) || ':' || stop, ',' ORDER BY ord) FILTER (WHERE noise), '') AS removed
FROM placed GROUP BY doc_id"""


# --- roles -------------------------------------------------------------------

_ROLE_SQL = (
    "CASE "
    + " ".join(f"WHEN regexp_matches(text, {S.text(r.pattern)}) THEN {S.text(r.role)}" for r in T.PROSE_ROLES)
    + " ELSE 'other' END"
)
_HINT_SQL = (
    "CASE text_role "
    + " ".join(f"WHEN {S.text(r.role)} THEN {S.text(','.join(r.hints))}" for r in T.PROSE_ROLES)
    + " ELSE 'none' END"
)
_CONF_SQL = (
    "CASE text_role "
    + " ".join(f"WHEN {S.text(r.role)} THEN {r.confidence}" for r in T.PROSE_ROLES)
    + f" WHEN '{NOISE_ROLE}' THEN 1.0 ELSE 0.5 END"
)
_TAGGED = f"""
tagged AS (SELECT *, CASE WHEN t <> '' AND {_NOISE_SQL} THEN '{NOISE_ROLE}' ELSE {_ROLE_SQL} END AS text_role
           FROM (SELECT *, {S.strip("text")} AS t FROM lines))"""


def prose_profiles(spark, d):
    return R.profile_blocks(prose_blocks(spark, d), N.is_noise(F.col("text"), T.PROSE_NOISE), T.PROSE_ROLES)


@query
def block_roles(spark, d):
    return prose_profiles(spark, d).select(
        "doc_id", "block_id", "page_number", "ord", "text_role", F.array_join("hints", ",").alias("hints"),
        "confidence", "rationale",
    )


ORACLE["block_roles"] = f"""
WITH {S.LINES}, {_TAGGED}
SELECT doc_id, block_id, page_number, ord, text_role, {_HINT_SQL} AS hints, CAST({_CONF_SQL} AS DOUBLE) AS confidence,
       CASE WHEN text_role = '{NOISE_ROLE}' THEN 'Pre-tagged as noise by pattern.' ELSE 'rule: ' || text_role END AS rationale
FROM tagged"""


@query
def merged_roles(spark, d):
    """The scored blocks put back among the blocks of their document, with the position they were read at."""
    profiles = prose_profiles(spark, d).filter(F.col("text_role") != NOISE_ROLE).select("doc_id", "block_id", "page_number", "ord", "text_role")
    return R.merge_in_order(prose_blocks(spark, d), profiles).select("doc_id", "block_id", "ord", "page_number", "text_role")


ORACLE["merged_roles"] = f"""
WITH {S.LINES}, {_TAGGED}
SELECT doc_id, block_id, ord, page_number, text_role FROM tagged WHERE text_role <> '{NOISE_ROLE}'"""


@query
def role_batches(spark, d):
    blocks = prose_blocks(spark, d).filter(~N.is_noise(F.col("text"), T.PROSE_NOISE))
    return R.batches(R.scorer_payload(blocks), 25).select("doc_id", "block_id", "ord", "batch", "text")


ORACLE["role_batches"] = f"""
WITH {S.LINES}
SELECT doc_id, block_id, ord, (row_number() OVER (PARTITION BY doc_id ORDER BY ord) - 1) // 25 AS batch,
       text
FROM (SELECT *, {S.strip("text")} AS t FROM lines) WHERE NOT (t <> '' AND {_NOISE_SQL})"""


def _flaky_scores(blocks: DataFrame) -> DataFrame:
    """Profiles as an unreliable model would return them: some lost, some doubled, some renamed."""
    ord_ = F.col("ord")
    renamed = F.when(ord_ % 13 == 7, F.concat("block_id", F.lit("x"))).otherwise(F.col("block_id"))
    copies = F.when(ord_ % 11 == 5, 0).when(ord_ % 17 == 3, 2).otherwise(1)
    scored = R.score_by_rules(blocks, T.PROSE_ROLES).withColumn("block_id", renamed)
    return scored.withColumn("copy", F.explode(F.array_repeat(F.lit(True), copies))).drop("copy")


@query
def role_parity(spark, d):
    blocks = prose_blocks(spark, d)
    return R.parity_violations(blocks, _flaky_scores(blocks))


ORACLE["role_parity"] = f"""
WITH {S.LINES},
scored AS (SELECT doc_id, CASE WHEN ord % 13 = 7 THEN block_id || 'x' ELSE block_id END AS block_id
           FROM lines, (SELECT unnest([1, 2]) AS copy)
           WHERE ord % 11 <> 5 AND (copy = 1 OR ord % 17 = 3)),
counted AS (SELECT doc_id, block_id, sum(a) AS n_sent, sum(b) AS n_scored
            FROM (SELECT doc_id, block_id, 1 AS a, 0 AS b FROM lines
                  UNION ALL SELECT doc_id, block_id, 0, 1 FROM scored) GROUP BY ALL)
SELECT doc_id, block_id, CAST(n_sent AS BIGINT) AS n_sent, CAST(n_scored AS BIGINT) AS n_scored,
       CASE WHEN n_scored = 0 THEN 'missing' WHEN n_sent = 0 THEN 'extra' ELSE 'count' END AS problem
FROM counted WHERE n_sent <> n_scored"""


def _table_scorer(rows):
    """A model's stand-in: rows with cell marks are tables, the last of every batch gets an impossible confidence."""
    n = len(rows)
    return {c: rows[c].tolist() for c in ("doc_id", "block_id", "page_number")} | {
        "text_role": ["results_table" if "|" in t else "other" for t in rows["text"].tolist()],
        "hints": [["none"]] * n,
        "confidence": [0.5] * (n - 1) + [7.0],
        "rationale": ["by the model"] * n,
    }


@query
def scored_blocks(spark, d):
    """Blocks scored by a Python model, with what it got wrong set apart."""
    accepted, wrong = R.profile_with_model(prose_blocks(spark, d), N.is_noise(F.col("text"), T.PROSE_NOISE), _table_scorer, size=25)
    good = accepted.select("doc_id", "block_id", "text_role", F.lit(None).cast("string").alias("problem"))
    return good.unionByName(wrong.select("doc_id", "block_id", F.lit(None).cast("string").alias("text_role"), "problem"))


ORACLE["scored_blocks"] = f"""
WITH {S.LINES}, marked AS (SELECT *, t <> '' AND {_NOISE_SQL} AS noise FROM (SELECT *, {S.strip("text")} AS t FROM lines)),
sent AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS r, count(*) OVER (PARTITION BY doc_id) AS n FROM marked WHERE NOT noise),
bad AS (SELECT *, r % 25 = 0 OR r = n AS wrong FROM sent)
SELECT doc_id, block_id, '{NOISE_ROLE}' AS text_role, NULL AS problem FROM marked WHERE noise
UNION ALL SELECT doc_id, block_id, CASE WHEN NOT wrong THEN CASE WHEN contains(text, '|') THEN 'results_table' ELSE 'other' END END,
  CASE WHEN wrong THEN 'confidence' END FROM bad"""


@query
def role_legend(spark, d):
    return R.role_legend(prose_profiles(spark, d))


ORACLE["role_legend"] = f"""
WITH {S.LINES}, {_TAGGED}
SELECT doc_id, page_number, text_role, count(*) AS blocks FROM tagged GROUP BY ALL"""


# --- entities ----------------------------------------------------------------

_MODELS = list(dict.fromkeys(p.model for p in T.PROSE_PATTERNS))


def _mentions_sql() -> str:
    """Clean pages, and all pattern mentions with positions, role and context."""
    parts = []
    for i, p in enumerate(T.PROSE_PATTERNS):
        rx = S.text(p.regex)
        parts.append(f"""
  SELECT doc_id, page_number, text AS page, {_MODELS.index(p.model)} AS model_no, {i} AS pattern_no,
         {S.text(p.model)} AS source_model, {S.text(p.label)} AS label,
         unnest(regexp_extract_all(text, {rx})) AS text,
         unnest(list_transform(range(1, len(regexp_extract_all(text, {rx})) + 1), lambda k:
           CAST(list_sum(list_transform(string_split_regex(text, {rx})[1:k], lambda x: length(x)))
                + coalesce(list_sum(list_transform(regexp_extract_all(text, {rx})[1:k-1], lambda x: length(x))), 0)
                AS BIGINT))) AS char_start
  FROM clean WHERE regexp_matches(text, {rx})""")
    return f"""
{S.LINES}, {_TAGGED},
clean AS ({S.page_texts(where=f"NOT {_NOISE_SQL}")}),
spans AS (SELECT s.*, g.text_role, {_HINT_SQL.replace("text_role", "g.text_role")} AS hints
          FROM ({S.page_spans(where=f"NOT {_NOISE_SQL}")}) s JOIN tagged g USING (doc_id, block_id)),
found AS ({" UNION ALL ".join(parts)}),
mentions AS (
  SELECT f.doc_id, f.page_number, f.page, f.source_model, f.label, f.text, f.char_start,
         f.char_start + length(f.text) AS char_end, s.block_id, coalesce(s.text_role, '') AS text_role, s.hints,
         row_number() OVER (PARTITION BY f.doc_id, f.page_number ORDER BY model_no, char_start, pattern_no) - 1 AS seq,
         trim(regexp_replace(substr(page, greatest(char_start - 50, 0) + 1,
              char_start + length(f.text) + 50 - greatest(char_start - 50, 0)), '\\s+', ' ', 'g')) AS excerpt,
         lower(substr(page, greatest(char_start - 80, 0) + 1, char_start - greatest(char_start - 80, 0))) AS left_text
  FROM found f LEFT JOIN spans s ON f.doc_id = s.doc_id AND f.page_number = s.page_number
       AND s."start" <= f.char_start AND f.char_start < s."end")"""


_MENTIONS = _mentions_sql()


def _load_recognisers():
    """Stand-ins for two models: one takes the start of a page, the other its end and fails on some pages."""

    def head(rows):
        text = rows["text"].str[:5]
        return rows[["doc_id", "page_number"]].assign(text=text, label="HEAD", char_start=0, char_end=text.str.len())

    def tail(rows):
        if ((rows["doc_id"] * 7 + rows["page_number"]) % 10 == 3).any():
            raise ValueError("unreadable page")
        text, n = rows["text"].str[-4:], rows["text"].str.len()
        return rows[["doc_id", "page_number"]].assign(text=text, label="TAIL", char_start=n - text.str.len(), char_end=n)

    return {"head": head, "tail": tail}


@query
def model_mentions(spark, d):
    """Mentions by two Python models; a page on which one of them fails costs its mentions there and nothing else."""
    mentions, bad = E.recognise_models(prose_pages(spark, d), _load_recognisers)
    names = ["doc_id", "page_number", "source_model", "text", "char_start", "char_end", "error"]
    return mentions.withColumn("error", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True).select(*names)


@query
def entity_mentions(spark, d):
    return prose_mentions(spark, d).select(
        "doc_id", "page_number", "seq", "text", "label", "source_model", "char_start", "char_end", "excerpt"
    )


ORACLE["entity_mentions"] = f"""
WITH {_MENTIONS}
SELECT doc_id, page_number, seq, text, label, source_model, char_start, char_end, excerpt FROM mentions"""


ORACLE["model_mentions"] = f"""
WITH {S.LINES}, {_TAGGED}, clean AS (SELECT * FROM ({S.page_texts(where=f"NOT {_NOISE_SQL}")}) WHERE {S.strip("text")} <> ''),
tails AS (SELECT *, (doc_id * 7 + page_number) % 10 = 3 AS bad FROM clean)
SELECT doc_id, page_number, 'head' AS source_model, left(text, 5) AS text, CAST(0 AS BIGINT) AS char_start, length(left(text, 5)) AS char_end, NULL AS error FROM clean
UNION ALL
SELECT doc_id, page_number, 'tail', CASE WHEN NOT bad THEN right(text, 4) END, CASE WHEN NOT bad THEN greatest(length(text) - 4, 0) END,
       CASE WHEN NOT bad THEN length(text) END, CASE WHEN bad THEN 'ValueError: unreadable page' END FROM tails"""


@query
def entity_blocks(spark, d):
    """Attribution by the bucketed range join, from tables of mentions and spans."""
    pages = B.pages_from_text(T.documents(spark, d), drop=_noise)
    found = E.recognise(pages.select("doc_id", "page_number", "text"), T.PROSE_PATTERNS)
    # one mention in seven is moved to a separator or past the end of its page
    moved = F.when(F.col("char_start") % 7 == 0, F.col("char_end") + 37).otherwise(F.col("char_start"))
    rows = found.select("doc_id", "page_number", "seq", "label", moved.alias("char_start"))
    return E.attach_blocks(rows, B.span_rows(pages), width=64)


ORACLE["entity_blocks"] = f"""
WITH {_MENTIONS},
moved AS (SELECT doc_id, page_number, seq, label,
                 CASE WHEN char_start % 7 = 0 THEN char_end + 37 ELSE char_start END AS char_start FROM mentions)
SELECT m.*, s.block_id FROM moved m LEFT JOIN spans s ON m.doc_id = s.doc_id AND m.page_number = s.page_number
     AND s."start" <= m.char_start AND m.char_start < s."end\""""


_REASON_SQL = (
    "CASE WHEN text_role IN ("
    + ", ".join(S.text(r) for r in T.PROSE_TABLES.drop_roles)
    + ") THEN 'block role ''' || text_role || ''' in drop-set' WHEN "
    + S.key("text")
    + " IN ("
    + ", ".join(S.text(s) for s in T.PROSE_TABLES.stoplist)
    + ") THEN 'in stoplist (known false positive)' WHEN label NOT IN ("
    + ", ".join(S.text(x) for x in T.PROSE_TABLES.label_sections)
    + ") THEN 'label ''' || label || ''' not in schema v2' END"
)


@query
def entity_drops(spark, d):
    return E.drop_examples(prose_gated(spark, d))


ORACLE["entity_drops"] = f"""
WITH {_MENTIONS}
SELECT doc_id, page_number, seq, text, drop_reason, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_number, seq) AS rank
  FROM (SELECT *, {_REASON_SQL} AS drop_reason FROM mentions) WHERE drop_reason IS NOT NULL)
WHERE rank <= 5"""


@query
def entity_drop_counts(spark, d):
    return E.drop_counts(prose_gated(spark, d))


ORACLE["entity_drop_counts"] = f"""
WITH {_MENTIONS}
SELECT doc_id, count({_REASON_SQL}) AS dropped_count, count(*) AS mentions FROM mentions GROUP BY doc_id"""


def _resolved_sql() -> str:
    allowed = " ".join(
        f"WHEN {S.text(k)} THEN [{', '.join(map(S.text, sorted(v)))}]" for k, v in T.PROSE_TABLES.label_sections.items()
    )
    field = (
        "CASE WHEN section <> 'report_metadata' THEN NULL "
        + " ".join(
            "WHEN " + " OR ".join(f"contains(left_text, {S.text(n)})" for n in r.near_labels) + f" THEN {S.text(r.field)}"
            for r in T.PROSE_TABLES.hint_rules
        )
        + " END"
    )
    return f"""{_MENTIONS},
kept AS (SELECT *, CASE label {allowed} END AS allowed, string_split(coalesce(hints, ''), ',') AS hinted
         FROM mentions WHERE ({_REASON_SQL}) IS NULL),
met AS (SELECT *, list_filter(allowed, lambda a: list_contains(hinted, a)) AS met_both FROM kept),
resolved AS (SELECT *, CASE WHEN len(met_both) > 0 THEN 0.9 ELSE 0.6 END AS confidence,
                    unnest(CASE WHEN len(met_both) > 0 THEN met_both ELSE allowed END) AS section FROM met),
hinted AS (SELECT *, {S.key("text")} AS text_key, {field} AS field, page_number * 1000000 + seq AS place FROM resolved)"""


_RESOLVED = _resolved_sql()


@query
def entity_sections(spark, d):
    out = E.resolve_sections(prose_gated(spark, d), T.PROSE_TABLES)
    return out.select("doc_id", "page_number", "seq", "label", "section", "confidence")


ORACLE["entity_sections"] = f"""
WITH {_RESOLVED}
SELECT doc_id, page_number, seq, label, section, CAST(confidence AS DOUBLE) AS confidence FROM resolved"""


@query
def candidates(spark, d):
    return prose_candidates(spark, d).select(
        "doc_id", "text_key", "section", "text", "field_hint", "n_occurrences", F.array_join("pages", ",").alias("pages"),
        "evidence_excerpt", F.array_join("source_models", ",").alias("source_models"), "confidence", "rationale",
    )


_FOLD = f"""
WITH {_RESOLVED},
folded AS (
  SELECT doc_id, text_key, section, arg_min(text, place) AS text,
         arg_min(field, place) FILTER (WHERE field IS NOT NULL) AS near, count(*) AS n_occurrences,
         array_to_string(list_sort(list(DISTINCT page_number)), ',') AS pages, arg_min(excerpt, place) AS evidence_excerpt,
         array_to_string(list_sort(list(DISTINCT source_model)), ',') AS source_models,
         CAST(max(confidence) AS DOUBLE) AS confidence,
         array_to_string(list_sort(list(DISTINCT text_role) FILTER (WHERE text_role <> '')), ', ') AS roles
  FROM hinted GROUP BY ALL),
cands AS (
  SELECT *, CASE WHEN section = 'report_metadata' AND ({
      " OR ".join(f"contains(lower(text), {S.text(v)})" for v in T.PROSE_TABLES.vendor_names)
  }) THEN 'Vendor_Name' ELSE near END AS field_hint FROM folded)"""

ORACLE["candidates"] = f"""{_FOLD}
SELECT doc_id, text_key, section, text, field_hint, n_occurrences, pages, evidence_excerpt, source_models, confidence,
       CASE WHEN contains(text, '''') THEN '"' || text || '"' ELSE '''' || text || '''' END
       || ' → ' || section || ' (' || CASE WHEN confidence >= 0.9 THEN 'block-confirmed' ELSE 'label-only fallback' END
       || '; ' || n_occurrences || ' occurrence(s) in ' || roles || ')' AS rationale
FROM cands"""


@query
def candidate_occurrences(spark, d):
    return E.candidate_occurrences(E.resolve_sections(prose_gated(spark, d), T.PROSE_TABLES))


ORACLE["candidate_occurrences"] = f"""
WITH {_RESOLVED}
SELECT doc_id, text_key, section, page_number, seq, block_id, char_start, char_end, text_role,
       excerpt AS evidence_excerpt FROM hinted"""


@query
def section_counts(spark, d):
    return E.section_counts(T.documents(spark, d), prose_candidates(spark, d))


ORACLE["section_counts"] = f"""{_FOLD}
SELECT doc_id, section, count(text_key) AS candidates
FROM (SELECT doc_id, unnest(['report_metadata', 'Genomic_Variant_umbrella', 'other_molecular_biomarker_umbrella',
      'tested_biomarker_umbrella']) AS section FROM documents) LEFT JOIN cands USING (doc_id, section)
GROUP BY ALL"""


@query
def section_candidates(spark, d):
    """The checklist of one section, as its team sees it."""
    return E.of_section(prose_candidates(spark, d), "report_metadata").select("doc_id", "text", "field_hint", "confidence")


ORACLE["section_candidates"] = f"""{_FOLD}
SELECT doc_id, text, field_hint, confidence FROM cands WHERE section = 'report_metadata'"""


@query
def field_hints(spark, d):
    cands = E.of_section(prose_candidates(spark, d), "report_metadata")
    return cands.groupBy("doc_id", F.coalesce("field_hint", F.lit("(none)")).alias("field_hint")).agg(
        F.count(F.lit(1)).alias("candidates")
    )


ORACLE["field_hints"] = f"""{_FOLD}
SELECT doc_id, coalesce(field_hint, '(none)') AS field_hint, count(*) AS candidates
FROM cands WHERE section = 'report_metadata' GROUP BY ALL"""


def checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: each candidate with the number of candidates in its document and section."""
    cands = prose_candidates(spark, sf_dir)
    counts = E.section_counts(T.documents(spark, sf_dir), cands)
    return cands.join(counts, ["doc_id", "section"]).select(
        "doc_id", "section", "text", "field_hint", "n_occurrences", "confidence", "candidates"
    )
