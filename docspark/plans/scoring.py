"""Queries on scoring and review."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.operators import entities as E
from docspark.operators import fields as FI
from docspark.operators import ledger as LE
from docspark.operators import audit as A
from docspark.operators import review as RV
from docspark.operators import score as SC
from docspark.plans import prose, quality, reports, sqltext as S
from docspark.sources import tables as T
from docspark.sources.reports import GOLD_SQL, gold_records
from docspark.sources.scratch import stage
from docspark.vocab import DATE_FIELDS, RECORD_FIELDS, STRICT_FIELDS

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- scoring -----------------------------------------------------------------


def gold_json(spark: SparkSession, d: str) -> DataFrame:
    r = gold_records(spark, d)
    return r.select("doc_id", FI.record_json(r).alias("record"))


def altered_json(spark: SparkSession, d: str) -> DataFrame:
    """Extracted records: gold records with one kind of change per key."""
    k = F.col("doc_id")
    g = gold_records(spark, d)
    us = lambda c: F.date_format(F.to_date(c), "MM/dd/yyyy")
    g = g.withColumns(
        {
            "Patient_Last_Name": F.when(k % 9 == 1, F.concat(F.lit("  "), F.upper("Patient_Last_Name"), F.lit(" "))).otherwise(F.col("Patient_Last_Name")),
            "Patient_DOB": F.when(k % 9 == 2, us("Patient_DOB")).otherwise(F.col("Patient_DOB")),
            "Received_Date": F.when(k % 9 == 2, F.lit("1999-12-31")).otherwise(F.col("Received_Date")),
            "Practice_ZIP_5digit": F.when(k % 9 == 3, F.concat("Practice_ZIP_5digit", F.lit(" "))).otherwise(F.col("Practice_ZIP_5digit")),
            "Practice_City": F.when(k % 9 != 4, F.col("Practice_City")),
            "llm_confidence_score": F.lit(0.1),
        }
    )
    r = FI.record_json(g)
    r = (
        F.when(k % 9 == 5, F.replace(r, F.lit('"total_pages":2'), F.lit('"total_pages":"2"')))
        .when(k % 9 == 6, F.regexp_replace(r, '"Practice_City":"[^"]*",', ""))
        .when(k % 9 == 7, F.concat(F.lit('{"Extra":"x",'), F.substr(r, F.lit(2))))
        .when(k % 9 == 8, F.regexp_replace(r, '"Test_Name":"[^"]*"', '"Test_Name":7'))
        .otherwise(r)
    )
    return g.select("doc_id", r.alias("record"))


@query
def field_scores(spark, d):
    return SC.compare_fields(gold_json(spark, d), altered_json(spark, d))


def _scores_sql(lenient: bool) -> str:
    fields = [f for f in RECORD_FIELDS if f != "llm_confidence_score"]
    long = " UNION ALL ".join(f"SELECT doc_id, '{f}' AS field, CAST({f} AS VARCHAR) AS expected FROM g" for f in fields)
    strict = ", ".join(f"'{f}'" for f in STRICT_FIELDS)
    dates = ", ".join(f"'{f}'" for f in DATE_FIELDS)
    tiers = "" if lenient else f"""
      WHEN field IN ({strict}) THEN 'strict' WHEN field IN ({dates}) AND strftime(try_strptime(actual, ['%m/%d/%Y', '%Y-%m-%d']), '%Y-%m-%d') = expected THEN 'date'
      WHEN field IN ({dates}) THEN 'baddate'"""
    extras = "" if lenient else """
  UNION ALL SELECT doc_id, 'Extra', NULL, 'x', 'extra' FROM g WHERE doc_id % 9 = 7"""
    iso = "strftime(try_strptime(actual, ['%m/%d/%Y', '%Y-%m-%d']), '%Y-%m-%d')"
    return f"""
WITH g AS ({GOLD_SQL}), long AS ({long}),
paired AS (SELECT doc_id, field, expected, CASE
    WHEN doc_id % 9 = 1 AND field = 'Patient_Last_Name' THEN '  ' || upper(expected) || ' '
    WHEN doc_id % 9 = 2 AND field = 'Patient_DOB' THEN strftime(CAST(expected AS DATE), '%m/%d/%Y')
    WHEN doc_id % 9 = 2 AND field = 'Received_Date' THEN '1999-12-31'
    WHEN doc_id % 9 = 3 AND field = 'Practice_ZIP_5digit' THEN expected || ' '
    WHEN doc_id % 9 IN (4, 6) AND field = 'Practice_City' THEN NULL
    WHEN doc_id % 9 = 8 AND field = 'Test_Name' THEN '7' ELSE expected END AS actual,
    (doc_id % 9 = 5 AND field = 'total_pages') OR (doc_id % 9 = 8 AND field = 'Test_Name') AS other_type FROM long),
kinds AS (SELECT doc_id, field, expected, actual, CASE WHEN expected IS NULL AND actual IS NULL THEN 'both_null'
      WHEN expected IS NULL OR actual IS NULL THEN 'null' WHEN expected = actual AND NOT other_type THEN 'exact'{tiers}
      WHEN other_type THEN 'type' WHEN {S.key("expected")} = {S.key("actual")} THEN 'normalized_string' ELSE 'string' END AS kind FROM paired{extras})
SELECT doc_id, field, expected, actual, kind IN ('both_null', 'exact', 'date', 'normalized_string') AS passed,
  CASE WHEN kind IN ('both_null', 'exact', 'date', 'normalized_string') THEN kind ELSE 'fail' END AS match_type,
  CASE kind WHEN 'both_null' THEN '' WHEN 'exact' THEN ''
    WHEN 'null' THEN 'one side null (expected=' || coalesce(expected, 'null') || ', actual=' || coalesce(actual, 'null') || ')'
    WHEN 'strict' THEN 'strict field: exact match expected' WHEN 'date' THEN 'matched after ISO normalization (' || expected || ')'
    WHEN 'baddate' THEN 'date mismatch (expected_iso=' || expected || ', actual_iso=' || {iso} || ')'
    WHEN 'normalized_string' THEN 'matched after lowercase + whitespace normalize' WHEN 'string' THEN 'string mismatch even after normalization'
    WHEN 'type' THEN CASE WHEN field = 'total_pages' THEN 'type mismatch (int vs str)' ELSE 'type mismatch (str vs int)' END
    ELSE 'extra field: not in gold record' END AS notes FROM kinds"""


ORACLE["field_scores"] = _scores_sql(False)


@query
def doc_scores(spark, d):
    return SC.score_documents(SC.compare_fields(gold_json(spark, d), altered_json(spark, d)), 0.98)


def _doc_scores(sql: str, threshold: float) -> str:
    return f"""
SELECT doc_id, count(*) AS total_fields, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
       round(count(*) FILTER (WHERE passed) / count(*), 4) AS pass_rate, count(*) FILTER (WHERE passed) / count(*) >= {threshold} AS meets_threshold
FROM ({sql}) GROUP BY doc_id"""


ORACLE["doc_scores"] = _doc_scores(_scores_sql(False), 0.98)


@query
def lenient_scores(spark, d):
    return SC.score_documents(SC.compare_fields(gold_json(spark, d), altered_json(spark, d), lenient=True))


ORACLE["lenient_scores"] = _doc_scores(_scores_sql(True), 0.80)


@query
def comparison_table(spark, d):
    return RV.comparison_table(SC.compare_fields(gold_json(spark, d), altered_json(spark, d)))


ORACLE["comparison_table"] = f"""
SELECT doc_id, field, coalesce(actual, '—') AS extracted, coalesce(expected, '—') AS expected, CASE WHEN passed THEN 'yes' ELSE 'no' END AS match
FROM ({_scores_sql(False)})"""


@query
def extraction_scores(spark, d):
    """Extracted records of all reports against their gold records."""
    r = reports.records(spark, d)
    extracted = r.select("doc_id", FI.record_json(r).alias("record"))
    return SC.score_documents(SC.compare_fields(gold_json(spark, d), extracted))


ORACLE["extraction_scores"] = """
SELECT c_custkey AS doc_id, CAST(24 AS BIGINT) AS total_fields, CAST(24 AS BIGINT) AS passed, CAST(0 AS BIGINT) AS failed,
       CAST(1 AS DOUBLE) AS pass_rate, true AS meets_threshold FROM customer"""


@query
def record_kpis(spark, d):
    return LE.record_kpis(A.record_rows(gold_records(spark, d)))


_FILLED = " + ".join(f"CAST({f} IS NOT NULL AS BIGINT)" for f in RECORD_FIELDS)

ORACLE["record_kpis"] = f"""
SELECT doc_id, {_FILLED} AS populated, {_FILLED} - CAST(llm_confidence_score IS NOT NULL AS BIGINT) AS extracted, CAST({len(RECORD_FIELDS)} AS BIGINT) AS fields
FROM ({GOLD_SQL})"""


# --- review ------------------------------------------------------------------


def prose_views(spark: SparkSession, d: str) -> DataFrame:
    """Block views of the prose documents."""
    key = ["doc_id", "text_key", "section"]
    resolved = E.resolve_sections(prose.prose_gated(spark, d), T.PROSE_TABLES)
    resolved = stage(resolved, "mentions")
    cands = E.candidates(resolved, T.PROSE_TABLES)
    occ = E.candidate_occurrences(resolved).join(cands.select(*key, "text", "source_models"), key)
    rows = quality.prose_rows(E.of_section(cands, "report_metadata"))
    fields = RV.field_rows(rows.select("doc_id", "field", "block_id", F.lit("verbatim").alias("type")), rows)
    return RV.block_views(prose.prose_blocks(spark, d), prose.prose_profiles(spark, d), occ, fields)


@query
def block_views(spark, d):
    return prose_views(spark, d).select(
        "doc_id", "block_id", "page_number", "ord", "text", "text_role", F.array_join("hints", ",").alias("hints"), "confidence",
        F.array_join(F.transform("entities", lambda e: F.concat_ws("/", e["section"], e["text"], F.array_join(e["source_models"], "+"))), ";").alias("entities"),
        F.array_join(F.transform("fields", lambda f: F.concat_ws("=", f["field"], f["value"])), ";").alias("fields"),
    )


_VIEWS = f"""{quality._ROWS},
occ AS (SELECT h.doc_id, h.block_id, string_agg(h.section || '/' || c.text || '/' || replace(c.source_models, ',', '+'), ';' ORDER BY h.page_number, h.seq, h.section) AS entities,
               to_json(list({{'text': c.text, 'section': h.section, 'models': string_split(c.source_models, ',')}} ORDER BY h.page_number, h.seq, h.section)) AS entity_json
        FROM hinted h JOIN cands c USING (doc_id, text_key, section) WHERE h.block_id IS NOT NULL GROUP BY ALL),
fld AS (SELECT doc_id, block_id, string_agg(concat_ws('=', field, value), ';' ORDER BY field) AS fields,
               to_json(list({{'field': field, 'value': coalesce(value, 'null'), 'type': 'verbatim'}} ORDER BY field)) AS field_json
        FROM rows WHERE block_id IS NOT NULL GROUP BY ALL),
profiles AS (SELECT *, {prose._HINT_SQL} AS hints, CAST({prose._CONF_SQL} AS DOUBLE) AS confidence FROM tagged),
views AS (SELECT * FROM profiles LEFT JOIN occ USING (doc_id, block_id) LEFT JOIN fld USING (doc_id, block_id))"""

ORACLE["block_views"] = f"""{_VIEWS}
SELECT doc_id, block_id, page_number, ord, text, text_role, hints, confidence, coalesce(entities, '') AS entities, coalesce(fields, '') AS fields FROM views"""


@query
def view_payload(spark, d):
    return RV.view_payload(prose_views(spark, d))


ORACLE["view_payload"] = f"""{_VIEWS}
SELECT doc_id, block_id, '{{"block_id":"' || block_id || '","page":' || page_number || ',"role":"' || text_role || '","sections":'
  || to_json(string_split(hints, ',')) || ',"confidence":' || CAST(confidence AS VARCHAR) || ',"rationale":"'
  || CASE WHEN text_role = 'fax_transport_noise' THEN 'Pre-tagged as noise by pattern.' ELSE 'rule: ' || text_role END
  || '","text":' || to_json(text) || ',"entities":' || coalesce(CAST(entity_json AS VARCHAR), '[]') || ',"fields":' || coalesce(CAST(field_json AS VARCHAR), '[]') || '}}' AS payload
FROM views"""


@query
def view_caption(spark, d):
    return RV.view_caption(prose.prose_profiles(spark, d))


ORACLE["view_caption"] = f"""
WITH {S.LINES}, {prose._TAGGED}
SELECT doc_id, count(*) AS blocks, CAST(0 AS BIGINT) AS with_geometry, count(*) FILTER (WHERE contains({prose._HINT_SQL}, ',')) AS multi_section
FROM tagged GROUP BY doc_id"""


@query
def page_roles(spark, d):
    out = RV.page_roles(prose.prose_profiles(spark, d))
    return out.select("doc_id", "page_number", F.array_join("roles", ",").alias("roles"), F.array_join("sections", ",").alias("sections"))


ORACLE["page_roles"] = f"""
WITH {S.LINES}, {prose._TAGGED},
h AS (SELECT *, {prose._HINT_SQL} AS hints FROM tagged)
SELECT doc_id, page_number, array_to_string(list_sort(list(DISTINCT text_role)), ',') AS roles,
       array_to_string(list_sort(list_distinct(flatten(list(string_split(hints, ','))))), ',') AS sections FROM h GROUP BY ALL"""


@query
def conversation_trace(spark, d):
    """Turns as trace entries: even lines are text parts, odd lines carry none."""
    parts = F.transform(
        F.split("text", "\n", -1),
        lambda t, i: F.struct(F.when(i % 2 == 0, F.lit("text")).otherwise(F.lit("tool_use")).alias("type"), F.when(i % 2 == 0, t).alias("text")),
    )
    tools = F.when(F.col("role") == "assistant", F.array(F.lit("pdf_text_search"), F.lit("date_parser"))).otherwise(F.array().cast("array<string>"))
    turns = T.table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", "role", parts.alias("parts"), tools.alias("tools"))
    return RV.conversation_trace(turns)


ORACLE["conversation_trace"] = """
SELECT conv_id AS doc_id, turn AS entry_no, role,
       array_to_string(list_transform(list_filter(range(1, len(p) + 1), lambda i: i % 2 = 1), lambda i: p[i]), '') AS content,
       CASE WHEN role = 'assistant' THEN 'pdf_text_search, date_parser' ELSE '' END AS tools
FROM (SELECT *, string_split(text, chr(10)) AS p FROM conversations)"""
