"""Queries on record quality: envelopes, validation, audit, routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.operators import audit as A
from docspark.operators import blocks as B
from docspark.operators import fields as FI
from docspark.operators import ledger as LE
from docspark.operators import models as M
from docspark.operators import routing as RO
from docspark.operators import schema as SC
from docspark.operators import validate as V
from docspark.operators import workflow as W
from docspark.plans import prose, sqltext as S
from docspark.sources import tables as T
from docspark.sources.reports import GOLD_SQL, gold_records
from docspark.sources.scratch import stage
from docspark.vocab import ENVELOPE, SECTION_RULES

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- envelopes and validation ------------------------------------------------


def faulty_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Envelopes of customer records with faults chosen by the key."""
    k = F.col("doc_id")
    gold = gold_records(spark, d)
    r = FI.record_json(gold)
    r = (
        F.when(k % 8 == 1, F.regexp_replace(r, '"Practice_City":"[^"]*",', ""))
        .when(k % 8 == 2, F.concat(F.lit('{"Extra_B":1,"Extra_A":null,'), F.substr(r, F.lit(2))))
        .when(k % 8 == 3, F.replace(r, F.lit('"total_pages":2'), F.lit('"total_pages":"2"')))
        .when(k % 8 == 4, F.replace(r, F.lit('"total_pages":2'), F.lit('"total_pages":0')))
        .when(k % 8 == 5, F.regexp_replace(r, '"Practice_ZIP_5digit":"[0-9]*"', '"Practice_ZIP_5digit":"9256"'))
        .when(k % 8 == 6, F.regexp_replace(r, '"llm_confidence_score":[0-9.]*', '"llm_confidence_score":1.5'))
        .when(k % 8 == 7, F.regexp_replace(F.replace(r, F.lit('"total_pages":2'), F.lit('"total_pages":null')), '"Patient_DOB":"[^"]*"', '"Patient_DOB":19.5'))
        .otherwise(r)
    )
    variants = F.when(
        k % 10 == 3,
        F.lit('{"count_of_Genomic_Variants":2,"llm_confidence_score":0.5,"Genomic_Variants":[{"page_number":0,"gene_studied":"JAK2"},7]}'),
    )
    panel = F.when(
        k % 10 == 4,
        F.lit('{"count_of_tested_biomarkers":-1,"page_numbers":[1,0,"x"],"llm_confidence_score":null,"tested_biomarkers":["A","B","A",3]}'),
    )
    env = V.envelope_json(r, Genomic_Variant_umbrella=variants, tested_biomarker_umbrella=panel)
    cut = F.when(k % 101 == 100, F.left(env, F.length(env) - 1)).otherwise(env)
    return gold.select("doc_id", cut.alias("envelope"))


@query
def envelopes(spark, d):
    """Envelopes of the records that are complete, as they are stored."""
    r = gold_records(spark, d)
    return r.select("doc_id", V.envelope_json(FI.record_json(r)).alias("envelope")).select(
        "doc_id",
        F.get_json_object("envelope", "$.count_of_extracted_objects").cast("bigint").alias("objects"),
        F.get_json_object("envelope", "$.report_metadata.Practice_City").alias("city"),
        F.get_json_object("envelope", "$.report_metadata.Practice_NPI").alias("practice_npi"),
        F.get_json_object("envelope", "$.tested_biomarker_umbrella.tested_biomarkers").alias("panel"),
        F.array_join(F.json_object_keys("envelope"), ",").alias("sections"),
        F.array_join(F.json_object_keys(F.get_json_object("envelope", "$.report_metadata")), ",").alias("fields"),
    )


_FIELDS = ",".join(r.field for r in SECTION_RULES["report_metadata"] if r.required)

ORACLE["envelopes"] = f"""
SELECT doc_id, CAST(0 AS BIGINT) AS objects, Practice_City AS city, Practice_NPI AS practice_npi, '[]' AS panel,
       'count_of_extracted_objects,report_metadata,Genomic_Variant_umbrella,other_molecular_biomarker_umbrella,tested_biomarker_umbrella' AS sections,
       '{_FIELDS}' AS fields FROM ({GOLD_SQL})"""


def checked(spark, d) -> DataFrame:
    return V.check_envelopes(faulty_envelopes(spark, d), schema=SC.compile_schema(SC.json_schema(ENVELOPE)))


@query
def validate_records(spark, d):
    return V.violation_rows(checked(spark, d)).select("doc_id", "section", F.array_join("loc", ".").alias("loc"), "rule", "msg")


@query
def field_catalogue(spark, d):
    """The declared fields of all sections, and how many of the stored envelopes hold and fill each."""
    return SC.field_use(faulty_envelopes(spark, d), ENVELOPE).drop("description")


def _catalogue_sql() -> str:
    whole = "doc_id % 101 <> 100"
    held_if = {"Practice_City": f"{whole} AND doc_id % 8 <> 1", "provenance": "false"}
    text = lambda v: S.text(v) if v else "CAST(NULL AS VARCHAR)"
    rows = []
    for section, rules in SECTION_RULES.items():
        for i, r in enumerate(rules):
            held = filled = whole
            if section == "report_metadata":
                held = held_if.get(r.field, whole)
                filled = f"{held} AND {r.field} IS NOT NULL" if r.required else held
                filled += " AND doc_id % 8 <> 7" if r.field == "total_pages" else ""
            elif r.field == "llm_confidence_score":
                filled = f"{whole} AND doc_id % 10 = 3" if section == "Genomic_Variant_umbrella" else "false"
            rows.append(
                f"SELECT '{section}' AS section, CAST({i} AS BIGINT) AS no, '{r.field}' AS field, '{' or '.join(r.types)}' AS type, {str(r.required).lower()} AS required,"
                f" {text(r.mode)} AS mode, {text(r.format)} AS format, {text(r.pattern)} AS pattern, count(*) FILTER (WHERE {held}) AS held,"
                f" count(*) FILTER (WHERE {filled}) AS filled FROM gold"
            )
    return f"WITH gold AS ({GOLD_SQL}) " + " UNION ALL ".join(rows)


ORACLE["field_catalogue"] = _catalogue_sql()


# --- a second schema: nested objects, references, unions, choices ------------

ORDER_SCHEMA = """{
  "type": "object", "required": ["version", "order"],
  "$defs": {
    "key": {"type": "integer", "minimum": 1},
    "customer": {"type": "object", "additionalProperties": false, "required": ["key"],
                 "properties": {"key": {"$ref": "#/$defs/key"}, "contact": {"type": "object", "required": ["phone"],
                                "properties": {"phone": {"type": "string", "pattern": "^[0-9-]+$"}}}}}},
  "properties": {
    "version": {"const": 1},
    "order": {
      "type": "object", "additionalProperties": false, "required": ["id", "status", "placed", "customer"],
      "properties": {
        "id": {"$ref": "#/$defs/key"},
        "status": {"type": "string", "enum": ["F", "O", "P"]},
        "placed": {"type": "string", "format": "date"},
        "customer": {"anyOf": [{"$ref": "#/$defs/customer"}, {"type": "null"}]},
        "parties": {"type": "array", "items": {"type": "object", "required": ["role"],
                    "properties": {"role": {"type": "string", "enum": ["buyer", "it's me"]}}}}}}}}"""


def order_records(spark: SparkSession, d: str) -> DataFrame:
    """Orders as nested JSON records, with faults chosen by the key."""
    k = F.col("o_orderkey") % 12
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    pick = lambda n, bad, good: F.when(k == n, bad).otherwise(good)
    contact = text('"contact":{"more":1,"phone":"', pick(11, F.lit("none"), F.lit("555-0100")), '"}')
    key = pick(2, F.lit("0"), F.col("o_custkey").cast("string"))
    customer = text('{"key":', key, pick(3, F.lit(',"zip":null'), F.lit("")), ",", contact, "}")
    customer = F.when(k == 7, F.lit('"none"')).when(k == 9, F.lit("null")).otherwise(customer)
    return T.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        text(
            '{"version":', pick(5, F.lit("2"), F.lit("1")), pick(10, F.lit(',"note":"x"'), F.lit("")),
            ',"order":{"id":', F.col("o_orderkey").cast("string"),
            ',"status":"', pick(1, F.lit("X"), F.lit("O")),
            '","placed":"', pick(4, F.lit("1995-02-30"), F.lit("1995-02-28")), '"',
            pick(6, F.lit(""), text(',"customer":', customer)),
            ',"parties":[{"role":"it\'s me","since":1},', pick(8, F.lit('{"role":"spy"}'), F.lit('{"role":"buyer"}')), "]}}",
        ).alias("envelope"),
    )


@query
def schema_file_checks(spark, d):
    """Nested records checked by the rules of a second JSON Schema."""
    found = V.check_envelopes(order_records(spark, d), check_dates=True, schema=SC.compile_schema(ORDER_SCHEMA))
    return V.violation_rows(found).select("doc_id", "section", F.array_join("loc", ".").alias("loc"), "rule", "msg")


_ORDER_FAULTS = (
    (1, "order", "status", "enum", 'not one of "F", "O", "P"'),
    (2, "order", "customer.key", "minimum", "less than 1.0"),
    (3, "order", "customer.zip", "additionalProperties", "unknown field"),
    (4, "order", "placed", "format", "not an ISO date"),
    (5, "<root>", "version", "enum", "not one of 1"),
    (6, "order", "customer", "required", "field required"),
    (7, "order", "customer", "type", "expected object or null, got string"),
    (8, "order", "parties.1.role", "enum", 'not one of "buyer", "it\'s me"'),
    (11, "order", "customer.contact.phone", "pattern", "does not match ^[0-9-]+$"),
)

ORACLE["schema_file_checks"] = " UNION ALL ".join(
    f"SELECT o_orderkey AS doc_id, '{section}' AS section, '{loc}' AS loc, '{rule}' AS rule, {S.text(msg)} AS msg FROM orders WHERE o_orderkey % 12 = {n}"
    for n, section, loc, rule, msg in _ORDER_FAULTS
) + """
UNION ALL SELECT o_orderkey, 'order', 'id', 'minimum', 'less than 1.0' FROM orders WHERE o_orderkey < 1
UNION ALL SELECT o_orderkey, 'order', 'customer.key', 'minimum', 'less than 1.0' FROM orders WHERE o_custkey < 1 AND o_orderkey % 12 NOT IN (2, 6, 7, 9)"""


def _load_answerer():
    """A model's stand-in: the prompt is the record; some first answers are wrong, some stay wrong, and it fails on some prompts."""

    def model(rows):
        answers = []
        for key, prompt in zip(rows["doc_id"], rows["prompt"]):
            record, _, again = prompt.partition("\n\n")
            if not again and key % 11 == 4:
                raise TimeoutError("no reply")
            if key % 7 == 3:
                record = record.replace('"total_pages":2', '"total_pages":"2"')
            elif not again and key % 5 == 1:
                record = "I found no record."
            elif not again and key % 5 == 2:
                record = record.replace('"total_pages":2', '"total_pages":0')
            answers.append(f"Here it is:\n```json\n{record}\n```" if key % 2 else record)
        return rows[["doc_id"]].assign(answer=answers)

    return model


@query
def model_answers(spark, d):
    """Records by a model, checked, asked for once more with what was wrong, or set apart."""
    gold = gold_records(spark, d)
    prompts = gold.select("doc_id", FI.record_json(gold).alias("prompt"))
    found = M.checked_answers(prompts, _load_answerer)
    return found.select(
        "doc_id",
        "outcome",
        "tries",
        F.get_json_object("record", "$.Practice_City").alias("city"),
        F.get_json_object("record", "$.total_pages").alias("total_pages"),
        F.array_join("problems", "; ").alias("problems"),
    )


ORACLE["model_answers"] = f"""
SELECT doc_id, CASE WHEN bad THEN 'quarantined' WHEN late THEN 'corrected' ELSE 'accepted' END AS outcome,
       CAST(CASE WHEN bad OR late THEN 2 ELSE 1 END AS BIGINT) AS tries, CASE WHEN NOT bad THEN Practice_City END AS city,
       CASE WHEN NOT bad THEN '2' END AS total_pages, CASE WHEN bad THEN 'total_pages: expected integer, got string' ELSE '' END AS problems
FROM (SELECT *, doc_id % 7 = 3 AS bad, doc_id % 11 = 4 OR doc_id % 5 IN (1, 2) AS late FROM ({GOLD_SQL}))"""


def _violations_sql() -> str:
    k, live = "c_custkey", "c_custkey % 101 <> 100"
    rows: list[tuple[str, str, str, str, str]] = [
        (f"{k} % 8 = 1", "report_metadata", "Practice_City", "required", "field required"),
        (f"{k} % 8 = 2", "report_metadata", "Extra_A", "additionalProperties", "unknown field"),
        (f"{k} % 8 = 2", "report_metadata", "Extra_B", "additionalProperties", "unknown field"),
        (f"{k} % 8 = 3", "report_metadata", "total_pages", "type", "expected integer, got string"),
        (f"{k} % 8 = 4", "report_metadata", "total_pages", "minimum", "less than 1.0"),
        (f"{k} % 8 = 5", "report_metadata", "Practice_ZIP_5digit", "pattern", "does not match ^[0-9]{5}$"),
        (f"{k} % 8 = 6", "report_metadata", "llm_confidence_score", "maximum", "greater than 1.0"),
        (f"{k} % 8 = 7", "report_metadata", "total_pages", "type", "expected integer, got null"),
        (f"{k} % 8 = 7", "report_metadata", "Patient_DOB", "type", "expected string or null, got number"),
        (f"{k} % 10 = 4", "tested_biomarker_umbrella", "count_of_tested_biomarkers", "minimum", "less than 0.0"),
        (f"{k} % 10 = 4", "tested_biomarker_umbrella", "tested_biomarkers", "uniqueItems", "has repeated items"),
        (f"{k} % 10 = 4", "tested_biomarker_umbrella", "page_numbers.1", "minimum", "less than 1.0"),
        (f"{k} % 10 = 4", "tested_biomarker_umbrella", "page_numbers.2", "type", "expected integer"),
        (f"{k} % 10 = 4", "tested_biomarker_umbrella", "tested_biomarkers.3", "type", "expected string"),
        (f"{k} % 10 = 3", "Genomic_Variant_umbrella", "Genomic_Variants.0.page_number", "minimum", "less than 1.0"),
        (f"{k} % 10 = 3", "Genomic_Variant_umbrella", "Genomic_Variants.1", "type", "expected object"),
    ]
    item = SECTION_RULES["Genomic_Variant_umbrella"][2].items
    rows += [
        (f"{k} % 10 = 3", "Genomic_Variant_umbrella", f"Genomic_Variants.0.{r.field}", "required", "field required")
        for r in item
        if r.field not in ("page_number", "gene_studied")
    ]
    parts = [
        f"SELECT {k} AS doc_id, '{s}' AS section, '{loc}' AS loc, '{rule}' AS rule, '{m}' AS msg FROM customer WHERE {c} AND {live}"
        for c, s, loc, rule, m in rows
    ]
    parts.append(f"SELECT {k}, '<root>', '', 'type', 'not a JSON object' FROM customer WHERE {k} % 101 = 100")
    return " UNION ALL ".join(parts)


ORACLE["validate_records"] = _violations_sql()


@query
def envelope_counts(spark, d):
    return LE.envelope_counts(faulty_envelopes(spark, d)).drop("envelope")


ORACLE["envelope_counts"] = """
SELECT c_custkey AS doc_id, CAST(CASE WHEN c_custkey % 10 = 3 AND c_custkey % 101 <> 100 THEN 2 ELSE 0 END AS BIGINT) AS variants,
       CAST(0 AS BIGINT) AS biomarkers, CAST(CASE WHEN c_custkey % 10 = 4 AND c_custkey % 101 <> 100 THEN -1 ELSE 0 END AS BIGINT) AS tested FROM customer"""


@query
def scorecards(spark, d):
    k = F.col("doc_id")
    flagged = checked(spark, d).withColumn("team_verdict", F.when(k % 20 == 4, F.lit("sme_flag")).otherwise(F.lit("committed"))).withColumn(
        "team_reason", F.lit("no hints")
    )
    return V.scorecards(flagged).select("doc_id", "verifier_name", "passed", F.size("field_errors").alias("listed"), "n_errors", "notes")


ORACLE["scorecards"] = f"""
WITH v AS (SELECT doc_id, count(*) AS n FROM ({_violations_sql()}) GROUP BY doc_id),
s AS (SELECT c_custkey AS doc_id, coalesce(n, 0) AS n, c_custkey % 20 = 4 AS flag FROM customer LEFT JOIN v ON doc_id = c_custkey)
SELECT doc_id, 'schema_validator' AS verifier_name, flag OR n = 0 AS passed, CASE WHEN flag THEN 0 ELSE n END AS listed,
  CASE WHEN flag THEN 0 ELSE n END AS n_errors,
  CASE WHEN flag THEN 'Skipped detailed validation: team emitted sme_flag: no hints'
       WHEN n = 0 THEN 'Envelope validated against schema v2.'
       ELSE n || ' validation error(s); first: ' || CASE
         WHEN doc_id % 101 = 100 THEN '<root>.: not a JSON object'
         WHEN doc_id % 8 = 1 THEN 'report_metadata.Practice_City: field required'
         WHEN doc_id % 8 = 2 THEN 'report_metadata.Extra_A: unknown field'
         WHEN doc_id % 8 = 3 THEN 'report_metadata.total_pages: expected integer, got string'
         WHEN doc_id % 8 = 4 THEN 'report_metadata.total_pages: less than 1.0'
         WHEN doc_id % 8 = 5 THEN 'report_metadata.Practice_ZIP_5digit: does not match ^[0-9]{{5}}$'
         WHEN doc_id % 8 = 6 THEN 'report_metadata.llm_confidence_score: greater than 1.0'
         WHEN doc_id % 8 = 7 THEN 'report_metadata.total_pages: expected integer, got null'
         WHEN doc_id % 10 = 3 THEN 'Genomic_Variant_umbrella.Genomic_Variants.0.page_number: less than 1.0'
         ELSE 'tested_biomarker_umbrella.count_of_tested_biomarkers: less than 0.0' END END AS notes
FROM s"""


@query
def section_checks(spark, d):
    """Event props as candidates for sections, one of them unknown."""
    k = F.col("event_id")
    section = F.when(k % 3 == 0, F.lit("report_metadata")).when(k % 3 == 1, F.lit("other_molecular_biomarker_umbrella")).otherwise(F.lit("summary"))
    empty = F.lit('{"count":0,"llm_confidence_score":null,"other_molecular_biomarkers":[]}')
    candidate = F.when(k % 6 == 1, empty).otherwise(F.col("props"))
    df = T.table(spark, d, "events").select("event_id", section.alias("section"), candidate.alias("candidate"))
    return V.check_sections(df).select("event_id", "section", "ok", F.size("errors").alias("errors"), F.array_distinct(F.transform("errors", lambda e: e["rule"])).alias("r")).select(
        "event_id", "section", "ok", "errors", F.array_join("r", ",").alias("rules")
    )


ORACLE["section_checks"] = """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'report_metadata' WHEN 1 THEN 'other_molecular_biomarker_umbrella' ELSE 'summary' END AS section,
       event_id % 6 = 1 AS ok, CAST(CASE WHEN event_id % 3 = 0 THEN 26 WHEN event_id % 6 = 1 THEN 0 WHEN event_id % 3 = 1 THEN 4 ELSE 1 END AS BIGINT) AS errors,
       CASE WHEN event_id % 6 = 1 THEN '' WHEN event_id % 3 = 2 THEN 'section' ELSE 'required,additionalProperties' END AS rules FROM events"""


@query
def answer_records(spark, d):
    """JSON records out of model-like answers: bare, fenced, wrapped in prose, broken."""
    k = F.col("doc_id")
    body = F.concat(F.lit('{"id": '), k.cast("string"), F.lit(', "tags": ["a", "b"]}'))
    answer = (
        F.when(k % 4 == 0, body)
        .when(k % 4 == 1, F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```\n")))
        .when(k % 4 == 2, F.concat(F.lit("The record is "), body, F.lit(" as asked.")))
        .otherwise(F.concat(F.lit("{"), body))
    )
    answers = T.table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id")).select("doc_id", answer.alias("answer"))
    return FI.parse_answers(answers).select("doc_id", "record", F.array_join(F.json_object_keys("record"), ",").alias("keys"))


ORACLE["answer_records"] = """
SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 4 <> 3 THEN '{"id": ' || c_custkey || ', "tags": ["a", "b"]}' END AS record,
       CASE WHEN c_custkey % 4 <> 3 THEN 'id,tags' END AS keys FROM customer"""


# --- audit -------------------------------------------------------------------


def _checklist(spark, d) -> DataFrame:
    """Record candidates, written once: the audit reads them several times."""
    cands = prose.candidates_of(T.documents(spark, d), "report_metadata")
    return stage(cands.select("doc_id", "text_key", "text", "field_hint", "evidence_block"), "checklist")


def prose_rows(cands: DataFrame) -> DataFrame:
    """Record rows of prose documents: the first candidate per hinted field.

    With faults by document: some fields were not extracted, some values are
    not what the block says.
    """
    k = F.col("doc_id")
    best = (
        cands.filter(F.col("field_hint").isNotNull())
        .groupBy("doc_id", F.col("field_hint").alias("field"))
        .agg(F.min(F.struct("text_key", "text", "evidence_block")).alias("c"))
    )
    value = (
        F.when((k % 3 == 0) & (F.col("field") == "Practice_Name"), F.lit(None).cast("string"))
        .when((k % 5 == 0) & (F.col("field") == "Report_Date"), F.concat("c.text", F.lit("zz")))
        .otherwise(F.col("c.text"))
    )
    return best.select("doc_id", "field", value.alias("value"), F.col("c.evidence_block").alias("block_id"))


_ROWS = f"""{prose._FOLD},
checklist AS (SELECT c.*, arg_min(h.block_id, h.place) AS evidence_block FROM cands c JOIN hinted h USING (doc_id, text_key, section)
              WHERE c.section = 'report_metadata' GROUP BY ALL),
offers AS (SELECT doc_id, field_hint AS field, arg_min(text, text_key) AS text, arg_min(evidence_block, text_key) AS evidence_block
           FROM checklist WHERE field_hint IS NOT NULL GROUP BY ALL),
rows AS (SELECT doc_id, field, CASE WHEN doc_id % 3 = 0 AND field = 'Practice_Name' THEN NULL
                                    WHEN doc_id % 5 = 0 AND field = 'Report_Date' THEN text || 'zz' ELSE text END AS value,
                evidence_block AS block_id FROM offers),
missed AS (SELECT doc_id, field, text AS source_value, evidence_block FROM offers
           WHERE (doc_id, field) NOT IN (SELECT (doc_id, field) FROM rows WHERE value IS NOT NULL)),
spurious AS (SELECT r.doc_id, r.field, r.value, r.block_id FROM rows r LEFT JOIN lines l USING (doc_id, block_id)
             WHERE r.value IS NOT NULL AND NOT coalesce(contains({S.key("l.text")}, {S.key("r.value")}), false)),
misses AS (SELECT * FROM checklist WHERE (doc_id, text_key) NOT IN (SELECT (doc_id, {S.key("value")}) FROM rows WHERE value IS NOT NULL))"""


@query
def missed_fields(spark, d):
    cands = _checklist(spark, d)
    return A.missed_fields(cands, prose_rows(cands))


ORACLE["missed_fields"] = f"{_ROWS} SELECT doc_id, field, source_value, evidence_block FROM missed"


@query
def spurious_fields(spark, d):
    return A.spurious_fields(prose_rows(_checklist(spark, d)), prose.prose_blocks(spark, d))


ORACLE["spurious_fields"] = f"{_ROWS} SELECT doc_id, field, value, block_id FROM spurious"


@query
def checklist_misses(spark, d):
    cands = _checklist(spark, d)
    return A.checklist_misses(cands, prose_rows(cands)).select("doc_id", "text", "field_hint")


ORACLE["checklist_misses"] = f"{_ROWS} SELECT doc_id, text, field_hint FROM misses"


def prose_audit(spark, d, cands: DataFrame | None = None) -> DataFrame:
    cands = _checklist(spark, d) if cands is None else cands
    return A.audit(T.documents(spark, d), cands, prose_rows(cands), prose.prose_blocks(spark, d))


@query
def coverage_gap(spark, d):
    return prose_audit(spark, d)


_AUDIT = f"""{_ROWS},
counts AS (SELECT doc_id, (SELECT count(*) FROM checklist c WHERE c.doc_id = d.doc_id) AS candidates,
  (SELECT count(value) FROM rows c WHERE c.doc_id = d.doc_id) AS extracted,
  (SELECT count(evidence_block) FROM missed c WHERE c.doc_id = d.doc_id) AS missed,
  (SELECT count(*) - count(evidence_block) FROM missed c WHERE c.doc_id = d.doc_id) AS vague,
  (SELECT count(*) FROM spurious c WHERE c.doc_id = d.doc_id) AS spurious,
  (SELECT count(*) FROM misses c WHERE c.doc_id = d.doc_id) AS checklist_misses FROM documents d),
audits AS (SELECT *, missed + vague + checklist_misses = 0 AS coverage_ok,
                  (candidates - extracted) / greatest(candidates, 1) > 0.1 AS gap_signal FROM counts)"""

ORACLE["coverage_gap"] = f"{_AUDIT} SELECT * FROM audits"


@query
def audit_policy(spark, d):
    return A.choose_policy(prose_audit(spark, d)).select("doc_id", "conflict", "policy")


_POLICY = f"""{_AUDIT},
policies AS (SELECT *, NOT coverage_ok OR gap_signal AS conflict,
  CASE WHEN coverage_ok AND NOT gap_signal THEN NULL WHEN missed > 0 AND vague = 0 THEN 'RE_EXTRACT' WHEN spurious > 0 THEN 'RE_EXTRACT'
       WHEN gap_signal AND missed + vague = 0 AND extracted = 0 THEN 'INVOKE_VMAW' WHEN vague > 0 THEN 'INVOKE_VMAW'
       ELSE 'ACCEPT_EXTRACTOR' END AS policy FROM audits)"""

ORACLE["audit_policy"] = f"{_POLICY} SELECT doc_id, conflict, policy FROM policies"


def prose_verdicts(spark, d, cands: DataFrame | None = None) -> DataFrame:
    """Team verdicts; documents with an id divisible by 15 lost their hints."""
    policies = A.choose_policy(prose_audit(spark, d, cands))
    hints = F.when(F.col("doc_id") % 15 == 0, F.lit(0)).otherwise(F.col("missed") + F.col("spurious"))
    reasoning = F.concat(F.lit("missed="), F.col("missed").cast("string"))
    return A.team_verdicts(policies.withColumn("hints", hints).withColumn("reasoning", reasoning))


@query
def team_verdict(spark, d):
    return prose_verdicts(spark, d)


_VERDICT = f"""{_POLICY},
hinted_policies AS (SELECT *, CASE WHEN doc_id % 15 = 0 THEN 0 ELSE missed + spurious END AS hints FROM policies),
verdicts AS (SELECT doc_id, policy,
  CASE WHEN conflict AND (policy = 'INVOKE_VMAW' OR policy = 'RE_EXTRACT' AND hints = 0) THEN 'sme_flag' ELSE 'committed' END AS team_verdict,
  CASE WHEN NOT conflict THEN 'Coverage audit found no conflict and no gap; committed the extracted record.'
       WHEN policy = 'ACCEPT_EXTRACTOR' THEN 'Policy ACCEPT_EXTRACTOR: missed=' || missed
       WHEN policy = 'INVOKE_VMAW' THEN 'Policy INVOKE_VMAW is not available; flagging to review. missed=' || missed
       WHEN hints = 0 THEN 'Policy RE_EXTRACT without hints cannot guide a retry; flagging to review.'
       ELSE 'Policy RE_EXTRACT with ' || hints || ' hint(s); second extraction committed. missed=' || missed END AS team_reason,
  conflict AND coalesce(policy = 'RE_EXTRACT', false) AND hints > 0 AS rerun FROM hinted_policies)"""

ORACLE["team_verdict"] = f"{_VERDICT} SELECT * FROM verdicts"


@query
def reextract_hints(spark, d):
    cands = _checklist(spark, d)
    rows = prose_rows(cands)
    return A.reextract_hints(A.missed_fields(cands, rows), A.spurious_fields(rows, prose.prose_blocks(spark, d)))


ORACLE["reextract_hints"] = f"""{_ROWS}
SELECT doc_id, field AS field_name, 'look at block ' || coalesce(evidence_block, '?') || ' for ' || source_value AS hint FROM missed
UNION ALL SELECT doc_id, field, 'not found in cited block ' || coalesce(block_id, '?') || ': ' || value FROM spurious"""


def hinted_rows(cands: DataFrame) -> DataFrame:
    """Record rows of a second extraction, which takes the hinted values."""
    best = cands.filter(F.col("field_hint").isNotNull()).groupBy("doc_id", F.col("field_hint").alias("field")).agg(
        F.min(F.struct("text_key", "text", "evidence_block")).alias("c")
    )
    return best.select("doc_id", "field", F.col("c.text").alias("value"), F.col("c.evidence_block").alias("block_id"))


@query
def reextracted_rows(spark, d):
    """Records after the one re-extraction round."""
    cands = _checklist(spark, d)

    def second_pass(again: DataFrame) -> DataFrame:
        return hinted_rows(cands.join(again, "doc_id", "left_semi"))

    return A.reextract_once(prose_rows(cands), prose_verdicts(spark, d, cands), second_pass)


ORACLE["reextracted_rows"] = f"""{_VERDICT}
SELECT r.doc_id, r.field, CASE WHEN v.rerun THEN o.text ELSE r.value END AS value, r.block_id
FROM rows r JOIN offers o USING (doc_id, field) JOIN verdicts v USING (doc_id)"""


# --- the whole plan ----------------------------------------------------------

PROSE_PLAN = W.Plan(
    checklist=lambda docs: prose.candidates_of(docs, "report_metadata"),
    first_pass=prose_rows,
    second_pass=hinted_rows,
    blocks=B.blocks_from_text,
    total_pages="greatest(1, ceil(size(split(text, '\n', -1)) / 5))",
    hints="CASE WHEN doc_id % 15 = 0 THEN 0 ELSE missed + spurious END",
    confidence="CASE WHEN policy <=> 'RE_EXTRACT' AND hints > 0 THEN 0.9 ELSE greatest(0, 90 - 5 * (missed + spurious)) / 100 END",
    check_dates=True,
)


def prose_results(docs: DataFrame) -> DataFrame:
    """Prose documents from text to verdict; as everywhere here, those with an id divisible by 15 lost their hints."""
    return W.process(docs, PROSE_PLAN)


def result_columns(df: DataFrame) -> DataFrame:
    member = lambda name: F.get_json_object("envelope", f"$.report_metadata.{name}")
    return df.select(
        "*", member("Practice_Name").alias("practice"), member("Patient_Last_Name").alias("last_name"), member("total_pages").alias("pages")
    ).drop("envelope")


@query
def document_results(spark, d):
    """Every document through checklist, record, audit, policy, second extraction, check and route."""
    found = result_columns(prose_results(T.documents(spark, d)))
    return found.withColumn("verifier_scorecards", F.to_json("verifier_scorecards"))


_RESULTS = f"""{_VERDICT},
final AS (SELECT r.doc_id, max(CASE WHEN v.rerun THEN o.text ELSE r.value END) FILTER (WHERE field = 'Practice_Name') AS practice,
                 max(CASE WHEN v.rerun THEN o.text ELSE r.value END) FILTER (WHERE field = 'Patient_Last_Name') AS last_name,
                 max(CASE WHEN v.rerun THEN o.text ELSE r.value END) FILTER (WHERE field = 'Report_Date') IS NOT NULL AS undated
          FROM rows r JOIN offers o USING (doc_id, field) JOIN verdicts v USING (doc_id) GROUP BY r.doc_id),
state AS (SELECT v.*, practice, last_name, team_verdict = 'sme_flag' AS flag, coalesce(undated, false) AND team_verdict <> 'sme_flag' AS failed,
                 CASE WHEN rerun THEN 0.9 ELSE CAST(greatest(0, 90 - 5 * (missed + spurious)) AS DOUBLE) / 100 END AS confidence,
                 CAST((len(string_split(d.text, chr(10))) - 1) // 5 + 1 AS VARCHAR) AS pages
          FROM verdicts v JOIN audits USING (doc_id) JOIN documents d USING (doc_id) LEFT JOIN final USING (doc_id)),
checked_state AS (SELECT *, CASE WHEN flag THEN 'Skipped detailed validation: team emitted sme_flag: ' || team_reason
                         WHEN failed THEN '1 validation error(s); first: report_metadata.Report_Date: not an ISO date'
                         ELSE 'Envelope validated against schema v2.' END AS notes FROM state),
results AS (SELECT doc_id, policy, team_verdict, team_reason, confidence, practice, last_name, pages,
  '[{{"verifier_name":"schema_validator","passed":' || (NOT failed) || ',"n_errors":' || CASE WHEN failed THEN 1 ELSE 0 END || ',"notes":"' || notes || '"}}]'
    AS verifier_scorecards,
  CASE WHEN flag OR failed OR confidence < 0.85 THEN 'sme_flag' ELSE 'auto_accept' END AS verdict,
  CASE WHEN flag THEN 'Team emitted sme_flag: ' || team_reason
       WHEN failed THEN 'Verifier ''schema_validator'' failed with 1 error(s): ' || notes
       WHEN confidence < 0.85 THEN 'llm_confidence_score=' || format('{{:.2f}}', confidence) || ' is below auto-accept threshold 0.85'
       ELSE 'All verifiers passed and llm_confidence_score (' || CAST(confidence AS DOUBLE) || ') is at least 0.85' END AS verdict_reason
  FROM checked_state)"""

ORACLE["document_results"] = f"{_RESULTS} SELECT * FROM results"


# --- routing -----------------------------------------------------------------


@query
def route_verdicts(spark, d):
    """Documents routed by their labels: toxic flags, low quality fails, id gives confidence."""
    labels = T.table(spark, d, "labels").select("doc_id", "quality", "toxic")
    docs = T.table(spark, d, "documents").select("doc_id").join(labels, "doc_id", "left")
    state = docs.select(
        "doc_id",
        F.when(F.col("toxic") == 1, F.lit("sme_flag")).otherwise(F.lit("committed")).alias("team_verdict"),
        F.when(F.col("doc_id") % 2 == 0, F.lit("labelled toxic")).otherwise(F.lit("")).alias("team_reason"),
        F.lit("schema_validator").alias("verifier_name"),
        (F.coalesce("quality", F.lit(1)) == 1).alias("passed"),
        F.when(F.col("quality") == 0, F.lit(2)).otherwise(F.lit(0)).alias("n_errors"),
        F.lit("labelled low quality").alias("notes"),
        F.when(F.col("quality").isNotNull(), (F.col("doc_id") % 100) / 100).alias("confidence"),
    )
    return RO.route(state).select("doc_id", "verdict", "verdict_reason", "confidence_missing")


ORACLE["route_verdicts"] = """
WITH s AS (SELECT d.doc_id, coalesce(toxic = 1, false) AS flag, coalesce(quality, 1) = 0 AS failed,
                  CASE WHEN quality IS NOT NULL THEN (d.doc_id % 100) / 100 END AS c
           FROM documents d LEFT JOIN labels USING (doc_id))
SELECT doc_id, CASE WHEN flag OR failed OR coalesce(c < 0.85, false) THEN 'sme_flag' ELSE 'auto_accept' END AS verdict,
  CASE WHEN flag THEN 'Team emitted sme_flag: ' || CASE WHEN doc_id % 2 = 0 THEN 'labelled toxic' ELSE '(no reason)' END
       WHEN failed THEN 'Verifier ''schema_validator'' failed with 2 error(s): labelled low quality'
       WHEN c < 0.85 THEN 'llm_confidence_score=' || format('{:.2f}', c) || ' is below auto-accept threshold 0.85'
       ELSE 'All verifiers passed and llm_confidence_score (' || coalesce(CAST(CAST(c AS DOUBLE) AS VARCHAR), '<absent>') || ') is at least 0.85' END AS verdict_reason,
  c IS NULL AS confidence_missing FROM s"""
