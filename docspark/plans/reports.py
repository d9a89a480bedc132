"""Queries on reports: records, provenance, identifiers and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.operators import fields as FI
from docspark.operators import ledger as LE
from docspark.operators import noise as N
from docspark.operators import roles as R
from docspark.operators import routing as RO
from docspark.operators import validate as V
from docspark.sources import tables as T
from docspark.sources.reports import GOLD_SQL, report_blocks
from docspark.vocab import NOISE_ROLE, RECORD_FIELDS

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tagged_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Report blocks with their role; noise first, then the report rules."""
    noise = N.is_noise(F.col("text"))
    role = F.when(noise, F.lit(NOISE_ROLE)).otherwise(R.role_of(F.col("text")))
    return report_blocks(spark, d).withColumn("text_role", role)


def records(spark: SparkSession, d: str) -> DataFrame:
    return FI.extract_records(tagged_blocks(spark, d))


@query
def record_fields(spark, d):
    return records(spark, d).drop("provenance")


ORACLE["record_fields"] = GOLD_SQL


@query
def provenance(spark, d):
    return FI.provenance_rows(records(spark, d))


# raw line a field comes from, as SQL over the key; NULL where the value is a count
_LINE = {
    "report_title": "1", "Vendor_Name": "2", "Patient_First_Name": "3", "Patient_Last_Name": "3", "Patient_DOB": "4",
    "Patient_MRN": "5", "Collection_Date": "6", "Received_Date": "7", "Report_Date": "8",
    "Ordering_Provider_First_Name": "prov", "Ordering_Provider_Last_Name": "prov", "Ordering_Provider_Title": "prov",
    "Ordering_Provider_NPI": "11", "Practice_NPI": "0", "Practice_Name": "12", "Practice_Street_Address_1": "13",
    "Practice_Street_Address_2": "13", "Practice_City": "14", "Practice_State": "14", "Practice_ZIP_5digit": "14",
    "Practice_ZIP_4digit": "14", "Test_Name": "15", "Procedure": "16",
}
_DERIVED = (
    "Patient_First_Name", "Patient_Last_Name", "Patient_DOB", "Collection_Date", "Received_Date", "Report_Date",
    "Ordering_Provider_First_Name", "Ordering_Provider_Last_Name", "Practice_State",
)


def _provenance_sql() -> str:
    parts = []
    for f in RECORD_FIELDS:
        if f not in _LINE:
            note = "page count of the document" if f == "total_pages" else "self-assessed; not taken from the source"
            parts.append(f"SELECT doc_id, '{f}' AS field, NULL AS block_id, NULL AS page, 'derived' AS type, '{note}' AS rationale FROM g")
            continue
        kind = "'derived'" if f in _DERIVED else "CASE WHEN doc_id % 5 IN (1, 2) THEN 'inferred' ELSE 'verbatim' END" if f == "Vendor_Name" else "'verbatim'"
        parts.append(
            f"SELECT doc_id, '{f}', CASE WHEN {f} IS NOT NULL THEN doc_id || '-' || {_LINE[f]} END, "
            f"CASE WHEN {f} IS NOT NULL THEN CASE WHEN {_LINE[f]} < 15 THEN 1 ELSE 2 END END, "
            f"CASE WHEN {f} IS NULL THEN 'absent' ELSE {kind} END, "
            f"CASE WHEN {f} IS NULL THEN NULL WHEN {kind} = 'derived' THEN 'normalised from the source text' "
            f"WHEN {kind} = 'inferred' THEN 'inferred from a product marker' END FROM g"
        )
    return (
        f"WITH g AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 10 WHEN doc_id % 3 = 1 THEN 10 ELSE 18 END AS prov FROM ({GOLD_SQL}))"
        f" SELECT doc_id, field, block_id, CAST(page AS BIGINT) AS page, type, rationale FROM ({' UNION ALL '.join(parts)})"
    )


ORACLE["provenance"] = _provenance_sql()


@query
def fabricated_citations(spark, d):
    """Citations of provenance where some block ids were changed."""
    p = FI.provenance_rows(records(spark, d))
    changed = F.when((F.col("doc_id") % 50 == 0) & F.col("block_id").isNotNull(), F.concat("block_id", F.lit("x"))).otherwise(F.col("block_id"))
    return FI.fabricated_citations(p.withColumn("block_id", changed), report_blocks(spark, d)).select("doc_id", "field", "block_id")


ORACLE["fabricated_citations"] = f"""
SELECT doc_id, field, block_id || 'x' AS block_id FROM ({ORACLE["provenance"]}) WHERE doc_id % 50 = 0 AND block_id IS NOT NULL"""


@query
def identifier_audit(spark, d):
    """Ten-digit identifiers made of customer keys, some too short or not numeric."""
    k = F.col("c_custkey")
    npi = F.when(k % 13 == 12, F.concat(k.cast("string"), F.lit("X"))).when(k % 13 == 11, F.lit("")).otherwise(
        F.concat(F.lit(" "), F.lpad((k * 7919 % 10000000000).cast("string"), 10, "1"), F.lit(" "))
    )
    df = T.table(spark, d, "customer").select("c_custkey", npi.alias("npi"))
    return FI.audit_identifiers(df, "npi")


_DIGIT = "CAST(f[{i}] AS INTEGER)"
_LUHN = " + ".join(
    (f"CAST(f[{i}] AS INTEGER)" if (15 - i) % 2 == 0 else f"CASE WHEN CAST(f[{i}] AS INTEGER) > 4 THEN CAST(f[{i}] AS INTEGER) * 2 - 9 ELSE CAST(f[{i}] AS INTEGER) * 2 END")
    for i in range(1, 16)
)

ORACLE["identifier_audit"] = f"""
WITH n AS (SELECT c_custkey, CASE WHEN c_custkey % 13 = 12 THEN c_custkey || 'X' WHEN c_custkey % 13 = 11 THEN ''
             ELSE ' ' || lpad(CAST(c_custkey * 7919 % 10000000000 AS VARCHAR), 10, '1') || ' ' END AS npi FROM customer),
full_id AS (SELECT *, regexp_matches(trim(npi), '^[0-9]{{10}}$') AS ten, '80840' || trim(npi) AS f FROM n),
checked AS (SELECT *, CASE WHEN ten THEN ({_LUHN}) % 10 = 0 ELSE false END AS valid FROM full_id)
SELECT c_custkey, npi, valid, CASE WHEN NOT ten THEN 'Not exactly 10 digits' WHEN valid THEN 'Luhn check passed' ELSE 'Luhn check failed' END AS reason
FROM checked"""


@query
def date_normalise(spark, d):
    """Order dates printed in fifteen ways, some of them no full date, or none at all."""
    t, k = F.col("o_orderdate"), F.col("o_orderkey") % 15
    shapes = {
        0: F.date_format(t, "MM/dd/yyyy"),
        1: F.concat(F.date_format(t, "MM/dd/yyyy"), F.lit(" 01:15:00 PM PDT")),
        2: F.concat(F.date_format(t, "M/d/yyyy"), F.lit(" / M")),
        3: F.date_format(t, "yyyy-MM-dd"),
        4: F.concat(F.lit("on "), F.date_format(t, "MMMM d, yyyy")),
        5: F.date_format(t, "d MMM yyyy"),
        6: F.date_format(t, "MM-dd-yyyy"),
        7: F.date_format(t, "MMMM yyyy"),
        8: F.concat(F.lit("13/"), F.date_format(t, "dd/yyyy")),
        9: F.concat(F.date_format(t, "yyyy-MM-dd"), F.lit("T23:59:59-08:00")),
        10: F.date_format(t, "d-MMM-yyyy"),
        11: F.date_format(t, "MMM. d, yyyy"),
        12: F.date_format(t, "MMMM d yyyy"),
        13: F.date_format(t, "MM/dd/yy"),
        14: F.concat(F.lit("id 5"), F.date_format(t, "yyyy-MM-dd"), F.lit("5")),
    }
    raw = F.coalesce(*[F.when(k == i, s) for i, s in shapes.items()])
    return FI.normalise_dates(T.table(spark, d, "orders").select("o_orderkey", raw.alias("raw")), "raw")


ORACLE["date_normalise"] = """
SELECT o_orderkey, CASE o_orderkey % 15
    WHEN 0 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') || ' 01:15:00 PM PDT'
    WHEN 2 THEN strftime(o_orderdate, '%-m/%-d/%Y') || ' / M' WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 4 THEN 'on ' || strftime(o_orderdate, '%B %-d, %Y') WHEN 5 THEN strftime(o_orderdate, '%-d %b %Y')
    WHEN 6 THEN strftime(o_orderdate, '%m-%d-%Y') WHEN 7 THEN strftime(o_orderdate, '%B %Y')
    WHEN 8 THEN '13/' || strftime(o_orderdate, '%d/%Y') WHEN 9 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T23:59:59-08:00'
    WHEN 10 THEN strftime(o_orderdate, '%-d-%b-%Y') WHEN 11 THEN strftime(o_orderdate, '%b. %-d, %Y')
    WHEN 12 THEN strftime(o_orderdate, '%B %-d %Y') WHEN 13 THEN strftime(o_orderdate, '%m/%d/%y')
    ELSE 'id 5' || strftime(o_orderdate, '%Y-%m-%d') || '5' END AS raw, iso, iso IS NOT NULL AS ok,
  CASE WHEN iso IS NULL THEN CASE o_orderkey % 15 WHEN 8 THEN 'impossible date' ELSE 'no full date' END END AS reason
FROM (SELECT *, CASE o_orderkey % 15 WHEN 7 THEN NULL WHEN 14 THEN NULL
    WHEN 8 THEN CASE WHEN day(o_orderdate) <= 12 THEN strftime(o_orderdate, '%Y-%d-13') END
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders)"""


def report_results(spark: SparkSession, d: str) -> DataFrame:
    """Reports from printed blocks to verdicts: one shuffle, for the record."""
    r = records(spark, d)
    state = r.select(
        "doc_id",
        F.col("llm_confidence_score").alias("confidence"),
        V.envelope_json(FI.record_json(r)).alias("envelope"),
        F.lit("committed").alias("team_verdict"),
        F.lit("").alias("team_reason"),
    )
    kept = ["confidence", "envelope", "team_verdict", "team_reason"]
    cards = V.scorecards(V.check_envelopes(state), keep=kept)
    return RO.route(cards).withColumn(
        "verifier_scorecards", F.array(F.struct("verifier_name", "passed", "n_errors", "notes"))
    )


@query
def report_runs(spark, d):
    """Run rows of all reports, with the record's city where an extraction is stored."""
    city = F.when(LE.is_stored(), F.get_json_object("envelope", "$.report_metadata.Practice_City"))
    results = report_results(spark, d).withColumn("city", city)
    return LE.run_rows(results, LE.Storage("v1", "/ledger"), keep=["city"]).select(
        "doc_id", "run_id", "verdict", "verdict_reason", "verifier_scorecards", "artifacts_gcs_prefix", "city"
    )


ORACLE["report_runs"] = f"""
SELECT doc_id, sha256(doc_id || chr(31) || 'v1' || chr(31) || 'run') AS run_id, CASE WHEN c < 0.85 THEN 'sme_flag' ELSE 'auto_accept' END AS verdict,
  CASE WHEN c < 0.85 THEN 'llm_confidence_score=0.80 is below auto-accept threshold 0.85'
       ELSE 'All verifiers passed and llm_confidence_score (' || CAST(c AS VARCHAR) || ') is at least 0.85' END AS verdict_reason,
  '[{{"verifier_name":"schema_validator","passed":true,"n_errors":0,"notes":"Envelope validated against schema v2."}}]' AS verifier_scorecards,
  '/ledger/artifacts_v1/' || doc_id || '/' AS artifacts_gcs_prefix, CASE WHEN c >= 0.85 THEN Practice_City END AS city
FROM (SELECT *, CAST(llm_confidence_score AS DOUBLE) AS c FROM ({GOLD_SQL}))"""
