import json

from pyspark.sql import functions as F

from docspark.operators import audit as A
from docspark.operators import fields as FI
from docspark.operators import routing as RO
from docspark.operators import score as SC
from docspark.operators import validate as V
from docspark.vocab import RECORD_FIELDS, SECTION_RULES


def record(**changes):
    base = {f: None for f in RECORD_FIELDS}
    base.update(total_pages=2, report_title="Final Report", llm_confidence_score=0.9, Patient_DOB="1950-03-09", Practice_ZIP_5digit="40011", Practice_City="Eastmere")
    base.update(changes)
    return base


def envelope(rec, **sections):
    env = {
        "count_of_extracted_objects": 0,
        "report_metadata": rec,
        "Genomic_Variant_umbrella": {"count_of_Genomic_Variants": 0, "llm_confidence_score": None, "Genomic_Variants": []},
        "other_molecular_biomarker_umbrella": {"count": 0, "llm_confidence_score": None, "other_molecular_biomarkers": []},
        "tested_biomarker_umbrella": {"count_of_tested_biomarkers": 0, "page_numbers": [], "llm_confidence_score": None, "tested_biomarkers": []},
    }
    env.update(sections)
    return env


def breaches(spark, env, **kw):
    text = env if isinstance(env, str) else json.dumps(env)
    df = V.check_envelopes(spark.createDataFrame([("d", text)], "doc_id string, envelope string"), **kw)
    return [(r["section"], ".".join(r["loc"]), r["rule"]) for r in V.violation_rows(df).orderBy("no").collect()]


def test_clean_envelope(spark):
    assert breaches(spark, envelope(record(provenance={"a": 1}))) == []
    built = spark.createDataFrame([(json.dumps(record()),)], "r string").select(V.envelope_json(F.col("r"))).first()[0]
    assert json.loads(built) == envelope(record())
    empty = spark.createDataFrame([(None,)], "r string").select(V.envelope_json(F.col("r"))).first()[0]
    assert json.loads(empty) == envelope({})


def test_breaches(spark):
    r = record(total_pages=2.0, llm_confidence_score=2, Practice_ZIP_5digit="9256", Practice_State=5)
    del r["Practice_City"]
    assert breaches(spark, envelope(r)) == [
        ("report_metadata", "llm_confidence_score", "maximum"),
        ("report_metadata", "Practice_City", "required"),
        ("report_metadata", "Practice_State", "type"),
        ("report_metadata", "Practice_ZIP_5digit", "pattern"),
    ]
    assert breaches(spark, envelope(record(total_pages=True))) == [("report_metadata", "total_pages", "type")]
    assert breaches(spark, envelope(record(total_pages=None))) == [("report_metadata", "total_pages", "type")]
    assert breaches(spark, envelope(record(total_pages=1.5))) == [("report_metadata", "total_pages", "type")]
    env = envelope(record())
    del env["tested_biomarker_umbrella"]
    env["more"] = 1
    env["count_of_extracted_objects"] = -1
    assert breaches(spark, env) == [
        ("tested_biomarker_umbrella", "tested_biomarker_umbrella", "required"),
        ("<root>", "count_of_extracted_objects", "minimum"),
        ("<root>", "more", "additionalProperties"),
    ]
    assert breaches(spark, envelope([1])) == [("report_metadata", "report_metadata", "type")]
    assert breaches(spark, "{") == [("<root>", "", "type")]
    assert breaches(spark, "[1]") == [("<root>", "", "type")]
    item = {"page_number": None, "biomarker_name": "TMB", "method": 1, "result": None, "reference_range": None, "interpretation": None, "x": 1}
    bio = {"count": 1, "llm_confidence_score": None, "other_molecular_biomarkers": [item]}
    assert breaches(spark, envelope(record(), other_molecular_biomarker_umbrella=bio)) == [
        ("other_molecular_biomarker_umbrella", "other_molecular_biomarkers.0.method", "type"),
        ("other_molecular_biomarker_umbrella", "other_molecular_biomarkers.0.x", "additionalProperties"),
    ]
    assert breaches(spark, envelope(record(Patient_DOB="1941"))) == []
    assert breaches(spark, envelope(record(Patient_DOB="1941")), check_dates=True) == [("report_metadata", "Patient_DOB", "format")]


def test_a_document_without_gold_has_extras_only(spark):
    gold = spark.createDataFrame([("a", '{"F":"x"}')], "doc_id string, record string")
    got = spark.createDataFrame([("a", '{"F":"x"}'), ("b", '{"F":"x"}')], "doc_id string, record string")
    rows = {(r["doc_id"], r["field"], r["passed"]) for r in SC.compare_fields(gold, got).collect()}
    assert rows == {("a", "F", True), ("b", "F", False)}
    assert {r["doc_id"] for r in SC.compare_fields(gold, got, lenient=True).collect()} == {"a"}


def test_scorecard_lists_all_errors(spark):
    r = {f"x{i:02}": 1 for i in range(60)}
    df = spark.createDataFrame([("d", json.dumps(envelope({**record(), **r})))], "doc_id string, envelope string")
    card = V.scorecards(V.check_envelopes(df)).first()
    assert not card["passed"] and card["n_errors"] == 60 and len(card["field_errors"]) == 60
    shown = V.scorecards(V.check_envelopes(df), max_errors=25).first()
    assert shown["n_errors"] == 60 and len(shown["field_errors"]) == 25
    assert card["notes"] == "60 validation error(s); first: report_metadata.x00: unknown field"


def test_catalogue(spark):
    rows = V.field_catalogue(spark).collect()
    assert len(rows) == 26 + 3 + 3 + 4
    npi = [r for r in rows if r["field"] == "Practice_NPI"][0]
    assert (npi["type"], npi["required"], npi["pattern"]) == ("string or null", True, "^[0-9]{10}$")


def test_router(spark):
    rows = [
        ("team", "sme_flag", None, True, 0, None, 0.99),
        ("card", "committed", None, False, 2, "two errors", 0.99),
        ("low", "committed", None, True, 0, None, 0.84),
        ("edge", "committed", None, True, 0, None, 0.85),
        ("none", "committed", None, True, 0, None, None),
    ]
    df = spark.createDataFrame(rows, "doc_id string, team_verdict string, team_reason string, passed boolean, n_errors int, notes string, confidence double")
    out = {r["doc_id"]: r for r in RO.route(df.withColumn("verifier_name", F.lit("schema_validator"))).collect()}
    assert {k: r["verdict"] for k, r in out.items()} == {"team": "sme_flag", "card": "sme_flag", "low": "sme_flag", "edge": "auto_accept", "none": "auto_accept"}
    assert out["team"]["verdict_reason"] == "Team emitted sme_flag: (no reason)"
    assert out["card"]["verdict_reason"] == "Verifier 'schema_validator' failed with 2 error(s): two errors"
    assert out["low"]["verdict_reason"] == "llm_confidence_score=0.84 is below auto-accept threshold 0.85"
    assert "<absent>" in out["none"]["verdict_reason"] and out["none"]["confidence_missing"]


def test_team_paths(spark):
    rows = [
        ("commit", True, False, 0, 0, 0, 0, 3, 0),
        ("accept", False, False, 0, 0, 0, 2, 3, 0),
        ("retry", False, True, 1, 0, 0, 0, 1, 2),
        ("nohints", False, True, 1, 0, 0, 0, 1, 0),
        ("escalate", True, True, 0, 0, 0, 0, 0, 0),
        ("wrong", True, True, 0, 0, 1, 0, 2, 1),
    ]
    df = spark.createDataFrame(rows, "doc_id string, coverage_ok boolean, gap_signal boolean, missed int, vague int, spurious int, checklist_misses int, extracted int, hints int")
    policies = A.choose_policy(df)
    out = {r["doc_id"]: r for r in A.team_verdicts(policies.withColumn("reasoning", F.lit("why"))).collect()}
    assert {k: (r["policy"], r["team_verdict"], r["rerun"]) for k, r in out.items()} == {
        "commit": (None, "committed", False),
        "accept": ("ACCEPT_EXTRACTOR", "committed", False),
        "retry": ("RE_EXTRACT", "committed", True),
        "nohints": ("RE_EXTRACT", "sme_flag", False),
        "escalate": ("INVOKE_VMAW", "sme_flag", False),
        "wrong": ("RE_EXTRACT", "committed", True),
    }


def test_gap_boundary(spark):
    df = spark.createDataFrame([(10, 9), (10, 8), (0, 0), (0, 5), (1, 0)], "h int, e int")
    assert [r[0] for r in df.select(A.coverage_gap(F.col("h"), F.col("e"))).collect()] == [False, True, False, False, True]


def score(spark, gold, actual, **kw):
    s = "doc_id string, record string"
    g = spark.createDataFrame([("d", json.dumps(gold))], s)
    a = spark.createDataFrame([] if actual is None else [("d", json.dumps(actual)), ("other", json.dumps(gold))], s)
    cmp = SC.compare_fields(g, a, **kw).filter("doc_id = 'd'")
    r = SC.score_documents(cmp).first()
    return (r["passed"], r["total_fields"], r["meets_threshold"]), {x["field"]: x for x in cmp.collect()}


def test_scores(spark):
    gold = record(Patient_Last_Name="Quill", Vendor_Name="Tempus", Practice_NPI="1234567893", provenance={"a": 1})
    assert score(spark, gold, gold)[0] == (24, 24, True)
    changed = dict(gold, Patient_Last_Name="Other", Practice_ZIP_5digit=" 40011", Practice_City=None, total_pages="2", Extra=1)
    result, rows = score(spark, gold, changed)
    assert result == (20, 25, True) and {f for f, r in rows.items() if not r["passed"]} == {"Patient_Last_Name", "Practice_ZIP_5digit", "Practice_City", "total_pages", "Extra"}
    cosmetic = dict(gold, Patient_Last_Name=" QUILL ", Patient_DOB="03/09/1950", llm_confidence_score=0.1, total_pages=2.0)
    result, rows = score(spark, gold, cosmetic)
    assert result == (24, 24, True)
    assert (rows["Patient_Last_Name"]["match_type"], rows["Patient_DOB"]["match_type"]) == ("normalized_string", "date")
    lenient, rows = score(spark, gold, dict(cosmetic, Extra=1), lenient=True)
    assert lenient == (24, 25, True) and "Extra" not in rows and not rows["Patient_DOB"]["passed"]
    assert score(spark, gold, None)[0][2] is False


def test_address_and_names(spark):
    def parts(fn, value):
        r = spark.createDataFrame([(value,)], "t string").select(*[c.alias(k) for k, c in fn(F.col("t")).items()]).first()
        return tuple(r)

    assert parts(FI.split_street, "417 Juniper Rd. Suite 9") == ("417 Juniper Rd.", "Suite 9")
    assert parts(FI.split_street, "12 Main St.") == ("12 Main St.", None)
    assert parts(FI.split_city, "Eastmere, CA 40011") == ("Eastmere", "CA", "40011", None)
    assert parts(FI.split_city, "Port Calder, ca 40022-1234") == ("Port Calder", "CA", "40022", "1234")
    assert parts(FI.split_person, "ORVEN D QUILLON, M.D.") == ("Orven", "Quillon", "M.D.")
    assert parts(FI.split_person, "Dr. Tilda Brandt") == ("Tilda", "Brandt", "Dr.")
    assert parts(FI.split_person, "Pavo Lindqvar, D.O.") == ("Pavo", "Lindqvar", "D.O.")
    assert parts(FI.split_patient, "Doe, JANE Q") == ("Jane", "Doe", None)
    assert parts(FI.split_patient, "Jane Doe") == ("Jane", "Doe", None)


def test_models_answer_and_retry_rows(spark):
    prompts = spark.createDataFrame([("a", "x"), ("b", "y")], "doc_id string, prompt string")

    def load():
        def model(pdf):
            out = pdf[["doc_id"]].copy()
            out["answer"] = ["```json\n{\"t\": 1}\n```" if p == "x" else "no" for p in pdf["prompt"]]
            return out

        return model

    out = {r["doc_id"]: r["record"] for r in FI.parse_answers(FI.extract_with(prompts, load)).collect()}
    assert out == {"a": '{"t": 1}', "b": None}


def test_severity_and_summary(spark):
    runs = spark.createDataFrame([("a", "auto_accept", 5), ("a", "sme_flag", 7), ("b", "errored", 1), ("b", "sme_flag", 1), ("c", None, 2)], "batch string, verdict string, latency_ms bigint")
    assert {tuple(r) for r in RO.severity(runs, "batch").collect()} == {("a", 1), ("b", 2), ("c", 0)}
    assert {tuple(r) for r in RO.run_summary(runs).collect()} == {("auto_accept", 1, 5), ("sme_flag", 2, 8), ("errored", 1, 1), ("(none)", 1, 2)}


def test_single_sections(spark):
    rows = [
        ("report_metadata", json.dumps(record()), 0),
        ("report_metadata", "{}", 25),
        ("tested_biomarker_umbrella", json.dumps({"count_of_tested_biomarkers": 0, "page_numbers": [0], "llm_confidence_score": None, "tested_biomarkers": []}), 1),
        ("nowhere", "{}", 1),
        ("report_metadata", "oops", 1),
        (None, "{}", 1),
    ]
    df = spark.createDataFrame(rows, "section string, candidate string, want int")
    assert all(len(r["errors"]) == r["want"] and r["ok"] == (r["want"] == 0) for r in V.check_sections(df).collect())


def test_flagged_records_are_not_checked(spark):
    """Where ``unless`` holds the JSON is not looked at; all others are checked as ever, a null condition included."""
    rows = [("good", json.dumps(envelope(record())), True), ("bad", "no JSON", True), ("seen", "no JSON", False), ("unsure", "no JSON", None)]
    df = spark.createDataFrame(rows, "doc_id string, envelope string, skip boolean")
    got = {r["doc_id"]: r["n"] for r in V.check_envelopes(df, unless=F.col("skip")).select("doc_id", F.size("errors").alias("n")).collect()}
    assert got == {"good": 0, "bad": 0, "seen": 1, "unsure": 1}
    kinds = {k for rule in SECTION_RULES.values() for r in rule for k in r.types} | {"missing", "boolean", "object", "number", "integer", "null", "string", "array"}
    assert not [(a, b) for a in kinds for b in kinds if a != b and a in b]
