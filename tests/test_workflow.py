"""The plan from documents to verdicts: every outcome on planted documents, and the same over a stream with failures."""

import json

import pytest
from pyspark.sql import functions as F

from docspark.operators import workflow as W
from docspark.operators.blocks import blocks_from_text
from docspark.operators.ledger import Storage
from docspark.streaming import ingest as IN

DOCS = [
    ("fine", "City: Eastmere"),
    ("unseen", "nothing here"),
    ("missed", "City: Eastmere\nName: Lee"),
    ("untold", "City: Eastmere\nName: Lee\nno hints"),
    ("made up", "City: Eastmere\nCity wrong"),
    ("bare", "item x\nitem y"),
    ("extra", "City: Eastmere\nName: Lee\nkeep all\nitem x"),
    ("late", "City: Eastmere\nDate: soon"),
    ("empty", ""),
    ("null", None),
    (None, "City: Eastmere"),
]
FIELDS = {"City": "Practice_City", "Name": "Patient_Last_Name", "Date": "Report_Date"}


def checklist(docs):
    """``Label: value`` lines are candidates with a field, ``item value`` ones without."""
    lines = blocks_from_text(docs)
    label, value = F.regexp_extract("text", r"^(\w+): ", 1), F.regexp_extract("text", r"^(?:\w+:|item) (.+)$", 1)
    hint = F.coalesce(*[F.when(label == k, F.lit(v)) for k, v in FIELDS.items()])
    found = lines.select("doc_id", F.lower(value).alias("text_key"), value.alias("text"), hint.alias("field_hint"), F.col("block_id").alias("evidence_block"))
    return found.filter("text <> ''")


def rows(cands):
    return cands.filter("field_hint IS NOT NULL").select("doc_id", F.col("field_hint").alias("field"), F.col("text").alias("value"), F.col("evidence_block").alias("block_id"))


def first_pass(cands):
    """Takes no names unless told to keep all, and makes one city up."""
    made_up = F.when((F.col("doc_id") == "made up") & (F.col("field") == "Practice_City"), F.lit("Westmere")).otherwise(F.col("value"))
    return rows(cands).filter("field <> 'Patient_Last_Name' OR doc_id = 'extra'").withColumn("value", made_up)


PLAN = W.Plan(
    checklist=checklist,
    first_pass=first_pass,
    second_pass=rows,
    blocks=blocks_from_text,
    total_pages="coalesce(greatest(1, ceil(size(split(text, '\\n', -1)) / 5)), 1)",
    hints="CASE WHEN doc_id = 'untold' THEN 0 ELSE missed + spurious END",
    confidence="CASE WHEN doc_id = 'unseen' THEN 0.5 ELSE 0.9 END",
    check_dates=True,
)
WANT = {
    "fine": (None, "committed", "auto_accept", "Eastmere", None),
    "unseen": (None, "committed", "sme_flag", None, None),
    "missed": ("RE_EXTRACT", "committed", "auto_accept", "Eastmere", "Lee"),
    "untold": ("RE_EXTRACT", "sme_flag", "sme_flag", "Eastmere", None),
    "made up": ("RE_EXTRACT", "committed", "auto_accept", "Eastmere", None),
    "bare": ("INVOKE_VMAW", "sme_flag", "sme_flag", None, None),
    "extra": ("ACCEPT_EXTRACTOR", "committed", "auto_accept", "Eastmere", "Lee"),
    "late": (None, "committed", "sme_flag", "Eastmere", None),
    "empty": (None, "committed", "auto_accept", None, None),
    "null": (None, "committed", "auto_accept", None, None),
}


def process(docs):
    return W.process(docs, PLAN)


def metadata(envelope):
    return json.loads(envelope)["report_metadata"]


def test_every_outcome(spark):
    out = process(spark.createDataFrame(DOCS, "doc_id string, text string").withColumn("policy", F.lit("a clash"))).collect()
    got = {
        r["doc_id"]: (r["policy"], r["team_verdict"], r["verdict"], metadata(r["envelope"])["Practice_City"], metadata(r["envelope"])["Patient_Last_Name"])
        for r in out
    }
    assert got == WANT and len(out) == len(WANT)
    why = {r["doc_id"]: r["verdict_reason"] for r in out}
    assert "Report_Date: not an ISO date" in why["late"] and "below" in why["unseen"] and "without hints" in why["untold"]


def test_no_documents(spark):
    assert process(spark.createDataFrame([], "doc_id string, text string")).collect() == []


def ledger(spark, storage):
    runs = IN.read_ledger(spark, storage.runs, IN.RUN_COLUMNS.format(id="string")).collect()
    found = IN.read_ledger(spark, storage.extractions, IN.EXTRACTION_COLUMNS.format(id="string")).collect()
    return (
        sorted((r["doc_id"], r["verdict"], r["verdict_reason"]) for r in runs),
        sorted((r["doc_id"], r["genomic_pathology_extraction"]) for r in found),
    )


def test_stream_equals_batch_whatever_fails_between_the_ledgers(spark, tmp_path, monkeypatch):
    inbox, storage, checkpoint = tmp_path / "in", Storage("v1", str(tmp_path / "out")), str(tmp_path / "cp")
    inbox.mkdir()
    for n, part in enumerate((DOCS[:5], DOCS[5:10])):
        (inbox / f"{n}.json").write_text("\n".join(json.dumps({"doc_id": d, "text": t}) for d, t in part))
    write, failures = IN.write_batch, []

    def failing(rows, path, *rest):
        if path == storage.runs and len(failures) < 2:
            failures.append(path)
            raise OSError("the second ledger is away")
        write(rows, path, *rest)

    monkeypatch.setattr(IN, "write_batch", failing)

    def start():
        stream = spark.readStream.schema("doc_id string, text string").option("maxFilesPerTrigger", 1).json(str(inbox))
        IN.ingest(stream, process, storage, checkpoint).awaitTermination()

    for _ in range(2):
        with pytest.raises(Exception, match="second ledger"):
            start()
    start()
    batch = process(spark.createDataFrame(DOCS[:10], "doc_id string, text string")).collect()
    want_runs = sorted((r["doc_id"], r["verdict"], r["verdict_reason"]) for r in batch)
    want_found = sorted((r["doc_id"], r["envelope"]) for r in batch if r["verdict"] == "auto_accept")
    assert ledger(spark, storage) == (want_runs, want_found)


def test_the_audit_shuffles_no_candidate_for_an_anti_join(spark):
    from docspark.operators import audit as A

    docs = spark.createDataFrame(DOCS[:10], "doc_id string, text string")
    cands = checklist(docs)
    plan = A.audit(docs, cands, first_pass(cands), blocks_from_text(docs))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and plan.count("Aggregate") == 2
