import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from docspark.operators import ledger as LE
from docspark.operators import roles as R
from docspark.operators import review as RV
from docspark.sources import files as FS
from docspark.sources import layout as LA
from docspark.sources.scratch import scratch_root, stage


def test_list_and_read_inputs(spark, tmp_path):
    for name, body in {"b.PDF": b"two", "sub/a.pdf": b"one", "c.txt": b"no", "x.tar.pdf": b"three"}.items():
        f = tmp_path / name
        f.parent.mkdir(exist_ok=True)
        f.write_bytes(body)
    listed = FS.list_inputs(spark, str(tmp_path))
    assert {(r["doc_id"], r["length"]) for r in listed.collect()} == {("b", 3), ("a", 3), ("x.tar", 5)}
    assert "content" not in listed.columns
    assert {(r["doc_id"], bytes(r["content"])) for r in FS.read_inputs(spark, str(tmp_path)).collect()} == {("b", b"two"), ("a", b"one"), ("x.tar", b"three")}
    assert [r["doc_id"] for r in FS.first_inputs(listed, 2).collect()] == ["b", "a"]


def test_doc_ids(spark):
    cases = {"gs/x/doc_3.pdf": "doc_3", "doc": "doc", "a/b.c.pdf": "b.c", "a/": "unknown", "": "unknown", "a/.pdf": ".pdf"}
    df = spark.createDataFrame(list(cases.items()), "uri string, want string").select("want", FS.doc_id_of(F.col("uri")).alias("got"))
    assert all(r["want"] == r["got"] for r in df.collect())


def test_gate(spark):
    rows = [
        ("d", "v1", "x.PDF", None, None),
        ("d", "v1", None, b"x", None),
        ("d", "v1", "x.pdf", b"x", "two sources"),
        ("d", "v1", "x.txt", None, "not a PDF"),
        ("d", "v1", None, None, "no source"),
        ("", "v1", "x.pdf", None, "doc_id missing"),
        ("d", None, "x.pdf", None, "pipeline_version missing"),
        ("d", "v9", "x.pdf", None, "unsupported pipeline_version"),
    ]
    df = spark.createDataFrame(rows, "doc_id string, pipeline_version string, uri string, content binary, want string")
    gated = FS.gate_inputs(df)
    assert all(r["want"] == r["reject_reason"] for r in gated.collect())
    good, bad = FS.split_gated(gated)
    assert (good.count(), bad.count()) == (2, 6)


def run_line(run, doc, at, **kw):
    return json.dumps({"run_id": run, "doc_id": doc, "completed_at": at, **kw})


def test_json_lines(spark, tmp_path):
    f = tmp_path / "runs.jsonl"
    f.write_text("\n".join([run_line("1", "a", "2024-01-01"), "", "   ", '{"run_id": "2", "doc', run_line("3", "a", "2024-01-02", latency_ms="x"), run_line("4", "a", "2023-12-31")]) + "\n")
    parsed = FS.read_json_lines(spark, str(f), FS.RUNS_SCHEMA).cache()
    assert sorted(r["run_id"] for r in FS.good_rows(parsed).collect()) == ["1", "4"]
    counts = FS.bad_line_count(parsed).first()
    assert counts["good"] == 2 and counts["bad"] >= 2
    latest = LE.latest_runs(FS.good_rows(parsed)).first()
    assert (latest["run_id"], latest["runs"]) == ("1", 2)
    assert [r["run_id"] for r in LE.recent_runs(FS.good_rows(parsed)).collect()] == ["1", "4"]


def test_latest_extraction(spark, tmp_path):
    f = tmp_path / "x.jsonl"
    rows = [("e1", "a", "2024-01-01"), ("e3", "a", "2024-01-03"), ("e2", "a", "2024-01-03"), ("e9", "b", "2020-01-01")]
    f.write_text("\n".join(json.dumps({"extraction_id": e, "doc_id": d, "extracted_at": t}) for e, d, t in rows))
    out = {r["doc_id"]: r["extraction_id"] for r in FS.read_latest_extractions(spark, str(f)).collect()}
    assert out == {"a": "e3", "b": "e9"}


def test_gold_precedence_and_shapes(spark, tmp_path):
    root, second = tmp_path / "gold", tmp_path / "gold" / "phase1"
    second.mkdir(parents=True)
    wrapped = lambda v: json.dumps({"genomic_pathology_extraction": {"report_metadata": {"v": v}}}, indent=1)
    (root / "a.json").write_text(wrapped(1))
    (second / "a.json").write_text(wrapped(2))
    (second / "b.json").write_text(json.dumps({"report_metadata": {"v": 3}}))
    (second / "c.json").write_text(json.dumps({"genomic_pathology_extraction": {"other": 1}, "report_metadata": {"v": 9}}))
    out = {r["doc_id"]: r["record"] for r in FS.read_gold(spark, str(root), str(second)).collect()}
    assert out == {"a": '{"v":1}', "b": '{"v":3}', "c": None}


def test_ledger_rows_and_artifacts(spark, tmp_path):
    storage = LE.Storage("v1", str(tmp_path))
    results = spark.createDataFrame(
        [("a", "auto_accept", "ok", "{}"), ("b", "auto_accept", "ok", None), ("c", "sme_flag", "low", "{}")],
        "doc_id string, verdict string, verdict_reason string, envelope string",
    )
    LE.append(LE.run_rows(results, storage), storage.runs)
    LE.append(LE.extraction_rows(results, storage), storage.extractions)
    runs = spark.read.parquet(storage.runs)
    assert runs.count() == 3 and set(runs.columns) >= {"run_id", "artifacts_gcs_prefix", "completed_at", "verifier_scorecards"}
    assert runs.first()["artifacts_gcs_prefix"].startswith(str(tmp_path))
    x = spark.read.parquet(storage.extractions).join(runs.select("run_id", "verdict"), "run_id").collect()
    assert [(r["doc_id"], r["verdict"]) for r in x] == [("a", "auto_accept")]
    todo = spark.createDataFrame([("a", "v1"), ("a", "v2"), ("z", "v1")], "doc_id string, pipeline_version string")
    assert {tuple(r) for r in FS.not_yet_done(todo, runs).collect()} == {("a", "v2"), ("z", "v1")}

    first = spark.createDataFrame([(f"d{i}", "[1]") for i in range(50)], "doc_id string, content string")
    LE.write_artifacts(first, storage, "blocks", buckets=4)
    new = spark.createDataFrame([("d1", "[2]"), ("e", "{")], "doc_id string, content string")
    LE.write_artifacts(new, storage, "blocks", buckets=4)
    back = FS.parsed_artifacts(FS.read_artifacts(spark, f"{tmp_path}/artifacts_v1", "blocks"))
    got = {r["doc_id"]: r["t"] for r in back.select("doc_id", F.to_json("content").alias("t")).collect()}
    assert len(got) == 51 and got["d1"] == "[2]" and got["d2"] == "[1]" and got["e"] is None
    switch = LE._switch
    LE._switch = lambda *a: 1 / 0  # between write and switch
    try:
        LE.write_artifacts(spark.createDataFrame([("d1", "[3]"), ("f", "[3]")], new.schema), storage, "blocks")
        raise AssertionError("expected ZeroDivisionError")
    except ZeroDivisionError:
        pass
    finally:
        LE._switch = switch
    table = lambda: {r["doc_id"]: r["content"] for r in LE.read_artifact_table(spark, storage.artifacts("blocks")).collect()}
    assert len(table()) == 51 and table()["d1"] == "[2]"
    held = LE.read_artifact_table(spark, storage.artifacts("blocks"))
    twice = spark.createDataFrame([("d1", "[4]", 1), ("d1", "[5]", 2), (None, "[]", 3)], "doc_id string, content string, n int")
    LE.write_artifacts(twice, storage, "blocks")
    assert held.count() == 51 and table()["d1"] == "[5]" and len(table()) == 52
    seen = LE.artifact_manifest(spark, storage.artifacts("blocks"))
    with pytest.raises(RuntimeError):
        LE._switch(spark, storage.artifacts("blocks"), seen)
    before = table()
    assert LE.remove_old_artifacts(spark, storage, "blocks") >= 1 and table() == before
    assert LE.remove_old_artifacts(spark, storage, "blocks") == 0 == LE.remove_old_artifacts(spark, storage, "none")
    kinds = spark.createDataFrame([("a", "blocks")], "doc_id string, kind string")
    present = FS.artifact_presence(results, kinds, ("blocks", "pages")).collect()
    assert {(r["doc_id"], r["kind"]) for r in present if r["present"]} == {("a", "blocks")} and len(present) == 6


def test_latest_of_a_hot_document(spark):
    runs = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("doc_id"), F.col("id").alias("run_id"), F.lit("t").alias("completed_at")
    )
    out = LE.latest_runs(runs)
    assert "partial_max_by" in out._jdf.queryExecution().executedPlan().toString()
    hot = out.filter("doc_id = -1").first()
    assert (hot["run_id"], hot["runs"]) == (89_997, 30_000)


class Session:
    """Stands in for a session with given settings, which cannot change at run time."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}
        self.sparkContext = SimpleNamespace(master="local[2]")


def test_scratch_root_follows_the_session(spark):
    assert scratch_root(Session(spark_checkpoint_dir="hdfs://shared/cp/")) == "hdfs://shared/cp"
    assert scratch_root(Session()).startswith("/tmp/spark-")
    staged = stage(spark.range(3), "t")
    assert staged.count() == 3 and "docspark-t-" in staged.inputFiles()[0]


def test_layout_json_inherits_pages_and_reads_both_spellings(spark):
    leaf = {"block_id": "c", "text_block": {"text": "leaf", "layout": {"bounding_poly": {"vertices": [{"x": 1}, {"y": 4.5}]}}}}
    mid = {"blockId": "b", "textBlock": {"text": "mid", "blocks": [leaf, {"textBlock": {"text": "no id"}}]}}
    top = {"blockId": "a", "pageSpan": {"pageStart": 3}, "textBlock": {"text": "top", "blocks": [mid]}}
    docs = [("d", json.dumps({"documentLayout": {"blocks": [top]}})), ("e", "{"), ("f", "{}")]
    out = LA.layout_blocks(spark.createDataFrame(docs, "doc_id string, layout string")).orderBy("order_key").collect()
    assert [(r["block_id"], r["page_number"], list(r["order_key"]), r["text"]) for r in out] == [("a", 3, [0], "top"), ("b", 3, [0, 0], "mid"), ("c", 3, [0, 0, 0], "leaf")]
    assert list(out[2]["bbox"]) == [0.0, 0.0, 1.0, 4.5] and list(out[0]["bbox"]) == []


def test_review_defaults(spark):
    blocks = spark.createDataFrame([("d", "b1", 1, "t"), ("d", "b2", 1, "u")], "doc_id string, block_id string, page_number int, text string")
    profiles = spark.createDataFrame([("d", "b1", "results_table", [], 0.5, "r")], "doc_id string, block_id string, text_role string, hints array<string>, confidence double, rationale string")
    occ = spark.createDataFrame([("d", "b2", 1, 0, "s", "JAK2", ["m"]), ("d", None, 1, 1, "s", "x", ["m"])], "doc_id string, block_id string, page_number int, seq int, section string, text string, source_models array<string>")
    prov = spark.createDataFrame([("d", "F1", "b1", "inferred"), ("d", "F2", None, "absent"), ("d", "F3", "b1", "")], "doc_id string, field string, block_id string, type string")
    values = spark.createDataFrame([("d", "F1", "v"), ("d", "F3", None)], "doc_id string, field string, value string")
    views = {r["block_id"]: r for r in RV.block_views(blocks, profiles, occ, RV.field_rows(prov, values)).collect()}
    assert views["b1"]["hints"] == ["none"] and views["b2"]["text_role"] == "other" and views["b2"]["rationale"] == ""
    assert [tuple(f) for f in views["b1"]["fields"]] == [("F1", "v", "inferred"), ("F3", None, "verbatim")]
    assert views["b1"]["entities"] == [] and [e["text"] for e in views["b2"]["entities"]] == ["JAK2"]
    payload = {r["block_id"]: json.loads(r["payload"]) for r in RV.view_payload(RV.block_views(blocks, profiles, occ, RV.field_rows(prov, values))).collect()}
    assert payload["b1"]["fields"][1] == {"field": "F3", "value": "null", "type": "verbatim"} and payload["b2"]["confidence"] is None
    single = spark.createDataFrame([([], "x"), (None, None), (["a"], "x")], "h array<string>, s string").select(RV.hint_list(F.col("h"), F.col("s")))
    assert [r[0] for r in single.collect()] == [["x"], ["none"], ["a"]]
    assert R.role_legend(spark.createDataFrame([("d", 1, "other")] * 3, "doc_id string, page_number int, text_role string")).first()["blocks"] == 3


def test_parse_layout_kinds_cells_and_boxes(spark):
    cell = lambda i, t: {"blocks": [{"block_id": i, "text_block": {"text": t}}]}
    table = {"block_id": "t", "table_block": {"body_rows": [{"cells": [cell("x", "1"), cell("y", "2")]}], "header_rows": [{"cells": [cell("h", "head")]}]}}
    image = {"block_id": "i", "image_block": {}, "bounding_box": {"normalized_vertices": [{"x": 0.1, "y": 0.2}, {"x": 0.5}]}}
    listed = {"block_id": "l", "list_block": {"list_entries": []}}
    top = {"block_id": "p", "page_span": {"page_start": 2}, "text_block": {"type": "heading", "text": "", "blocks": [table, image, listed]}}
    docs = [("d", json.dumps({"document_layout": {"blocks": [top]}}))]
    out = LA.parse_layout(spark.createDataFrame(docs, "doc_id string, layout string")).orderBy("order_key").collect()
    assert [(r["block_id"], r["page_number"], r["section_path"]) for r in out] == [
        ("h", 1, "page_2/heading/table/text"),
        ("x", 1, "page_2/heading/table/text"),
        ("y", 1, "page_2/heading/table/text"),
        ("i", 1, "page_2/heading/image"),
    ]
    assert list(out[3]["bbox"]) == [0.1, 0.0, 0.5, 0.2]


def test_configuration(spark):
    from docspark.operators.entities import Tables

    with pytest.raises(KeyError):
        Tables.from_mapping({"stoplist": []})
    with pytest.raises(KeyError):
        Tables.from_mapping({"label_to_umbrellas": {}, "stop_list": []})
    assert Tables.from_mapping({"label_to_umbrellas": {"A": ["x"]}}).label_sections == {"A": ["x"]}
    t = Tables.from_mapping({"label_to_sections": {"A": ["report_metadata"]}, "stoplist": [" DNA ", 5], "vendor_names": ["Quest"], "field_hint_rules": [{"near_labels": ["Dob"], "field": "Patient_DOB"}]})
    assert t.stoplist == ("dna", "5") and t.vendor_names == ("quest",) and t.hint_rules[0].field == "Patient_DOB" and t.drop_roles == ()
    configs = {"phase_1": {"pipeline_version": "v1", "root": "/x/"}}
    s = LE.load_storage(configs, "phase_1")
    assert (s.runs, s.artifacts("blocks")) == ("/x/runs_v1", "/x/artifacts_v1/blocks")
    try:
        LE.load_storage(configs, "phase_9")
        raise AssertionError("expected KeyError")
    except KeyError:
        pass


def test_warehouse_tables(spark):
    rows = [(f"e{i}", f"d{i % 2}", f"2024-01-0{i + 1}") for i in range(4)]
    df = spark.createDataFrame(rows, "extraction_id string, doc_id string, extracted_at string")
    df.createOrReplaceTempView("extractions_test")
    assert {r["extraction_id"] for r in FS.warehouse_extractions(spark, "extractions_test").collect()} == {"e2", "e3"}
    one = spark.createDataFrame([("d1",)], "doc_id string")
    assert [r["extraction_id"] for r in FS.warehouse_extractions(spark, "extractions_test", one).collect()] == ["e3"]
    df.select(F.col("extraction_id").alias("run_id"), F.col("extracted_at").alias("completed_at")).createOrReplaceTempView("runs_test")
    assert [r["run_id"] for r in FS.warehouse_runs(spark, "runs_test", 2).collect()] == ["e3", "e2"]


def test_ledgers_are_read_as_they_are_written(spark, tmp_path):
    storage = LE.Storage("v1", str(tmp_path))
    results = spark.createDataFrame([("a", "auto_accept", "ok", '{"x":1}')], "doc_id string, verdict string, verdict_reason string, envelope string")
    LE.run_rows(results, storage).write.json(f"{tmp_path}/runs")
    LE.extraction_rows(results, storage).write.json(f"{tmp_path}/extractions")
    run = spark.read.schema(FS.RUNS_SCHEMA).json(f"{tmp_path}/runs").first()
    assert run["artifacts_gcs_prefix"].endswith("/a/")
    assert spark.read.schema(FS.EXTRACTIONS_SCHEMA).json(f"{tmp_path}/extractions").first()["genomic_pathology_extraction"] == '{"x":1}'


def test_scratch_needs_a_shared_folder_on_a_cluster():
    cluster, shared = Session(), Session(spark_checkpoint_dir="hdfs://x/y/")
    cluster.sparkContext.master = shared.sparkContext.master = "spark://host:7077"
    with pytest.raises(ValueError):
        scratch_root(cluster)
    assert scratch_root(shared) == "hdfs://x/y"


def test_all_text_of_marked_up_pages(spark):
    pages = [
        (1, "lead <p>a <b>b</b> tail</p><td>cell</td><h2>Head</h2><span>s</span>"),
        (2, "<!DOCTYPE html><!-- <p>no</p> --><script>if (a<b) x()</script ><STYLE>p{}</STYLE><P CLASS='x'>1 < 2 &amp; 3<br>4 \n</P>\n<div> </div>"),
        (3, ""),
        (4, None),
        (5, "plain"),
        (6, "<p>" + "long " * 200_000 + "</p>"),
    ]
    got = LA.html_blocks(spark.createDataFrame(pages, "page_id int, html string")).orderBy("doc_id", "ord").collect()
    found = lambda d: [(r["section_path"][7:], r["text"]) for r in got if r["doc_id"] == d]
    assert found(1) == [("text", "lead "), ("p", "a "), ("b", "b"), ("text", " tail"), ("td", "cell"), ("h2", "Head"), ("span", "s")]
    assert found(2) == [("p", "1 < 2 &amp; 3"), ("text", "4 \n")]
    assert found(3) == found(4) == [] and found(5) == [("text", "plain")] and len(found(6)[0][1]) == 1_000_000
    assert [r["ord"] for r in got if r["doc_id"] == 1] == list(range(7))
