import json
import re

import pytest
from pyspark.sql import functions as F

from docspark.operators.ledger import Storage, run_rows
from docspark.streaming import ingest as IN


def arrive(folder, name, rows):
    (folder / name).write_text("\n".join(json.dumps({"doc_id": d, "text": t}) for d, t in rows))


def process(docs):
    bad = F.contains("text", F.lit("bad"))
    return docs.select(
        "doc_id",
        F.when(bad, F.lit("sme_flag")).otherwise(F.lit("auto_accept")).alias("verdict"),
        F.lit("").alias("verdict_reason"),
        F.to_json(F.struct("text")).alias("envelope"),
    )


def run(spark, inbox, storage, checkpoint):
    stream = spark.readStream.schema("doc_id string, text string").option("maxFilesPerTrigger", 1).json(str(inbox))
    IN.ingest(stream, process, storage, str(checkpoint)).awaitTermination()
    runs = IN.read_ledger(spark, storage.runs, IN.RUN_COLUMNS.format(id="string")).collect()
    found = IN.read_ledger(spark, storage.extractions, IN.EXTRACTION_COLUMNS.format(id="string")).collect()
    return sorted(r["doc_id"] for r in runs), sorted(r["doc_id"] for r in found)


def test_each_document_once(spark, tmp_path):
    inbox, storage, checkpoint = tmp_path / "in", Storage("v1", str(tmp_path / "out")), tmp_path / "cp"
    inbox.mkdir()
    arrive(inbox, "1.json", [("a", "good"), ("b", "bad"), ("a", "good")])
    arrive(inbox, "2.json", [("a", "again"), ("c", "good")])
    assert run(spark, inbox, storage, checkpoint) == (["a", "b", "c"], ["a", "c"])
    # nothing new: nothing written
    assert run(spark, inbox, storage, checkpoint) == (["a", "b", "c"], ["a", "c"])
    arrive(inbox, "3.json", [("c", "late copy"), ("d", "good")])
    assert run(spark, inbox, storage, checkpoint) == (["a", "b", "c", "d"], ["a", "c", "d"])
    # a lost checkpoint replays what is still there, and nothing written goes away
    (inbox / "1.json").unlink()
    arrive(inbox, "4.json", [("e", "good")])
    assert run(spark, inbox, storage, tmp_path / "cp2") == (["a", "b", "c", "d", "e"], ["a", "c", "d", "e"])
    folders = {p.name for p in (tmp_path / "out" / "runs_v1").glob("batch=*")}
    assert len(folders) >= 6 and not any("None" in f for f in folders)
    # another version runs everything again
    assert run(spark, inbox, Storage("v2", str(tmp_path / "out")), tmp_path / "cp3")[0] == ["a", "c", "d", "e"]


def test_rows_without_an_id_are_set_apart(spark, tmp_path):
    inbox, storage, checkpoint = tmp_path / "in", Storage("v1", str(tmp_path / "out")), tmp_path / "cp"
    inbox.mkdir()
    arrive(inbox, "1.json", [("a", "good"), (None, "first"), (None, "second"), (None, "second")])
    for _ in range(2):
        assert run(spark, inbox, storage, checkpoint) == (["a"], ["a"])
        rejected = [(r["reject_reason"], json.loads(r["row"])["text"]) for r in spark.read.parquet(storage.rejected).collect()]
        assert sorted(rejected) == [("doc_id is required", t) for t in ("first", "second", "second")]


COLUMNS = IN.RUN_COLUMNS.format(id="bigint")


def run_batch(spark, path, key, ids, buckets=8):
    results = spark.createDataFrame([(i, "auto_accept") for i in ids], "doc_id bigint, verdict string")
    IN.write_batch(run_rows(results, Storage("v1", "/ledger")), path, key, buckets)


def stored(spark, path, buckets=None):
    return sorted((r["doc_id"], r["batch"]) for r in IN.read_ledger(spark, path, COLUMNS, buckets).collect())


def test_a_batch_reads_only_the_buckets_it_touches(spark, tmp_path):
    path = str(tmp_path / "runs")
    run_batch(spark, path, "q-0", range(100))
    run_batch(spark, path, "q-1", range(100, 150))
    IN.compact(spark, path, COLUMNS, buckets=8)
    run_batch(spark, path, "q-2", range(150, 200))
    ids = spark.range(200).select("id", IN.bucket_of(F.col("id"), 8).alias("b"))
    want = sorted(r["id"] for r in ids.filter("b IN (2, 5)").collect())
    read = IN.read_ledger(spark, path, COLUMNS, [2, 5])
    assert sorted(r["doc_id"] for r in read.collect()) == want
    scans = [line for line in read._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all(re.search(r"PartitionFilters: \[doc_bucket#\d+ IN \(2,5\)\]", line) for line in scans)
    assert stored(spark, path, []) == []


def test_merging_keeps_every_row_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    run_batch(spark, path, "q-0", [1, 2, 3])
    run_batch(spark, path, "q-1", [4])
    want = [(1, "q-0"), (2, "q-0"), (3, "q-0"), (4, "q-1")]

    def fails(*_):
        raise OSError("no manifest")

    with monkeypatch.context() as m:
        m.setattr(IN, "switch_manifest", fails)
        with pytest.raises(OSError):
            IN.compact(spark, path, COLUMNS)
    assert stored(spark, path) == want
    assert IN.compact(spark, path, COLUMNS) == 2 and stored(spark, path) == want
    assert IN.compact(spark, path, COLUMNS) == 0
    # a merged batch is replayed: its folder is written anew, and its rows are still there once
    run_batch(spark, path, "q-1", [4])
    assert stored(spark, path) == want
    run_batch(spark, path, "q-2", [5, 6])
    want += [(5, "q-2"), (6, "q-2")]
    assert IN.compact(spark, path, COLUMNS) == 1 and stored(spark, path) == want
    assert IN.remove_merged(spark, path) == 3 + 2 and stored(spark, path) == want
    assert len(list((tmp_path / "runs" / "_bases").iterdir())) == 1
    assert IN.compact(spark, path, COLUMNS) == 0 and IN.remove_merged(spark, path) == 0


def test_merged_documents_do_not_run_again(spark, tmp_path):
    inbox, storage, checkpoint = tmp_path / "in", Storage("v1", str(tmp_path / "out")), tmp_path / "cp"
    inbox.mkdir()
    arrive(inbox, "1.json", [("a", "good"), ("b", "bad")])
    assert run(spark, inbox, storage, checkpoint) == (["a", "b"], ["a"])
    IN.compact(spark, storage.runs, IN.RUN_COLUMNS.format(id="string"))
    IN.compact(spark, storage.extractions, IN.EXTRACTION_COLUMNS.format(id="string"))
    IN.remove_merged(spark, storage.runs)
    arrive(inbox, "2.json", [("a", "again"), ("b", "good now"), ("c", "good")])
    assert run(spark, inbox, storage, checkpoint) == (["a", "b", "c"], ["a", "c"])


def test_a_table_of_many_files_arrives_whole(spark, small, tmp_path):
    from docspark.plans import ledger

    spark.read.parquet(f"{small}/documents.parquet").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = {r["doc_id"]: r["verdict"] for r in ledger.ingest_stream(spark, small).collect()}
    assert want and {r["doc_id"]: r["verdict"] for r in ledger.ingest_stream(spark, str(tmp_path)).collect()} == want


def test_arrived_documents_lie_in_small_files(spark, tmp_path, monkeypatch):
    """The rows of a batch are dealt to many files, so the tasks that read them are even."""
    monkeypatch.setattr(IN, "ARRIVED_ROWS", 5)
    files, inbox = [], tmp_path / "in"
    inbox.mkdir()
    arrive(inbox, "1.json", [(str(i), "ok") for i in range(100)])

    def look(docs):
        files.append(len(docs.inputFiles()))
        return process(docs)

    stream = spark.readStream.schema("doc_id string, text string").json(str(inbox))
    storage = Storage("v1", str(tmp_path / "out"))
    IN.ingest(stream, look, storage, str(tmp_path / "checkpoint")).awaitTermination()
    assert files[0] >= 20 and IN.read_ledger(spark, storage.runs, IN.RUN_COLUMNS.format(id="string")).count() == 100
