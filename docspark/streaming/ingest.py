"""Newly arrived documents through a per-document plan into the ledgers, once each."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docspark.operators.ledger import (
    Storage,
    delete_folder,
    extraction_rows,
    folder_exists,
    list_folder,
    read_manifest,
    run_rows,
    switch_manifest,
)
from docspark.sources.scratch import stage

#: Hash buckets of the run ledger.
BUCKETS = 64

#: Rows in a file of the documents of a batch.
ARRIVED_ROWS = 2000

RUN_COLUMNS = (
    "run_id string, doc_id {id}, pipeline_version string, verdict string, verdict_reason string, cost_usd double, "
    "latency_ms bigint, otel_trace_id string, preprocessing_errors string, verifier_scorecards string, "
    "artifacts_gcs_prefix string, completed_at timestamp"
)
EXTRACTION_COLUMNS = (
    "extraction_id string, run_id string, doc_id {id}, pipeline_version string, genomic_pathology_extraction string, extracted_at timestamp"
)


BATCHES = "batch="
BASES = "_bases"


def _merged(spark: SparkSession, path: str) -> dict:
    """The newest manifest of a ledger: the folder of merged rows and the batches that are in it."""
    return read_manifest(spark, path) or {"number": 0, "base": None, "batches": []}


def read_ledger(spark: SparkSession, path: str, columns: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """All rows of a ledger, with the batch that wrote them.

    Merged rows come from the folder that the newest manifest names, later ones
    from the folders of their batches. ``buckets`` reads only rows of these hash
    buckets of documents: other folders are not opened.
    """
    now = _merged(spark, path)
    reader = spark.read.schema(columns + ", batch string, doc_bucket int")
    merged = set(now["batches"])
    live = [f"{path}/{f}" for f in list_folder(spark, path) if f.startswith(BATCHES) and f.removeprefix(BATCHES) not in merged]
    parts = [reader.option("basePath", path).parquet(*live)] if live else []
    if now["base"]:
        parts.append(reader.parquet(f"{path}/{BASES}/{now['base']}"))
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], columns + ", batch string, doc_bucket int")
    if buckets is not None:
        rows = rows.where(F.col("doc_bucket").isin(*buckets) if buckets else F.lit(False))
    return rows.drop("doc_bucket")


def bucket_of(doc_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(buckets)).cast("int")


def _batch_key(spark: SparkSession, batch_id: int) -> str:
    """Names a batch across restarts: batches count per query, and a query keeps
    its id as long as its checkpoint lives."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}"


def write_batch(rows: DataFrame, path: str, key: str, buckets: int | None = None) -> None:
    """Write the rows of one batch to a folder of its own; a replay replaces it.

    With ``buckets``, rows lie in a folder for each hash bucket of documents.
    """
    folder = f"{path}/{BATCHES}{key}"
    if buckets is None:
        rows.write.mode("overwrite").parquet(folder)
    else:
        _bucketed(rows, buckets).write.mode("overwrite").partitionBy("doc_bucket").parquet(folder)


def _bucketed(rows: DataFrame, buckets: int, parts: int = 1) -> DataFrame:
    placed = rows.withColumn("doc_bucket", bucket_of(F.col("doc_id"), buckets))
    return placed.repartition("doc_bucket", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(parts)))


def compact(spark: SparkSession, path: str, columns: str, buckets: int = BUCKETS, parts: int = 8) -> int:
    """Merge the batches of a ledger into one folder for each hash bucket. Gives the number of batches merged.

    The merged rows are written beside, and a manifest that names them and the
    batches in them is switched last, so readers see every row once whatever fails
    in between. Rows keep the batch that wrote them: a replay of a merged batch
    writes its old folder anew, which nobody reads. One compaction at a time; one that finds another's manifest in its
    place fails. Old folders stay for running readers until :func:`remove_merged`.
    """
    now = _merged(spark, path)
    names = [f.removeprefix(BATCHES) for f in list_folder(spark, path) if f.startswith(BATCHES)]
    fresh = [n for n in names if n not in set(now["batches"])]
    if not fresh:
        return 0
    base = f"base-{now['number'] + 1:010d}-{uuid.uuid4().hex[:8]}"
    # one listing decides: a batch that arrives meanwhile is in neither the rows nor the manifest
    reader = spark.read.schema(columns + ", batch string, doc_bucket int")
    rows = reader.option("basePath", path).parquet(*[f"{path}/{BATCHES}{n}" for n in fresh])
    if now["base"]:
        rows = rows.unionByName(reader.parquet(f"{path}/{BASES}/{now['base']}"))
    _bucketed(rows, buckets, parts).write.partitionBy("doc_bucket").parquet(f"{path}/{BASES}/{base}")
    switch_manifest(spark, path, {"number": now["number"] + 1, "base": base, "batches": sorted({*now["batches"], *fresh})})
    return len(fresh)


def remove_merged(spark: SparkSession, path: str) -> int:
    """Delete folders of merged batches and older merged folders, for times when nobody reads them. Gives their number."""
    now = _merged(spark, path)
    merged = set(now["batches"])
    old = [f for f in list_folder(spark, path) if f.removeprefix(BATCHES) in merged]
    bases = [f"{BASES}/{b}" for b in list_folder(spark, f"{path}/{BASES}") if b != now["base"]]
    for name in [*old, *bases]:
        delete_folder(spark, f"{path}/{name}")
    return len(old) + len(bases)


def first_copies(batch: DataFrame) -> DataFrame:
    """One row per document: of several copies always the same one, whatever order a replay reads them in."""
    rest = F.struct(*[c for c in batch.columns if c != "doc_id"])
    text = F.to_json(rest)
    one = batch.groupBy("doc_id").agg(F.min_by(rest, F.struct(F.xxhash64(text), text)).alias("row"))
    return one.select("doc_id", "row.*").select(*batch.columns)


def ingest(
    arrivals: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    storage: Storage,
    checkpoint: str,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Start the job over what has arrived and stop when it is done.

    ``arrivals`` is a stream with ``doc_id``. ``process`` maps the new documents
    of a batch to results with ``verdict``, ``verdict_reason`` and ``envelope``.
    Documents that another batch has run under this version are left out, and of
    several copies in one batch one is taken. Every batch owns a folder in both
    ledgers that a replay overwrites, so each document has one run row and at
    most one extraction row whatever fails in between. Run rows lie in hash
    buckets of documents, and a batch reads only those that it touches;
    ``buckets`` must stay the same for the life of a ledger. :func:`compact`
    merges the folders of many batches.
    """
    spark = arrivals.sparkSession
    id_type = arrivals.schema["doc_id"].dataType.simpleString()
    run_columns = RUN_COLUMNS.format(id=id_type)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        key = _batch_key(spark, batch_id)
        nameless = F.col("doc_id").isNull()
        rejected = batch.where(nameless).select(F.lit("doc_id is required").alias("reject_reason"), F.to_json(F.struct("*")).alias("row"))
        if not rejected.isEmpty():
            write_batch(rejected, storage.rejected, key)
        new = first_copies(batch.where(~nameless))
        if folder_exists(spark, storage.runs):
            ids = stage(batch.where(~nameless).select("doc_id").distinct().withColumn("doc_bucket", bucket_of(F.col("doc_id"), buckets)), "arrived-ids")
            touched = [r[0] for r in ids.select("doc_bucket").distinct().collect()]  # at most one per bucket
            done = read_ledger(spark, storage.runs, run_columns, touched).filter(
                (F.col("batch") != key) & (F.col("pipeline_version") == storage.version)
            )
            # the ledger meets the ids of the batch first, so what the texts meet is no longer than the batch
            known = done.select("doc_id").join(ids.select("doc_id"), "doc_id", "left_semi")
            new = new.join(known, "doc_id", "left_anti")
        results = process(stage(new, "arrived", ARRIVED_ROWS)).persist()
        try:
            write_batch(extraction_rows(results, storage), storage.extractions, key)
            write_batch(run_rows(results, storage), storage.runs, key, buckets)
        finally:
            results.unpersist()

    return (
        arrivals.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
