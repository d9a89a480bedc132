"""Queries on ledgers, inputs and files, with events as run rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.operators import ledger as LE
from docspark.operators import noise as N
from docspark.operators import routing as RO
from docspark.plans import prose, quality, sqltext as S
from docspark.sources import files as FS
from docspark.sources import tables as T
from docspark.sources.scratch import scratch_path
from docspark.streaming import ingest as IN

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def event_runs(spark: SparkSession, d: str) -> DataFrame:
    """Events as run rows: the user is the document, the type gives the verdict."""
    kind = F.col("event_type")
    verdict = (
        F.when(kind.isin("view", "click"), F.lit("auto_accept"))
        .when(kind == "purchase", F.lit("sme_flag"))
        .when(kind == "error", F.lit("errored"))
    )
    return T.table(spark, d, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("user_id").alias("doc_id"),
        F.lit("v1").alias("pipeline_version"),
        verdict.alias("verdict"),
        F.concat(F.lit("from "), kind).alias("verdict_reason"),
        F.lit(0.0).alias("cost_usd"),
        F.round(F.col("value") * 1000).cast("bigint").alias("latency_ms"),
        F.concat(F.lit("artifacts/"), F.col("user_id").cast("string"), F.lit("/")).alias("artifacts_gcs_prefix"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("completed_at"),
    )


_RUNS = """
runs AS (SELECT event_id AS run_id, user_id AS doc_id, 'v1' AS pipeline_version,
  CASE WHEN event_type IN ('view', 'click') THEN 'auto_accept' WHEN event_type = 'purchase' THEN 'sme_flag' WHEN event_type = 'error' THEN 'errored' END AS verdict,
  'from ' || event_type AS verdict_reason, CAST(0 AS DOUBLE) AS cost_usd, CAST(round(value * 1000) AS BIGINT) AS latency_ms,
  'artifacts/' || user_id || '/' AS artifacts_gcs_prefix, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS completed_at FROM events)"""


@query
def latest_runs(spark, d):
    return LE.latest_runs(event_runs(spark, d))


ORACLE["latest_runs"] = f"""
WITH {_RUNS}
SELECT * EXCLUDE (rn) FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS runs,
  row_number() OVER (PARTITION BY doc_id ORDER BY completed_at DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1"""


@query
def recent_runs(spark, d):
    return LE.recent_runs(event_runs(spark, d)).select("run_id", "doc_id", "verdict", "completed_at")


ORACLE["recent_runs"] = f"""
WITH {_RUNS} SELECT run_id, doc_id, verdict, completed_at FROM runs ORDER BY completed_at DESC, run_id DESC LIMIT 200"""


@query
def run_summary(spark, d):
    return RO.run_summary(event_runs(spark, d))


ORACLE["run_summary"] = f"""
WITH {_RUNS} SELECT coalesce(verdict, '(none)') AS verdict, count(*) AS documents, CAST(sum(latency_ms) AS BIGINT) AS latency_ms FROM runs GROUP BY 1"""


@query
def batch_severity(spark, d):
    """Worst outcome of each hour, taken as a batch."""
    runs = event_runs(spark, d).withColumn("batch", F.substring("completed_at", 1, 13))
    return RO.severity(runs, "batch")


ORACLE["batch_severity"] = f"""
WITH {_RUNS} SELECT completed_at[1:13] AS batch, CAST(max(CASE verdict WHEN 'errored' THEN 2 WHEN 'sme_flag' THEN 1 ELSE 0 END) AS BIGINT) AS severity
FROM runs GROUP BY 1"""


@query
def usage_rollup(spark, d):
    """Conversation turns as agent calls: words in, words out, calls of tools."""
    n = F.size(F.split("text", "[ \n]+"))
    user = F.col("role") == "user"
    calls = T.table(spark, d, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        F.when(user, n).alias("tokens_input"),
        F.when(~user, n).alias("tokens_output"),
        (F.col("role") == "system").cast("int").alias("tool_calls"),
        (F.length("text") * 3).alias("latency_ms"),
    )
    return RO.usage_rollup(calls, "doc_id")


ORACLE["usage_rollup"] = """
SELECT conv_id AS doc_id, count(*) AS calls, CAST(coalesce(sum(CASE WHEN role = 'user' THEN n END), 0) AS BIGINT) AS tokens_input,
       CAST(coalesce(sum(CASE WHEN role <> 'user' THEN n END), 0) AS BIGINT) AS tokens_output,
       count(*) FILTER (WHERE role = 'system') AS tool_calls, CAST(sum(length(text) * 3) AS BIGINT) AS latency_ms
FROM (SELECT *, len(string_split_regex(text, '[ \n]+')) AS n FROM conversations) GROUP BY conv_id"""


@query
def pending_documents(spark, d):
    """Documents without a run under this version."""
    docs = T.table(spark, d, "documents").select("doc_id").withColumn("pipeline_version", F.lit("v1"))
    return FS.not_yet_done(docs, event_runs(spark, d))


ORACLE["pending_documents"] = """
SELECT doc_id, 'v1' AS pipeline_version FROM documents WHERE doc_id NOT IN (SELECT user_id FROM events)"""


def _run_and_extraction_rows(spark, d) -> tuple[DataFrame, DataFrame]:
    """Ledger rows for the latest run of each document, with its props as envelope."""
    storage = LE.Storage("v1", "/ledger")
    e = T.table(spark, d, "events").select(F.col("event_id").alias("run_id"), "props")
    results = LE.latest_runs(event_runs(spark, d)).drop("runs").join(e, "run_id").withColumn(
        "envelope", F.when(F.col("run_id") % 3 != 0, F.col("props"))
    )
    at = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    return LE.run_rows(results, storage, at), LE.extraction_rows(results, storage, at)


@query
def ledger_rows(spark, d):
    """The run row of every document and, if accepted, its extraction row."""
    runs, extractions = _run_and_extraction_rows(spark, d)
    e = extractions.select("run_id", "extraction_id", F.col("genomic_pathology_extraction").alias("envelope"))
    return runs.join(e, "run_id", "left").select(
        "run_id", "doc_id", "pipeline_version", "verdict", "verdict_reason", "cost_usd", "latency_ms", "preprocessing_errors",
        "artifacts_gcs_prefix", "envelope", "extraction_id",
    )


ORACLE["ledger_rows"] = f"""
WITH {_RUNS},
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY completed_at DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1)
SELECT run_id, doc_id, pipeline_version, verdict, verdict_reason, cost_usd, latency_ms, '[]' AS preprocessing_errors, artifacts_gcs_prefix,
  CASE WHEN verdict = 'auto_accept' AND run_id % 3 <> 0 THEN props END AS envelope,
  CASE WHEN verdict = 'auto_accept' AND run_id % 3 <> 0 THEN sha256(doc_id || chr(31) || 'v1' || chr(31) || 'extraction') END AS extraction_id
FROM last JOIN events ON event_id = run_id"""


@query
def run_results(spark, d):
    runs, extractions = _run_and_extraction_rows(spark, d)
    docs = T.table(spark, d, "documents").select("doc_id", F.concat(F.lit("in/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("uri"))
    return RO.run_results(docs, runs, extractions)


ORACLE["run_results"] = f"""
SELECT d.doc_id, 'in/' || d.doc_id || '.pdf' AS uri, pipeline_version, CASE WHEN run_id IS NULL THEN 'errored' ELSE verdict END AS verdict,
       coalesce(verdict_reason, '') AS verdict_reason, artifacts_gcs_prefix, run_id, extraction_id, coalesce(latency_ms, 0) AS latency_ms,
       coalesce(cost_usd, 0.0) AS cost_usd, CASE WHEN run_id IS NULL THEN 'no run row' END AS error
FROM documents d LEFT JOIN ({ORACLE["ledger_rows"]}) USING (doc_id)"""


# --- inputs ------------------------------------------------------------------


@query
def document_ids(spark, d):
    """Document ids of page addresses without their query part."""
    path = F.regexp_replace("url", "[?#].*$", "")
    uri = F.when(F.col("page_id") % 3 == 0, F.concat(path, F.lit(".tar.pdf"))).when(F.col("page_id") % 3 == 1, F.concat(path, F.lit("/"))).otherwise(path)
    return T.table(spark, d, "pages").select("page_id", FS.doc_id_of(uri).alias("doc_id"))


ORACLE["document_ids"] = """
WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS u FROM pages),
n AS (SELECT page_id, regexp_extract(CASE page_id % 3 WHEN 0 THEN u || '.tar.pdf' WHEN 1 THEN u || '/' ELSE u END, '([^/]*)$', 1) AS n FROM p)
SELECT page_id, coalesce(nullif(CASE WHEN position('.' IN n[2:]) > 0 THEN regexp_replace(n, '\\.[^.]*$', '') ELSE n END, ''), 'unknown') AS doc_id FROM n"""


@query
def first_inputs(spark, d):
    return FS.first_inputs(T.table(spark, d, "pages").select("page_id", F.concat("url", F.lit("-"), "page_id").alias("uri")), 25)


ORACLE["first_inputs"] = "SELECT page_id, url || '-' || page_id AS uri FROM pages ORDER BY uri LIMIT 25"


@query
def input_gate(spark, d):
    k = F.col("page_id")
    inputs = T.table(spark, d, "pages").select(
        F.when(k % 11 != 0, k.cast("string")).alias("doc_id"),
        F.when(k % 7 == 0, F.lit("v2")).when(k % 13 != 0, F.lit("v1")).alias("pipeline_version"),
        F.when(k % 3 == 0, F.concat("url", F.lit(".PDF"))).when(k % 3 == 1, F.col("url")).alias("uri"),
        F.when((k % 3 == 2) & (k % 2 == 0) | (k % 17 == 0), F.encode("html", "UTF-8")).alias("content"),
        "page_id",
    )
    gated = FS.gate_inputs(inputs)
    good, bad = FS.split_gated(gated)
    return good.withColumn("reject_reason", F.lit("accepted")).unionByName(bad).select("page_id", "reject_reason")


ORACLE["input_gate"] = """
SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 'doc_id missing' WHEN page_id % 7 <> 0 AND page_id % 13 = 0 THEN 'pipeline_version missing'
  WHEN page_id % 7 = 0 THEN 'unsupported pipeline_version' WHEN page_id % 3 = 2 AND NOT (page_id % 2 = 0 OR page_id % 17 = 0) THEN 'no source'
  WHEN page_id % 3 <> 2 AND page_id % 17 = 0 THEN 'two sources' WHEN page_id % 3 = 1 THEN 'not a PDF' ELSE 'accepted' END AS reject_reason FROM pages"""


def _event_lines(spark, d) -> DataFrame:
    """Run rows as JSON lines; some are blank, some cut short."""
    r = event_runs(spark, d)
    k = F.col("run_id")
    line = F.to_json(F.struct(k.cast("string").alias("run_id"), F.col("doc_id").cast("string").alias("doc_id"), "verdict", "latency_ms"))
    text = F.when(k % 20 == 7, F.lit("   ")).when(k % 20 == 11, F.left(line, F.length(line) - 5)).otherwise(line)
    return r.select(k.alias("line_no"), text.alias("line"))


@query
def bad_lines(spark, d):
    return FS.bad_line_count(FS.parse_json_lines(_event_lines(spark, d), "run_id string, doc_id string, verdict string, latency_ms bigint"))


ORACLE["bad_lines"] = """
SELECT count(*) FILTER (WHERE event_id % 20 NOT IN (7, 11)) AS good, count(*) FILTER (WHERE event_id % 20 = 11) AS bad FROM events"""


@query
def ledger_lines(spark, d):
    return FS.good_rows(FS.parse_json_lines(_event_lines(spark, d), "run_id string, doc_id string, verdict string, latency_ms bigint"))


ORACLE["ledger_lines"] = f"""
WITH {_RUNS} SELECT run_id AS line_no, CAST(run_id AS VARCHAR) AS run_id, CAST(doc_id AS VARCHAR) AS doc_id, verdict, latency_ms
FROM runs WHERE run_id % 20 NOT IN (7, 11)"""


@query
def gold_precedence(spark, d):
    """Labels win over documents as the source of a gold value."""
    first = T.table(spark, d, "labels").select("doc_id", F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("gold"))
    second = T.table(spark, d, "documents").select("doc_id", F.concat(F.lit("lang "), "lang").alias("gold"))
    return FS.by_precedence([first, second])


ORACLE["gold_precedence"] = """
SELECT doc_id, CASE WHEN quality IS NOT NULL THEN 'quality ' || quality ELSE 'lang ' || lang END AS gold FROM documents LEFT JOIN labels USING (doc_id)"""


@query
def dual_shape(spark, d):
    """Envelopes that are wrapped, bare, or hold no record."""
    k = F.col("c_custkey")
    record = F.concat(F.lit('{"report_metadata":{"name":"'), "c_name", F.lit('"}}'))
    env = F.when(k % 3 == 0, F.concat(F.lit('{"genomic_pathology_extraction":'), record, F.lit("}"))).when(k % 3 == 1, record).otherwise(F.lit('{"other":1}'))
    return T.table(spark, d, "customer").select("c_custkey", FS.metadata_of(env).alias("record"))


ORACLE["dual_shape"] = """
SELECT c_custkey, CASE WHEN c_custkey % 3 < 2 THEN '{"name":"' || c_name || '"}' END AS record FROM customer"""


@query
def artifact_presence(spark, d):
    """Kinds of artifact a document (user) has: event types by the size of their value."""
    events = T.table(spark, d, "events")
    kind = F.concat_ws("-", "event_type", F.floor(F.col("value") / 20).cast("string"))
    a = events.select(F.col("user_id").alias("doc_id"), kind.alias("kind"))
    users = events.select(F.col("user_id").alias("doc_id")).distinct()
    return FS.artifact_presence(users, a, ("view-0", "click-3", "error-5"))


ORACLE["artifact_presence"] = """
SELECT doc_id, kind, bool_or(event_type || '-' || CAST(floor(value / 20) AS BIGINT) = kind) AS present
FROM (SELECT DISTINCT user_id AS doc_id, unnest(['view-0', 'click-3', 'error-5']) AS kind FROM events) JOIN events ON user_id = doc_id GROUP BY ALL"""


# --- streaming ---------------------------------------------------------------


@query
def artifact_upsert(spark, d):
    """Artifacts of all documents, then new ones for every third: the others stay."""
    storage = LE.Storage("v1", scratch_path(spark, "artifacts"))
    docs = T.table(spark, d, "documents").select("doc_id", F.length("text").alias("chars"))
    content = lambda chars: F.to_json(F.struct(chars.alias("chars"))).alias("content")
    LE.write_artifacts(docs.select("doc_id", content(F.col("chars"))), storage, "blocks", buckets=16)
    LE.write_artifacts(docs.filter(F.col("doc_id") % 3 == 0).select("doc_id", content(F.col("chars") + 1)), storage, "blocks", buckets=16)
    return LE.read_artifact_table(spark, storage.artifacts("blocks")).select("doc_id", "content")


ORACLE["artifact_upsert"] = """
SELECT doc_id, '{"chars":' || (length(text) + CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END) || '}' AS content FROM documents"""


@query
def artifact_content(spark, d):
    """JSON artifacts read back from their table as variants, some of them cut short."""
    storage = LE.Storage("v1", scratch_path(spark, "artifacts"))
    k = F.col("event_id")
    content = F.when(k % 9 == 4, F.left("props", F.length("props") - 1)).otherwise(F.col("props"))
    LE.write_artifacts(T.table(spark, d, "events").select(k.alias("doc_id"), content.alias("content")), storage, "props", buckets=16)
    back = FS.parsed_artifacts(FS.read_artifacts(spark, storage.artifacts("props").removesuffix("/props"), "props"))
    return back.select("doc_id", F.try_variant_get("content", "$.k", "bigint").alias("k"), F.col("content").isNull().alias("unreadable"))


ORACLE["artifact_content"] = """
SELECT event_id AS doc_id, CASE WHEN event_id % 9 <> 4 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k, event_id % 9 = 4 AS unreadable FROM events"""


@query
def latest_extractions(spark, d):
    """Orders as extractions of their customers in JSON lines files, some lines cut: the last one of each that can be read."""
    path = scratch_path(spark, "extractions")
    row = F.struct(
        F.concat(F.lit("x"), F.col("o_orderkey").cast("string")).alias("extraction_id"),
        F.col("o_custkey").cast("string").alias("doc_id"),
        F.col("o_orderpriority").alias("genomic_pathology_extraction"),
        F.col("o_orderdate").cast("date").cast("string").alias("extracted_at"),
    )
    line = F.to_json(row)
    cut = F.when(F.col("o_orderkey") % 13 == 5, F.left(line, F.length(line) - 4)).otherwise(line)
    T.table(spark, d, "orders").select(cut.alias("value")).write.text(path)
    return FS.read_latest_extractions(spark, path).select("doc_id", "extraction_id", "genomic_pathology_extraction", "extracted_at")


ORACLE["latest_extractions"] = """
SELECT CAST(o_custkey AS VARCHAR) AS doc_id, 'x' || o_orderkey AS extraction_id, o_orderpriority AS genomic_pathology_extraction,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS extracted_at
FROM orders WHERE o_orderkey % 13 <> 5
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, 'x' || o_orderkey DESC) = 1"""


def arriving(spark: SparkSession, d: str) -> DataFrame:
    """The documents as a file stream. The path is a pattern, since a stream takes a single file only by a pattern, and a folder too."""
    return spark.readStream.schema("doc_id bigint, text string").parquet(f"{d}/documents.parque[t]")


def judge(docs: DataFrame) -> DataFrame:
    """Results of prose documents: any noise line sends a document to review."""
    lines = F.split("text", "\n", -1)
    noisy = F.exists(lines, lambda t: N.is_noise(t, T.PROSE_NOISE))
    envelope = F.to_json(F.struct(F.size(lines).alias("lines"), F.length("text").alias("chars")))
    return docs.select("doc_id", noisy.alias("noisy"), envelope.alias("envelope")).select(
        "doc_id",
        F.when(F.col("noisy"), F.lit("sme_flag")).otherwise(F.lit("auto_accept")).alias("verdict"),
        F.when(F.col("noisy"), F.lit("noise found")).otherwise(F.lit("clean")).alias("verdict_reason"),
        "envelope",
    )


@query
def ingest_stream(spark, d):
    """Documents as a file stream into the ledgers, read back from there."""
    root = scratch_path(spark, "ingest")
    storage = LE.Storage("v1", root)
    IN.ingest(arriving(spark, d), judge, storage, f"{root}/checkpoint").awaitTermination()
    runs = IN.read_ledger(spark, storage.runs, IN.RUN_COLUMNS.format(id="bigint"))
    extractions = IN.read_ledger(spark, storage.extractions, IN.EXTRACTION_COLUMNS.format(id="bigint"))
    return runs.join(extractions.select("run_id", F.col("genomic_pathology_extraction").alias("envelope")), "run_id", "left").select(
        "doc_id", "pipeline_version", "verdict", "verdict_reason", "envelope"
    )


ORACLE["ingest_stream"] = f"""
WITH {S.LINES},
d AS (SELECT doc_id, bool_or(t <> '' AND {prose._NOISE_SQL}) AS noisy, count(*) AS n, CAST(sum(length(text)) + count(*) - 1 AS BIGINT) AS chars
      FROM (SELECT *, {S.strip("text")} AS t FROM lines) GROUP BY doc_id)
SELECT doc_id, 'v1' AS pipeline_version, CASE WHEN noisy THEN 'sme_flag' ELSE 'auto_accept' END AS verdict,
       CASE WHEN noisy THEN 'noise found' ELSE 'clean' END AS verdict_reason,
       CASE WHEN NOT noisy THEN '{{"lines":' || n || ',"chars":' || chars || '}}' END AS envelope FROM d"""


@query
def merged_ledger(spark, d):
    """Events as run rows of four batches, the first three merged, the last one read by its hash buckets."""
    path = LE.Storage("v1", scratch_path(spark, "merged")).runs
    columns = IN.RUN_COLUMNS.format(id="bigint")
    e = event_runs(spark, d).withColumn("run_id", F.col("run_id").cast("string"))
    for n in range(4):
        if n == 3:
            IN.compact(spark, path, columns, buckets=16)
        IN.write_batch(LE.run_rows(e.where(F.col("doc_id") % 4 == n), LE.Storage("v1", "/ledger")), path, f"b{n}", buckets=16)
    old = IN.read_ledger(spark, path, columns).where("batch <> 'b3'")
    new = IN.read_ledger(spark, path, columns, range(16)).where("batch = 'b3'")
    return old.unionByName(new).groupBy("doc_id", "batch").agg(F.count("*").alias("runs"), F.max("latency_ms").alias("slowest"))


ORACLE["merged_ledger"] = f"""
WITH {_RUNS} SELECT doc_id, 'b' || doc_id % 4 AS batch, count(*) AS runs, max(latency_ms) AS slowest FROM runs GROUP BY ALL"""


@query
def ingest_documents(spark, d):
    """Documents as a file stream through the whole plan into the ledgers: the stored verdicts equal those of the batch."""
    root = scratch_path(spark, "ingest")
    storage = LE.Storage("v1", root)
    IN.ingest(arriving(spark, d), quality.prose_results, storage, f"{root}/checkpoint").awaitTermination()
    runs = IN.read_ledger(spark, storage.runs, IN.RUN_COLUMNS.format(id="bigint"))
    extractions = IN.read_ledger(spark, storage.extractions, IN.EXTRACTION_COLUMNS.format(id="bigint"))
    stored = quality.result_columns(extractions.select("run_id", F.col("genomic_pathology_extraction").alias("envelope")))
    return runs.join(stored, "run_id", "left").select(
        "doc_id", "pipeline_version", "verdict", "verdict_reason", "verifier_scorecards", "practice", "last_name", "pages"
    )


ORACLE["ingest_documents"] = f"""{quality._RESULTS}
SELECT doc_id, 'v1' AS pipeline_version, verdict, verdict_reason, verifier_scorecards, CASE WHEN verdict = 'auto_accept' THEN practice END AS practice,
       CASE WHEN verdict = 'auto_accept' THEN last_name END AS last_name, CASE WHEN verdict = 'auto_accept' THEN pages END AS pages FROM results"""
