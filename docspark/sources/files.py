"""Reading inputs, ledgers, artifacts and gold records from files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.text import is_blank
from docspark.operators.ledger import latest_per_key, read_artifact_table, recent_runs

CORRUPT = "_corrupt_record"

RUNS_SCHEMA = (
    "run_id string, doc_id string, pipeline_version string, verdict string, verdict_reason string, "
    "cost_usd double, latency_ms bigint, otel_trace_id string, preprocessing_errors string, "
    "verifier_scorecards string, artifacts_gcs_prefix string, completed_at string"
)
EXTRACTIONS_SCHEMA = (
    "extraction_id string, run_id string, doc_id string, pipeline_version string, "
    "genomic_pathology_extraction string, extracted_at string"
)


# --- input documents ---------------------------------------------------------


def list_inputs(spark: SparkSession, path: str) -> DataFrame:
    """PDF files under a path, whatever the case of their extension; content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[pP][dD][fF]")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("uri"), "length")
        .withColumn("doc_id", doc_id_of(F.col("uri")))
    )


def read_inputs(spark: SparkSession, path: str) -> DataFrame:
    """PDF files under a path with their bytes."""
    df = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[pP][dD][fF]")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return df.select(doc_id_of(F.col("path")).alias("doc_id"), F.col("path").alias("uri"), "length", "content")


def first_inputs(inputs: DataFrame, limit: int) -> DataFrame:
    """The first inputs in order of their path."""
    return inputs.orderBy("uri").limit(limit)


def doc_id_of(uri: Column) -> Column:
    """File name without its last suffix; ``unknown`` if that is empty."""
    name = F.regexp_extract(uri, r"([^/]*)$", 1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    return F.coalesce(F.nullif(stem, F.lit("")), F.lit("unknown"))


def gate_inputs(inputs: DataFrame, version: str = "v1") -> DataFrame:
    """Add ``reject_reason`` to ``inputs(doc_id, pipeline_version, uri, content)``.

    Null means accepted. Exactly one of uri and content must be given, a uri
    must name a PDF, the id must be there and the version must be known.
    """
    has_uri = F.coalesce("uri", F.lit("")) != ""
    has_content = F.coalesce(F.length("content"), F.lit(0)) > 0
    reason = (
        F.when(F.coalesce("doc_id", F.lit("")) == "", F.lit("doc_id missing"))
        .when(F.coalesce("pipeline_version", F.lit("")) == "", F.lit("pipeline_version missing"))
        .when(F.col("pipeline_version") != version, F.lit("unsupported pipeline_version"))
        .when(~has_uri & ~has_content, F.lit("no source"))
        .when(has_uri & has_content, F.lit("two sources"))
        .when(has_uri & ~F.lower("uri").endswith(".pdf"), F.lit("not a PDF"))
    )
    return inputs.withColumn("reject_reason", reason)


def split_gated(gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and quarantined inputs."""
    bad = F.col("reject_reason").isNotNull()
    return gated.filter(~bad).drop("reject_reason"), gated.filter(bad)


def not_yet_done(inputs: DataFrame, runs: DataFrame, *keys: str) -> DataFrame:
    """Inputs without a run; ``keys`` default to the document and the version."""
    on = list(keys or ("doc_id", "pipeline_version"))
    return inputs.join(runs.select(*on), on, "left_anti")


# --- JSON lines --------------------------------------------------------------


def _with_corrupt(schema: str | T.StructType) -> T.StructType:
    base = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    return T.StructType([*base.fields, T.StructField(CORRUPT, T.StringType())])


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a fixed schema; blank lines are skipped, bad ones marked."""
    return (
        spark.read.schema(_with_corrupt(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def parse_json_lines(lines: DataFrame, schema: str, column: str = "line") -> DataFrame:
    """The same for JSON lines that are already rows."""
    row = F.from_json(
        column, _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    others = [c for c in lines.columns if c != column]
    return lines.filter(~is_blank(F.col(column))).select(*others, row.alias("row")).select(*others, "row.*")


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_line_count(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("good"), F.count_if(F.col(CORRUPT).isNotNull()).alias("bad")
    )


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return good_rows(read_json_lines(spark, path, RUNS_SCHEMA))


def read_latest_extractions(spark: SparkSession, path: str) -> DataFrame:
    """The last extraction of each document, by time and then id."""
    rows = good_rows(read_json_lines(spark, path, EXTRACTIONS_SCHEMA))
    return latest_per_key(rows, ["doc_id"], ["extracted_at", "extraction_id"])


# --- ledgers in a warehouse ---


def warehouse_runs(spark: SparkSession, table: str, limit: int = 200) -> DataFrame:
    """The newest runs of a catalog table."""
    return recent_runs(spark.table(table), limit)


def warehouse_extractions(spark: SparkSession, table: str, doc_ids: DataFrame | None = None) -> DataFrame:
    """The last extraction of each document of a catalog table, or of some documents."""
    rows = spark.table(table)
    if doc_ids is not None:
        rows = rows.join(doc_ids, "doc_id", "left_semi")
    return latest_per_key(rows, ["doc_id"], ["extracted_at", "extraction_id"])


# --- gold records and envelopes ----------------------------------------------


def by_precedence(sources: Sequence[DataFrame], key: str = "doc_id") -> DataFrame:
    """Rows of the first source that has their key."""
    out = None
    for i, df in enumerate(sources):
        ranked = df.withColumn("_prio", F.lit(i))
        out = ranked if out is None else out.unionByName(ranked, allowMissingColumns=True)
    rest = [c for c in out.columns if c not in (key, "_prio")]
    best = out.groupBy(key).agg(F.min_by(F.struct(*rest), "_prio").alias("row"))
    return best.select(key, "row.*")


def read_gold(spark: SparkSession, *paths: str) -> DataFrame:
    """Gold records of one JSON file per document, earlier paths winning.

    Gives ``doc_id``, the ``source`` file and the ``record`` as JSON.
    """

    def one(path: str) -> DataFrame:
        raw = spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
        return raw.select(
            doc_id_of(F.col("_metadata.file_path")).alias("doc_id"),
            F.col("_metadata.file_path").alias("source"),
            metadata_of(F.col("value")).alias("record"),
        )

    return by_precedence([one(p) for p in paths])


def metadata_of(envelope: Column) -> Column:
    """The record inside an envelope, wrapped or bare; null if there is none."""
    wrapped = F.get_json_object(envelope, "$.genomic_pathology_extraction.report_metadata")
    has_wrapper = F.get_json_object(envelope, "$.genomic_pathology_extraction").isNotNull()
    return F.when(has_wrapper, wrapped).otherwise(F.get_json_object(envelope, "$.report_metadata"))


# --- artifacts ---------------------------------------------------------------


def read_artifacts(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The artifact table of one kind, as its newest manifest has it."""
    return read_artifact_table(spark, f"{root}/{kind}")


def parsed_artifacts(artifacts: DataFrame) -> DataFrame:
    """JSON artifacts as variants; null where the content is not readable."""
    return artifacts.withColumn("content", F.try_parse_json("content"))


def artifact_presence(docs: DataFrame, artifacts: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Which kinds of artifact exist per document.

    ``artifacts(doc_id, kind)``; one aggregation instead of a join per kind.
    """
    have = artifacts.groupBy("doc_id").agg(*[F.bool_or(F.col("kind") == k).alias(f"_{k}") for k in kinds])
    rows = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.coalesce(f"_{k}", F.lit(False)).alias("present")) for k in kinds]
    )
    return docs.select("doc_id").join(have, "doc_id", "left").select("doc_id", F.inline_outer(rows))
