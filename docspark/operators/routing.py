"""Verdicts per document and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.vocab import AUTO_ACCEPT_CONFIDENCE


def route(docs: DataFrame, threshold: float = AUTO_ACCEPT_CONFIDENCE) -> DataFrame:
    """Add ``verdict``, ``verdict_reason`` and ``confidence_missing``.

    ``docs`` has ``team_verdict, team_reason, passed, verifier_name, n_errors,
    notes, confidence``. First match wins: team flag, failed scorecard, low
    confidence, accept. A missing confidence is accepted, and marked.
    """
    conf = F.col("confidence")
    flagged = F.coalesce(F.col("team_verdict") == "sme_flag", F.lit(False))
    failed = ~F.coalesce("passed", F.lit(True))
    low = F.coalesce(conf < threshold, F.lit(False))
    limit = F.format_string("%.2f", F.lit(float(threshold)))
    reason = (
        F.when(flagged, F.concat(F.lit("Team emitted sme_flag: "), F.coalesce(F.nullif("team_reason", F.lit("")), F.lit("(no reason)"))))
        .when(
            failed,
            F.concat(
                F.lit("Verifier '"),
                F.coalesce("verifier_name", F.lit("?")),
                F.lit("' failed with "),
                F.coalesce("n_errors", F.lit(0)).cast("string"),
                F.lit(" error(s): "),
                F.coalesce("notes", F.lit("")),
            ),
        )
        .when(low, F.concat(F.lit("llm_confidence_score="), F.format_string("%.2f", conf), F.lit(" is below auto-accept threshold "), limit))
        .otherwise(
            F.concat(
                F.lit("All verifiers passed and llm_confidence_score ("),
                F.coalesce(conf.cast("string"), F.lit("<absent>")),
                F.lit(") is at least "),
                limit,
            )
        )
    )
    return docs.select(
        "*",
        F.when(flagged | failed | low, F.lit("sme_flag")).otherwise(F.lit("auto_accept")).alias("verdict"),
        reason.alias("verdict_reason"),
        conf.isNull().alias("confidence_missing"),
    )


def run_summary(runs: DataFrame) -> DataFrame:
    """Documents and total latency per verdict; no verdict counts as ``(none)``."""
    return runs.groupBy(F.coalesce("verdict", F.lit("(none)")).alias("verdict")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum("latency_ms").alias("latency_ms")
    )


def severity(runs: DataFrame, *keys: str) -> DataFrame:
    """Worst outcome per group: 2 if any run errored, 1 if any was flagged, else 0."""
    level = F.when(F.col("verdict") == "errored", 2).when(F.col("verdict") == "sme_flag", 1).otherwise(0)
    return runs.groupBy(*keys).agg(F.max(level).alias("severity"))


def usage_rollup(calls: DataFrame, *keys: str) -> DataFrame:
    """Tokens, tool calls and latency summed over the agent calls of a document."""
    names = ("tokens_input", "tokens_output", "tool_calls", "latency_ms")
    return calls.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("calls"), *[F.sum(F.coalesce(n, F.lit(0))).alias(n) for n in names]
    )


def run_results(inputs: DataFrame, runs: DataFrame, extractions: DataFrame) -> DataFrame:
    """Final row per input document, from its run and its extraction if any.

    A document without a run has verdict ``errored``.
    """
    e = extractions.select("run_id", "extraction_id")
    r = runs.select("doc_id", "run_id", "pipeline_version", "verdict", "verdict_reason", "artifacts_gcs_prefix", "latency_ms", "cost_usd")
    # runs meet their extractions first: after the outer join, inputs without a
    # run would share one null key
    return (
        inputs.join(r.join(e, "run_id", "left"), "doc_id", "left")
        .select(
            "doc_id",
            "uri",
            "pipeline_version",
            F.when(F.col("run_id").isNull(), F.lit("errored")).otherwise(F.col("verdict")).alias("verdict"),
            F.coalesce("verdict_reason", F.lit("")).alias("verdict_reason"),
            "artifacts_gcs_prefix",
            "run_id",
            "extraction_id",
            F.coalesce("latency_ms", F.lit(0)).alias("latency_ms"),
            F.coalesce("cost_usd", F.lit(0.0)).alias("cost_usd"),
            F.when(F.col("run_id").isNull(), F.lit("no run row")).alias("error"),
        )
    )
