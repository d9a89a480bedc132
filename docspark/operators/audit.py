"""Coverage audit of records and the resolution of conflicts.

Records are in long form here: ``rows(doc_id, field, value, block_id)``, one
row per field, ``value`` null where nothing was extracted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.text import text_key
from docspark.vocab import COVERAGE_GAP_TOLERANCE, RECORD_FIELDS, UNSCORED_FIELDS


def record_rows(records: DataFrame) -> DataFrame:
    """Wide records in long form, one row per record field."""
    names = [f for f in RECORD_FIELDS if f in records.columns]
    block = (lambda f: F.col("provenance")[f]["block_id"]) if "provenance" in records.columns else (lambda f: F.lit(None).cast("string"))
    rows = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"), block(f).alias("block_id")) for f in names]
    )
    return records.select("doc_id", F.inline_outer(rows))


def missed_fields(cands: DataFrame, rows: DataFrame) -> DataFrame:
    """Fields without a value although a candidate for them is in the source.

    The first candidate in text order stands for the field.
    """
    offers = (
        cands.filter(F.col("field_hint").isNotNull())
        .groupBy("doc_id", F.col("field_hint").alias("field"))
        .agg(F.min(F.struct("text_key", "text", "evidence_block")).alias("c"))
        .select("doc_id", "field", F.col("c.text").alias("source_value"), F.col("c.evidence_block").alias("evidence_block"))
    )
    return offers.join(rows.filter(F.col("value").isNotNull()).select("doc_id", "field"), ["doc_id", "field"], "left_anti")


def grounded_fields(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Fields whose value is contained in a block that they cite.

    An inner join: it can be planned from the side of the few values, which an
    outer join could not, so the block texts need not travel.
    """
    cited = rows.filter(F.col("value").isNotNull()).select("doc_id", "field", "value", "block_id")
    texts = blocks.select("doc_id", "block_id", F.col("text").alias("block_text"))
    found = F.contains(text_key(F.col("block_text")), text_key(F.col("value")))
    return texts.join(cited, ["doc_id", "block_id"]).filter(found).select("doc_id", "field")


def spurious_fields(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Values that the block they cite does not contain, or that cite no known block."""
    cited = rows.filter(F.col("value").isNotNull()).select("doc_id", "field", "value", "block_id")
    return cited.join(grounded_fields(rows, blocks), ["doc_id", "field"], "left_anti")


def checklist_misses(cands: DataFrame, rows: DataFrame) -> DataFrame:
    """Candidates whose text is no extracted value."""
    values = rows.filter(F.col("value").isNotNull()).select("doc_id", text_key(F.col("value")).alias("text_key"))
    return cands.join(values, ["doc_id", "text_key"], "left_anti")


def coverage_gap(candidates: Column, extracted: Column, tolerance: float = COVERAGE_GAP_TOLERANCE) -> Column:
    """True if far fewer values were extracted than candidates were seen."""
    return (candidates - extracted) / F.greatest(candidates, F.lit(1)) > tolerance


def audit(
    docs: DataFrame,
    cands: DataFrame,
    rows: DataFrame,
    blocks: DataFrame,
    tolerance: float = COVERAGE_GAP_TOLERANCE,
) -> DataFrame:
    """One audit row per document.

    Everything the audit knows is a tagged row: a candidate or a value under its
    text, an offer, a value or a grounded value under its field. One aggregation by
    document and tag finds what is missing on either side, a second one counts,
    so no anti join shuffles the candidates again. Confidence and provenance are
    no extracted values.
    """
    filled = rows.filter(F.col("value").isNotNull())
    offer = F.struct("text_key", "text", "evidence_block")
    offers = cands.filter(F.col("field_hint").isNotNull())
    parts = [
        _tagged(docs, "document", F.lit("")),
        _tagged(cands, "text", F.col("text_key"), seen=1),
        _tagged(filled, "text", text_key(F.col("value")), valued=1),
        _tagged(offers, "field", F.col("field_hint"), seen=1, offer=offer),
        _tagged(filled, "field", F.col("field"), valued=1),
        _tagged(grounded_fields(rows, blocks), "field", F.col("field"), grounded=1),
    ]
    tags = parts[0]
    for p in parts[1:]:
        tags = tags.unionByName(p)
    sums = [F.sum(c).alias(c) for c in ("seen", "valued", "grounded")]
    found = tags.groupBy("doc_id", "kind", "key").agg(*sums, F.min("offer").alias("offer"))
    kind, value = F.col("kind"), F.col("valued")
    unmet = (F.col("seen") > 0) & (value == 0)
    block = F.col("offer.evidence_block")

    def total(when: Column, what: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(when, what)), F.lit(0)).alias(name)

    counts = found.groupBy("doc_id").agg(
        F.count_if(kind == "document").alias("documents"),
        total(kind == "text", F.col("seen"), "candidates"),
        total((kind == "field") & ~F.col("key").isin(*UNSCORED_FIELDS), value, "extracted"),
        F.count_if((kind == "field") & unmet & block.isNotNull()).alias("missed"),
        F.count_if((kind == "field") & unmet & block.isNull()).alias("vague"),
        total((kind == "field") & (F.col("grounded") == 0), value, "spurious"),
        total((kind == "text") & unmet, F.col("seen"), "checklist_misses"),
    )
    return counts.filter(F.col("documents") > 0).select(
        "doc_id",
        "candidates",
        "extracted",
        "missed",
        "vague",
        "spurious",
        "checklist_misses",
        (F.col("missed") + F.col("vague") + F.col("checklist_misses") == 0).alias("coverage_ok"),
        coverage_gap(F.col("candidates"), F.col("extracted"), tolerance).alias("gap_signal"),
    )


def _tagged(df: DataFrame, kind: str, key: Column, seen: int = 0, valued: int = 0, grounded: int = 0, offer: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("struct<text_key:string,text:string,evidence_block:string>")
    counts = [F.lit(n).cast("bigint").alias(c) for n, c in ((seen, "seen"), (valued, "valued"), (grounded, "grounded"))]
    return df.select("doc_id", F.lit(kind).alias("kind"), key.alias("key"), *counts, (none if offer is None else offer).alias("offer"))


def choose_policy(audits: DataFrame) -> DataFrame:
    """Add ``conflict`` and, for conflicts, the resolution ``policy``.

    A concrete miss or a spurious value can be extracted again. A gap that
    nothing concrete explains needs a fact check. Checklist misses alone are
    taken for noise of the recogniser.
    """
    conflict = ~F.col("coverage_ok") | F.col("gap_signal")
    policy = (
        F.when(~conflict, F.lit(None).cast("string"))
        .when((F.col("missed") > 0) & (F.col("vague") == 0), F.lit("RE_EXTRACT"))
        .when(F.col("spurious") > 0, F.lit("RE_EXTRACT"))
        .when(F.col("gap_signal") & (F.col("missed") + F.col("vague") == 0) & (F.col("extracted") == 0), F.lit("INVOKE_VMAW"))
        .when(F.col("vague") > 0, F.lit("INVOKE_VMAW"))
        .otherwise(F.lit("ACCEPT_EXTRACTOR"))
    )
    return audits.withColumn("conflict", conflict).withColumn("policy", policy)


def reextract_hints(missed: DataFrame, spurious: DataFrame) -> DataFrame:
    """Hints for a second extraction: ``(doc_id, field_name, hint)``."""
    look = F.concat(F.lit("look at block "), F.coalesce("evidence_block", F.lit("?")), F.lit(" for "), F.col("source_value"))
    check = F.concat(F.lit("not found in cited block "), F.coalesce("block_id", F.lit("?")), F.lit(": "), F.col("value"))
    return missed.select("doc_id", F.col("field").alias("field_name"), look.alias("hint")).unionByName(
        spurious.select("doc_id", F.col("field").alias("field_name"), check.alias("hint"))
    )


def team_verdicts(policies: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Outcome of the team per document, from policy and number of hints.

    ``policies`` has ``conflict, policy, hints, reasoning``. Accepted and
    re-extracted records are committed; a re-extraction without a hint and a
    fact check go to review. ``keep`` names other columns to carry along.
    """
    p = F.col("policy")
    why = F.coalesce("reasoning", F.lit(""))
    no_hints = F.coalesce("hints", F.lit(0)) == 0
    reason = (
        F.when(~F.col("conflict"), F.lit("Coverage audit found no conflict and no gap; committed the extracted record."))
        .when(p == "ACCEPT_EXTRACTOR", F.concat(F.lit("Policy ACCEPT_EXTRACTOR: "), why))
        .when(p == "INVOKE_VMAW", F.concat(F.lit("Policy INVOKE_VMAW is not available; flagging to review. "), why))
        .when(no_hints, F.lit("Policy RE_EXTRACT without hints cannot guide a retry; flagging to review."))
        .otherwise(F.concat(F.lit("Policy RE_EXTRACT with "), F.col("hints").cast("string"), F.lit(" hint(s); second extraction committed. "), why))
    )
    flag = F.col("conflict") & ((p == "INVOKE_VMAW") | ((p == "RE_EXTRACT") & no_hints))
    return policies.select(
        "doc_id",
        "policy",
        F.when(flag, F.lit("sme_flag")).otherwise(F.lit("committed")).alias("team_verdict"),
        reason.alias("team_reason"),
        (F.col("conflict") & (p == "RE_EXTRACT") & ~no_hints).alias("rerun"),
        *keep,
    )


def reextract_once(
    rows: DataFrame, verdicts: DataFrame, second_pass: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Replace the rows of documents to be re-extracted by one second pass.

    ``second_pass`` maps the documents to run again, ``(doc_id)``, to record
    rows. It is not audited again, so there is at most one such round.
    """
    again = verdicts.filter("rerun").select("doc_id")
    return rows.join(again, "doc_id", "left_anti").unionByName(second_pass(again).select(*rows.columns))
