"""Block roles: rule scorer, plugged-in scorer, batching, parity, merging."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.operators.models import FIRST_WAIT, IN_FLIGHT, TRIES, gathered, in_flight, with_retries
from docspark.operators.running import number_in_order
from docspark.sources.scratch import stage
from docspark.vocab import (
    DEFAULT_ROLE,
    NO_SECTION,
    NOISE_ROLE,
    SCORER_BATCH_SIZE,
    SECTIONS,
    TEXT_ROLES,
)

PROFILE_SCHEMA = (
    "doc_id {id_type}, block_id string, page_number int, text_role string, "
    "hints array<string>, confidence double, rationale string"
)
Scorer = Callable[[pd.DataFrame], "pd.DataFrame | Mapping[str, list]"]
PROFILE_COLUMNS = ["doc_id", "block_id", "page_number", "text_role", "hints", "confidence", "rationale"]


NOISE_RATIONALE = "Pre-tagged as noise by pattern."


@dataclass(frozen=True)
class RoleRule:
    """A role given to blocks whose text matches; the first rule wins.

    ``quick`` is a cheaper pattern that occurs wherever ``pattern`` does, looked for first.
    """

    role: str
    pattern: str
    hints: tuple[str, ...] = (NO_SECTION,)
    confidence: float = 0.9
    quick: str | None = None


# Rules for printed laboratory reports, from the meaning of each role.
REPORT_RULES = (
    RoleRule("page_footer", r"(?i)\bCASE NUMBER:.*\bPHYSICIAN:", ("report_metadata",), 0.9),
    RoleRule("report_title", r"(?i)^\s*(final report|molecular genetics|\w+ sample)\s*$", ("report_metadata",), 0.95),
    RoleRule("ordering_provider", r"(?i)^\s*(ordering|treating)?\s*physician|\bNPI\b", ("report_metadata",), 0.9),
    RoleRule("accession_block", r"(?i)^\s*(accession|case|order) (number|no|#)|patient id|specimen id", ("none",), 0.9),
    RoleRule("patient_demographics", r"(?i)^\s*(patient name|dob|date of birth|mrn|medical record #|med rec #)", ("report_metadata",), 0.95),
    RoleRule("specimen_metadata", r"(?i)^\s*(collected|collection date|received date|report date)", ("report_metadata",), 0.95),
    RoleRule("practice_block", r"(?i)^\s*practice|\b(rd|st|ave)\.|,\s+[A-Z]{2}\s+\d{5}", ("report_metadata",), 0.85),
    RoleRule("panel_or_test_name", r"(?i)^\s*(test|panel):", ("report_metadata", "tested_biomarker_umbrella"), 0.9),
    RoleRule("methodology", r"(?i)^\s*method", ("report_metadata",), 0.9),
    RoleRule("results_table", r"(?i)\bp\.[A-Z]\d+[A-Z]\b", ("Genomic_Variant_umbrella", "tested_biomarker_umbrella"), 0.9),
    RoleRule("electronic_signature", r"(?i)electronically signed|\bCLIA\b", ("none",), 0.95),
    RoleRule("cpt_codes", r"(?i)\bCPT\b", ("none",), 0.95),
    RoleRule("references", r"(?i)^\s*references?:", ("none",), 0.95),
    RoleRule("disclaimer_or_notes", r"(?i)^\s*(notes?|comments?|disclaimer):", ("none",), 0.9),
    RoleRule("vendor_branding", r"(?i)laborator|\xa9|\binc\.", ("report_metadata",), 0.85),
)


def _pick(text: Column, rules: Sequence[RoleRule], value: Callable[[RoleRule], Column], default: Column) -> Column:
    out = None
    for r in rules:
        hit = text.rlike(r.pattern) if r.quick is None else text.rlike(r.quick) & text.rlike(r.pattern)
        out = F.when(hit, value(r)) if out is None else out.when(hit, value(r))
    return default if out is None else out.otherwise(default)


def role_of(text: Column, rules: Sequence[RoleRule] = REPORT_RULES) -> Column:
    """Role of a block by rule; ``other`` when no rule matches."""
    return _pick(text, rules, lambda r: F.lit(r.role), F.lit(DEFAULT_ROLE))


def role_value(role: Column, rules: Sequence[RoleRule], value: Callable[[RoleRule], Column], default: Column) -> Column:
    """A property of the rule behind a role (roles are unique in a rule list)."""
    out = None
    for r in rules:
        out = F.when(role == r.role, value(r)) if out is None else out.when(role == r.role, value(r))
    return default if out is None else out.otherwise(default)


def hints_of(role: Column, rules: Sequence[RoleRule] = REPORT_RULES) -> Column:
    return role_value(
        role, rules, lambda r: F.array(*map(F.lit, r.hints)), F.array(F.lit(NO_SECTION))
    )


def score_by_rules(blocks: DataFrame, rules: Sequence[RoleRule] = REPORT_RULES) -> DataFrame:
    """Profiles of blocks by the built-in rules."""
    role = F.col("text_role")
    return blocks.select(
        "doc_id", "block_id", "page_number", "ord", role_of(F.col("text"), rules).alias("text_role")
    ).select(
        "*",
        hints_of(role, rules).alias("hints"),
        role_value(role, rules, lambda r: F.lit(r.confidence), F.lit(0.5)).alias("confidence"),
        F.concat(F.lit("rule: "), role).alias("rationale"),
    )


def noise_profiles(blocks: DataFrame) -> DataFrame:
    """Fixed profiles of blocks already known to be noise."""
    return blocks.select(
        "doc_id",
        "block_id",
        "page_number",
        "ord",
        F.lit(NOISE_ROLE).alias("text_role"),
        F.array(F.lit(NO_SECTION)).alias("hints"),
        F.lit(1.0).alias("confidence"),
        F.lit(NOISE_RATIONALE).alias("rationale"),
    )


def profile_blocks(blocks: DataFrame, noise: Column, rules: Sequence[RoleRule] = REPORT_RULES) -> DataFrame:
    """One profile per block in one pass: noise is pre-tagged, the rest scored by rule."""
    role = F.col("text_role")
    scored = F.when(noise, F.lit(NOISE_ROLE)).otherwise(role_of(F.col("text"), rules))
    tagged = role == NOISE_ROLE
    return blocks.select("doc_id", "block_id", "page_number", "ord", scored.alias("text_role")).select(
        "*",
        F.when(tagged, F.array(F.lit(NO_SECTION))).otherwise(hints_of(role, rules)).alias("hints"),
        F.when(tagged, F.lit(1.0))
        .otherwise(role_value(role, rules, lambda r: F.lit(r.confidence), F.lit(0.5)))
        .alias("confidence"),
        F.when(tagged, F.lit(NOISE_RATIONALE))
        .otherwise(F.concat(F.lit("rule: "), role))
        .alias("rationale"),
    )


def accept_scores(sent: DataFrame, scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scored profiles that are right, and a quarantine of the rest.

    Right is a profile of a block that was sent, scored once, within the
    vocabularies. The quarantine lists ``doc_id, block_id, problem``: blocks
    that were lost, made up, scored more than once, or scored out of range.
    """
    keys = ["doc_id", "block_id"]
    wrong = parity_violations(sent, scored).select(*keys, "problem")
    wrong = wrong.unionByName(vocabulary_violations(scored).select(*keys, "problem"))
    bad = wrong.select(*keys).distinct().alias("w")
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"w.{k}")) for k in keys]
    return scored.alias("s").join(bad, same, "left_anti"), wrong


def profile_with_model(
    blocks: DataFrame,
    noise: Column,
    scorer: Scorer,
    size: int = SCORER_BATCH_SIZE,
) -> tuple[DataFrame, DataFrame]:
    """Profiles by a model, which never gets to see the noise blocks, and the quarantine of its answers.

    The model's answers are written once, so that both parts are of the same run.
    So are the ids of the blocks with their noise mark, which all but the model
    works on: texts are cut and matched once for them and once for the model.
    """
    marked = blocks.withColumn("_noise", F.coalesce(noise, F.lit(False)))
    ids = stage(marked.select("doc_id", "block_id", "page_number", "ord", "_noise"), "marked-blocks")
    sent = ids.filter("not _noise")
    scored = score_blocks(marked.filter("not _noise"), scorer, size, narrow=sent)
    accepted, wrong = accept_scores(sent, stage(scored, "scored-blocks"))
    return noise_profiles(ids.filter("_noise")).drop("ord").unionByName(accepted), wrong


def scorer_payload(blocks: DataFrame, max_chars: int | None = None) -> DataFrame:
    """What a model gets to see of a block: no box, the whole text.

    ``max_chars`` cuts longer texts for a model with a small prompt
    (``PROMPT_TEXT_LIMIT`` is the usual cut); the block itself stays whole.
    """
    t = F.coalesce("text", F.lit(""))
    capped = t if max_chars is None else F.when(F.length(t) > max_chars, F.concat(F.left(t, F.lit(max_chars)), F.lit("…"))).otherwise(t)
    return blocks.select("doc_id", "block_id", "page_number", "ord", "section_path", capped.alias("text"))


def batches(blocks: DataFrame, size: int = SCORER_BATCH_SIZE, narrow: DataFrame | None = None) -> DataFrame:
    """Give each block its batch number: ``size`` consecutive blocks of a document.

    ``narrow`` may give the same blocks with ``doc_id`` and ``ord`` alone.
    """
    return (
        number_in_order(blocks, "doc_id", "ord", narrow=narrow)
        .withColumn("batch", F.floor(F.col("row_no") / size))
        .drop("row_no")
    )


def score_blocks(
    blocks: DataFrame,
    scorer: Scorer,
    size: int = SCORER_BATCH_SIZE,
    at_once: int = IN_FLIGHT,
    tries: int = TRIES,
    first_wait: float = FIRST_WAIT,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """Run a scorer on batches of at most ``size`` blocks of one document.

    ``scorer`` maps a frame of payload rows to a frame of profile rows, or to
    their columns as lists, which costs less for small batches. A task
    has at most ``at_once`` calls open, in threads; a call that raises is tried
    again after growing waits, and a batch whose last try fails is left out, so
    that its blocks show up as missing. Only this step leaves the JVM. Check the
    result with :func:`parity_violations` and :func:`vocabulary_violations`.
    ``narrow`` is as in :func:`batches`.
    """
    id_type = blocks.schema["doc_id"].dataType.simpleString()
    payload = batches(scorer_payload(blocks), size, narrow)

    def calls(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The batches of a task, of which each comes whole and in order."""
        held: pd.DataFrame | None = None
        for pdf in frames:
            for a, b in pairwise(_batch_cuts(pdf)):
                part = pdf.iloc[a:b]
                if held is None:
                    held = part
                elif a == 0 and _same_batch(held, part):
                    held = pd.concat([held, part], ignore_index=True)
                else:
                    yield held.reset_index(drop=True)
                    held = part
        if held is not None:
            yield held.reset_index(drop=True)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done = in_flight(calls(frames), with_retries(scorer, tries, first_wait), at_once)
        return gathered((profiles for _, profiles, failed in done if failed is None), columns=PROFILE_COLUMNS)

    ordered = payload.repartition("doc_id", "batch").sortWithinPartitions("doc_id", "batch", "ord")
    return ordered.mapInPandas(run, PROFILE_SCHEMA.format(id_type=id_type))


def _batch_cuts(pdf: pd.DataFrame) -> list[int]:
    """Where the batches of an ordered frame begin, and its end."""
    doc, batch = pd.factorize(pdf["doc_id"], use_na_sentinel=False)[0], pdf["batch"].to_numpy()
    inner = np.flatnonzero((doc[1:] != doc[:-1]) | (batch[1:] != batch[:-1])) + 1
    return [0, *inner.tolist(), len(pdf)] if len(pdf) else []


def _same_batch(a: pd.DataFrame, b: pd.DataFrame) -> bool:
    x, y = a.iloc[-1], b.iloc[0]
    return x["batch"] == y["batch"] and (x["doc_id"] == y["doc_id"] or (pd.isna(x["doc_id"]) and pd.isna(y["doc_id"])))


def parity_violations(sent: DataFrame, scored: DataFrame) -> DataFrame:
    """Block ids sent but not scored exactly once, or scored but never sent; a null id is an id like others."""
    keys = ["doc_id", "block_id"]
    one, none = F.lit(1), F.lit(0)
    both = sent.select(*keys, one.alias("s"), none.alias("r")).unionByName(scored.select(*keys, none.alias("s"), one.alias("r")))
    counted = both.groupBy(*keys).agg(F.sum("s").alias("n_sent"), F.sum("r").alias("n_scored"))
    problem = (
        F.when(F.col("n_scored") == 0, F.lit("missing"))
        .when(F.col("n_sent") == 0, F.lit("extra"))
        .when(F.col("n_sent") != F.col("n_scored"), F.lit("count"))
    )
    return counted.withColumn("problem", problem).filter(F.col("problem").isNotNull())


def vocabulary_violations(profiles: DataFrame) -> DataFrame:
    """Profiles outside the closed vocabularies or value ranges."""
    known = F.array(*map(F.lit, (*SECTIONS, NO_SECTION)))
    hints = F.col("hints")
    problem = (
        F.when(~F.coalesce(F.col("text_role").isin(*TEXT_ROLES), F.lit(False)), F.lit("text_role"))
        .when(F.coalesce(F.size(hints), F.lit(0)) <= 0, F.lit("no hints"))
        .when(F.size(F.array_except(hints, known)) > 0, F.lit("hint"))
        .when(F.array_contains(hints, NO_SECTION) & (F.size(hints) > 1), F.lit("none not alone"))
        .when(~F.coalesce(F.col("confidence").between(0.0, 1.0), F.lit(False)), F.lit("confidence"))
        .when(F.coalesce(F.col("page_number"), F.lit(0)) < 1, F.lit("page_number"))
    )
    return profiles.withColumn("problem", problem).filter(F.col("problem").isNotNull())


def merge_in_order(blocks: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profiles with the input position of their block."""
    keys = ["doc_id", "block_id"]
    return blocks.select(*keys, "ord").join(profiles.drop("ord"), keys)


def role_legend(pages: DataFrame, by: Sequence[str] = ("doc_id", "page_number")) -> DataFrame:
    """Blocks per role on each page."""
    return pages.groupBy(*by, "text_role").agg(F.count(F.lit(1)).alias("blocks"))
