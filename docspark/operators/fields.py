"""Record extraction by rule: one record per document, every field with its source.

Each rule looks at one block at a time and offers a value with a rank; the
best offer per document and field is the least ``(rank, ord)``. Offers combine
before the shuffle, so a document costs one row per task, however long it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.answers import json_of_answer
from docspark.functions.dates import date_text, to_iso_date
from docspark.functions.identifiers import identifier_reason, is_valid_identifier
from docspark.functions.text import squash, strip
from docspark.vocab import (
    MRN_LABELS,
    NOISE_ROLE,
    PROCEDURES,
    PRODUCT_MARKERS,
    RECORD_FIELDS,
    VENDOR_CANONICAL,
)

FRAGMENT_SEPARATOR = " | "

_LABELLED = r"^\s*([^:]+?)\s*:\s*(.*?)\s*$"
_PHYSICIAN = r"(?i)^\s*(ordering |treating )?physician(?:\(s\))?(?:\s*:\s*|\s+)(\S.*?)\s*$"
_FOOTER_PHYSICIAN = r"(?i)\bCASE NUMBER:.*\bPHYSICIAN:\s*(\S.*?)\s*$"
_FOOTER_PATIENT = r"(?i)^\s*PATIENT:\s*(\S.*?)\s+CASE NUMBER:"
_TITLE_PREFIX = r"(?i)^(dr\.?|prof\.?)\s+"
_STREET = r"(?i)^(\d+\s.*?)(?:,?\s+((?:suite|ste|unit|floor|fl|apt)\b\.?\s*\S+|#\s*\S+))?$"
_CITY = r"^([A-Za-z][A-Za-z .'-]*),\s*([A-Za-z]{2})\s+(\d{5})(?:-(\d{4}))?$"

_OFFER_RATIONALE = {"derived": "normalised from the source text", "inferred": "inferred from a product marker"}


def _group(text: Column, pattern: str, i: int) -> Column:
    """A regex group, null where the pattern does not match or the group is empty."""
    return F.nullif(F.regexp_extract(text, pattern, i), F.lit(""))


def join_fragments(fragments: Column) -> Column:
    """Fragments of one value as one text; null if there are none."""
    return F.nullif(F.array_join(fragments, FRAGMENT_SEPARATOR), F.lit(""))


def _clues(blocks: DataFrame) -> DataFrame:
    """What the rules look at in a block, each computed once."""
    text = F.col("text")
    low = F.lower(text)
    explicit = F.coalesce(*[F.when(F.contains(low, F.lit(n)) & low.rlike(rf"\b{n}\b"), F.lit(v)) for n, v in VENDOR_CANONICAL])
    marker = F.coalesce(*[F.when(text.rlike(rf"\b{m}\b"), F.lit(v)) for m, v in PRODUCT_MARKERS])
    procedures = F.array(*[F.when(low.rlike(rf"\b{p}\b"), F.lit(v)) for p, v in PROCEDURES])
    footer = F.col("text_role") == "page_footer"
    line = F.col("line")
    return blocks.select(
        "doc_id",
        "ord",
        "block_id",
        F.col("page_number").cast("int").alias("page"),
        "text_role",
        squash(text).alias("line"),
        F.lower(_group(text, _LABELLED, 1)).alias("label"),
        _group(text, _LABELLED, 2).alias("value"),
        explicit.alias("vendor"),
        marker.alias("marker"),
        F.when(F.col("text_role") == "methodology", join_fragments(F.array_compact(procedures))).alias("procedure"),
        F.lower(strip(F.regexp_extract(text, _PHYSICIAN, 1))).alias("physician_kind"),
        _group(text, _PHYSICIAN, 2).alias("physician"),
        F.when(footer, _group(text, _FOOTER_PHYSICIAN, 1)).alias("footer_physician"),
        F.when(footer, _group(text, _FOOTER_PATIENT, 1)).alias("footer_patient"),
    ).select(
        "*",
        to_iso_date(F.when(F.col("label").isin(*_DATE_LABELS), F.col("value"))).alias("iso"),
        F.when(is_valid_identifier(F.col("value")), F.col("value")).alias("npi"),
        F.when(line.rlike(r"^\d+\s"), line).alias("street_line"),
        F.when(line.rlike(_CITY), line).alias("city_line"),
    )


# fixed values: labels a date is printed under
_DATE_LABELS = {
    "dob": "Patient_DOB",
    "date of birth": "Patient_DOB",
    "d.o.b": "Patient_DOB",
    "collected": "Collection_Date",
    "collection date": "Collection_Date",
    "draw date": "Collection_Date",
    "received": "Received_Date",
    "received date": "Received_Date",
    "report date": "Report_Date",
    "reported": "Report_Date",
}


def _label_in(labels) -> str:
    return "label IN (" + ", ".join(f"'{x}'" for x in labels) + ")"


def _date_offer(field: str) -> list[tuple[str, str, str]]:
    return [(_label_in([x for x, f in _DATE_LABELS.items() if f == field]), "iso", "derived")]


# Per raw field the offers of a block, best first: condition, value, provenance type.
_OFFERS: dict[str, list[tuple[str, str, str]]] = {
    "report_title": [("text_role = 'report_title'", "line", "verbatim")],
    "Vendor_Name": [("text_role <> 'practice_block'", "vendor", "verbatim"), ("true", "marker", "inferred")],
    "patient": [
        ("text_role = 'patient_demographics' AND " + _label_in(["patient name", "name"]), "value", "derived"),
        ("true", "footer_patient", "derived"),
    ],
    "Patient_DOB": _date_offer("Patient_DOB"),
    "Patient_MRN": [(_label_in(MRN_LABELS), "value", "verbatim")],
    "Collection_Date": _date_offer("Collection_Date"),
    "Received_Date": _date_offer("Received_Date"),
    "Report_Date": _date_offer("Report_Date"),
    "Test_Name": [
        ("text_role = 'panel_or_test_name' AND " + _label_in(["test", "panel", "test name"]), "value", "verbatim")
    ],
    "Procedure": [("true", "procedure", "verbatim")],
    "provider": [
        ("physician_kind = 'ordering'", "physician", "derived"),
        ("physician_kind = 'treating'", "physician", "derived"),
        ("physician_kind = ''", "physician", "derived"),
        ("true", "footer_physician", "derived"),
    ],
    "Ordering_Provider_NPI": [("text_role = 'ordering_provider' AND label = 'npi'", "npi", "verbatim")],
    "Practice_NPI": [("label = 'practice npi'", "npi", "verbatim")],
    "Practice_Name": [
        ("text_role = 'practice_block' AND " + _label_in(["practice", "clinic", "practice name"]), "value", "verbatim")
    ],
    "street": [("text_role = 'practice_block'", "street_line", "verbatim")],
    "city": [("text_role = 'practice_block'", "city_line", "verbatim")],
}


def _best_offers(blocks: DataFrame) -> DataFrame:
    """One row per document: its page count and the best offer per raw field."""

    def best(options: list[tuple[str, str, str]]) -> str:
        whens = " ".join(
            f"WHEN {value} IS NOT NULL AND ({condition}) THEN named_struct('rank', {i}, 'ord', ord, "
            f"'block_id', block_id, 'page', page, 'value', {value}, 'type', '{kind}')"
            for i, (condition, value, kind) in enumerate(options)
        )
        return f"CASE {whens} END"

    # noise offers nothing, but its page counts
    live = f"text_role <> '{NOISE_ROLE}'"
    tops = [f"min({best(o)}) FILTER (WHERE {live}) AS {n}" for n, o in _OFFERS.items()]
    return _clues(blocks).groupBy("doc_id").agg(
        F.max("page").alias("total_pages"), *[F.expr(t) for t in tops]
    )


def split_person(raw: Column) -> dict[str, Column]:
    """First name, last name and title of a printed name; middle parts are dropped.

    Names come in title case, the title as printed, before or after the name.
    """
    s = squash(raw)
    prefix = _group(s, _TITLE_PREFIX, 1)
    rest = F.regexp_replace(s, _TITLE_PREFIX, "")
    suffix = F.nullif(strip(F.regexp_extract(rest, r"^[^,]*,\s*(.*)$", 1)), F.lit(""))
    name = F.split(strip(F.regexp_extract(rest, r"^([^,]*)", 1)), " ")
    return {
        "first": F.nullif(F.initcap(F.get(name, F.lit(0))), F.lit("")),
        "last": F.when(F.size(name) > 1, F.initcap(F.element_at(name, -1))),
        "title": F.coalesce(suffix, prefix),
    }


def split_patient(raw: Column) -> dict[str, Column]:
    """First and last name from ``Last, First`` or ``First Last``."""
    s = squash(raw)
    turned = F.when(F.contains(s, F.lit(",")), F.concat(F.regexp_extract(s, r",\s*(.*)$", 1), F.lit(" "), F.regexp_extract(s, r"^([^,]*)", 1))).otherwise(s)
    return split_person(turned)


def split_street(line: Column) -> dict[str, Column]:
    return {"street": _group(line, _STREET, 1), "unit": _group(line, _STREET, 2)}


def split_city(line: Column) -> dict[str, Column]:
    return {
        "city": _group(line, _CITY, 1),
        "state": F.upper(_group(line, _CITY, 2)),
        "zip5": _group(line, _CITY, 3),
        "zip4": _group(line, _CITY, 4),
    }


def extract_records(blocks: DataFrame) -> DataFrame:
    """Records of ``blocks(doc_id, ord, block_id, page_number, text, text_role)``.

    One row per document with the record fields and ``provenance``, a map from
    field to block, page, type and rationale.
    """
    best = _best_offers(blocks)
    v = {n: F.col(f"{n}.value") for n in _OFFERS}
    person = split_person(v["provider"])
    patient = split_patient(v["patient"])
    street = split_street(v["street"])
    city = split_city(v["city"])
    confidence = (
        F.when(F.col("Vendor_Name.type") == "inferred", F.lit(0.8))
        .when(F.col("provider.rank") == 3, F.lit(0.9))
        .otherwise(F.lit(0.95))
    )
    # field: value, raw field it comes from
    plan: dict[str, tuple[Column, str | None]] = {
        "total_pages": (F.col("total_pages"), None),
        "llm_confidence_score": (confidence, None),
        "Patient_First_Name": (patient["first"], "patient"),
        "Patient_Last_Name": (patient["last"], "patient"),
        "Ordering_Provider_First_Name": (person["first"], "provider"),
        "Ordering_Provider_Last_Name": (person["last"], "provider"),
        "Ordering_Provider_Title": (person["title"], "provider"),
        "Practice_Street_Address_1": (street["street"], "street"),
        "Practice_Street_Address_2": (street["unit"], "street"),
        "Practice_City": (city["city"], "city"),
        "Practice_State": (city["state"], "city"),
        "Practice_ZIP_5digit": (city["zip5"], "city"),
        "Practice_ZIP_4digit": (city["zip4"], "city"),
    }
    plan.update({n: (v[n], n) for n in v if n in RECORD_FIELDS})
    values = best.select(*best.columns, *[plan[f][0].alias(f"_{f}") for f in RECORD_FIELDS])
    entries = ", ".join(f"'{f}', {_source(f, plan[f][1])}" for f in RECORD_FIELDS)
    return values.select(
        "doc_id", *[F.col(f"_{f}").alias(f) for f in RECORD_FIELDS], F.expr(f"map({entries})").alias("provenance")
    )


def _source(field: str, raw: str | None) -> str:
    """Provenance entry of a field: the block behind its raw field, or absent."""
    if raw is None:
        note = "page count of the document" if field == "total_pages" else "self-assessed; not taken from the source"
        return _entry("NULL", "NULL", "'derived'", f"'{note}'")
    kind = {"Ordering_Provider_Title": "'verbatim'", "Practice_State": "'derived'"}.get(field, f"{raw}.type")
    notes = " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in _OFFER_RATIONALE.items())
    there = _entry(f"{raw}.block_id", f"{raw}.page", kind, f"CASE {kind} {notes} END")
    return f"IF(_{field} IS NULL, {_entry('NULL', 'NULL', repr('absent'), 'NULL')}, {there})"


def _entry(block_id: str, page: str, kind: str, rationale: str) -> str:
    return (
        f"named_struct('block_id', CAST({block_id} AS STRING), 'page', CAST({page} AS INT), "
        f"'type', {kind}, 'rationale', CAST({rationale} AS STRING))"
    )


def provenance_rows(records: DataFrame) -> DataFrame:
    """One row per record field with the block it came from."""
    return records.select("doc_id", F.explode_outer("provenance").alias("field", "p")).select("doc_id", "field", "p.*")


def fabricated_citations(provenance: DataFrame, blocks: DataFrame) -> DataFrame:
    """Cited blocks that the document does not have.

    A merge join on document and block, whatever the planner takes the sizes
    for: it knows the files that blocks and citations are made of, which can be
    many times smaller, and a broadcast of either would fill the driver.
    """
    keys = ["doc_id", "block_id"]
    cited = provenance.filter(F.coalesce("block_id", F.lit("")) != "")
    return cited.join(blocks.select(*keys).hint("merge"), keys, "left_anti")


def record_json(records: DataFrame) -> Column:
    """A record as JSON text, with its null fields."""
    extra = ["provenance"] if "provenance" in records.columns else []
    return F.to_json(F.struct(*RECORD_FIELDS, *extra), {"ignoreNullFields": "false"})


def audit_identifiers(df: DataFrame, column: str) -> DataFrame:
    """Add ``valid`` and ``reason`` for a ten-digit identifier column."""
    c = F.col(column)
    return df.withColumn("valid", is_valid_identifier(c)).withColumn("reason", identifier_reason(c))


def normalise_dates(df: DataFrame, column: str) -> DataFrame:
    """Add ``iso``, ``ok`` and ``reason`` for a column of printed dates."""
    iso = to_iso_date(F.col(column))
    reason = F.when(date_text(F.col(column)).isNull(), F.lit("no full date")).otherwise(F.lit("impossible date"))
    return df.withColumn("iso", iso).select(
        "*", F.col("iso").isNotNull().alias("ok"), F.when(F.col("iso").isNull(), reason).alias("reason")
    )


def extract_with(prompts: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]) -> DataFrame:
    """Answers of a model to document prompts ``(doc_id, prompt)``, over Arrow batches.

    ``load`` runs once per task; its function returns ``(doc_id, answer)``.
    """
    id_type = prompts.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for pdf in frames:
            model = model or load()
            yield model(pdf)

    return prompts.select("doc_id", "prompt").mapInPandas(run, f"doc_id {id_type}, answer string")


def parse_answers(answers: DataFrame) -> DataFrame:
    """Add the JSON record in each answer, null where there is none."""
    return answers.withColumn("record", json_of_answer(F.col("answer")))
