"""The driver tables, and report-like data that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docspark.operators.entities import Pattern, Tables
from docspark.operators.roles import RoleRule
from docspark.vocab import NOISE_PATTERNS, HintRule


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


# fixed values: lookup tables for the prose documents

PROSE_NOISE = (
    *NOISE_PATTERNS,
    ("junk", r"[#*%&$!]{2,}.*[#*%&$!]{2,}"),
)

PROSE_ROLES = (
    RoleRule("disclaimer_or_notes", r"(?i)licensed under|released under", ("none",), 0.95),
    RoleRule("patient_demographics", r"@mail|\+1 \(", ("report_metadata",), 0.9, r"[@+]"),
    RoleRule("accession_block", r"[0-9]{13,16}|([0-9]{1,3}\.){3}[0-9]{1,3}|token =", ("report_metadata", "tested_biomarker_umbrella"), 0.8, r"[0-9=]"),
    RoleRule("panel_or_test_name", r"^[A-Z][a-z]{9,}", ("report_metadata", "tested_biomarker_umbrella"), 0.7),
)

PROSE_PATTERNS = (
    Pattern("contact_rules", "EMAIL", r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+\.[a-z]{2,}", "@"),
    Pattern("contact_rules", "PHONE", r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}", "+1 ("),
    Pattern("network_rules", "IP", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"),
    Pattern("network_rules", "EMAIL", r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+\.[a-z]{2,}", "@"),
    Pattern("secret_rules", "CARD", r"[0-9]{13,16}"),
    Pattern("secret_rules", "TOKEN", r'token = "[0-9a-f]+"', "token ="),
    Pattern("name_rules", "ORG", r"[A-Z][a-z]{9,}"),
)

PROSE_TABLES = Tables(
    label_sections={
        "EMAIL": ("report_metadata",),
        "PHONE": ("report_metadata",),
        "IP": ("tested_biomarker_umbrella",),
        "CARD": ("Genomic_Variant_umbrella", "tested_biomarker_umbrella"),
        "ORG": ("report_metadata", "other_molecular_biomarker_umbrella"),
    },
    stoplist=("erthndthea", "tionthesoner", "everything"),
    hint_rules=(
        HintRule("ORG", ("nicht", "und "), "Practice_Name"),
        HintRule("ORG", (" was ", " were "), "Report_Date"),
        HintRule("EMAIL", ("the",), "Patient_Last_Name"),
    ),
    vendor_names=("mail1.example", "mail2.example"),
)
