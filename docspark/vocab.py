"""Closed vocabularies, lookup tables and schema rules.

Everything here is a fixed value that results depend on: change a row and the
output changes. All tables are small and of fixed size, so operators compile
them into column expressions instead of joining to them.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: closed vocabularies -------------------------------------

SECTIONS = (
    "report_metadata",
    "Genomic_Variant_umbrella",
    "other_molecular_biomarker_umbrella",
    "tested_biomarker_umbrella",
)
NO_SECTION = "none"

TEXT_ROLES = (
    "report_title",
    "vendor_branding",
    "practice_block",
    "patient_demographics",
    "specimen_metadata",
    "ordering_provider",
    "accession_block",
    "panel_or_test_name",
    "methodology",
    "results_table",
    "interpretation",
    "clinical_significance",
    "references",
    "cpt_codes",
    "electronic_signature",
    "page_header",
    "page_footer",
    "fax_transport_noise",
    "chart_image_caption",
    "disclaimer_or_notes",
    "other",
)
NOISE_ROLE = "fax_transport_noise"
DEFAULT_ROLE = "other"

PROVENANCE_TYPES = ("verbatim", "inferred", "derived", "absent")
VERDICTS = ("auto_accept", "sme_flag", "errored")
POLICIES = ("ACCEPT_EXTRACTOR", "RE_EXTRACT", "INVOKE_VMAW")

# --- fixed values: thresholds ------------------------------------------------

AUTO_ACCEPT_CONFIDENCE = 0.85
COVERAGE_GAP_TOLERANCE = 0.10
SCORE_THRESHOLD = 0.80
SCORER_BATCH_SIZE = 300
PROMPT_TEXT_LIMIT = 600
DROP_EXAMPLES = 5

# --- fixed values: transport noise patterns ---------------------------------

NOISE_PATTERNS = (
    ("banner", r"(?i)\*{2,}\s*INBOUND\s+NOTIFICATION\s*:\s*FAX\s+RECEIVED\s+SUCCESSFULLY\s*\*{2,}"),
    ("col_header", r"(?i)TIME\s+RECEIVED.{0,80}?REMOTE\s+CSID.{0,80}?DURATION"),
    (
        "timestamp",
        r"(?i)\b\d{2}\.\d{2}\.\d{4}\s+\d{2}:\d{2}:\d{2}\b.{0,30}?Page:\s*\d+\s+of\s+\d+.{0,200}?",
    ),
    (
        "page_of",
        r"(?i)\bPage:\s*\d+\s+of\s+\d+\s+Sender:\s+[^\n\r]{1,80}\s+Recipient:\s*\+?\d{6,}\b",
    ),
    (
        "status_row",
        r"(?i)\b\d{4}\s+at\s+\d{1,2}:\d{2}(?::\d{2})?\s*(?:AM|PM)?\s*(?:[A-Z]{2,4})?\s*"
        r".{1,150}?\b(?:Received|Success(?:fully)?|OK)\b",
    ),
)

# a literal part of every match, by expression
NOISE_NEEDS = {regex: ":" for name, regex in NOISE_PATTERNS if name in ("banner", "timestamp", "page_of", "status_row")}

# --- fixed values: entity label -> sections, drop roles, stoplist ------------

LABEL_SECTIONS = {
    "GENE_OR_GENE_PRODUCT": ("Genomic_Variant_umbrella", "tested_biomarker_umbrella"),
    "AMINO_ACID": ("Genomic_Variant_umbrella",),
    "SIMPLE_CHEMICAL": ("other_molecular_biomarker_umbrella",),
    "CANCER": ("other_molecular_biomarker_umbrella",),
    "PATHOLOGICAL_FORMATION": ("other_molecular_biomarker_umbrella",),
    "CHEMICAL": ("other_molecular_biomarker_umbrella",),
    "DISEASE": ("other_molecular_biomarker_umbrella",),
    "PERSON": ("report_metadata",),
    "DATE": ("report_metadata",),
    "ORG": ("report_metadata",),
    "GPE": ("report_metadata",),
    "LOC": ("report_metadata",),
    "FAC": ("report_metadata",),
}

DROP_ROLES = (
    "references",
    "cpt_codes",
    "fax_transport_noise",
    "chart_image_caption",
    "disclaimer_or_notes",
    "electronic_signature",
    "page_header",
    "page_footer",
)

STOPLIST = (
    "dna",
    "rna",
    "gene",
    "genes",
    "mutation",
    "mutations",
    "mutant",
    "allele",
    "patient",
    "date",
    "result",
    "results",
    "test",
    "tests",
    "percent",
    "specimen",
    "sample",
    "report",
    "blood",
    "normal",
    "negative",
    "positive",
    "detected",
)


@dataclass(frozen=True)
class HintRule:
    """A record field suggested by a label found left of a mention."""

    entity_label: str
    near_labels: tuple[str, ...]
    field: str


HINT_RULES = (
    HintRule("DATE", ("collection date", "collected", "draw date"), "Collection_Date"),
    HintRule("DATE", ("received date", "received"), "Received_Date"),
    HintRule("DATE", ("report date", "reported", "final report"), "Report_Date"),
    HintRule("DATE", ("dob", "date of birth", "d.o.b"), "Patient_DOB"),
    HintRule(
        "PERSON",
        ("ordering physician", "treating physician", "ordered by", "physician", "provider"),
        "Ordering_Provider_Last_Name",
    ),
    HintRule("PERSON", ("patient name", "patient", "name:"), "Patient_Last_Name"),
    HintRule("ORG", ("client", "practice", "clinic", "ordering facility"), "Practice_Name"),
)

VENDOR_NAMES = (
    "neogenomics",
    "tempus",
    "foundation medicine",
    "foundationone",
    "caris",
    "guardant",
    "myriad",
    "quest",
    "labcorp",
    "invitae",
    "genomic health",
)

# --- fixed values: record rules ----------------------------------------------

# vendor as printed, canonical spelling
VENDOR_CANONICAL = (
    ("neogenomics", "NeoGenomics"),
    ("tempus", "Tempus"),
    ("foundation medicine", "Foundation Medicine"),
    ("caris", "Caris"),
    ("guardant health", "Guardant Health"),
    ("myriad genetics", "Myriad Genetics"),
    ("quest diagnostics", "Quest Diagnostics"),
    ("labcorp", "Labcorp"),
    ("invitae", "Invitae"),
    ("genomic health", "Genomic Health"),
)

# product marker (case sensitive, whole word), vendor it implies
PRODUCT_MARKERS = (
    ("xT", "Tempus"),
    ("FoundationOne", "Foundation Medicine"),
    ("F1CDx", "Foundation Medicine"),
    ("xGEN", "Caris"),
    ("Guardant", "Guardant Health"),
    ("MyChoice", "Myriad Genetics"),
)

MRN_LABELS = ("mrn", "medical record #", "med rec #")

# phrase in a methodology block, procedure name it stands for
PROCEDURES = (
    ("quantitative pcr", "Quantitative PCR"),
    ("next generation sequencing", "Next Generation Sequencing"),
    ("fish", "FISH"),
    ("ihc", "IHC"),
    ("sanger sequencing", "Sanger sequencing"),
)

IDENTIFIER_PREFIX = "80840"

DATE_FIELDS = ("Patient_DOB", "Collection_Date", "Received_Date", "Report_Date")
STRICT_FIELDS = (
    "total_pages",
    "Ordering_Provider_NPI",
    "Practice_NPI",
    "Practice_ZIP_5digit",
    "Practice_ZIP_4digit",
)
UNSCORED_FIELDS = ("llm_confidence_score", "provenance")

# --- fixed values: the declared record schema --------------------------------


@dataclass(frozen=True)
class Rule:
    """One property of a section, as declared in the record schema.

    ``types`` holds JSON type names; ``"null"`` marks a nullable property.
    ``items`` describes array elements: either a JSON type name or the rules
    of an object element. ``members`` are the rules of an object property;
    ``open`` objects, or object elements, may have undeclared members.
    ``choices`` are the allowed values as JSON.
    """

    field: str
    types: tuple[str, ...]
    mode: str = "VERBATIM"
    required: bool = True
    minimum: float | None = None
    maximum: float | None = None
    pattern: str | None = None
    format: str | None = None
    unique: bool = False
    items: str | tuple["Rule", ...] | None = None
    item_minimum: float | None = None
    members: tuple["Rule", ...] | None = None
    open: bool = False
    choices: tuple[str, ...] | None = None
    description: str = ""


def _text(*names: str, **kw) -> tuple[Rule, ...]:
    return tuple(Rule(n, ("string", "null"), **kw) for n in names)


_CONFIDENCE = Rule(
    "llm_confidence_score", ("number", "null"), mode="DERIVED", minimum=0.0, maximum=1.0
)
_PAGE = Rule("page_number", ("integer", "null"), mode="DERIVED", minimum=1)

RECORD_RULES = (
    Rule("total_pages", ("integer",), mode="DERIVED", minimum=1),
    *_text("report_title"),
    _CONFIDENCE,
    *_text("Patient_MRN", "Patient_First_Name", "Patient_Last_Name"),
    *_text("Patient_DOB", mode="DERIVED", format="date"),
    *_text("Vendor_Name", mode="VERBATIM_OR_INFERRED"),
    *_text("Collection_Date", "Received_Date", "Report_Date", mode="DERIVED", format="date"),
    *_text("Test_Name", "Procedure", "Ordering_Provider_First_Name", "Ordering_Provider_Last_Name"),
    *_text("Ordering_Provider_NPI", pattern="^[0-9]{10}$"),
    *_text("Ordering_Provider_Title", "Practice_Name"),
    *_text("Practice_NPI", pattern="^[0-9]{10}$"),
    *_text(
        "Practice_Street_Address_1",
        "Practice_Street_Address_2",
        "Practice_City",
        "Practice_State",
    ),
    *_text("Practice_ZIP_5digit", pattern="^[0-9]{5}$"),
    *_text("Practice_ZIP_4digit", pattern="^[0-9]{4}$"),
    Rule("provenance", ("object",), mode="DERIVED", required=False),
)
RECORD_FIELDS = tuple(r.field for r in RECORD_RULES if r.required)

_VARIANT_ITEM = (
    _PAGE,
    *_text(
        "gene_studied",
        "method",
        "result",
        "variant_allele_frequency",
        "dna_change_type",
        "amino_acid_change_type",
        "genomic_dna_change",
        "genomic_reference_sequence",
        "coding_dna_change",
        "transcript_reference_sequence",
        "amino_acid_change",
        "amino_acid_reference_sequence",
        "clinical_significance",
        "genomic_source_class",
        "human_reference_sequence_assembly_version",
        "allelic_state",
        "chromosome_identifier",
        "genomic_position",
        "exon",
    ),
)
_BIOMARKER_ITEM = (
    _PAGE,
    *_text("biomarker_name", "method", "result", "reference_range", "interpretation"),
)

SECTION_RULES: dict[str, tuple[Rule, ...]] = {
    "report_metadata": RECORD_RULES,
    "Genomic_Variant_umbrella": (
        Rule("count_of_Genomic_Variants", ("integer",), mode="DERIVED", minimum=0),
        _CONFIDENCE,
        Rule("Genomic_Variants", ("array",), mode="", items=_VARIANT_ITEM),
    ),
    "other_molecular_biomarker_umbrella": (
        Rule("count", ("integer",), mode="DERIVED", minimum=0),
        _CONFIDENCE,
        Rule("other_molecular_biomarkers", ("array",), mode="", items=_BIOMARKER_ITEM),
    ),
    "tested_biomarker_umbrella": (
        Rule("count_of_tested_biomarkers", ("integer",), mode="DERIVED", minimum=0),
        Rule("page_numbers", ("array",), mode="DERIVED", items="integer", item_minimum=1),
        _CONFIDENCE,
        Rule("tested_biomarkers", ("array",), mode="DERIVED", items="string", unique=True),
    ),
}
ENVELOPE_COUNT = Rule("count_of_extracted_objects", ("integer",), mode="DERIVED", minimum=0)

#: The whole envelope: its count, then its sections.
ENVELOPE = Rule(
    "<root>",
    ("object",),
    mode="",
    members=(ENVELOPE_COUNT, *(Rule(name, ("object",), mode="", members=rules) for name, rules in SECTION_RULES.items())),
)
