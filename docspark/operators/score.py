"""Scoring records against gold records, field by field.

Both sides are one JSON record per document. They meet in one join on the
document, and the fields are compared inside the joined row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.dates import to_iso_date
from docspark.functions.text import text_key
from docspark.vocab import DATE_FIELDS, SCORE_THRESHOLD, STRICT_FIELDS, UNSCORED_FIELDS

_KIND = (
    "CASE WHEN {x} IS NULL OR schema_of_variant({x}) = 'VOID' THEN 'null' "
    "WHEN schema_of_variant({x}) = 'STRING' THEN 'str' WHEN schema_of_variant({x}) = 'BOOLEAN' THEN 'bool' "
    "WHEN schema_of_variant({x}) = 'BIGINT' THEN 'int' WHEN startswith(schema_of_variant({x}), 'OBJECT') THEN 'dict' "
    "WHEN startswith(schema_of_variant({x}), 'ARRAY') THEN 'list' ELSE 'float' END"
)


def _members(column: str) -> Column:
    """A JSON record as ``map<string,variant>``; an unreadable one is empty."""
    parsed = F.try_variant_get(F.try_parse_json(column), "$", "map<string,variant>")
    return F.coalesce(parsed, F.expr("CAST(map() AS map<string,variant>)"))


def _compare(expected: Column, actual: Column, ekind: Column, akind: Column, field: Column, lenient: bool) -> Column:
    """``struct(passed, match_type, notes)`` of two values of one field."""

    def out(passed: bool, match: str, notes: Column | str) -> Column:
        n = F.lit(notes) if isinstance(notes, str) else notes
        return F.struct(F.lit(passed).alias("passed"), F.lit(match).alias("match_type"), n.alias("notes"))

    number = lambda k: k.isin("int", "float")
    equal = F.when(
        number(ekind) & number(akind), expected.try_cast("double") == actual.try_cast("double")
    ).otherwise((ekind == akind) & (expected == actual))
    show = lambda c: F.coalesce(c, F.lit("null"))
    e_iso, a_iso = to_iso_date(expected), to_iso_date(actual)
    both_text = (ekind == "str") & (akind == "str")
    result = (
        F.when(expected.isNull() & actual.isNull(), out(True, "both_null", ""))
        .when(
            expected.isNull() | actual.isNull(),
            out(False, "fail", F.concat(F.lit("one side null (expected="), show(expected), F.lit(", actual="), show(actual), F.lit(")"))),
        )
        .when(equal, out(True, "exact", ""))
    )
    if not lenient:
        dates = both_text & F.coalesce(e_iso == a_iso, F.lit(False))
        result = (
            result.when(field.isin(*STRICT_FIELDS), out(False, "fail", "strict field: exact match expected"))
            .when(field.isin(*DATE_FIELDS) & dates, out(True, "date", F.concat(F.lit("matched after ISO normalization ("), e_iso, F.lit(")"))))
            .when(
                field.isin(*DATE_FIELDS),
                out(False, "fail", F.concat(F.lit("date mismatch (expected_iso="), show(e_iso), F.lit(", actual_iso="), show(a_iso), F.lit(")"))),
            )
        )
    return (
        result.when(
            both_text & (text_key(expected) == text_key(actual)),
            out(True, "normalized_string", "matched after lowercase + whitespace normalize"),
        )
        .when(both_text, out(False, "fail", "string mismatch even after normalization"))
        .otherwise(out(False, "fail", F.concat(F.lit("type mismatch ("), ekind, F.lit(" vs "), akind, F.lit(")"))))
    )


def compare_fields(gold: DataFrame, actual: DataFrame, lenient: bool = False) -> DataFrame:
    """One comparison per document of ``gold(doc_id, record)`` and field.

    Every gold field counts, whether it was extracted or not. A field that only
    ``actual(doc_id, record)`` has fails as an extra; the lenient form ignores
    extras, and knows neither strict nor date fields. A document without a gold
    record has extras only. Confidence and provenance are not scored.
    """
    skipped = ("llm_confidence_score",) if lenient else UNSCORED_FIELDS
    keys = lambda m: F.coalesce(F.map_keys(m), F.array().cast("array<string>"))
    names = keys("g") if lenient else F.array_union(keys("g"), keys("a"))
    rows = (
        gold.select("doc_id", F.col("record").alias("_gold"))
        .join(actual.select("doc_id", F.col("record").alias("_actual")), "doc_id", "full")
        .select("doc_id", _members("_gold").alias("g"), _members("_actual").alias("a"))
        .select("doc_id", "g", "a", F.explode_outer(names).alias("field"))
        .filter(F.col("field").isNotNull() & ~F.col("field").isin(*skipped))
        .select(
            "doc_id", "field", F.coalesce(F.map_contains_key("g", F.col("field")), F.lit(False)).alias("in_gold"), F.expr("g[field]").alias("x"), F.expr("a[field]").alias("y")
        )
        .select(
            "doc_id",
            "field",
            "in_gold",
            F.try_variant_get("x", "$", "string").alias("expected"),
            F.try_variant_get("y", "$", "string").alias("actual"),
            F.expr(_KIND.format(x="x")).alias("ekind"),
            F.expr(_KIND.format(x="y")).alias("akind"),
        )
    )
    compared = _compare(F.col("expected"), F.col("actual"), F.col("ekind"), F.col("akind"), F.col("field"), lenient)
    extra = F.struct(
        F.lit(False).alias("passed"), F.lit("fail").alias("match_type"), F.lit("extra field: not in gold record").alias("notes")
    )
    return rows.withColumn("r", F.when(F.col("in_gold"), compared).otherwise(extra)).select(
        "doc_id", "field", "expected", "actual", "r.passed", "r.match_type", "r.notes"
    )


def score_documents(comparisons: DataFrame, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """Fields, passes and pass rate per document, and whether it meets the threshold."""
    rate = F.col("passed") / F.greatest("total_fields", F.lit(1))
    return (
        comparisons.groupBy("doc_id")
        .agg(F.count("field").alias("total_fields"), F.count_if("passed").alias("passed"))
        .select(
            "doc_id",
            "total_fields",
            "passed",
            (F.col("total_fields") - F.col("passed")).alias("failed"),
            F.round(rate, 4).alias("pass_rate"),
            (rate >= threshold).alias("meets_threshold"),
        )
    )
