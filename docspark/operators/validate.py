"""Envelopes, validation against the declared schema, scorecards.

A record is checked inside its own row: its JSON becomes a map of variants,
and the rules, a literal array, are applied to it with higher-order functions.
There is no join and no shuffle, and the plan does not grow with the rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.vocab import ENVELOPE, SECTION_RULES, Rule

ROOT = "<root>"
_NONE = "CAST(NULL AS STRING)"

EMPTY_SECTIONS = {
    "Genomic_Variant_umbrella": '{"count_of_Genomic_Variants":0,"llm_confidence_score":null,"Genomic_Variants":[]}',
    "other_molecular_biomarker_umbrella": '{"count":0,"llm_confidence_score":null,"other_molecular_biomarkers":[]}',
    "tested_biomarker_umbrella": '{"count_of_tested_biomarkers":0,"page_numbers":[],"llm_confidence_score":null,"tested_biomarkers":[]}',
}


def envelope_json(record: Column, **sections: Column) -> Column:
    """The full envelope around a record, as JSON text.

    Sections that are not given are empty placeholders; a null record is an
    empty object. No object is extracted outside the record, so the count is 0.
    """
    parts = [F.lit('{"count_of_extracted_objects":0,"report_metadata":'), F.coalesce(record, F.lit("{}"))]
    for name, empty in EMPTY_SECTIONS.items():
        body = F.coalesce(sections[name], F.lit(empty)) if name in sections else F.lit(empty)
        parts += [F.lit(f',"{name}":'), body]
    return F.concat(*parts, F.lit("}"))


# --- rules as SQL literals ---------------------------------------------------


def _text_or_null(v: str | None) -> str:
    return _NONE if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _texts_or_null(v: Sequence[str] | None) -> str:
    return "CAST(NULL AS ARRAY<STRING>)" if v is None else f"array({', '.join(map(_text_or_null, v))})"


def _number_or_null(v: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if v is None else f"CAST({v} AS DOUBLE)"


def _kinds(rule: Rule) -> str:
    """The JSON types that a rule takes, in one text: no type's name is part of another's, so a look for the name will do."""
    return ",".join([*rule.types, *(["integer"] if "number" in rule.types else [])])


def _rules_literal(rules: Sequence[Rule]) -> str:
    rows = [
        f"named_struct('no', {i}, 'field', {_text_or_null(r.field)}, 'types', array({', '.join(map(_text_or_null, r.types))}), "
        f"'required', {str(r.required).lower()}, 'lo', {_number_or_null(r.minimum)}, 'hi', {_number_or_null(r.maximum)}, "
        f"'pattern', {_text_or_null(r.pattern)}, 'format', {_text_or_null(r.format)}, 'distinct', {str(r.unique).lower()}, "
        f"'item', {_text_or_null(r.items if isinstance(r.items, str) else None)}, 'item_lo', {_number_or_null(r.item_minimum)}, "
        f"'choices', {_texts_or_null(r.choices)}, 'kinds', {_text_or_null(_kinds(r))})"
        for i, r in enumerate(rules)
    ]
    return "array(" + ", ".join(rows) + ")"


def _json_type(v: str, kind: str | None = None) -> str:
    """JSON type name of a variant; a whole number is an integer however it is written.

    ``kind`` is its schema if that is at hand.
    """
    kind = kind or f"schema_of_variant({v})"
    number = f"try_variant_get({v}, '$', 'double')"
    return (
        f"CASE WHEN {v} IS NULL THEN 'missing' WHEN {kind} = 'VOID' THEN 'null' WHEN {kind} = 'STRING' THEN 'string' "
        f"WHEN {kind} = 'BOOLEAN' THEN 'boolean' WHEN {kind} = 'BIGINT' THEN 'integer' "
        f"WHEN startswith({kind}, 'OBJECT') THEN 'object' WHEN startswith({kind}, 'ARRAY') THEN 'array' "
        f"WHEN {number} = floor({number}) THEN 'integer' ELSE 'number' END"
    )


def _error(section: str, loc: str, rule: str, msg: str) -> str:
    return f"named_struct('section', {section}, 'loc', {loc}, 'rule', '{rule}', 'msg', {msg})"


def _check_object(section: str, members: str, rules: Sequence[Rule], path: str, depth: int, check_dates: bool, is_open: bool = False) -> str:
    """SQL for the errors of an object given as ``map<string,variant>``."""
    r, v = f"r{depth}", f"v{depth}"
    typed = f"{v}.t"
    val = f"{v}.x"
    loc = f"concat({path}, array({v}.r.field))"
    is_number = f"{typed} IN ('integer', 'number')"
    as_double = f"try_variant_get({val}, '$', 'double')"
    as_text = f"try_variant_get({val}, '$', 'string')"
    as_array = f"try_variant_get({val}, '$', 'array<variant>')"
    fits = f"contains({v}.r.kinds, {typed})"

    def when(cond: str, rule: str, msg: str) -> str:
        return f"IF({cond}, {_error(section, loc, rule, msg)}, NULL)"

    checks = [
        when(f"{typed} = 'missing' AND {v}.r.required", "required", "'field required'"),
        when(f"{typed} <> 'missing' AND NOT {fits}", "type", f"concat('expected ', array_join({v}.r.types, ' or '), ', got ', {typed})"),
        when(f"{is_number} AND {fits} AND {as_double} < {v}.r.lo", "minimum", f"concat('less than ', CAST({v}.r.lo AS STRING))"),
        when(f"{is_number} AND {fits} AND {as_double} > {v}.r.hi", "maximum", f"concat('greater than ', CAST({v}.r.hi AS STRING))"),
        when(f"{typed} = 'string' AND {v}.r.pattern IS NOT NULL AND NOT rlike({as_text}, coalesce({v}.r.pattern, ''))", "pattern", f"concat('does not match ', {v}.r.pattern)"),
        when(f"{typed} = 'array' AND {v}.r.distinct AND size(array_distinct(transform({as_array}, e -> to_json(e)))) < size({as_array})", "uniqueItems", "'has repeated items'"),
    ]
    if any(x.choices is not None for x in rules):
        allowed = f"array_contains({v}.r.choices, to_json({val}))"
        checks.append(when(f"{typed} <> 'missing' AND {fits} AND NOT {allowed}", "enum", f"concat('not one of ', array_join({v}.r.choices, ', '))"))
    if check_dates:
        ok = f"(rlike({as_text}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') AND try_to_date({as_text}, 'yyyy-MM-dd') IS NOT NULL)"
        checks.append(when(f"{typed} = 'string' AND {v}.r.format = 'date' AND NOT {ok}", "format", "'not an ISO date'"))
    own = (
        f"flatten(transform(transform(transform({_rules_literal(rules)}, {r} -> "
        f"named_struct('r', {r}, 'x', {members}[{r}.field], 'k', schema_of_variant({members}[{r}.field]))), "
        f"{v} -> named_struct('r', {v}.r, 'x', {v}.x, 't', {_json_type(val, v + '.k')})), {v} -> array_compact(array({', '.join(checks)}))))"
    )
    parts = [own] if rules else []
    if any(isinstance(x.items, str) for x in rules):
        e = f"e{depth}"
        item_loc = f"concat({path}, array({v}.r.field, CAST(i AS STRING)))"
        kind = _json_type(e)
        bad_type = f"IF({kind} <> {v}.r.item, {_error(section, item_loc, 'type', f'concat({chr(39)}expected {chr(39)}, {v}.r.item)')}, NULL)"
        low = f"IF({kind} = 'integer' AND try_variant_get({e}, '$', 'double') < {v}.r.item_lo, {_error(section, item_loc, 'minimum', f'concat({chr(39)}less than {chr(39)}, CAST({v}.r.item_lo AS STRING))')}, NULL)"
        each = f"flatten(transform(coalesce(try_variant_get({v}.x, '$', 'array<variant>'), array()), ({e}, i) -> array_compact(array({bad_type}, {low}))))"
        simple = [x for x in rules if isinstance(x.items, str)]
        parts.append(
            f"flatten(transform(transform({_rules_literal(simple)}, {r} -> named_struct('r', {r}, 'x', {members}[{r}.field])), {v} -> {each}))"
        )
    for x in rules:
        if isinstance(x.items, tuple):
            e, m = f"e{depth}", f"m{depth}"
            name = _text_or_null(x.field)
            item_loc = f"concat({path}, array({name}, CAST(i{depth} AS STRING)))"
            inner = _check_object(section, m, x.items, item_loc, depth + 1, check_dates, x.open)
            as_map = f"try_variant_get({e}, '$', 'map<string,variant>')"
            not_object = f"array({_error(section, item_loc, 'type', repr('expected object'))})"
            parts.append(
                f"flatten(transform(coalesce(try_variant_get({members}[{name}], '$', 'array<variant>'), array()), ({e}, i{depth}) -> "
                f"IF({_json_type(e)} <> 'object', {not_object}, flatten(transform(array({as_map}), {m} -> {inner})))))"
            )
    for x in rules:
        if x.members:
            m, name = f"m{depth}", _text_or_null(x.field)
            as_map = f"try_variant_get({members}[{name}], '$', 'map<string,variant>')"
            inner = _check_object(section, m, x.members, f"concat({path}, array({name}))", depth + 1, check_dates, x.open)
            parts.append(f"flatten(transform(filter(array({as_map}), {m} -> {m} IS NOT NULL), {m} -> {inner}))")
    if is_open and parts:
        return f"concat({', '.join(parts)})"
    known = "CAST(array(" + ", ".join(_text_or_null(x.field) for x in rules) + ") AS array<string>)"
    if is_open:
        known = f"map_keys({members})"
    extra_error = _error(section, f"concat({path}, array(k))", "additionalProperties", "'unknown field'")
    parts.append(f"transform(array_sort(array_except(map_keys({members}), {known})), k -> {extra_error})")
    return f"concat({', '.join(parts)})"


def check_envelopes(
    df: DataFrame, column: str = "envelope", check_dates: bool = False, schema: Rule = ENVELOPE, unless: Column | None = None
) -> DataFrame:
    """Add ``errors``: one entry per breach, in schema order.

    An entry is ``struct<section, loc array<string>, rule, msg>``. Text that is
    no JSON object gives one error. ``check_dates`` also enforces the declared
    date format. ``schema`` is the rule of the envelope, the declared one or one
    from :func:`docspark.operators.schema.compile_schema`; members that have
    members themselves are its sections. Where ``unless`` holds nothing is checked.
    """
    parts = []
    sections = [x for x in schema.members if x.members]
    for x in sections:
        name = _text_or_null(x.field)
        missing = _error(name, f"array({name})", "required", "'section missing from envelope'")
        wrong = _error(name, f"array({name})", "type", "'section is not an object'")
        absent = f"array({missing})" if x.required else f"filter(array({missing}), y -> false)"
        inner = _check_object(name, "sec", x.members, "CAST(array() AS array<string>)", 0, check_dates, x.open)
        members = f"try_variant_get(root[{name}], '$', 'map<string,variant>')"
        void = f"WHEN schema_of_variant(root[{name}]) = 'VOID' THEN filter(array({wrong}), y -> false) " if "null" in x.types else ""
        body = f"CASE WHEN root[{name}] IS NULL THEN {absent} {void}WHEN sec IS NULL THEN array({wrong}) ELSE {inner} END"
        parts.append(_bind(members, "sec", body))
    names = "CAST(array(" + ", ".join(_text_or_null(x.field) for x in sections) + ") AS array<string>)"
    others = f"map_filter(root, (k, x) -> NOT array_contains({names}, k))"
    outer = _check_object(f"'{ROOT}'", "sec", [x for x in schema.members if not x.members], "CAST(array() AS array<string>)", 0, check_dates, schema.open)
    unreadable = _error(f"'{ROOT}'", "CAST(array() AS array<string>)", "type", "'not a JSON object'")
    errors = f"CASE WHEN root IS NULL THEN array({unreadable}) ELSE concat({', '.join([*parts, _bind(others, 'sec', outer)])}) END"
    root = f"try_variant_get(try_parse_json(`{column}`), '$', 'map<string,variant>')"
    found = F.expr(_bind(root, "root", errors))
    none = F.expr(f"filter(array({unreadable}), y -> false)")
    return df.withColumn("errors", found if unless is None else F.when(unless, none).otherwise(found))


def _bind(value: str, name: str, body: str) -> str:
    """SQL that computes a value once under a name, inside one expression.

    A column of its own would be substituted wherever a filter on the errors is
    pushed down, and the JSON parsed again for each mention of it.
    """
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def check_sections(df: DataFrame, check_dates: bool = False) -> DataFrame:
    """Check single candidates ``df(section, candidate string)``: adds ``ok`` and ``errors``.

    An unknown section is an error of its own.
    """
    root = "CAST(array() AS array<string>)"
    whens = " ".join(
        f"WHEN section = '{name}' THEN {_check_object(f'{chr(39)}{name}{chr(39)}', 'sec', rules, root, 0, check_dates)}"
        for name, rules in SECTION_RULES.items()
    )
    known = "', '".join(SECTION_RULES)
    unknown = _error("section", root, "section", "'unknown section'")
    unreadable = _error("section", root, "type", "'not a JSON object'")
    errors = f"CASE WHEN section IS NULL OR section NOT IN ('{known}') THEN array({unknown}) WHEN sec IS NULL THEN array({unreadable}) {whens} END"
    members = "try_variant_get(try_parse_json(candidate), '$', 'map<string,variant>')"
    checked = df.withColumn("errors", F.expr(_bind(members, "sec", errors)))
    return checked.withColumn("ok", F.size("errors") == 0)


def violation_rows(checked: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per breach."""
    return checked.select(key, F.posexplode_outer("errors").alias("no", "e")).filter(F.col("e").isNotNull()).select(key, "no", "e.*")


def scorecards(checked: DataFrame, key: str = "doc_id", keep: Sequence[str] = (), max_errors: int | None = None) -> DataFrame:
    """One scorecard per document from its errors and the team's outcome.

    ``keep`` names other columns to carry along. A document the team flagged passes without a check, since it goes to review
    anyway. All errors are listed; for display, ``max_errors`` lists only the first ones and counts the rest
    in the notes.
    ``checked`` may carry ``team_verdict`` and ``team_reason``.
    """
    flagged = F.lit(False)
    reason = F.lit("")
    if "team_verdict" in checked.columns:
        flagged = F.coalesce(F.col("team_verdict") == "sme_flag", F.lit(False))
        reason = F.coalesce("team_reason", F.lit("(no reason)"))
    n = F.size("errors")
    first = F.get("errors", F.lit(0))
    failed = F.concat(
        n.cast("string"),
        F.lit(" validation error(s); first: "),
        first["section"],
        F.lit("."),
        F.array_join(first["loc"], "."),
        F.lit(": "),
        first["msg"],
    )
    notes = (
        F.when(flagged, F.concat(F.lit("Skipped detailed validation: team emitted sme_flag: "), reason))
        .when(n == 0, F.lit("Envelope validated against schema v2."))
        .otherwise(failed)
    )
    listed = F.col("errors") if max_errors is None else F.slice("errors", 1, max_errors)
    return checked.select(
        key,
        *keep,
        F.lit("schema_validator").alias("verifier_name"),
        (flagged | (n == 0)).alias("passed"),
        F.when(flagged, F.slice("errors", 1, 0)).otherwise(listed).alias("field_errors"),
        F.when(flagged, F.lit(0)).otherwise(n).alias("n_errors"),
        notes.alias("notes"),
    )


def field_catalogue(spark: SparkSession) -> DataFrame:
    """The declared fields of all sections, as a table."""
    rows = [
        (name, i, r.field, " or ".join(r.types), r.required, r.mode or None, r.format, r.pattern)
        for name, rules in SECTION_RULES.items()
        for i, r in enumerate(rules)
    ]
    return spark.createDataFrame(
        rows, "section string, no int, field string, type string, required boolean, mode string, format string, pattern string"
    )
