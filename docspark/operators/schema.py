"""Rules out of a JSON Schema: what :mod:`docspark.operators.validate` checks and the catalogue lists.

A schema file describes an envelope: an object whose object properties are its
sections. It is compiled on the driver into the same rule tuples as the declared
record schema, so checking stays an expression inside the record's row.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.vocab import Rule

_NOTES = {"$schema", "$id", "$defs", "definitions", "$comment", "title", "description", "default", "examples", "extraction_mode"}
_KNOWN = _NOTES | {
    "type", "properties", "required", "additionalProperties", "items", "uniqueItems", "minimum", "maximum", "pattern", "format", "enum", "const",
}
_TYPES = {"string", "integer", "number", "boolean", "object", "array", "null"}


def read_schema(spark: SparkSession, path: str) -> dict[str, Any]:
    """The JSON Schema in a file of any file system that Spark reads."""
    rows = spark.read.text(path, wholetext=True).head(2)
    if len(rows) != 1:
        raise ValueError(f"{path} must be one file")
    return json.loads(rows[0][0])


def compile_schema(schema: Mapping[str, Any] | str) -> Rule:
    """The rule of an envelope; its ``members`` are the properties in schema order, sections have members themselves.

    Knows objects, arrays of simple types or of objects, type unions, ``anyOf`` and
    ``oneOf`` with null, ``enum``, ``const``, ``format``, ``pattern``, ``minimum``,
    ``maximum``, ``uniqueItems``, ``required``, ``additionalProperties`` and local
    ``$ref``. Anything else that would narrow a value raises ValueError rather than
    being left unchecked, and so does a reference that contains itself.
    """
    root = json.loads(schema) if isinstance(schema, str) else schema
    found = _resolve(root, root, ())[0]
    if "object" not in _types(found, "<root>"):
        raise ValueError("the root of a schema must be an object")
    return Rule("<root>", ("object",), mode="", members=_members(found, root, (), "<root>"), open=_is_open(found, "<root>"))


def json_schema(rule: Rule) -> dict[str, Any]:
    """The JSON Schema of a rule, as a model is given it; compiling it gives the rule again."""
    node: dict[str, Any] = {"type": rule.types[0] if len(rule.types) == 1 else list(rule.types)}
    own = {"minimum": rule.minimum, "maximum": rule.maximum, "pattern": rule.pattern, "format": rule.format}
    node |= {k: v for k, v in own.items() if v is not None}
    node |= {"uniqueItems": True} if rule.unique else {}
    node |= {"extraction_mode": rule.mode} if rule.mode else {}
    node |= {"description": rule.description} if rule.description else {}
    node |= {} if rule.choices is None else {"enum": [json.loads(c) for c in rule.choices]}
    if isinstance(rule.items, str):
        node["items"] = {"type": rule.items} | ({} if rule.item_minimum is None else {"minimum": rule.item_minimum})
    elif rule.items is not None:
        node["items"] = {"type": "object"} | _object(rule.items, rule.open)
    if rule.members:
        node |= _object(rule.members, rule.open)
    return node


def _object(members: tuple[Rule, ...], is_open: bool) -> dict[str, Any]:
    return {
        "additionalProperties": is_open,
        "required": [r.field for r in members if r.required],
        "properties": {r.field: json_schema(r) for r in members},
    }


def _resolve(node: Mapping[str, Any], root: Mapping[str, Any], seen: tuple[str, ...]) -> tuple[dict[str, Any], tuple[str, ...]]:
    """A node with its references and its union with null replaced by what they stand for."""
    node = dict(node)
    if "$ref" in node:
        ref = node.pop("$ref")
        if ref in seen:
            raise ValueError(f"{ref} contains itself")
        if not ref.startswith("#/"):
            raise ValueError(f"{ref} is not in the same file")
        target: Any = root
        for step in ref[2:].split("/"):
            step = step.replace("~1", "/").replace("~0", "~")
            if step not in target:
                raise ValueError(f"{ref} does not exist")
            target = target[step]
        target, seen = _resolve(target, root, (*seen, ref))
        node = target | node
    for word in ("anyOf", "oneOf"):
        if word in node:
            options = node.pop(word)
            solid = [o for o in options if o.get("type") != "null"]
            if len(solid) != 1:
                raise ValueError(f"{word} of more than one type and null")
            target, seen = _resolve(solid[0], root, seen)
            node = target | node
            if len(solid) < len(options):
                own = node.get("type", [])
                node["type"] = [*([own] if isinstance(own, str) else own), "null"]
                if "enum" in node and None not in node["enum"]:
                    node["enum"] = [*node["enum"], None]
    return node, seen


def _types(node: Mapping[str, Any], name: str) -> tuple[str, ...]:
    unknown = set(node) - _KNOWN
    if unknown:
        raise ValueError(f"{name}: {', '.join(sorted(unknown))} is not supported")
    own = node.get("type")
    if own is None:
        own = "object" if "properties" in node else "array" if "items" in node else sorted(_TYPES)
    own = (own,) if isinstance(own, str) else tuple(own)
    if not own or set(own) - _TYPES:
        raise ValueError(f"{name}: unknown type {own}")
    return own


def _members(node: Mapping[str, Any], root: Mapping[str, Any], seen: tuple[str, ...], name: str) -> tuple[Rule, ...]:
    required = set(node.get("required", ()))
    undeclared = required - set(node.get("properties", {}))
    if undeclared:
        raise ValueError(f"{name}: required but not declared: {', '.join(sorted(undeclared))}")
    return tuple(_rule(k, v, k in required, root, seen) for k, v in node.get("properties", {}).items())


def _is_open(node: Mapping[str, Any], name: str) -> bool:
    more = node.get("additionalProperties", True)
    if not isinstance(more, bool):
        raise ValueError(f"{name}: additionalProperties must be true or false")
    return more


def _rule(name: str, node: Mapping[str, Any], required: bool, root: Mapping[str, Any], seen: tuple[str, ...]) -> Rule:
    node, seen = _resolve(node, root, seen)
    types = _types(node, name)
    more: dict[str, Any] = {}
    if "properties" in node:
        more |= {"members": _members(node, root, seen, name), "open": _is_open(node, name)}
    if "items" in node:
        item, inside = _resolve(node["items"], root, seen)
        kinds = _types(item, f"{name}[]")
        if kinds == ("object",) and "properties" in item:
            more |= {"items": _members(item, root, inside, f"{name}[]"), "open": _is_open(item, f"{name}[]")}
        elif len(kinds) == 1 and not set(item) - _NOTES - {"type", "minimum"}:
            more |= {"items": kinds[0], "item_minimum": _number(item.get("minimum"))}
        else:
            raise ValueError(f"{name}[]: items must be objects or of one simple type")
    choices = [node["const"]] if "const" in node else node.get("enum")
    return Rule(
        name,
        types,
        mode=node.get("extraction_mode", ""),
        required=required,
        minimum=_number(node.get("minimum")),
        maximum=_number(node.get("maximum")),
        pattern=node.get("pattern"),
        format=node.get("format"),
        unique=bool(node.get("uniqueItems", False)),
        choices=None if choices is None else tuple(json.dumps(c, ensure_ascii=False, separators=(",", ":")) for c in choices),
        description=node.get("description", ""),
        **more,
    )


def _number(v: Any) -> float | None:
    return None if v is None else float(v)


def field_use(envelopes: DataFrame, schema: Rule, column: str = "envelope") -> DataFrame:
    """The declared fields of all sections, each with the number of envelopes that hold it and that fill it.

    ``held`` counts fields that are there, ``filled`` those that are not null. All
    fields are counted in one pass, so one row leaves a task.
    """
    parsed = envelopes.select(F.try_parse_json(column).alias("v"))
    counted, rows = [], []
    fields = [(s, i, r) for s in schema.members if s.members for i, r in enumerate(s.members)]
    for n, (s, i, r) in enumerate(fields):
        value = F.try_variant_get("v", f'$["{s.field}"]["{r.field}"]', "variant")
        counted += [F.count(value).alias(f"h{n}"), F.count_if(value.isNotNull() & ~F.is_variant_null(value)).alias(f"f{n}")]
        rows.append(
            F.struct(
                F.lit(s.field).alias("section"),
                F.lit(i).alias("no"),
                F.lit(r.field).alias("field"),
                F.lit(" or ".join(r.types)).alias("type"),
                F.lit(r.required).alias("required"),
                F.lit(r.mode or None).cast("string").alias("mode"),
                F.lit(r.format).cast("string").alias("format"),
                F.lit(r.pattern).cast("string").alias("pattern"),
                F.lit(r.description).alias("description"),
                F.col(f"h{n}").alias("held"),
                F.col(f"f{n}").alias("filled"),
            )
        )
    return parsed.agg(*counted).select(F.inline(F.array(*rows)))
