import json

import pytest

from docspark.operators import schema as SC
from docspark.operators import validate as V
from docspark.vocab import ENVELOPE


def test_schema_compiles_back_to_its_rules(spark, tmp_path):
    text = json.dumps(SC.json_schema(ENVELOPE))
    assert SC.compile_schema(text) == ENVELOPE
    f = tmp_path / "schema.json"
    f.write_text(json.dumps(json.loads(text), indent=2))
    assert SC.compile_schema(SC.read_schema(spark, str(f))) == ENVELOPE


def test_schema_that_cannot_be_checked_is_refused():
    obj = lambda **p: {"type": "object", "properties": p}
    bad = [
        {"type": "array"},
        obj(a={"type": "text"}),
        obj(a={"type": "string", "maxLength": 3}),
        obj(a={"$ref": "#/$defs/none"}),
        obj(a={"$ref": "other.json#/a"}),
        obj(a={"anyOf": [{"type": "string"}, {"type": "integer"}]}),
        obj(a={"type": "array", "items": {"type": ["string", "null"]}}),
        obj() | {"required": ["b"]},
        obj(a=obj(b={"$ref": "#/properties/a"})),
    ]
    for schema in bad:
        with pytest.raises(ValueError):
            SC.compile_schema(schema)


def test_nested_rules_of_a_schema(spark):
    leaf = {"type": "object", "additionalProperties": False, "required": ["v'1"], "properties": {"v'1": {"type": ["integer", "null"], "enum": [1, 2, None]}}}
    schema = {
        "type": "object", "required": ["s"], "additionalProperties": False, "$defs": {"leaf": leaf},
        "properties": {
            "s": {"type": "object", "required": ["one"], "properties": {"one": {"$ref": "#/$defs/leaf"}, "many": {"type": "array", "items": {"$ref": "#/$defs/leaf"}}}},
            "t": {"type": ["object", "null"], "properties": {"x": {"type": "boolean"}}},
        },
    }
    one = '{"v\'1":1}'
    rows = [
        (1, '{"s":{"one":%s,"free":0}}' % one, []),
        (2, '{"s":{"one":{"v\'1":3},"many":[%s,{"w":1},5]},"t":null}' % one, ["s one.v'1 enum", "s many.1.v'1 required", "s many.1.w additionalProperties", "s many.2 type"]),
        (3, '{"s":{"one":{"v\'1":null}},"t":{"x":1},"u":1}', ["t x type", "<root> u additionalProperties"]),
        (4, '{"t":{"x":true}}', ["s s required"]),
        (5, '{"s":{"one":null}}', ["s one type"]),
        (6, '{"s":7,"t":[]}', ["s s type", "t t type"]),
        (7, "[1]", ["<root>  type"]),
        (8, None, ["<root>  type"]),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id int, envelope string")
    got = V.check_envelopes(df, schema=SC.compile_schema(schema))
    errors = {r["doc_id"]: [f"{e['section']} {'.'.join(e['loc'])} {e['rule']}" for e in r["errors"]] for r in got.collect()}
    for d, _, want in rows:
        assert sorted(errors[d]) == sorted(want), d
