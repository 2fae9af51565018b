"""Walks and schemas over VARIANT against plain Python."""

import json
import math
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import variants
from millrace.sources import markup

KINDS = {str: "string", bool: "boolean", type(None): "null", list: "array", dict: "object"}


def kind(v):
    return KINDS.get(type(v)) or ("integer" if float(v).is_integer() else "number")


def faults(v, schema, path="", root=None):
    """The plain version: one keyword after the other."""
    root = schema if root is None else root
    if isinstance(schema, bool):
        return [] if schema else [(path, "false")]
    if "$ref" in schema:
        target = root
        for part in schema["$ref"][2:].split("/"):
            target = target[part]
        schema = target
    k, out = kind(v), []
    number, string = k in ("integer", "number"), k == "string"
    same = lambda a, b: a == b and isinstance(a, bool) == isinstance(b, bool)
    plain = {
        "enum": lambda s: any(same(v, x) for x in s), "const": lambda s: same(v, s), "minimum": lambda s: not number or v >= s, "maximum": lambda s: not number or v <= s,
        "exclusiveMinimum": lambda s: not number or v > s, "exclusiveMaximum": lambda s: not number or v < s, "multipleOf": lambda s: not number or math.isclose(v / s, round(v / s)),
        "minLength": lambda s: not string or len(v) >= s, "maxLength": lambda s: not string or len(v) <= s, "pattern": lambda s: not string or re.search(s, v),
        "minItems": lambda s: k != "array" or len(v) >= s, "maxItems": lambda s: k != "array" or len(v) <= s, "uniqueItems": lambda s: k != "array" or len({json.dumps(x, sort_keys=True) for x in v}) == len(v),
        "minProperties": lambda s: k != "object" or len(v) >= s, "maxProperties": lambda s: k != "object" or len(v) <= s,
        "anyOf": lambda s: any(not faults(v, x, path, root) for x in s), "oneOf": lambda s: sum(not faults(v, x, path, root) for x in s) == 1, "not": lambda s: faults(v, s, path, root),
    }
    for word, s in schema.items():
        if word in plain:
            out += [] if plain[word](s) else [(path, word)]
        elif word == "type":
            kinds = [s] if isinstance(s, str) else s
            out += [] if k in kinds or (k == "integer" and "number" in kinds) else [(path, f"type {' or '.join(kinds)}")]
        elif word == "allOf":
            out += [x for part in s for x in faults(v, part, path, root)]
        elif k == "object" and word == "required":
            out += [(path, f"required {n}") for n in s if n not in v]
        elif k == "object" and word == "properties":
            out += [x for n, part in s.items() if n in v for x in faults(v[n], part, f"{path}/{n}", root)]
        elif k == "object" and word == "additionalProperties":
            out += [x for n in v if n not in schema.get("properties", {}) for x in faults(v[n], s, f"{path}/{n}", root)]
        elif k == "array" and word == "items":
            out += [x for i, e in enumerate(v) if i >= len(schema.get("prefixItems", [])) for x in faults(e, s, f"{path}/{i}", root)]
        elif k == "array" and word == "prefixItems":
            out += [x for i, (e, part) in enumerate(zip(v, s)) for x in faults(e, part, f"{path}/{i}", root)]
    return out


VALUES = [
    None, True, False, 0, 1, 2.0, 2.5, -3, 10**20, "", "a", "añb", "x" * 100_000, "1", [], [1], [1, 1], [1, "a", None, {"k": 1}], [[1, [2, "b"]], []], {}, {"a": 1}, {"a": "x", "b": [1, 2, 3]},
    {"a": None}, {"a.b": {"c": "é"}, "a": {"c": 2}}, {"b": [{"a": 1}, {"a": "1"}, {}, 7]}, {"tipo": "t", "valor": {"tipo": "u"}},
]
SCHEMAS = [
    {"type": "integer"}, {"type": "number"}, {"type": ["string", "null"]}, {"type": "object"}, {"type": "array"}, {"type": "boolean"}, {"enum": [1, "a", None, True]}, {"const": 2}, {"const": ""},
    {"minimum": 1}, {"maximum": 2}, {"exclusiveMinimum": 1}, {"exclusiveMaximum": 2.5}, {"multipleOf": 2}, {"minLength": 2}, {"maxLength": 1}, {"pattern": "ñ|^1$"}, {"minItems": 1}, {"maxItems": 2},
    {"uniqueItems": True}, {"minProperties": 1}, {"maxProperties": 1}, {"required": ["a", "b"]}, {"properties": {"a": {"type": "integer"}}}, {"properties": {"a.b": {"required": ["d"]}}},
    {"properties": {"a": True}, "additionalProperties": False}, {"additionalProperties": {"type": "array"}}, {"items": {"type": "integer"}}, {"prefixItems": [{"const": 1}, {"type": "string"}], "items": {"type": "null"}},
    {"allOf": [{"type": "integer"}, {"minimum": 1}]}, {"anyOf": [{"type": "string"}, {"minimum": 2}]}, {"oneOf": [{"type": "integer"}, {"minimum": 2}]}, {"not": {"type": "object"}}, {"not": {}}, True, False, {},
    {"properties": {"b": {"items": {"$ref": "#/$defs/row"}}}, "$defs": {"row": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer"}}}}},
    {"title": "notes change nothing", "description": "x"},
]


def test_every_keyword_fails_and_passes_as_in_plain_python(spark):
    rows = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=False)) for i, v in enumerate(VALUES)], "i int, j string")
    for part in (SCHEMAS[:20], SCHEMAS[20:]):
        for r in rows.select("i", *[variants.schema_faults(F.col("j"), s).alias(f"s{n}") for n, s in enumerate(part)]).collect():
            for n, s in enumerate(part):
                assert sorted((f["path"], f["rule"]) for f in r[f"s{n}"]) == sorted(faults(VALUES[r["i"]], s)), (VALUES[r["i"]] if r["i"] != 12 else "long", s)


def test_no_json_and_schemas_that_cannot_be_compiled(spark):
    rows = spark.createDataFrame([(None,), ("",), ("{",), ('{"a": 1, "a": 2}',)], "j string")
    assert {tuple(map(tuple, r["f"])) for r in rows.select(variants.schema_faults(F.col("j"), {}).alias("f")).collect()} == {(("", "not json"),)}
    assert rows.where("j = 'x'").select(variants.schema_faults(F.col("j"), {}).alias("f")).count() == 0
    loop = {"$ref": "#/$defs/a", "$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}}
    for schema in ({"unheardOf": 1}, {"enum": [[1]]}, {"$ref": "https://schema.example/x"}, loop):
        with pytest.raises(ValueError):
            variants.schema_faults(F.col("j"), schema)


def test_walk_equals_the_plain_walk(spark):
    rows = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=False), 0) for i, v in enumerate(VALUES)] + [(100, None, 0), (101, "no json", 0), (101, "[1]", 0), (101, "[1]", 0)], "`i.d` int, value string, path int")
    got = sorted((r["i.d"], r["path"], r["value"]) for r in variants.scalars(rows, ["i.d"], "value").collect() if r["kind"] not in ("integer", "number"))
    plain = [(i, v) for i, v in enumerate(VALUES)]
    want = sorted((i, p, t) for i, v in plain for p, t in markup.walk(v) if not re.fullmatch(r"-?[\d.e+]+", t) or isinstance(v, str))
    assert [x for x in got if x[2] != "1"] == [x for x in want if x[2] != "1"]
    numbers = sorted((r["i.d"], r["path"], float(r["value"])) for r in variants.scalars(rows, ["i.d"], "value").collect() if r["kind"] in ("integer", "number"))
    assert [x for x in numbers if x[0] < 100] == sorted((i, p, float(t)) for i, v in plain if not isinstance(v, str) for p, t in markup.walk(v) if re.fullmatch(r"-?[\d.e+]+", t) and not (i == 24 and p == "$.b[1].a"))
    assert [x for x in numbers if x[0] >= 100] == [(101, "$[0]", 1.0)] * 2
    assert variants.nodes(rows.where("path = 1"), ["i.d"], "value").count() == 0
    with pytest.raises(ValueError):
        variants.nodes(rows, ["i.d"], "value", depth=2)


def test_typed_fields_inside_each_other(spark):
    rows = spark.createDataFrame([(1, json.dumps({"a": [{"tipo": "t", "valor": {"tipo": "u", "valor": None}}, {"valor": 1}]}))], "id int, j string")
    got = sorted(tuple(r) for r in variants.typed_fields(rows, ["id"], "j", "tipo", ["tipo", "valor"]).collect())
    assert got == [(1, "$.a[0]", "a", "t", '{"tipo":"u","valor":null}'), (1, "$.a[0].valor", "valor", "u", None)]


NESTED = [
    {"properties": {"a.b": {"properties": {"c": {"maxLength": 0}}}, "a": {"anyOf": [{"required": ["d"]}, {"properties": {"c": {"minimum": 3}}}]}}, "additionalProperties": {"items": {"required": ["a"], "minProperties": 1}}},
    {"allOf": [{"items": {"type": ["integer", "array"]}}, {"items": {"allOf": [{"type": "integer"}, {"minimum": 1}], "not": {"minimum": 1.5}}}, {"maxItems": 3}], "prefixItems": [{"enum": [1, 2]}, False]},
    {"properties": {"a": False, "b": {"items": {"anyOf": [{"type": "integer"}, {"items": True}], "additionalProperties": False}}}, "required": ["valor"], "additionalProperties": {"$ref": "#/$defs/t"}, "$defs": {"t": {"oneOf": [{"type": "string"}, {"required": ["tipo"]}]}}},
]


def test_rows_of_faults_equal_the_expression(spark):
    texts = [json.dumps(v, ensure_ascii=False) for v in VALUES] + [None, "", "{", '{"a": 1, "a": 2}', '{"a/~x": [{"q": 1}, 3, {}], "a": null, "b": [{}, 1.5, [1]]}', "[3, 1, 0.5, [], 1e300, 12345678901234567890123, true]"]
    rows = spark.createDataFrame(list(enumerate(texts)), "`i.d` int, j string").repartition(2)
    for schema in [*NESTED, {"enum": [1, "a", None, True]}, {"multipleOf": 2, "type": ["number", "null"], "uniqueItems": True}, True, False]:
        want = rows.select(F.col("`i.d`").alias("i"), F.explode(variants.schema_faults(F.col("j"), schema)).alias("f")).select("i", "f.*").collect()
        assert sorted(map(tuple, variants.fault_rows(rows, ["i.d"], "j", schema).collect())) == sorted(map(tuple, want)), schema
    for schema in ({"unheardOf": 1}, {"items": {"enum": [[1]]}}, {"$ref": "#/$defs/a", "$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}}):
        with pytest.raises(ValueError):
            variants.fault_rows(rows, ["i.d"], "j", schema)


def test_checks_of_orders_are_compiled_and_dealt_out(spark):
    import re

    from millrace.plans import queries

    plan = queries()["schema_paths"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan  # a broadcast leaves all checks to one task
    assert "aggregate(" not in plan and not re.search(r"size\(CASE", plan)  # no check inside a lambda, none worked out twice
