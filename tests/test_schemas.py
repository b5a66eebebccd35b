"""Compiled schemas against a validator in plain Python, on made and on random values."""

import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from loomlex.functions import schemas

HASH = {"type": "string", "pattern": "^[0-9a-f]{4}$"}
ANSWER = {
    "type": "object", "additionalProperties": False, "required": ["id", "verdict", "score", "kinds", "spans", "more"],
    "properties": {
        "id": HASH, "verdict": {"enum": ["pass", "defect", None]}, "score": {"type": "number", "minimum": 0, "exclusiveMaximum": 1}, "kinds": {"type": "array", "uniqueItems": True, "maxItems": 3, "items": {"enum": ["a", "b"]}},
        "spans": {"type": "array", "items": {"$ref": "#/$defs/span"}}, "more": {"type": ["string", "null"]}, "count": {"type": "integer"}, "row": {"type": "array", "prefixItems": [{"enum": ["added"]}, {"type": "string"}], "items": False},
        "hashes": {"type": "object", "additionalProperties": HASH}, "lineage": {"oneOf": [{"type": "null"}, {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "minimum": 1}}}]}, "flag": {"type": "boolean"}, "claim": {"const": "it's so"},
    },
    "allOf": [
        {"if": {"properties": {"verdict": {"const": "defect"}}}, "then": {"properties": {"kinds": {"minItems": 1}, "spans": {"minItems": 1}}}},
        {"if": {"properties": {"verdict": {"const": "pass"}}, "required": ["verdict"]}, "then": {"properties": {"more": {"type": "null"}}}, "else": {"not": {"required": ["count"]}}},
    ],
    "$defs": {"span": {"type": "object", "additionalProperties": False, "required": ["source"], "properties": {"source": {"enum": ["x", "y"]}, "quote": {"type": "string", "minLength": 1}}}},
}


def is_(v, kind):
    number = isinstance(v, int | float) and not isinstance(v, bool)
    return {"object": isinstance(v, dict), "array": isinstance(v, list), "string": isinstance(v, str), "boolean": isinstance(v, bool), "null": v is None, "number": number, "integer": number and v == math.floor(v)}[kind]


def same(a, b):
    return json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True) or (is_(a, "number") and is_(b, "number") and a == b)


def fails(v, s, root, path="$"):
    """The set of "path: keyword" of a value."""
    if s is True or s is False:
        return set() if s else {f"{path}: false"}
    out = set()
    say = lambda bad, keyword: out.add(f"{path}: {keyword}") if bad else None
    if "$ref" in s:
        out |= fails(v, root["$defs"][s["$ref"].split("/")[-1]], root, path)
    if "type" in s:
        say(not any(is_(v, k) for k in ([s["type"]] if isinstance(s["type"], str) else s["type"])), "type")
    say("const" in s and not same(v, s["const"]), "const")
    say("enum" in s and not any(same(v, x) for x in s["enum"]), "enum")
    if isinstance(v, str):
        say("pattern" in s and not re.search(s["pattern"], v), "pattern")
        say(len(v) < s.get("minLength", 0), "minLength")
    if is_(v, "number"):
        say(v < s.get("minimum", v), "minimum")
        say(v >= s.get("exclusiveMaximum", v + 1), "exclusiveMaximum")
    if isinstance(v, list):
        say(len(v) < s.get("minItems", 0), "minItems")
        say(len(v) > s.get("maxItems", len(v)), "maxItems")
        say(s.get("uniqueItems") and any(same(a, b) for i, a in enumerate(v) for b in v[:i]), "uniqueItems")
        first = s.get("prefixItems", [])
        for k, (x, sub) in enumerate(zip(v, first, strict=False)):
            out |= fails(x, sub, root, f"{path}[{k}]")
        for x in v[len(first) :]:
            out |= fails(x, s.get("items", True), root, f"{path}[]")
    if isinstance(v, dict):
        for k, sub in s.get("properties", {}).items():
            if k in v:
                out |= fails(v[k], sub, root, f"{path}.{k}")
        for k in s.get("required", []):
            say(k not in v, f"required {k}")
        for k in v.keys() - s.get("properties", {}).keys():
            more = s.get("additionalProperties", True)
            say(more is False, "additionalProperties")
            if isinstance(more, dict):
                out |= fails(v[k], more, root, f"{path}.*")
    for sub in s.get("allOf", []):
        out |= fails(v, sub, root, path)
    say("oneOf" in s and sum(not fails(v, sub, root) for sub in s["oneOf"]) != 1, "oneOf")
    say("not" in s and not fails(v, s["not"], root), "not")
    if "if" in s:
        out |= fails(v, s.get("else", True) if fails(v, s["if"], root) else s.get("then", True), root, path)
    return out


def values(n, seed=1):
    r = random.Random(seed)
    odd = [None, True, 0, 1, 1.5, 2.0, -1, "", "a", "00ff", "é", [], ["a"], ["a", "a"], ["a", 1, 1.0], [None], {}, {"n": 1}, {"n": 0}, {"source": "x"}, {"source": "x", "quote": ""}, {"k": "00ff"}, {"k": 1}, "it's so", "pass", "defect", ["added", "x"], ["added", 1], ["added", "x", "y"]]
    good = {"id": "00ff", "verdict": "pass", "score": 0.5, "kinds": ["a"], "spans": [{"source": "x", "quote": "q"}], "more": None}
    names = [*ANSWER["properties"], "extra"]
    out = [*odd, good]
    for _ in range(n):
        v = dict(good)
        for _ in range(r.randint(0, 3)):
            k = r.choice(names)
            if r.random() < 0.2:
                v.pop(k, None)
            else:
                v[k] = r.choice(odd) if r.random() < 0.8 else [r.choice(odd) for _ in range(3)]
        out.append(v)
    return out


def test_against_plain_python(spark):
    found = values(400)
    rows = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=False)) for i, v in enumerate(found)], "i int, text string")
    got = {r.i: set(r.f) for r in rows.select("i", schemas.failures(F.col("text"), ANSWER).alias("f")).collect()}
    for i, v in enumerate(found):
        assert got[i] == fails(v, ANSWER, ANSWER), v
    assert sum(not x for x in got.values()) > 20 and len(set().union(*got.values())) > 30
    told = schemas.findings(rows, "text", ANSWER, "i").collect()
    assert {(r.i, f"{r.path}: {r.keyword}") for r in told} == {(i, x) for i, xs in got.items() for x in xs} and len(told) == sum(map(len, got.values()))


def test_texts_that_are_no_json(spark):
    rows = spark.createDataFrame([(None,), ("{",), ("",), ("{}",), ("[1]",)], "text string")
    assert [r[0] for r in rows.select(schemas.failures(F.col("text"), {"type": "object"})).collect()] == [["$: json"], ["$: json"], ["$: json"], [], ["$: type"]]


def test_schemas_that_are_not_understood(spark, tmp_path):
    for bad in ({"contains": 1}, {"$ref": "#"}, {"$ref": "http://x"}, {"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"}):
        (tmp_path / "s.json").write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            schemas.read(str(tmp_path / "s.json"))
    (tmp_path / "s.json").write_text(json.dumps(ANSWER))
    assert schemas.read(str(tmp_path / "s.json")) == ANSWER
