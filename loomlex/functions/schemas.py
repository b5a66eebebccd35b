"""JSON Schemas as plans: a schema is compiled to one Column over a JSON text, whose value lists the paths and keywords that fail.

The text becomes a VARIANT; each keyword is a condition on it or on its parts, so that a whole table is checked within
code generation, without a parser in Python. Known keywords: type, const, enum, pattern, minLength, maxLength, minimum,
maximum, exclusiveMinimum, exclusiveMaximum, minItems, maxItems, uniqueItems, items, prefixItems, properties, required,
additionalProperties, allOf, anyOf, oneOf, not, if, then, else, and $ref within the schema. Formats, titles and the like say
nothing. A schema with another keyword, or with a reference to itself, is refused.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_IDLE = {"$schema", "$id", "$defs", "title", "description", "default", "examples", "format", "$comment"}
_KNOWN = _IDLE | set("type const enum pattern minLength maxLength minimum maximum exclusiveMinimum exclusiveMaximum minItems maxItems uniqueItems items prefixItems properties required additionalProperties allOf anyOf oneOf not if then else $ref".split())


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is(v: Column, name: str) -> Column:
    kind = _kind(v)
    number = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
    return {
        "object": F.startswith(kind, F.lit("OBJECT")), "array": F.startswith(kind, F.lit("ARRAY")), "string": kind == "STRING", "boolean": kind == "BOOLEAN", "null": kind == "VOID", "number": number,
        "integer": number & F.coalesce(_number(v) == F.floor(_number(v)), F.lit(False)),
    }[name]


def _number(v: Column) -> Column:
    return F.try_variant_get(v, "$", "decimal(38,10)")


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _items(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _part(v: Column, name: str) -> Column:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(v, f"$['{quoted}']", "variant")


def _canonical(v: Column) -> Column:
    """A text that equal values share: a variant's keys are sorted, and numbers are without trailing zeros."""
    return F.when(_is(v, "number"), F.regexp_replace(_number(v).cast("string"), r"\.?0*$", "")).otherwise(F.to_json(v))


def _equals(v: Column, value) -> Column:
    return F.coalesce(_canonical(v) == _canonical(F.parse_json(F.lit(json.dumps(value)))), F.lit(False)) & ((_kind(v) == "STRING") == F.lit(isinstance(value, str)))


def _none() -> Column:
    return F.array().cast("array<string>")


def _fails(bad: Column, path: str, keyword: str) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), F.array(F.lit(f"{path}: {keyword}"))).otherwise(_none())


def _all(found: list[Column]) -> Column:
    return F.concat(*found) if len(found) > 1 else found[0] if found else _none()


class Compiler:
    def __init__(self, schema: dict):
        self.root = schema

    def resolve(self, ref: str):
        if not ref.startswith("#"):
            raise ValueError(f"a reference out of the schema: {ref}")
        at = self.root
        for step in filter(None, ref[1:].split("/")):
            at = at[step.replace("~1", "/").replace("~0", "~")]
        return at

    def check(self, v: Column, schema, path: str, seen: tuple[str, ...] = ()) -> Column:
        """The findings of a value that is there."""
        if schema is True:
            return _none()
        if schema is False:
            return F.array(F.lit(f"{path}: false"))
        if unknown := set(schema) - _KNOWN:
            raise ValueError(f"unknown keywords: {sorted(unknown)}")
        out: list[Column] = []
        fails = lambda kind, keyword, bad: out.append(_fails(_is(v, kind) & bad, path, keyword))
        if "$ref" in schema:
            if schema["$ref"] in seen:
                raise ValueError(f"a reference to itself: {schema['$ref']}")
            out.append(self.check(v, self.resolve(schema["$ref"]), path, (*seen, schema["$ref"])))
        if "type" in schema:
            kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
            out.append(_fails(~reduce(Column.__or__, [_is(v, k) for k in kinds]), path, "type"))
        if "const" in schema:
            out.append(_fails(~_equals(v, schema["const"]), path, "const"))
        if "enum" in schema:
            out.append(_fails(~reduce(Column.__or__, [_equals(v, x) for x in schema["enum"]]), path, "enum"))
        for keyword, kind, bad in (
            ("pattern", "string", lambda x: ~_text(v).rlike(x)), ("minLength", "string", lambda x: F.length(_text(v)) < x), ("maxLength", "string", lambda x: F.length(_text(v)) > x),
            ("minimum", "number", lambda x: _number(v) < x), ("maximum", "number", lambda x: _number(v) > x), ("exclusiveMinimum", "number", lambda x: _number(v) <= x), ("exclusiveMaximum", "number", lambda x: _number(v) >= x),
            ("minItems", "array", lambda x: F.size(_items(v)) < x), ("maxItems", "array", lambda x: F.size(_items(v)) > x),
        ):
            if keyword in schema:
                fails(kind, keyword, bad(schema[keyword]))
        if schema.get("uniqueItems"):
            names = F.transform(_items(v), lambda x: F.concat(F.when(_kind(x) == "STRING", F.lit("s")).otherwise(F.lit("v")), _canonical(x)))
            fails("array", "uniqueItems", F.size(names) != F.size(F.array_distinct(names)))
        inside = lambda kind, found: out.append(F.when(_is(v, kind), found).otherwise(_none()))
        first = schema.get("prefixItems", [])
        for k, sub in enumerate(first):
            x = F.get(_items(v), F.lit(k))
            inside("array", F.when(x.isNotNull(), self.check(x, sub, f"{path}[{k}]", seen)).otherwise(_none()))
        if "items" in schema:
            rest = F.slice(_items(v), len(first) + 1, F.greatest(F.lit(0), F.size(_items(v)) - len(first))) if first else _items(v)
            inside("array", F.flatten(F.transform(rest, lambda x: self.check(x, schema["items"], f"{path}[]", seen))))
        for name, sub in schema.get("properties", {}).items():
            x = _part(v, name)
            inside("object", F.when(x.isNotNull(), self.check(x, sub, f"{path}.{name}", seen)).otherwise(_none()))
        for name in schema.get("required", []):
            fails("object", f"required {name}", _part(v, name).isNull())
        if "additionalProperties" in schema and schema["additionalProperties"] is not True:
            fields = F.try_variant_get(v, "$", "map<string,variant>")
            known = list(schema.get("properties", {}))
            more = F.filter(F.map_entries(fields), lambda e: ~e["key"].isin(known)) if known else F.map_entries(fields)
            if schema["additionalProperties"] is False:
                fails("object", "additionalProperties", F.size(more) > 0)
            else:
                inside("object", F.flatten(F.transform(more, lambda e: self.check(e["value"], schema["additionalProperties"], f"{path}.*", seen))))
        good = lambda sub: F.size(self.check(v, sub, path, seen)) == 0
        out += [self.check(v, sub, path, seen) for sub in schema.get("allOf", [])]
        if "anyOf" in schema:
            out.append(_fails(~reduce(Column.__or__, [good(s) for s in schema["anyOf"]]), path, "anyOf"))
        if "oneOf" in schema:
            out.append(_fails(reduce(Column.__add__, [good(s).cast("int") for s in schema["oneOf"]]) != 1, path, "oneOf"))
        if "not" in schema:
            out.append(_fails(good(schema["not"]), path, "not"))
        if "if" in schema:
            holds = good(schema["if"])
            out.append(F.when(holds, self.check(v, schema.get("then", True), path, seen)).otherwise(self.check(v, schema.get("else", True), path, seen)))
        return _all(out)


def failures(text: Column, schema) -> Column:
    """Sorted, distinct "path: keyword" of a JSON text; of what is no JSON, or null, "$: json"."""
    v = F.try_parse_json(text)
    return F.when(v.isNull(), F.array(F.lit("$: json"))).otherwise(F.array_sort(F.array_distinct(Compiler(schema).check(v, schema, "$"))))


def findings(rows: DataFrame, text: str, schema, *keep: str) -> DataFrame:
    """(keep..., path, keyword): a row per failure of the JSON in a column; none for rows that fit the schema."""
    found = rows.select(*keep, F.explode(failures(F.col(text), schema)).alias("_f"))
    return found.select(*keep, F.substring_index("_f", ": ", 1).alias("path"), F.expr("substr(_f, instr(_f, ': ') + 2)").alias("keyword"))


def read(path: str) -> dict:
    """A schema file, compiled once so that one that is not understood is refused here."""
    with open(path, encoding="utf-8") as f:
        schema = json.load(f)
    Compiler(schema).check(F.parse_json(F.lit("null")), schema, "$")
    return schema
