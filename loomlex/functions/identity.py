"""Hashes of canonical JSON, and families of identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What no annotation hashes to, and the shapes of local names, in the order in which they are tried.
ABSENT = "<absent>"
FAMILIES = (
    ("canonical", r"R[0-9A-Za-z]{19,22}"),
    ("legacy-hex", r"R[0-9A-Fa-f]{23}"),
    ("legacy-r-base64url", r"R[0-9A-Za-z_-]{19,23}"),
    ("legacy-uuid", r"[0-9A-Za-z_-]{22}"),
    ("legacy-16-bytes", r"[0-9A-Za-z]{17,21}[AQgw]"),
)


def canonical_json(**fields: Column) -> Column:
    """Keys sorted, no spaces, nulls kept. Values are strings; control characters below 0x20 are spelt in lower case."""
    pairs = []
    for k in sorted(fields):
        v = F.to_json(F.array(fields[k].cast("string")))
        text = F.substring(v, 2, 1 << 30)
        text = F.substring(text, F.lit(1), F.length(text) - 1)
        pairs.append(F.concat(F.lit(f'"{k}":'), F.when(fields[k].isNull(), F.lit("null")).otherwise(text)))
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def value_hash(subject: Column, predicate: Column, lexical: Column, language: Column, datatype: Column) -> Column:
    """Of a literal annotation; lexical in NFC."""
    return content_hash(canonical_json(subject=subject, predicate=predicate, object_kind=F.lit("literal"), language=F.lower(language), datatype=datatype, lexical=lexical))


def record_id(locator: Column, before_hash: Column, after_hash: Column) -> Column:
    """Of a change; locator is canonical JSON."""
    absent = F.sha2(F.lit(ABSENT), 256)
    q = lambda c: F.concat(F.lit('"'), F.coalesce(c, absent), F.lit('"'))
    return content_hash(F.concat(F.lit('{"after_hash":'), q(after_hash), F.lit(',"before_hash":'), q(before_hash), F.lit(',"locator":'), locator, F.lit("}")))


def surveillance_id(subject: Column, predicate: Column, lexical: Column, language: Column) -> Column:
    """Of a standing annotation; a missing language counts as English."""
    locale = F.lower(F.coalesce(F.nullif(language, F.lit("")), F.lit("en")))
    return content_hash(canonical_json(subject=subject, predicate=predicate, lexical=lexical, locale=locale))


def debt_root(debt_id: Column, subject: Column, predicate: Column, language: Column, datatype: Column, current_hash: Column) -> Column:
    """Of an entry of confirmed debt; corrections name it as their root."""
    return content_hash(canonical_json(debt_id=debt_id, subject=subject, predicate=predicate, language=language, datatype=datatype, current_hash=current_hash))


def to_curie(c: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), c)


def from_curie(c: Column, prefix: str) -> Column:
    """What follows the prefix; another prefix fails the job."""
    wrong = F.raise_error(F.concat(F.lit("not an identifier with the prefix " + prefix + ": "), F.coalesce(c, F.lit("null"))))
    return F.when(F.startswith(c, F.lit(prefix)), F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(wrong.cast("string"))


def family(local_name: Column, families=FAMILIES, other: str = "nonconforming") -> Column:
    out = F.lit(other)
    for name, shape in reversed(families):
        out = F.when(local_name.rlike(f"^(?:{shape})$") & ~F.contains(local_name, F.lit("\n")), F.lit(name)).otherwise(out)
    return out
