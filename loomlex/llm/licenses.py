"""Licence scans: identifier tags and notice phrases by an Aho-Corasick automaton, licence expressions by a shunting-yard parser.

The text's words are read by one automaton over words, whose patterns are notice phrases and the words of identifier tags
("spdx license identifier"). A tag's expression is then read from the text itself, up to the end of its line: names,
AND, OR, WITH, "+" and parentheses become postfix by a shunting yard, which is evaluated to the names it holds, its
obligation (of OR the mildest side, of AND the strictest, WITH an exception one step milder) and its plain form.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import steps, texts

#: Phrases that count in n_base, with their labels.
BASE: Mapping[str, str] = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further notices, with their labels.
NOTICES: Mapping[str, str] = {
    "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "bsd license": "bsd", "boost software license": "bsl",
    "redistribution and use in source and binary forms": "bsd", "permission is hereby granted free of charge": "mit", "isc license": "isc",
    "creative commons attribution": "cc-by", "creative commons attribution noncommercial": "cc-by-nc", "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc0": "cc0", "public domain": "public-domain", "unlicense": "unlicense",
    "all rights reserved": "proprietary", "apache licence": "apache", "mit licence": "mit", "gnu general public licence": "gpl",
}
#: The words of tags that an expression follows.
TAGS = ("spdx license identifier", "license expression", "licence expression")
#: The families of identifiers by their first letters, the longest that fits, and how far a family obliges: 0 not at all to 4 wholly.
FAMILIES: Mapping[str, tuple[str, int]] = {
    "0bsd": ("bsd", 1), "agpl": ("agpl", 4), "apache": ("apache", 1), "bsd": ("bsd", 1), "bsl": ("bsl", 1), "cc-by": ("cc-by", 1), "cc-by-nc": ("cc-by-nc", 4), "cc-by-nd": ("cc-by-nd", 4),
    "cc-by-sa": ("cc-by-sa", 3), "cc0": ("cc0", 0), "epl": ("epl", 2), "gpl": ("gpl", 3), "isc": ("isc", 1), "lgpl": ("lgpl", 2), "mit": ("mit", 1), "mpl": ("mpl", 2), "unlicense": ("unlicense", 0), "zlib": ("zlib", 1),
}
#: Of labels that are no identifiers, and of names of no known family.
OTHERS, UNKNOWN = {"public-domain": 0, "proprietary": 4}, 4
_LOWER = bytes(b | 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_PIECE = re.compile(rb"[ \t]*(?:([()])|([a-z0-9][a-z0-9.\-]*\+?(?::[a-z0-9][a-z0-9.\-]*)?))")
#: How tightly an operator binds.
_BINDS = {"or": 1, "and": 2, "with": 3}


class WordAutomaton:
    """Aho-Corasick over words: every place where a pattern's words stand one after the other, overlaps included."""

    def __init__(self, patterns: list[list[bytes]]):
        self.go: list[dict[bytes, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.length = [len(p) for p in patterns]
        for k, p in enumerate(patterns):
            s = 0
            for w in p:
                if w not in self.go[s]:
                    self.go.append({})
                    self.ends.append([])
                    self.go[s][w] = len(self.go) - 1
                s = self.go[s][w]
            self.ends[s].append(k)
        self.fail = [0] * len(self.go)
        queue = deque(self.go[0].values())
        while queue:
            s = queue.popleft()
            for w, t in self.go[s].items():
                f = self.fail[s]
                while f and w not in self.go[f]:
                    f = self.fail[f]
                self.fail[t] = self.go[f].get(w, 0)
                self.ends[t] = self.ends[t] + self.ends[self.fail[t]]
                queue.append(t)
        self.known = {w for p in patterns for w in p}

    def matches(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(first word, pattern), by last word. Words that no pattern holds lead back to the start without a look at the tables."""
        out, s, last = [], 0, -2
        go, fail, known = self.go, self.fail, self.known
        for i, w in enumerate(words):
            if w not in known:
                continue
            if i != last + 1:
                s = 0
            last = i
            while s and w not in go[s]:
                s = fail[s]
            s = go[s].get(w, 0)
            for k in self.ends[s]:
                out.append((i - self.length[k] + 1, k))
        return out


@dataclass
class Expression:
    """Labels of an expression, how far it obliges, and its plain form; valid unless operators or parentheses are out of place."""

    labels: frozenset[str] = frozenset()
    obligation: int = 0
    text: str = ""
    valid: bool = True


def family(name: str) -> tuple[str, int]:
    """The label and obligation of an identifier: of the longest family that begins it and ends at one of its parts; the name itself if none does."""
    stem = name.removesuffix("+").removesuffix("-only").removesuffix("-or-later")
    while stem:
        if stem in FAMILIES:
            return FAMILIES[stem]
        stem = stem.rpartition("-")[0]
    return name.removesuffix("+"), UNKNOWN


def postfix(pieces: list[str]) -> list[str] | None:
    """Shunting yard: the pieces in postfix order, or None if they are no expression. WITH binds before AND before OR; all lean left."""
    out: list[str] = []
    held: list[str] = []
    operand = False
    for p in pieces:
        if p in _BINDS:
            if not operand:
                return None
            while held and held[-1] != "(" and _BINDS[held[-1]] >= _BINDS[p]:
                out.append(held.pop())
            held.append(p)
            operand = False
        elif p == "(":
            if operand:
                return None
            held.append(p)
        elif p == ")":
            if not operand:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        else:
            if operand:
                return None
            out.append(p)
            operand = True
    if not operand or "(" in held:
        return None
    return out + held[::-1]


def evaluate(pieces: list[str]) -> Expression:
    """The value of an expression. One that is none still tells the labels of its names, at the strictest obligation."""
    order = postfix(pieces)
    if order is None:
        names = [family(p) for i, p in enumerate(pieces) if p not in _BINDS and p not in "()" and (not i or pieces[i - 1] != "with")]
        return Expression(frozenset(n for n, _ in names), max((o for _, o in names), default=0), " ".join(pieces), False)
    stack: list[tuple[Expression, int]] = []
    for p in order:
        if p not in _BINDS:
            label, obligation = family(p)
            stack.append((Expression(frozenset([label]), obligation, p), 4))
            continue
        (b, tight_b), (a, tight_a) = stack.pop(), stack.pop()
        if p == "with":
            if tight_a < 4 or tight_b < 4:  # an exception is one name, and belongs to one name
                return Expression(a.labels, a.obligation, f"{a.text} with {b.text}", False)
            stack.append((Expression(a.labels, max(0, a.obligation - 1), f"{a.text} with {b.text}"), 3))
            continue
        pick = min if p == "or" else max
        side = lambda e, tight, at=_BINDS[p]: f"({e.text})" if tight < at else e.text
        stack.append((Expression(a.labels | b.labels, pick(a.obligation, b.obligation), f"{side(a, tight_a)} {p} {side(b, tight_b)}"), _BINDS[p]))
    return stack[0][0]


def _is_name(p: str) -> bool:
    """Whether a piece can name a licence or an exception: of a known family, or not just letters, as no word of prose is."""
    return family(p)[0] != p.removesuffix("+") or p in FAMILIES or not p.isalpha()


def read_expression(raw: bytes, at: int) -> Expression | None:
    """The expression of a lower-cased text from a place on: as many pieces of its line as go together. None if no name stands there."""
    end = raw.find(b"\n", at)
    line = raw[at : end if end >= 0 else len(raw)]
    pieces, i, depth, operand = [], 0, 0, False
    while m := _PIECE.match(line, i):
        p = (m[1] or m[2]).decode()
        word = p not in _BINDS and p not in "()"
        if p == "(" and operand or word and operand or p == ")" and not depth:
            break  # what follows is no part of it
        i = m.end()
        p = p.rstrip(".") if word else p
        if word and not _is_name(p):
            break
        depth += (p == "(") - (p == ")")
        operand = word or p == ")"
        pieces.append(p)
    while pieces and (pieces[-1] in _BINDS or pieces[-1] == "("):
        pieces.pop()
    return evaluate(pieces) if any(p not in _BINDS and p not in "()" for p in pieces) else None


@dataclass
class Found:
    """What a text says of licences: base matches (first word, label), all labels, expressions (first word of the tag, expression)."""

    n_words: int = 0
    base: list[tuple[int, str]] = field(default_factory=list)
    notices: list[tuple[int, str]] = field(default_factory=list)
    expressions: list[tuple[int, Expression]] = field(default_factory=list)

    def labels(self) -> set[str]:
        return {x for _, x in self.base + self.notices} | {x for _, e in self.expressions for x in e.labels}

    def obligation(self) -> int:
        """The strictest of the expressions and of the notices; an expression, where there is one, speaks for its own labels."""
        told = {x for _, e in self.expressions for x in e.labels}
        by_label = {label: o for label, o in FAMILIES.values()} | OTHERS
        return max([e.obligation for _, e in self.expressions] + [by_label.get(x, UNKNOWN) for x in self.labels() - told], default=0)

    def score(self) -> float:
        """How sure it is that the text speaks of a licence: what each kind of evidence leaves open, multiplied."""
        open_ = 0.5 ** min(len(self.notices), 8) * 0.25 ** min(len(self.base), 8)
        for _, e in self.expressions[:8]:
            open_ *= 0.1 if e.valid else 0.5
        return 1 - open_


class Scanner:
    def __init__(self, base: Mapping[str, str] = BASE, notices: Mapping[str, str] = NOTICES, tags: tuple[str, ...] = TAGS):
        self.kinds = [("base", x) for x in base.values()] + [("notice", x) for x in notices.values()] + [("tag", "")] * len(tags)
        self.automaton = WordAutomaton([_WORD.findall(p.encode()) for p in (*base, *notices, *tags)])

    def scan(self, text: bytes) -> Found:
        raw = text.translate(_LOWER)
        words = _WORD.findall(raw)
        out = Found(len(words))
        tags = []
        for first, k in self.automaton.matches(words):
            kind, label = self.kinds[k]
            if kind == "tag":
                tags.append((first, self.automaton.length[k]))
            else:
                (out.base if kind == "base" else out.notices).append((first, label))
        if tags:
            ends = {first + n - 1 for first, n in tags}
            place = {i: m.end() for i, m in enumerate(_WORD.finditer(raw)) if i in ends}
            for first, n in tags:
                at = place[first + n - 1]
                at += len(raw[at : at + 8]) - len(raw[at : at + 8].lstrip(b" \t:=\"'"))
                if (e := read_expression(raw, at)) is not None:
                    out.expressions.append((first, e))
        return out


def _map(docs: DataFrame, each, columns: dict[str, tuple[str, pa.DataType]], id_col: str, text: str, scanner: Scanner) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raws = batch.column("id"), texts(batch.column("text"))
            for a, b in steps(map(len, raws)):
                rows = [(i, *row) for i, r in enumerate(raws[a:b], a) for row in each(scanner.scan(r))]
                if rows:
                    at, *cols = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), *(pa.array(c, t[1]) for c, t in zip(cols, columns.values(), strict=True))], ["id", *columns])

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, " + ", ".join(f"{k} {t[0]}" for k, t in columns.items())).withColumnRenamed("id", id_col)


def matches(docs: DataFrame, id_col: str = "doc_id", text: str = "text", scanner: Scanner | None = None) -> DataFrame:
    """(id, word, kind, label, expression): a row per notice, and per label of a tag's expression; word is where it starts. Odd inputs as in scan()."""

    def each(f: Found) -> list[tuple]:
        plain = [(at, kind, label, None) for kind, found in (("base", f.base), ("notice", f.notices)) for at, label in found]
        return sorted(plain + [(at, "tag", label, e.text) for at, e in f.expressions for label in e.labels], key=lambda r: r[:3])

    columns = {"word": ("long", pa.int64()), "kind": ("string", pa.string()), "label": ("string", pa.string()), "expression": ("string", pa.string())}
    return _map(docs, each, columns, id_col, text, scanner or Scanner())


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", scanner: Scanner | None = None) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, obligation, expressions.

    Only A to Z are lower-cased; a word is a run of ASCII digits, letters and characters beyond ASCII. n_base counts the
    places of base phrases, first_word and last_word are the least and greatest of their starts, null without any. Labels
    are distinct, sorted, and empty strings if there are none. `obligation` runs from 0 (none) to 4, and `expressions`
    lists the plain forms of the text's valid expressions. Null and empty texts have no words and a score of 0. Rows
    correspond one to one, repeated rows and null ids too; an empty table stays empty; other columns are ignored.
    """

    def each(f: Found) -> list[tuple]:
        starts = [at for at, _ in f.base]
        base = {label for _, label in f.base}
        plain = sorted({e.text for _, e in f.expressions if e.valid})
        return [(f.n_words, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(f.labels())), f.score(), f.obligation(), plain)]

    columns = {
        "n_words": ("long", pa.int64()), "n_base": ("long", pa.int64()), "first_word": ("long", pa.int64()), "last_word": ("long", pa.int64()), "base_labels": ("string", pa.string()),
        "labels": ("string", pa.string()), "score": ("double", pa.float64()), "obligation": ("int", pa.int32()), "expressions": ("array<string>", pa.list_(pa.string())),
    }
    return _map(docs, each, columns, id_col, text, scanner or Scanner())
