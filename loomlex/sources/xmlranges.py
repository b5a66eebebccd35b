"""Byte ranges of XML files, each with the place of its first token and the depth there, so that many tasks read one file.

A task can't tell from the middle of a file whether it stands in text, in a tag, a comment or a CDATA section. So each range
is read once as if it began in text, which gives the places of its first tokens, its change of depth, and the first token
after it. A fold over a file's ranges then carries the true place and depth from range to range: where the true first
token is among those found, the range's figures hold; where it is not, that range alone is read again from the true place.
Only these figures leave a task, a row for each range.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

RANGE_BYTES = 32 << 20
#: Ranges of one file before they get longer than asked for, RANGE_BYTES at most: each costs a task, whatever it holds.
MOST_RANGES = 1024
#: Tokens at the start of a range that a task reports; beyond them lexing from different places has met as a rule.
REPORTED = 64
_STEP = 1 << 20
#: A comment, a CDATA section, an instruction, an end tag, or a start tag, whose quotes may hold ">".
_TOKEN = re.compile(rb"<(?:!--.*?-->|!\[CDATA\[.*?\]\]>|\?.*?\?>|/[^>]*>|[^!?/](?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+>)", re.S)
#: Text and the token after it, in bytes that hold the token to its end.
_NEXT = re.compile(rb"[^<]*+(" + _TOKEN.pattern + rb")", re.S)
_OPENERS = (b"<!--", b"<![CDATA[")
#: What a publication (publish) says of itself; a folder that has it is one document, whose parts follow each other.
MANIFEST = "_published.json"


def filesystem(path: str):
    """pyarrow's file system of a path or URI, and the path within it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path if "://" in path else "file://" + os.path.abspath(path.removeprefix("file:")))


def files_of(path: str) -> list[tuple[str, int]]:
    """(path within its file system, bytes) of a file or publication, or of a folder's files in order."""
    from pyarrow.fs import FileSelector, FileType

    fs, at = filesystem(path)
    parts = parts_of(fs, at)
    if parts is not None:
        return [(at.rstrip("/"), sum(n for _, n in parts))]
    info = fs.get_file_info(at)
    found = [f for f in fs.get_file_info(FileSelector(at)) if f.type == FileType.File and not f.base_name.startswith(("_", "."))] if info.type == FileType.Directory else [info]
    return sorted((f.path, f.size) for f in found)


def parts_of(fs, at: str) -> list[tuple[str, int]] | None:
    """(path, bytes) of a publication's parts in their order; None for what is no publication."""
    from pyarrow.fs import FileType

    told = f"{at.rstrip('/')}/{MANIFEST}"
    if fs.get_file_info(told).type != FileType.File:
        return None
    with fs.open_input_stream(told) as f:
        names = json.loads(f.read())["parts"]
    return [(i.path, i.size) for i in fs.get_file_info([f"{at.rstrip('/')}/{n}" for n in names])]


def opened(fs, file: str):
    """A file, or a publication's parts as one file, to seek and read in."""
    parts = parts_of(fs, file)
    return fs.open_input_file(file) if parts is None else Parts(fs, parts)


class Parts:
    """Files read as the one file that they are one after the other, so that none has to be written of them."""

    def __init__(self, fs, parts: list[tuple[str, int]]):
        self.fs, self.names, self.starts = fs, [p for p, _ in parts], [0, *accumulate(n for _, n in parts)]
        self.at, self.held, self.file = 0, -1, None

    def size(self) -> int:
        return self.starts[-1]

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, n: int | None = None) -> bytes:
        to, out = min(self.size(), self.size() if n is None or n < 0 else self.at + n), []
        while self.at < to:
            k = bisect_right(self.starts, self.at) - 1
            if k != self.held:
                self.close()
                self.file, self.held = self.fs.open_input_file(self.names[k]), k
            self.file.seek(self.at - self.starts[k])
            piece = self.file.read(min(to, self.starts[k + 1]) - self.at)
            if not piece:
                raise EOFError(f"{self.names[k]} is shorter than it was")
            out.append(piece)
            self.at += len(piece)
        return out[0] if len(out) == 1 else b"".join(out)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.held, self.file = -1, None

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        self.close()


class Window:
    """Bytes of an open file from a place on, read as they are asked for; what lies behind is dropped when more are read, so that no byte is moved for each token."""

    def __init__(self, file, at: int):
        self.file, self.base, self.low, self.data, self.done = file, at, at, b"", False
        file.seek(at)

    def more(self) -> bool:
        if self.done:
            return False
        held = self.data[self.low - self.base :]
        piece = self.file.read(max(_STEP, len(held)))
        self.done = not piece
        self.data, self.base = held + piece, self.low
        return not self.done

    def drop(self, to: int) -> None:
        self.low = to

    def find(self, what: bytes, at: int) -> int:
        """The first place of `what` from `at` on, -1 if there is none."""
        while (k := self.data.find(what, at - self.base)) < 0:
            at = max(at, self.base + len(self.data) - len(what) + 1)
            if not self.more():
                return -1
        return self.base + k

    def slice(self, a: int, b: int) -> bytes:
        return self.data[a - self.base : b - self.base]

    def token(self, at: int) -> tuple[int, int, int] | None:
        """(start, end, change of depth) of the first token from `at` on; None at the end of the file, or where what begins is never closed."""
        m = _NEXT.match(self.data, at - self.base)
        if m is not None:  # a token that is there to its end is the same whatever follows
            start, end = m.span(1)
            kind = self.data[start + 1]
            return self.base + start, self.base + end, 0 if kind in b"!?" else -1 if kind == 0x2F else 0 if self.data[end - 2] == 0x2F else 1
        start = self.find(b"<", at)
        if start < 0:
            return None
        while True:
            k = start - self.base
            head = self.data[k : k + 9]
            m = _TOKEN.match(self.data, k) if len(head) == 9 or self.done or b">" in head else None
            if m is not None and (m[0].startswith(_OPENERS) or not any(o.startswith(head) for o in _OPENERS)):
                end = m.end()
                kind = self.data[k + 1 : k + 2]
                change = 0 if kind in (b"!", b"?") else -1 if kind == b"/" else 0 if self.data[end - 2 : end - 1] == b"/" else 1
                return start, self.base + end, change
            if not self.more():
                return None


@dataclass
class Range:
    """A range of a file; at and depth are the true place and depth of its first token. head: how many bytes come before the first element within the root."""

    file: str
    number: int
    start: int
    stop: int
    head: int = 0
    at: int = -1
    depth: int = 0


def lex(window: Window, at: int, stop: int) -> tuple[list[tuple[int, int]], int, int]:
    """From a token's or text's place up to stop: the first tokens with the change of depth before each, the first token's place from stop on, and the change in all."""
    first, depth = [], 0
    while True:
        t = window.token(at)
        if t is None or t[0] >= stop:
            return first, t[0] if t else 1 << 62, depth
        if len(first) < REPORTED:
            first.append((t[0], depth))
        depth += t[2]
        at = t[1]
        window.drop(at)


def head_of(file) -> int:
    """The bytes up to the end of the root's start tag, declarations and document type included; ValueError if there is no root."""
    window, at = Window(file, 0), 0
    while True:
        start = window.find(b"<", at)
        if start < 0:
            raise ValueError("no root element")
        while len(window.data) < start - window.base + 9 and window.more():
            pass
        if window.slice(start, start + 9).upper() == b"<!DOCTYPE":
            at = _after_doctype(window, start)
            continue
        t = window.token(start)
        if t is None:
            raise ValueError("no root element")
        if t[2] or window.slice(t[0] + 1, t[0] + 2) not in (b"!", b"?"):
            return t[1]
        at = t[1]


def _after_doctype(window: Window, at: int) -> int:
    """Past a document type with its internal subset, whose comments, quotes and instructions may hold anything."""
    inner, i = re.compile(rb"<!--.*?-->|<\?.*?\?>|\"[^\"]*\"|'[^']*'|[\[\]>]", re.S), at + 9
    deep = 0
    while True:
        m = inner.search(window.data, i - window.base)
        if m is None:
            if not window.more():
                raise ValueError("a document type that is never closed")
            continue
        i = window.base + m.end()
        deep += {b"[": 1, b"]": -1}.get(m[0], 0)
        if m[0] == b">" and deep == 0:
            return i


def plan(path: str, size: int = RANGE_BYTES) -> list[Range]:
    """Ranges of `size` bytes of a file, or of a folder's files, longer ones where a file has very many; the driver reads their heads alone."""
    fs, _ = filesystem(path)
    out = []
    for file, length in files_of(path):
        with opened(fs, file) as f:
            head = head_of(f)
        step = max(size, min(RANGE_BYTES, -(-(length - head) // MOST_RANGES)))
        cuts = [head, *range(head + step, length, step), max(length, head + 1)]
        out += [Range(file, k, a, b, head) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return out


_PLANNED = "file string, number int, start long, stop long, head long"


def ranges(spark: SparkSession, path: str, size: int = RANGE_BYTES) -> DataFrame:
    """(file, number, start, stop, head, at, depth): where each range's first token stands, and how deep. A row for each range."""
    root = path

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(root)
        for batch in batches:
            for r in batch.to_pylist():
                with opened(fs, r["file"]) as f:
                    first, after, change = lex(Window(f, r["start"]), r["start"], r["stop"])
                row = r | {"places": [p for p, _ in first], "depths": [d for _, d in first], "after": after, "change": change}
                yield pa.RecordBatch.from_pylist([row], schema)

    def fold(key: tuple, table: pa.Table) -> pa.Table:
        fs, _ = filesystem(root)
        out, at, depth = [], -1, 1
        rows = sorted(table.to_pylist(), key=lambda r: r["number"])
        for r in rows:
            if at < 0:
                at = r["places"][0] if r["places"] else r["after"]
            out.append({k: r[k] for k in ("file", "number", "start", "stop", "head")} | {"at": at, "depth": depth})
            if at >= r["stop"]:
                continue
            if at in r["places"]:
                depth += r["change"] - r["depths"][r["places"].index(at)]
                at = r["after"]
            else:
                with opened(fs, r["file"]) as f:
                    _, at, change = lex(Window(f, at), at, r["stop"])
                depth += change
        return pa.Table.from_pylist(out, schema=pa.schema([pa.field("file", pa.string()), pa.field("number", pa.int32()), *(pa.field(c, pa.int64()) for c in ("start", "stop", "head", "at")), pa.field("depth", pa.int32())]))

    schema = pa.schema([("file", pa.string()), ("number", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("head", pa.int64()), ("places", pa.list_(pa.int64())), ("depths", pa.list_(pa.int32())), ("after", pa.int64()), ("change", pa.int32())])
    found = plan(path, size)
    rows = spark.createDataFrame([(r.file, r.number, r.start, r.stop, r.head) for r in found], _PLANNED).repartition(max(1, min(len(found), 4096)))
    reported = rows.mapInArrow(report, _PLANNED + ", places array<long>, depths array<int>, after long, change int")
    return reported.groupBy("file").applyInArrow(fold, _PLANNED + ", at long, depth int")


@dataclass
class Element:
    """A child of the root: its place, its bytes, and the places of its own children within the file."""

    start: int
    raw: bytes
    children: list[tuple[int, int]]


def elements(file, r: Range) -> Iterator[Element]:
    """The root's children that begin within a range, whole, even where they end beyond it."""
    window, at, depth = Window(file, r.at if r.at < 1 << 62 else r.stop), r.at, r.depth
    start, children, opened = -1, [], -1
    while True:
        if start < 0 and at >= r.stop:
            return
        t = window.token(at)
        if t is None or start < 0 and t[0] >= r.stop:
            return
        mark = window.slice(t[0] + 1, t[0] + 2)
        if mark not in (b"!", b"?"):
            if depth == 1 and t[2] >= 0 and mark != b"/":
                start, children = t[0], []
            elif depth == 2 and t[2] >= 0 and mark != b"/" and start >= 0:
                opened = t[0]
            depth += t[2]
            if start >= 0 and depth == 2 and opened >= 0:
                children.append((opened, t[1]))
                opened = -1
            if start >= 0 and depth == 1:
                yield Element(start, window.slice(start, t[1]), children)
                start = -1
            if depth < 1:
                return
        at = t[1]
        if start < 0:
            window.drop(at)
