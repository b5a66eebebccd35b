"""Detection of periodic runs: stretches of words that repeat with a period, and their removal but for one period each.

Main and Lorentz: a sequence of interned words is halved; Z-functions of both halves, and of their reverses, give for
each period the longest repetition that crosses the midpoint; the halves are treated alike. A repetition that still goes
on beyond the piece at hand is left to the larger piece whose midpoint it crosses, where it is found whole. Intervals
found for several periods keep the smallest.

Only stretches that can hold a run are looked at: in a run of period q each word lies in a sequence of LEAST // 2 words
that occurs again q words on, so words outside of all repeated sequences belong to no run. Hashes choose those stretches,
which can only make them longer; the runs in them are decided on words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import steps, texts

#: Words of the shortest run, which also holds its period at least twice.
LEAST = 12


def z_function(s: list[int]) -> list[int]:
    """Per place the length of the longest prefix of s that starts there too; 0 for the first place."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if k:
            z[i] = k
            left, right = i, i + k
    return z


def _crossing(w: list[int], lo: int, mid: int, hi: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the repetitions of w[lo:hi] that cross mid, as far as they go within it."""
    u, v, whole = w[lo:mid], w[mid:hi], w[lo:hi]
    a, b = len(u), len(v)
    ahead = np.array(z_function([*v, -1, *whole]))
    back = np.array(z_function([*reversed(u), -1, *reversed(whole)]))
    # Word mid against word mid + q, onwards and back.
    q = np.arange(1, b + 1)
    on, off = ahead[1 : b + 1], back[a + 1 + b - q]
    # Word mid - q against word mid.
    p = np.arange(1, a + 1)
    far, near = ahead[b + 1 + a - p], back[1 : a + 1]
    start, end, period = np.concatenate([mid - off, mid - p - near]), np.concatenate([mid + q + on, mid + far]), np.concatenate([q, p])
    keep = end - start >= np.maximum(least, 2 * period)
    return start[keep], end[keep], period[keep]


def find_runs(w: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs of w as (start, length, smallest period), by start, then period."""
    n = len(w)
    best: dict[tuple[int, int], int] = {}
    stack = [(0, n)]
    while stack:
        lo, hi = stack.pop()
        if hi - lo < max(2, least):
            continue
        mid = (lo + hi) // 2
        for s, e, q in zip(*(x.tolist() for x in _crossing(w, lo, mid, hi, least)), strict=True):
            if (s == 0 or w[s - 1] != w[s - 1 + q]) and (e == n or w[e] != w[e - q]) and q < best.get((s, e), n + 1):
                best[s, e] = q
        stack += [(lo, mid), (mid, hi)]
    return sorted((s, e - s, q) for (s, e), q in best.items())


def _stretches(ids: np.ndarray, doc: np.ndarray, gram: int) -> list[tuple[int, int]]:
    """Maximal stretches of words that lie in a sequence of `gram` words found twice or more in their document, as slices of ids."""
    n = len(ids) - gram + 1
    if n < 2:
        return []
    h = doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(gram):
        h = (h ^ ids[j : n + j].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    within = np.flatnonzero(doc[:n] == doc[gram - 1 :])
    order = within[np.argsort(h[within], kind="stable")]
    same = h[order[1:]] == h[order[:-1]]
    at = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(order) else order
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[at] += 1
    np.add.at(edge, at + gram, -1)
    # A stretch ends with its document.
    cuts = np.flatnonzero(np.diff(np.concatenate([[-1], np.where(np.cumsum(edge[:-1]) > 0, doc, -1), [-1]])))
    inside = np.cumsum(edge[:-1]) > 0
    return [(a, b) for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False) if inside[a]]


@dataclass
class Runs:
    """A document's words and its runs (start, length, period)."""

    words: list[bytes]
    runs: list[tuple[int, int, int]]

    def kept(self) -> list[bytes]:
        """The words that no run holds after its first period."""
        if not self.runs:
            return self.words
        edge = np.zeros(len(self.words) + 1, np.int64)
        for s, length, q in self.runs:
            edge[s + q] += 1
            edge[s + length] -= 1
        return [w for w, k in zip(self.words, np.cumsum(edge[:-1]).tolist(), strict=True) if not k]


def runs_of(sequences: list[list[bytes]], least: int = LEAST) -> list[Runs]:
    """Of each sequence of words. Words are interned across them."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for ws in sequences for w in ws], np.int64)
    doc = np.repeat(np.arange(len(sequences)), [len(ws) for ws in sequences])
    first = np.cumsum([0, *map(len, sequences)])
    out = [Runs(ws, []) for ws in sequences]
    for a, b in _stretches(ids, doc, max(1, least // 2)):
        if b - a >= least:
            d = int(doc[a])
            out[d].runs += [(s + a - int(first[d]), n, q) for s, n, q in find_runs(ids[a:b].tolist(), least)]
    return out


def plant(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's rewriting: of a tenth of the ids, by their checksum, all words from some place on repeat those before. A null id is none of them."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def _scan(docs: DataFrame, each, schema: str, id_col: str, text: str, least: int, rewrite) -> DataFrame:
    """each(id, Runs) gives the rows of a document, as tuples in the schema's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raws = batch.column("id").to_pylist(), texts(batch.column("text"))
            for a, b in steps(map(len, raws)):
                found = runs_of([rewrite(i, r.split()) if rewrite else r.split() for i, r in zip(ids[a:b], raws[a:b], strict=True)], least)
                rows = [row for i, f in zip(ids[a:b], found, strict=True) for row in each(i, f)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    full = f"id {kind}, {schema}"
    arrow = {"long": pa.int64(), "string": pa.string()}
    names = ["id", *(c.split()[0] for c in schema.split(", "))]
    kinds = [None, *(arrow[c.split()[1]] for c in schema.split(", "))]
    kinds[0] = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    return rows.mapInArrow(run, full).withColumnRenamed("id", id_col)


def spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST, rewrite=None) -> DataFrame:
    """(id, start, length, period): a row per run of each document, in words from 0. See digests() for odd inputs."""
    return _scan(docs, lambda i, f: [(i, *r) for r in f.runs], "start long, length long, period long", id_col, text, least, rewrite)


def collapse(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(id, n_runs, text): the words that no run holds after its first period, joined by one space."""
    return _scan(docs, lambda i, f: [(i, len(f.runs), b" ".join(f.kept()).decode())], "n_runs long, text string", id_col, text, least, None)


def digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST, rewrite=plant) -> DataFrame:
    """Per row: id, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256.

    A run is a stretch of words of smallest period q and at least max(least, 2 * q) words that no neighbouring word
    extends keeping the period. The longest is the one that starts first, then the one of smaller period, among equals.
    Null and empty texts have no words: no run, four nulls, and the digests of nothing. Rows correspond one to one,
    repeated rows and null ids too (`rewrite` leaves null ids' words alone); an empty table stays empty; other columns
    are ignored, whatever their names. A text of any length is one task's, in time n log n.
    """

    def each(i, f: Runs) -> list[tuple]:
        top = min(f.runs, key=lambda r: (-r[1], r[0], r[2])) if f.runs else None
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in f.runs)
        return [(i, len(f.runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(f.kept())).hexdigest())]

    return _scan(docs, each, "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string", id_col, text, least, rewrite)
