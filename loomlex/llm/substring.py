"""Substring dedup with suffix automata of reference shards.

What a document repeats of earlier ones is found in three steps, each on data dealt out by a key that bounds a task.

1. Documents lie in chunks by a hash of their id. Each chunk finds the minimizers of its windows: of the five-word
   hashes within a window, the least. Equal windows have equal minimizers. Per hash the least document that holds it, and
   its place there, are found; hashes of one document only are dropped, the others return to the chunks that hold them.
2. A chunk cuts the stretches around such hashes into pieces and names for each a shard: the least document, and a
   segment of it. All occurrences of a window that repeats are then in pieces of the same shard.
3. Per shard a suffix automaton over the words of its pieces is built, each state with the least document that holds
   it, and the pieces stream through it: where the matching statistic reaches the window's length, the state of that
   length tells the least document with the window. The answers return to the chunks, which remove the covered words.

Hashes only choose what meets in a shard; what is removed is decided on words. The reference is the corpus itself,
which has no bound, so automata are not broadcast whole: each is built in the task that its shard is dealt to.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_dir, parts_for, release, steps, texts, written

WINDOW, GRAM = 13, 5
#: Words of a reference document whose minimizers share a shard.
SEGMENT = 64
#: Stands for a null id: no document is after it.
LAST = (1 << 63) - 1
CHUNK_BYTES = 8 << 20
#: Buckets of the table of chunks, and parts that hashes are dealt to, at most; each then holds several chunks, taken one by one.
MOST_PARTS = 16_384
#: What begins the names of the tables of chunks in the session's catalogue.
CHUNKS = "chunks_"
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_P = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of the texts, and the place of its text in the list."""
    joined = b"\n".join(raws)
    b = np.frombuffer(joined, np.uint8)
    if not len(b):
        return np.array([], np.uint64), np.array([], np.int64)
    inner = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inner.view(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _powers(_P, len(b)), out=total[1:])
    back = _powers(pow(_P, -1, 1 << 64), len(b))
    first = np.cumsum([0, *(len(r) + 1 for r in raws)])[:-1]
    return _mix((total[ends] - total[starts]) * back[starts]), np.searchsorted(first, starts, side="right") - 1


def minimizers(raws: list[bytes], window: int = WINDOW, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Per minimizer: its text's place (doc), its word (at), its hash (h), and the first and last window (from, to) that it is the least of."""
    parts: list[tuple] = []
    for a, b in steps(map(len, raws)):
        words, doc = word_hashes(raws[a:b])
        n = len(words)
        if n < window:
            continue
        q = _powers(0xD1342543DE82EF95, gram)
        grams = np.zeros(n - gram + 1, np.uint64)
        for j in range(gram):
            grams += words[j : n - gram + 1 + j] * q[j]
        grams = _mix(grams)
        span = window - gram + 1
        # The least of each window by doubling, then its place: the first that equals it.
        at = np.arange(len(grams) - span + 1)
        least, where = grams[: len(at)].copy(), at.copy()
        for j in range(1, span):
            x = grams[j : j + len(at)]
            lower = x < least
            least[lower] = x[lower]
            where[lower] = at[lower] + j
        whole = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
        where = where[whole]
        cut = np.flatnonzero(np.concatenate([[True], (where[1:] != where[:-1]) | (whole[1:] != whole[:-1] + 1)])) if len(whole) else np.array([], np.int64)
        last = np.concatenate([cut[1:], [len(whole)]]) - 1 if len(cut) else cut
        first_word = np.searchsorted(doc, np.arange(b - a), side="left")
        d = doc[whole[cut]]
        shift = first_word[d]
        parts.append((d + a, where[cut] - shift, grams[where[cut]], whole[cut] - shift, whole[last] - shift))
    names, kinds = ("doc", "at", "h", "from", "to"), (np.int64, np.int64, np.uint64, np.int64, np.int64)
    return {k: np.concatenate([p[i] for p in parts]).astype(t) if parts else np.array([], t) for i, (k, t) in enumerate(zip(names, kinds, strict=True))}


def _ids(column) -> np.ndarray:
    return np.array([LAST if x is None else x for x in column.to_pylist()], np.int64)


def _least(table: pa.Table, window: int) -> tuple[np.ndarray, ...]:
    """A chunk's hashes, sorted; of each the least document of the chunk that holds it, its place there, and whether several do."""
    ids = _ids(table.column("id"))
    m = minimizers(texts(table.column("text")), window)
    doc = ids[m["doc"]]
    order = np.lexsort((m["at"], doc, m["h"]))
    h, doc, at = m["h"][order], doc[order], m["at"][order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.array([], np.int64)
    last = np.concatenate([first[1:], [len(h)]]) - 1 if len(first) else first
    return h[first], doc[first], at[first].astype(np.int32), doc[first] != doc[last]


def _emit(window: int):
    """A chunk's hashes with the least document of the chunk that holds each."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        h, doc, at, several = _least(table, window)
        return pa.table({"chunk": pa.array(np.full(len(h), key[0].as_py(), np.int32)), "h": pa.array(h.view(np.int64)), "doc": pa.array(doc), "at": pa.array(at), "several": pa.array(several)})

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (h, doc, at): those whose hash two documents or more hold, with the least document and the place there.

    A hash that all chunks hold streams through: of the run that a batch ends in only its first row is held, and whether
    a second document has been seen. Rows that follow with the first row's document are of null ids, which are the last.
    """
    held: tuple | None = None  # h, doc, at, chunk of the run's first row; whether the run is of several documents
    names, kinds = ("h", "doc", "at", "chunk", "several"), (np.int64, np.int64, np.int32, np.int32, bool)
    for batch in batches:
        if not batch.num_rows:
            continue
        h, doc, at, chunk, several = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False), k) for c, k in zip(names, kinds, strict=True))
        on = held is not None and h[0] == held[0]
        if on:  # the first row comes once more, as one that is already told of if the run is of several
            h, doc, at, chunk, several = (np.concatenate([np.array([x], v.dtype), v]) for x, v in zip((*held[:4], held[4]), (h, doc, at, chunk, several), strict=True))
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        run = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
        lead = first[run]
        more = np.logical_or.reduceat(several | (doc != doc[lead]), first)
        keep = more[run]
        if on and held[4]:
            keep[0] = False
        start = int(first[-1])
        held = (h[start], doc[start], at[start], chunk[start], bool(more[-1]))
        k = np.flatnonzero(keep)
        yield pa.RecordBatch.from_arrays([pa.array(chunk[k]), pa.array(h[k]), pa.array(doc[lead[k]]), pa.array(at[lead[k]])], ["chunk", "h", "doc", "at"])


_PIECES = "chunk int, ref long, segment int, piece binary, least long, docs binary, starts binary"


def _cut(window: int, segment: int):
    """A chunk's pieces, each distinct one once with all its places in the chunk: text numbers (docs) and first words (starts)."""

    def run(key: tuple, docs: pa.Table, back: pa.Table) -> pa.Table:
        names = ["ref", "segment", "piece", "least", "docs", "starts"]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
        empty = pa.table({"chunk": pa.array([], pa.int32()), **{k: pa.array([], t) for k, t in zip(names, kinds, strict=True)}})
        if not docs.num_rows or not back.num_rows:
            return empty
        ids, raws = _ids(docs.column("id")), texts(docs.column("text"))

        h, ref, at = back.column("h").to_numpy().view(np.uint64), back.column("doc").to_numpy(), back.column("at").to_numpy()
        order = np.argsort(h)
        h, ref, part = h[order], ref[order], at[order] // segment
        m = minimizers(raws, window)
        k = np.minimum(np.searchsorted(h, m["h"]), len(h) - 1)
        hit = np.flatnonzero(h[k] == m["h"])
        if not len(hit):
            return empty
        doc, lo, hi, r, s = m["doc"][hit], m["from"][hit], m["to"][hit], ref[k[hit]], part[k[hit]]
        # Neighbouring windows of one text and shard make one piece.
        joined = (doc[1:] == doc[:-1]) & (r[1:] == r[:-1]) & (s[1:] == s[:-1]) & (lo[1:] == hi[:-1] + 1)
        first = np.flatnonzero(np.concatenate([[True], ~joined]))
        last = np.concatenate([first[1:], [len(doc)]]) - 1
        found: dict = {}
        now, ws = -1, []
        for d, a, b, rr, ss in zip(doc[first].tolist(), lo[first].tolist(), hi[last].tolist(), r[first].tolist(), s[first].tolist(), strict=True):
            if d != now:
                now, ws = d, raws[d].split()
            found.setdefault((rr, ss, b" ".join(ws[a : b + window])), []).append((d, a))
        rows = []
        for (rr, ss, piece), places in found.items():
            ds, starts = np.array([p[0] for p in places]), np.array([p[1] for p in places], np.int32)
            rows.append((rr, ss, piece, int(ids[ds].min()), ds.astype(np.int32).tobytes(), starts.tobytes()))
        return pa.table({"chunk": pa.array([key[0].as_py()] * len(rows), pa.int32()), **{k: pa.array(c, t) for k, c, t in zip(names, zip(*rows, strict=True), kinds, strict=True)}})

    return run


class SuffixAutomaton:
    """Of several word sequences; each state knows the least owner of the sequences that hold it."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.len, self.least = [-1], [0], [LAST]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.len.append(length)
        self.link.append(link)
        self.least.append(LAST)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, w) -> int:
        c = self._state(self.len[p] + 1, self.next[q].copy(), self.link[q])
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def add(self, words: list, owner: int) -> None:
        nxt, link, length, least = self.next, self.link, self.len, self.least
        last = 0
        for w in words:
            q = nxt[last].get(w)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._clone(last, q, w)
            else:
                cur, p = self._state(length[last] + 1, {}, 0), last
                while p >= 0 and w not in nxt[p]:
                    nxt[p][w] = cur
                    p = link[p]
                if p >= 0:
                    q = nxt[p][w]
                    link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
                last = cur
            if owner < least[last]:
                least[last] = owner

    def close(self) -> None:
        """Hands each state's least owner on to its suffixes."""
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            up = self.link[s]
            if self.least[s] < self.least[up]:
                self.least[up] = self.least[s]

    def match(self, words: list, window: int) -> list[int]:
        """Per window of words: the least owner that has it, LAST if none; from the matching statistics."""
        nxt, link, length, least = self.next, self.link, self.len, self.least
        s = n = 0
        out = []
        for i, w in enumerate(words):
            while s and w not in nxt[s]:
                s = link[s]
                n = length[s]
            q = nxt[s].get(w)
            if q is not None:
                s, n = q, n + 1
            if i + 1 >= window:
                if n < window:
                    out.append(LAST)
                else:
                    while length[link[s]] >= window:
                        s = link[s]
                        n = length[s]
                    out.append(least[s])
        return out


def _answer(window: int):
    """Of one deal of shards, sorted out by shard: per piece the least document of each of its windows."""

    def run(_key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("ref", "segment", "least", "piece")), strict=True))
        out, i = [], 0
        while i < len(rows):
            j = i
            while j < len(rows) and rows[j][:2] == rows[i][:2]:
                j += 1
            automaton, split = SuffixAutomaton(), [r[3].split() for r in rows[i:j]]
            for r, ws in zip(rows[i:j], split, strict=True):
                automaton.add(ws, r[2])
            automaton.close()
            for r, ws in zip(rows[i:j], split, strict=True):
                out.append((r[0], r[1], hashlib.blake2b(r[3], digest_size=16).digest(), np.array(automaton.match(ws, window), np.int64).tobytes()))
            i = j
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table({k: pa.array(c, t) for k, c, t in zip(("ref", "segment", "digest", "first"), zip(*out, strict=True) if out else ((),) * 4, kinds, strict=True)})

    return run


def _with_digest(pieces: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digest = [hashlib.blake2b(x, digest_size=16).digest() for x in b.column("piece").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("chunk", "ref", "segment", "docs", "starts")), pa.array(digest, pa.binary())], ["chunk", "ref", "segment", "docs", "starts", "digest"])

    return pieces.mapInArrow(run, "chunk int, ref long, segment int, docs binary, starts binary, digest binary")


def covered(docs_ids: np.ndarray, counts: list[int], answers: pa.Table, window: int) -> list[np.ndarray]:
    """Per text of a chunk a mask of its words that earlier documents' windows cover."""
    edges = [np.zeros(n + 1, np.int32) for n in counts]
    for docs, starts, first in zip(*(answers.column(c).to_pylist() for c in ("docs", "starts", "first")), strict=True):
        f = np.frombuffer(first, np.int64)
        for d, a in zip(np.frombuffer(docs, np.int32).tolist(), np.frombuffer(starts, np.int32).tolist(), strict=True):
            at = a + np.flatnonzero(f < docs_ids[d])
            np.add.at(edges[d], at, 1)
            np.add.at(edges[d], at + window, -1)
    return [np.cumsum(e[:-1]) > 0 for e in edges]


def removed(docs: DataFrame, finish, schema: str, window: int = WINDOW, segment: int = SEGMENT, id_col: str = "doc_id", text: str = "text", extra: dict[str, str] | None = None) -> DataFrame:
    """finish(table of id, text and extra columns, masks) per chunk, where a mask marks the words to remove.

    extra: further columns to carry, their name here to their name in docs.
    """
    spark = docs.sparkSession
    chunks = parts_for(docs, CHUNK_BYTES)
    carried = {k: F.col(f"`{c}`").alias(k) for k, c in (extra or {}).items()}
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"), *carried.values())
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id", F.when(F.col("id").isNull(), F.col("text"))), F.lit(chunks)).cast("int"))
    # Dealt once, as a table in buckets: the three passes over the texts read it where it lies.
    parts = min(chunks, MOST_PARTS)
    name, at = f"{CHUNKS}{uuid.uuid4().hex}", new_dir(spark, "chunks")
    rows.repartition(parts, "chunk").sortWithinPartitions("chunk", "id", "text").write.bucketBy(parts, "chunk").sortBy("chunk").option("path", at).option("compression", "zstd").saveAsTable(name)
    release(spark)
    table = spark.table(name)
    slim = table.select("chunk", "id", "text")
    emitted = slim.groupBy("chunk").applyInArrow(_emit(window), "chunk int, h long, doc long, at int, several boolean")
    back = emitted.repartition(parts, "h").sortWithinPartitions("h", "doc", "at").mapInArrow(_repeated, "chunk int, h long, doc long, at int")
    pieces = written(slim.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(_cut(window, segment), _PIECES), "pieces")
    release(spark)
    distinct = pieces.groupBy("ref", "segment", "piece").agg(F.min("least").alias("least"))
    dealt = distinct.withColumn("deal", F.pmod(F.xxhash64("ref", "segment"), F.lit(4 * parts)).cast("int"))
    answers = written(dealt.groupBy("deal").applyInArrow(_answer(window), "ref long, segment int, digest binary, first binary"), "answers")
    release(spark)
    told = _with_digest(pieces).join(answers, ["ref", "segment", "digest"]).select("chunk", "docs", "starts", "first")

    def run(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        ids, raws = _ids(docs.column("id")), texts(docs.column("text"))
        return finish(docs, raws, covered(ids, [len(r.split()) for r in raws], told, window))

    return table.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, schema)


def drop_chunks(spark: SparkSession) -> None:
    """Takes the tables of chunks of all runs so far out of the catalogue; their results can't be read again afterwards, unless they were written."""
    for t in spark.catalog.listTables():
        if re.fullmatch(CHUNKS + "[0-9a-f]{32}", t.name):
            spark.sql(f"DROP TABLE {t.name}")


def digests(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256): which words go, by the digest of what stays, joined by one space.

    A word goes if a window of `window` words covers it whose sequence also starts in a document with a smaller id.
    Null and empty texts have no words. A null id counts as later than all others, and rows that repeat an id as one
    document: they never remove each other's words. An empty table gives an empty result; other columns are ignored.
    """

    def finish(table: pa.Table, raws: list[bytes], masks: list[np.ndarray]) -> pa.Table:
        kept = [hashlib.sha256(b" ".join([w for w, gone in zip(raw.split(), mask.tolist(), strict=True) if not gone])).hexdigest() for raw, mask in zip(raws, masks, strict=True)]
        return pa.table({"id": table.column("id"), "n_words": pa.array([len(m) for m in masks], pa.int64()), "n_removed": pa.array([int(m.sum()) for m in masks], pa.int64()), "kept_sha256": pa.array(kept, pa.string())})

    return removed(docs, finish, "id long, n_words long, n_removed long, kept_sha256 string", window, SEGMENT, id_col, text).withColumnRenamed("id", id_col)


def cut_spans(raw: bytes, mask: np.ndarray) -> bytes:
    """The text without the marked words: what stood between two kept words stays as it was if nothing went between them, else one space, or one line feed if a line ended there."""
    if not mask.any():
        return raw
    b = np.frombuffer(raw, np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (~_SPACE[b]).view(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    out, at = [], None
    for i in np.flatnonzero(~mask).tolist():
        if at is not None:
            between = raw[ends[at] : starts[i]]
            out.append(between if i == at + 1 else b"\n" if b"\n" in raw[ends[at] : starts[i]] else b" ")
        out.append(raw[starts[i] : ends[i]])
        at = i
    return b"".join(out)


def dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text", chars: str | None = "n_chars") -> DataFrame:
    """docs with the repeated spans cut out of their texts; documents of which nothing stays go. `chars` is counted anew where docs has it.

    The columns and their types stay; documents without repeats stay as they are, empty ones too.
    """
    names = {f"c{i}": c for i, c in enumerate(docs.columns)}
    kinds = dict(docs.dtypes)

    def finish(table: pa.Table, raws: list[bytes], masks: list[np.ndarray]) -> pa.Table:
        new = [cut_spans(r, m).decode() for r, m in zip(raws, masks, strict=True)]
        stays = [i for i, (t, m) in enumerate(zip(new, masks, strict=True)) if t or not m.any()]
        cols = {}
        for k, c in names.items():
            col = table.column(k)
            if c == text:
                col = pa.array([n if m.any() else o for n, m, o in zip(new, masks, col.to_pylist(), strict=True)], pa.string())
            elif c == chars and kinds[c] == "bigint":
                col = pa.array([len(n) if m.any() else o for n, m, o in zip(new, masks, col.to_pylist(), strict=True)], pa.int64())
            cols[k] = col
        return pa.table(cols).take(pa.array(stays, pa.int64()))

    schema = ", ".join(f"{k} {kinds[c]}" for k, c in names.items())
    out = removed(docs, finish, schema, window, SEGMENT, id_col, text, names)
    return out.select(*(F.col(k).alias(c) for k, c in names.items()))


_LEADS = " || ' ' || ".join(["a", *(f"lead(a, {k}) OVER o" for k in range(1, WINDOW))])
ORACLE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS a, unnest(generate_series(1, len(ws))) AS i FROM d),
k AS (SELECT *, {_LEADS} AS key FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, i, a, CASE WHEN key IS NOT NULL AND min(doc_id) OVER (PARTITION BY key) < doc_id THEN 1 ELSE 0 END AS hit FROM k),
c AS (SELECT *, max(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone FROM f),
s AS (SELECT doc_id, sum(gone) AS n, string_agg(a, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM c GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN s USING (doc_id)
"""
