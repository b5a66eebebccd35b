"""Audit of how the sources of a language differ in their terms, by sorted streams.

1. Tasks count each partition's terms before anything is shuffled: in how many documents of a language a term stands,
   and how often in each source. These rows are dealt out by (lang, term) and sorted within each partition; a scan of
   runs then sums each term's documents and its counts per source. So a term that every document holds gives one row
   per task, not one per document, and a document is told from others where its text lies, before the sort.
2. Terms of enough documents are kept as a table, from which come each group's total and each language's vocabulary.
3. A second scan over that table gives, per task, partial sums for each pair of sources and each group's best terms,
   which are then summed and ranked.

A task knows the totals of every (lang, source), which the driver gathers. They are the square root of the result, which
holds a row for every pair of sources of a language. All arithmetic is in whole numbers.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import parts_for, written

#: A term is kept if so many documents of its language hold it; shares are of a billion; ranks of the terms.
LEAST_DOCUMENTS, SCALE, TOP = 3, 1_000_000_000, 200
#: Different (lang, source, term) that a task counts before it hands them on.
HELD = 600_000
#: Cells of the matrices that a scan works on at once.
CELLS = 1 << 19
PARTITION_BYTES = 32 << 20
_LETTERS = string.ascii_letters.encode()
#: Lower-cases A to Z; of the ASCII characters only letters stay, all others part terms.
_TERMS = bytes.maketrans(bytes(range(128)), bytes(b | 32 if b in _LETTERS else 32 for b in range(128)))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_TERMS).split()


#: One row for each term of a language that a task has counted: its documents, and per source its count there.
_COUNTED = "lang string, term string, docs long, sources array<string>, counts array<long>"
_NAMES = ["lang", "term", "docs", "sources", "counts"]


def _lists(at: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)


def _collapse(rows: pa.Table) -> pa.Table:
    """Rows sorted by (lang, term) to one for each: documents and each source's counts are summed."""
    lang, term, docs, sources, counts = (rows.column(c).combine_chunks() for c in _NAMES)
    n = len(lang)
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = np.asarray(pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])))
    first = np.flatnonzero(new)
    names = sources.flatten().dictionary_encode()
    run = (np.cumsum(new) - 1)[np.asarray(sources.value_parent_indices())]
    key = run * max(1, len(names.dictionary)) + np.asarray(names.indices)
    order = np.argsort(key, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    sums = np.add.reduceat(np.asarray(counts.flatten())[order], cut)
    at = np.searchsorted(run[order][cut], np.arange(len(first) + 1))
    kept = names.dictionary.take(names.indices.take(pa.array(order[cut])))
    return pa.table([lang.take(pa.array(first)), term.take(pa.array(first)), pa.array(np.add.reduceat(np.asarray(docs), first)), _lists(at, kept), _lists(at, pa.array(sums))], names=_NAMES)


def _count(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """A partition's counts per (lang, term) and source, in rows of _COUNTED."""
    docs: dict[str, Counter] = {}
    times: dict[tuple, Counter] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, known in docs.items():
            by_term: dict[bytes, list] = {t: [] for t in known}
            names, counts = [], []
            for (of, source), count in times.items():
                if of == lang:
                    names.append(source)
                    counts.append(count)
                    for t in count:
                        by_term[t].append(len(names) - 1)
            at = np.cumsum([0, *map(len, by_term.values())])
            which = [k for ks in by_term.values() for k in ks]
            sums = [counts[k][t] for t, ks in by_term.items() for k in ks]
            cols = [pa.array([lang] * len(known), pa.string()), pa.array(list(known), pa.binary()).cast(pa.string()), pa.array(list(known.values()), pa.int64()), _lists(at, pa.array(names, pa.string()).take(pa.array(which, pa.int64()))), _lists(at, pa.array(sums, pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, _NAMES)
        docs.clear()
        times.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            if not (words := terms_of(text)):
                continue
            if (count := times.get((lang, source))) is None:
                count = times[lang, source] = Counter()
                docs.setdefault(lang, Counter())
            held -= len(count)
            count.update(words)
            docs[lang].update(set(words))
            held += len(count)
            if held > most:
                yield from flush()
                held = 0
    yield from flush()


def _runs(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (lang, term): one for each term of `least` documents or more. The last of a batch waits, summed, for the next batch."""
    held = None
    for batch in batches:
        if batch.num_rows:
            now = pa.Table.from_batches([batch]).cast(_ARROW)
            rows = _collapse(now if held is None else pa.concat_tables([held, now]))
            held = rows.slice(len(rows) - 1)
            yield from _kept(rows.slice(0, len(rows) - 1), least)
    if held is not None:
        yield from _kept(held, least)


_ARROW = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


def _kept(rows: pa.Table, least: int) -> list[pa.RecordBatch]:
    return rows.filter(pc.greater_equal(rows.column("docs"), least)).drop_columns("docs").combine_chunks().to_batches()


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), three digits at a time, so that 64 bits hold every step. count + 1 is at most total."""
    whole, rest = np.divmod(count + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class _Language:
    """What a task knows of a language: its sources, their totals, and the size of its vocabulary."""

    def __init__(self, totals: list[tuple[str, int]], kept: int):
        self.sources = [s for s, _ in totals]
        self.number = {s: i for i, s in enumerate(self.sources)}
        self.totals = np.array([n for _, n in totals], np.int64) + kept
        self.whole = int(sum(n for _, n in totals)) + kept
        self.absent = shares(np.zeros(len(totals), np.int64), self.totals) if kept else np.zeros(0, np.int64)

    def scan(self, rows: list[tuple[str, list[str], list[int]]], pairs: np.ndarray) -> Iterator[tuple[str, str, int]]:
        """Adds to pairs what each pair of sources gains over two absent terms, for the terms of rows; yields (source, term, value) of the terms that a source has above its language."""
        width = len(self.sources)
        counts = np.zeros((len(rows), width), np.int64)
        for i, (_, sources, times) in enumerate(rows):
            counts[i, [self.number[s] for s in sources]] = times
        p = shares(counts, self.totals)
        lang = shares(counts.sum(axis=1), np.int64(self.whole))
        idle = divergence(self.absent[:, None], self.absent[None, :])
        for b in range(width):
            at = np.flatnonzero(counts[:, b])
            if not len(at):
                continue
            here, own, there = p[at], p[at, b][:, None], counts[at] > 0
            # b as the one compared: against all others; as the one compared with: of those without the term, which come up nowhere else.
            pairs[b] += (divergence(own, here) - idle[b]).sum(axis=0)
            pairs[:, b] += np.where(there, 0, divergence(here, own) - idle[:, b]).sum(axis=0)
            above = own[:, 0] > lang[at]
            for i, f in zip(at[above].tolist(), divergence(own[above, 0], lang[at][above]).tolist(), strict=True):
                yield self.sources[b], rows[i][0], f


def _partial(languages: dict[str, _Language], top: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = {k: np.zeros((len(v.sources),) * 2, np.int64) for k, v in languages.items()}
        # Sums of a task may outgrow 64 bits only beyond 9e18 in all; they are handed on well before.
        best: dict[tuple[str, str], list[tuple[int, bytes]]] = {}
        work: dict[str, list[tuple]] = {k: [] for k in languages}

        def rows(out: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["lang", "source", "part", "item", "value"])

        def drain(lang: str) -> Iterator[pa.RecordBatch]:
            known = languages[lang]
            for source, term, f in known.scan(work[lang], pairs[lang]):
                held = best.setdefault((lang, source), [])
                held.append((-f, term.encode()))
                if len(held) > 8 * top:
                    held.sort()
                    del held[top:]
            work[lang] = []
            if np.abs(pairs[lang]).max(initial=0) > 1 << 61:
                yield from handed(lang)

        def handed(lang: str) -> Iterator[pa.RecordBatch]:
            names = languages[lang].sources
            out = [(lang, names[a], "pair", names[b], int(pairs[lang][a, b])) for a, b in zip(*np.nonzero(pairs[lang]), strict=True) if a != b]
            pairs[lang][:] = 0
            if out:
                yield rows(out)

        for batch in batches:
            for lang, term, sources, counts in zip(*(batch.column(c).to_pylist() for c in ("lang", "term", "sources", "counts")), strict=True):
                work[lang].append((term, sources, counts))
                if len(work[lang]) * len(languages[lang].sources) >= cells:
                    yield from drain(lang)
        for lang in languages:
            if work[lang]:
                yield from drain(lang)
            yield from handed(lang)
        for (lang, source), held in best.items():
            held.sort()
            yield rows([(lang, source, "term", t.decode(), -f) for f, t in held[:top]])

    return run


def audit(
    docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, lang: str = "lang", source: str = "source", text: str = "text", held: int = HELD, cells: int = CELLS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how each (lang, source) differs from the language's other sources and from the language.

    Part "pair": per other source, the sum over the kept terms of floor((p - q)^2 / q). Part "term": the terms with
    which the group stands out of its language, the `top` first. Ranks go by value, then by the item's bytes. Nulls
    count as empty strings, and a language of empty texts has pairs of value 0. Each row is a document, repeated rows
    too. An empty table gives an empty result; other columns, ids among them, are ignored. `held` and `cells` bound what a
    task holds at once, not the result.
    """
    spark = docs.sparkSession
    parts = parts_for(docs, PARTITION_BYTES)
    clean = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(clean(lang).alias("lang"), clean(source).alias("source"), clean(text).alias("text"))
    counted = rows.mapInArrow(lambda batches: _count(batches, held), _COUNTED)
    # The hash comes first, as longs compare faster than strings; terms that share one are told apart behind it.
    dealt = counted.withColumn("h", F.xxhash64("lang", "term")).repartition(parts, "h").sortWithinPartitions("h", "lang", "term").drop("h")
    kept = written(dealt.mapInArrow(lambda batches: _runs(batches, least), "lang string, term string, sources array<string>, counts array<long>"), "kept-terms")

    groups = rows.select("lang", "source").distinct()
    times = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n"))
    totals = groups.join(times, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")).orderBy("lang", "source").collect()
    sizes = {r[0]: r[1] for r in kept.groupBy("lang").count().collect()}
    by_lang: dict[str, list[tuple[str, int]]] = {}
    for r in totals:
        by_lang.setdefault(r[0], []).append((r[1], r[2]))
    languages = {k: _Language(v, sizes.get(k, 0)) for k, v in by_lang.items()}

    found = written(kept.mapInArrow(_partial({k: v for k, v in languages.items() if k in sizes}, top, cells), "lang string, source string, part string, item string, value long"), "divergence")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("gain"))
    # What every kept term would give if no source had any: the gains are over that.
    idle = spark.createDataFrame(
        [(k, s, sizes.get(k, 0), int(v.absent[i]) if len(v.absent) else 1) for k, v in languages.items() for i, s in enumerate(v.sources)], "lang string, source string, kept long, absent long"
    )
    other = idle.select("lang", F.col("source").alias("item"), F.col("absent").alias("q"))
    base = idle.join(other, "lang").where("source <> item").withColumn("idle", F.expr("kept * cast((absent - q) * (absent - q) div q as decimal(38,0))"))
    summed = base.join(pairs, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", (F.col("idle") + F.coalesce("gain", F.lit(0))).cast("long").alias("value"))
    order = W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    return ranked(summed).unionAll(ranked(found.where("part = 'term'")).where(F.col("rank") <= top))


ORACLE = rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, row_number() OVER () AS doc FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT lang, source, doc, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= {LEAST_DOCUMENTS}),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(n) AS HUGEINT) AS n FROM k GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
t AS (SELECT g.lang, g.source, CAST(coalesce(sum(c.n), 0) AS HUGEINT) AS n FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + {SCALE} * (CAST(coalesce(c.n, 0) AS HUGEINT) + 1) // (t.n + v.v) AS p, 1 + {SCALE} * (CAST(k.n AS HUGEINT) + 1) // (v.n + v.v) AS q
      FROM t JOIN k ON t.lang = k.lang JOIN v ON v.lang = t.lang LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
e AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM e) WHERE part = 'pair' OR rank <= {TOP}
"""
