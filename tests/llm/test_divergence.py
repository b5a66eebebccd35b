"""The audit against DuckDB, against plain Python with whole numbers, at several sizes of work, and on odd inputs."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from loomlex.llm import divergence, queries

SF = "/root/testdata/sf0.001"


def plain(rows, least=3, top=200):
    """rows (text, lang, source), each a document."""
    count, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups.add((lang, source))
        count[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= least]
        v, mine = len(kept), sorted(s for g, s in groups if g == lang)
        at = {s: {t: count[lang, s][t] for t in kept} for s in mine}
        at[None] = {t: sum(at[s][t] for s in mine) for t in kept}
        total = {s: sum(x.values()) + v for s, x in at.items()}
        p = {s: {t: 1 + 10**9 * (n + 1) // total[s] for t, n in x.items()} for s, x in at.items()}
        f = lambda a, b: (a - b) * (a - b) // b
        for a in mine:
            pairs = sorted((-sum(f(p[a][t], p[b][t]) for t in kept), b.encode()) for b in mine if b != a)
            terms = sorted((-f(p[a][t], p[None][t]), t.encode()) for t in kept if at[a][t] and p[a][t] > p[None][t])[:top]
            out += [(lang, a, part, item.decode(), -n, k) for part, found in (("pair", pairs), ("term", terms)) for k, (n, item) in enumerate(found, 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def test_query_against_sql(spark):
    rel = duckdb.connect()
    rel.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = rel.sql(divergence.ORACLE)
    found = queries.op12_source_divergence(spark, SF)
    assert sorted(want.columns) == sorted(found.columns)
    rows = got(found)
    assert rows == sorted(want.select("lang, source, part, item, value, rank").fetchall()) and len({r[2] for r in rows}) == 2


ODD = [("a b C", "en", "x"), ("A c c", "en", "x"), ("a_c1b", "en", "y"), (None, "en", "z"), ("", None, "x"), (None, None, None), ("ß É é a", "de", "x"), ("É é", "de", "y"), ("é É", "de", "y"), ("q", "fr", "x"), ("a b", "en", ""), ("a b", "en", None), ("c " * 5000, "en", "hot"), ("Straße", "de", "x")]


@pytest.mark.parametrize("held, cells, parts", [(400_000, 1 << 19, 1), (1, 1, 5), (4, 7, 3)])
def test_odd_rows_at_any_size_of_work(spark, held, cells, parts):
    df = spark.createDataFrame(ODD * 2, "text string, lang string, source string").withColumns({"term": F.lit("clash"), "docs": F.lit(1), "doc_id": F.lit(None).cast("long")})
    assert got(divergence.audit(df.repartition(parts), held=held, cells=cells)) == plain(ODD * 2)
    assert got(divergence.audit(df, least=1, top=2, held=held, cells=cells)) == plain(ODD * 2, 1, 2)


def test_empty_tables_and_texts(spark):
    df = spark.createDataFrame(ODD, "text string, lang string, source string")
    assert got(divergence.audit(df.limit(0))) == []
    bare = [(None, lang, source) for _, lang, source in ODD]
    assert got(divergence.audit(df.withColumn("text", F.lit(None).cast("string")))) == plain(bare) and any(r[4] == 0 for r in plain(bare))


def test_shares_are_exact():
    import numpy as np

    for n, total in ((0, 1), (0, 3), (6, 7), (10**14, 10**15 + 7), (0, 9 * 10**15), (9 * 10**15 - 1, 9 * 10**15)):
        assert int(divergence.shares(np.array([n]), np.array([total]))[0]) == 1 + 10**9 * (n + 1) // total
