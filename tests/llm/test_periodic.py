"""Runs against a check of every stretch and period, the query against that over whole tables, and odd inputs."""

import hashlib
import random
import time
import zlib

import pytest

from loomlex.llm import periodic

SF = "/root/testdata/sf0.001"


def brute(w, least=12):
    """Runs by extending every pair of equal words as far as it goes; the smallest period of a stretch wins."""
    n, best = len(w), {}
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and j > i:
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_sequences(seed):
    r = random.Random(seed)
    for _ in range(250):
        least = r.choice([2, 4, 12])
        w = [r.randrange(r.choice([1, 2, 2, 3, 9])) for _ in range(r.randint(0, 70))]
        if r.random() < 0.5:
            p = [r.randrange(4) for _ in range(r.randint(1, 9))]
            w = w[:20] + p * r.randint(2, 6) + p[: r.randint(0, len(p))] + w[20:]
        assert periodic.find_runs(w, least) == brute(w, least)


@pytest.mark.parametrize("seed", range(4))
def test_stretches_lose_no_run(seed):
    r = random.Random(100 + seed)
    docs = [[b"%d" % r.randrange(r.choice([2, 5, 300])) for _ in range(r.randint(0, 120))] for _ in range(60)]
    docs = [d + d[-r.randint(1, 30) :] * r.randint(0, 3) if d else d for d in docs]
    for d, f in zip(docs, periodic.runs_of(docs), strict=True):
        assert f.runs == brute(d)


def planted(i, ws):
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(ws)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = ws[:a] + [ws[a + (j - a) % p] for j in range(a, n)]
    return ws


def expected(i, text):
    ws = planted(i, (text or "").encode().split())
    found = brute(ws)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (i, len(found), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4), sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()), sha(b" ".join(w for k, w in enumerate(ws) if k not in gone)))


def test_query_against_brute_force(spark):
    """Of every document of up to 1,500 words; the brute force takes the square of that."""
    from loomlex.llm import queries

    got = {r[0]: tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(got) == sorted(r[0] for r in rows)
    short = [r for r in rows if len((r[1] or "").split()) <= 1500]
    assert len(short) > 150
    for i, text in short:
        assert got[i] == expected(i, text)


def test_odd_inputs(spark):
    rows = [(None, "x " * 20), (1, None), (1, None), (2, ""), (3, " \t\n"), (4, "a b " * 6), (4, "a b " * 6), (5, "ü\x0bü " * 30), (6, "a\xa0a " * 11)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, id string, start int")
    got = sorted(map(tuple, periodic.digests(df).collect()), key=repr)
    want = sorted([expected(i, t) for i, t in rows[1:]] + [(None, 1, 0, 20, 1, 20000, *expected(0, "x " * 20)[-2:])], key=repr)
    assert got == want
    assert periodic.digests(df.limit(0)).count() == 0
    assert [tuple(r) for r in periodic.spans(df.where("doc_id = 4")).collect()] == [(4, 0, 12, 2)] * 2
    assert [r.text for r in periodic.collapse(df.where("doc_id = 5")).collect()] == ["ü"]


@pytest.mark.parametrize("words", [["a"] * 60000, ["a", "b"] * 30000, [f"w{i % 777}" for i in range(60000)], [f"w{i}" for i in range(200000)]])
def test_long_texts_take_time_in_proportion(words):
    start = time.process_time()
    found = periodic.runs_of([[w.encode() for w in words]])[0]
    assert time.process_time() - start < 20
    q = len(set(words))
    assert found.runs == ([(0, len(words), q)] if q < 1000 else []) and len(found.kept()) == q
