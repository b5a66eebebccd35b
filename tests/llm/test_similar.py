"""Near copies of the pipeline against exact Jaccard similarities of five-word shingles."""

import random

import pytest

from loomlex.llm import simhash


def brute_groups(rows, similarity=0.8):
    """The least row number that links of similar shingle sets connect each row to."""
    sets = []
    for _, t in rows:
        ws = (t or "").lower().split()
        sets.append({" ".join(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set())
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= similarity * len(a | b) - 1e-9 and a and b:
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def lone_pairs(seed, extras=(10, 18, 22, 23, 24, 25, 26, 27, 28, 32, 40), times=3):
    """Pairs of 100 shingles and `extra` more: a similarity of 100 / (100 + extra), 0.8 at 25."""
    r, out = random.Random(seed), []
    for e in extras * times:
        ws = [f"w{r.randrange(10**9)}" for _ in range(104 + e)]
        out += [" ".join(ws[:104]), " ".join(ws)]
    return list(enumerate(out))


def family(seed, copies=60):
    """Copies of one text with some words replaced, so that links within it are partly there; and short texts at exactly 0.8."""
    r = random.Random(seed)
    base, out = [f"b{i}" for i in range(150)], []
    for k in range(copies):
        ws = list(base)
        for i in r.sample(range(150), r.choice((1, 2, 3, 4, 5))):
            ws[i] = f"x{k}-{i}"
        out.append(" ".join(ws))
    for k in range(6):
        ws = [f"s{k}-{i}" for i in range(9)]
        out += [" ".join(ws), " ".join(ws[:8])]
    return list(enumerate(out))


def groups_of(spark, rows):
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return [got[i] for i, _ in rows]


def test_lone_pairs_around_the_similarity(spark):
    rows = lone_pairs(1)
    assert groups_of(spark, rows) == brute_groups(rows)


@pytest.mark.parametrize(("share", "common"), [(256, 8), (8, 2), (8, 0)])
def test_large_groups_in_shares(spark, monkeypatch, share, common):
    monkeypatch.setattr(simhash, "SHARE_ROWS", share)
    monkeypatch.setattr(simhash, "COMMON", common)
    rows = family(2)
    want = brute_groups(rows)
    assert 6 < len(set(want)) < len(rows) and groups_of(spark, rows) == want


def test_null_and_repeated_ids_keep_their_groups(spark):
    t = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcdefg"]
    rows = [(None, t[0]), (None, t[1]), (None, t[1]), (None, t[2]), (3, t[2] + " more"), (5, t[3]), (5, t[4]), (5, t[4]), (6, t[4]), (7, t[5]), (None, t[6]), (8, t[6])]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted([(None, t[0]), (None, t[1]), (3, t[2] + " more"), (5, t[3]), (5, t[4]), (7, t[5]), (8, t[6])], key=repr)
    for groups in (simhash.similar(table), simhash.near_duplicates(table)):
        kept = sorted((tuple(r) for r in simhash.keep_one(table, groups).collect()), key=repr)
        assert kept == want
