"""The pipeline stage by stage against plain Python, and the queries with SQL against DuckDB."""

import glob
import hashlib
import os
import re
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from loomlex.llm import bpe, mixing, queries, simhash, substring

SF = "/root/testdata/sf0.001"
BASE = " ".join(f"word{i}" for i in range(80))
ODD = [
    (1, BASE, "en", "a", 10), (1, " ".join(f"other{i}" for i in range(90)), "en", "a", 10), (2, BASE + " tail", "en", "b", 10), (None, BASE + " end", "de", "a", None), (None, " ".join(f"third{i}" for i in range(70)), None, None, None),
    (None, " ".join(f"fourth{i}" for i in range(75)), "en", "a", 1), (3, None, "en", "a", 0), (4, "", "en", "a", 0), (5, BASE, "en", "a", 10), (5, BASE, "en", "a", 10), (6, " ".join(f"long{i}" for i in range(30000)), "fr", "c", 5), (7, "w " * 100, "en", "a", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Folders whose documents are the smallest table, odd rows with further columns, one id only, and none."""
    out = {}
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(ODD, SCHEMA).withColumns({"id": F.lit("clash"), "group": F.lit(1), "node": F.lit(2), "_row_key": F.lit("x")})
    for name, df in {"whole": whole, "odd": odd, "one": odd.withColumn("doc_id", F.lit(9).cast("long")), "none": whole.limit(0)}.items():
        at = str(tmp_path_factory.mktemp(name))
        df.repartition(3).write.mode("overwrite").parquet(f"{at}/documents.parquet")
        out[name] = at
    return out


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def shingle_set(text):
    ws = (text or "").lower().split()
    return {" ".join(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def least_of_groups(found, similarity=0.8):
    """The rows that near-duplicate removal keeps: per group the one with the least id, null last."""
    sets = [shingle_set(r[1]) for r in found]
    root = list(range(len(found)))
    for i in range(len(found)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if root[i] != root[j] and (a == b or a and b and min(len(a), len(b)) >= similarity * max(len(a), len(b)) - 1e-9 and len(a & b) >= similarity * len(a | b) - 1e-9):
                x, y = sorted((root[i], root[j]))
                root = [x if r == y else r for r in root]
    kept = {}
    for r, g in zip(found, root, strict=True):
        kept.setdefault(g, []).append(r)
    return kept.values()


def without_repeats(found, window=13):
    first = {}
    late = substring.LAST
    key = lambda r: late if r[0] is None else r[0]
    for r in found:
        ws = (r[1] or "").split()
        for j in range(len(ws) - window + 1):
            k = tuple(ws[j : j + window])
            first[k] = min(first.get(k, late), key(r))
    out = []
    for r in found:
        ws = (r[1] or "").split()
        gone = [False] * len(ws)
        for j in range(len(ws) - window + 1):
            if first[tuple(ws[j : j + window])] < key(r):
                gone[j : j + window] = [True] * window
        out.append((r[0], [w for w, g in zip(ws, gone, strict=True) if not g], any(gone)))
    return out


def good(text):
    """Whether the current policy keeps a text, by its rules in plain Python."""
    t = text or ""
    ws = t.encode().split()
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    repeated = len({j for i, w in enumerate(windows) if w in twice for j in (i, i + 1, i + 2)})
    lines = [x for x in t.split("\n") if x.encode().split()]
    n, chars, letters = len(ws), len(b"".join(ws).decode()), re.findall("[A-Za-z]", t)
    upper = re.findall("[A-Z]", t)
    return not (
        n < 50 or 100 * repeated > 50 * n or 10 * len(re.findall(r"[#*$%&|<>]", t)) > 3 * n or len(lines) >= 4 and 100 * (len(lines) - len(set(lines))) > 40 * len(lines)
        or len(letters) >= 50 and 2 * len(upper) > len(letters) or n > 0 and (chars < 2 * n or chars > 30 * n)
    )


def shared(children, budget):
    """children (name: (cap, weight)): what each gets of a budget, the fullest first."""
    order = sorted(children, key=lambda k: (children[k][1] == 0, Fraction(children[k][0], children[k][1]) if children[k][1] else 0, k))
    left, rest, out = budget, sum(w for _, w in children.values()), {}
    open_ = []
    for k in order:
        cap, w = children[k]
        if w > 0 and cap * rest <= w * left:
            out[k] = cap
        else:
            open_.append(k)
        left, rest = left - cap, rest - w
    over, weight = budget - sum(out.values()), max(1, sum(children[k][1] for k in open_))
    return out | {k: children[k][1] * over // weight for k in open_}


def mixed(found, fraction=(4, 5)):
    """The rows that one epoch of the mix takes of rows (doc_id, text, lang, source, n_chars)."""
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    leaves = {}
    for r in found:
        number = re.fullmatch("src([0-9]{1,9})", r[3] or "")
        leaves.setdefault((mixing.DOMAINS[int(number[1]) % 3] if number else mixing.NONE, r[2] if r[2] is not None else mixing.NONE, r[3] if r[3] is not None else mixing.NONE), []).append(r)
    size = lambda r: len((r[1] or "").encode().split())
    supply = {k: sum(map(size, rs)) for k, rs in leaves.items()}
    given = {(): sum(supply.values()) * fraction[0] // fraction[1]}
    for depth in (1, 2, 3):
        for parent in {k[: depth - 1] for k in supply}:
            names = {k[:depth] for k in supply if k[: depth - 1] == parent}
            given |= shared({n: (sum(v for k, v in supply.items() if k[:depth] == n), mixing.WEIGHTS.get(n, 1)) for n in names}, given[parent])
    out = []
    for k, rs in leaves.items():
        if supply[k]:
            whole, left = divmod(given[k], supply[k])
            place = lambda r: (md5(f"{mixing.SEED}:{whole}:{r[0] if r[0] is not None else md5(r[1] or '')}"), r[0] if r[0] is not None else -1, md5(r[1] or ""))  # noqa: B023, E731
            out += rs if whole else [r for r in rs if sum(size(x) for x in rs if place(x) <= place(r)) <= left]
    return out


def test_mixing_keeps_the_budget_without_ids(spark):
    df = spark.createDataFrame([(None if lang != "es" else i, f"{'w ' * 6}{lang}{i}", lang, "src0", 1) for lang, n in (("en", 20), ("de", 200), ("es", 200)) for i in range(n)], SCHEMA)
    found = rows(df, "doc_id", "text", "lang", "source", "n_chars")
    got = rows(mixing.mix(df, (2, 5)), "doc_id", "text", "lang", "source", "n_chars")
    assert got == sorted(mixed(found, (2, 5)), key=repr)
    assert 0.95 * 1176 <= sum(len(r[1].split()) for r in got) <= 1176 and any(r[0] is None for r in got) and len(got) < 200


@pytest.mark.parametrize("name", ["whole", "odd", "one", "none"])
def test_stages_against_plain_python(spark, tables, name):
    docs = spark.read.parquet(f"{tables[name]}/documents.parquet")
    columns = ("doc_id", "text", "lang", "source", "n_chars")
    for stage, f in pipeline.STAGES[:-1]:
        out = pipeline.written(f(spark, docs, tables[name]), stage)
        before, after = rows(docs, *columns), rows(out, *columns)
        assert out.columns == list(columns)
        if stage == "simhash_near_dedup":
            groups = least_of_groups(before)
            assert len(after) == len(groups)
            for g in groups:
                ids = [r[0] for r in g if r[0] is not None]
                kept = [r for r in after if r in g]
                assert kept and all(k[0] == (min(ids) if ids else None) for k in kept)
        elif stage == "substring_dedup":
            want = [(i, ws) for i, ws, cut in without_repeats(before) if ws or not cut]
            assert sorted(((r[0], (r[1] or "").split()) for r in after), key=repr) == sorted(want, key=repr)
        elif stage == "quality_rules":
            assert after == [r for r in before if good(r[1])]
        else:
            assert after == sorted(mixed(before), key=repr)
        docs = out
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    told = [(i, list(ids)) for i, ids in rows(pipeline.STAGES[-1][1](spark, docs, tables[name]), "doc_id", "ids")]
    want = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows(docs, "doc_id", "text")]
    assert sorted(told, key=repr) == sorted(want, key=repr)


def test_run_chains_the_stages(spark, tables):
    assert pipeline.run(spark, tables["none"]).count() == 0
    assert 0 < pipeline.run(spark, tables["whole"]).count() < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_recall_of_near_copies_by_pairs(spark):
    """Of the pairs of different texts at 0.8 or more on the 0.01 tables, and of made pairs around it, 0.9 or more come into one group, and none apart from it."""
    found = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    sets = {i: shingle_set(t) for i, t in found}
    group = {r["doc_id"]: r["group"] for r in simhash.similar(spark.createDataFrame(found, "doc_id long, text string")).collect()}
    order = sorted(sets, key=lambda i: len(sets[i]))
    pairs = []
    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            if 0.8 * len(sets[b]) > len(sets[a]):
                break  # no larger set can be as similar
            pairs.append((a, b))
    near = [(a, b) for a, b in pairs if sets[a] != sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert all(group[a] == group[b] for a, b in pairs if sets[a] == sets[b])
    assert sum(group[a] == group[b] for a, b in near) >= 0.9 * len(near)


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + 4]) for i in range(len(ws) - 3)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("share_rows", [20_000, 3])
def test_op1_against_plain_python(spark, tables, monkeypatch, share_rows):
    monkeypatch.setattr(simhash, "ANCHOR_ROWS", share_rows)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op1_simhash_components(spark, SF).collect()}
    docs = [(r["doc_id"], plain_fingerprint(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    f = np.array([x for _, x in docs], np.uint64)
    root = simhash._union(np.arange(len(f)), *np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= 4))
    least = {}
    for (i, _), r in zip(docs, root.tolist(), strict=True):
        least[r] = min(least.get(r, i), i)
    assert got == {i: (f"{x:016x}", least[r]) for (i, x), r in zip(docs, root.tolist(), strict=True)}


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = queries.queries()[name](spark, SF)
    rel = con.sql(queries.oracle_sql()[name])
    shared = [c for c in sorted(rel.columns) if c in df.columns]
    assert shared == sorted(rel.columns)
    at = [rel.columns.index(c) for c in shared]
    assert sorted((tuple(map(plain, r)) for r in df.select(*shared).collect()), key=repr) == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)


def test_op2_against_the_library(spark):
    import zlib

    from tokenizers import Tokenizer

    from loomlex.llm import tokenfile

    library = Tokenizer.from_file(tokenfile.default_path())
    want, start = [], 0
    for r in sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect(), key=lambda r: r["doc_id"]):
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert rows(queries.op2_token_files(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)


def test_op7_against_plain_python(spark):
    from loomlex.llm import media

    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        wave = media.to_wave(media.pad((r["text"] or "").encode()))
        want.append((r["doc_id"], len(wave), hashlib.sha256(wave).hexdigest()))
    out = queries.op7_media_archives(spark, SF)
    assert rows(out, "doc_id", "media_bytes", "media_sha256") == sorted(want, key=repr)
    twice = out.groupBy("payload_sha256").agg(F.count_distinct("feature").alias("n")).where("n > 1")
    assert twice.count() == 0
