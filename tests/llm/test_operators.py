"""The operators on small tables with nulls, empty and long texts, ties, repeated rows, clashing names and no rows."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomlex.llm import bpe, media, mixing, pages, quality, simhash, substring, tokenfile, toxicity, urlfilter

BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ROWS = [
    (1, BASE + " alpha", "en", "src0", 1), (2, "beta " + BASE, "en", "src1", 1), (3, None, None, None, None), (4, "", "de", "src2", 0), (5, BASE.upper() + " ALPHA", "en", "src0", 1),
    (5, BASE.upper() + " ALPHA", "en", "src0", 1), (6, "w%d " * 20 % tuple(range(20)), "fr", "odd", 1), (7, "long " * 30000, "en", "src0", 1), (None, BASE, "en", "src0", 1), (8, " \n\t", "en", "src4", 1), (9, "x " + BASE + " y " + BASE, "es", "src5", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({"id": F.lit("clash"), "chunk": F.lit(1), "fp": F.lit(2), "least": F.lit("x"), "_kept": F.lit(3)}).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_quality(docs, empty):
    got = quality.apply_policy(quality.ledger(docs))
    assert got.count() == len(ROWS) and quality.ledger(empty).count() == 0
    r = got.where("doc_id = 7").first()
    assert (r["n_words"], r["n_repeat_words"], r["kept"]) == (30000, 30000, False)
    kept = quality.keep_good(docs, "base")
    assert kept.columns == docs.columns and kept.count() == got.where("failures % 4 = 0").count() and quality.keep_good(empty).count() == 0
    table = {r["rule"]: (r["n_failed"], r["n_only"]) for r in quality.ablation(got, "base").collect()}
    assert table["few_words"] == (10, 9) and table["repeated_words"] == (2, 1)


def brute_removed(window=13):
    first, out = {}, {}
    items = sorted(ROWS, key=lambda r: substring.LAST if r[0] is None else r[0])
    for i, t, *_ in items:
        ws = (t or "").split()
        for j in range(len(ws) - window + 1):
            first.setdefault(tuple(ws[j : j + window]), substring.LAST if i is None else i)
    for i, t, *_ in items:
        ws = (t or "").split()
        gone = [False] * len(ws)
        for j in range(len(ws) - window + 1):
            if first[tuple(ws[j : j + window])] < (substring.LAST if i is None else i):
                gone[j : j + window] = [True] * window
        kept = " ".join(w for w, g in zip(ws, gone, strict=True) if not g)
        out.setdefault((i, len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest()), 0)
        out[i, len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return sorted((k for k, n in out.items() for _ in range(n)), key=repr)


@pytest.mark.parametrize("chunk_bytes, parts", [(substring.CHUNK_BYTES, substring.MOST_PARTS), (200, 3)])
def test_substring(docs, empty, monkeypatch, chunk_bytes, parts):
    """As one chunk, and as many that share few buckets."""
    monkeypatch.setattr(substring, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(substring, "MOST_PARTS", parts)
    assert rows(substring.digests(docs)) == brute_removed()
    assert substring.digests(empty).count() == 0
    out = substring.dedup(docs)
    assert out.dtypes == docs.dtypes
    assert out.where("doc_id = 1").first()["text"] == ROWS[0][1] and out.where("doc_id = 2").first()["text"] == "beta"


@pytest.mark.parametrize("seed", range(4))
def test_repeated_hashes_in_batches_of_any_size(seed):
    """Rows of hashes sorted as Spark sorts them, against the same in plain Python."""
    r = random.Random(seed)
    found = set()
    for doc in [*range(12), substring.LAST]:
        for h in r.sample(range(-3, 12), r.randint(1, 9)):
            for chunk in {doc % 4} if doc != substring.LAST else set(r.sample(range(4), 2)):
                found.add((h, doc, r.randrange(9), chunk, r.random() < 0.1 and doc != substring.LAST))
    ordered = sorted(found)
    by = {}
    for x in ordered:
        by.setdefault(x[0], []).append(x)
    want = [(c, h, xs[0][1], xs[0][2]) for h, xs in by.items() if len({x[1] for x in xs}) > 1 or any(x[4] for x in xs) for _, _, _, c, _ in xs]
    for size in (1, 2, 5, 1000):
        cut = [ordered[i : i + size] for i in range(0, len(ordered), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*b, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()), strict=True)], ["h", "doc", "at", "chunk", "several"]) for b in cut]
        got = [tuple(x.values()) for b in substring._repeated(iter(batches)) for x in b.to_pylist()]
        assert sorted(got) == sorted(want)


def test_chunks_are_dropped_on_request(spark, docs):
    substring.digests(docs).count()
    substring.drop_chunks(spark)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(substring.CHUNKS)]


def test_simhash(docs, empty):
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert got[1] == got[5] == 1 and got[3] == got[4] == got[8] == 3 and got[2] == 2
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs))
    assert kept.dtypes == docs.dtypes and sorted(r["doc_id"] for r in kept.select("doc_id").where("doc_id IS NOT NULL").collect()) == sorted({v for v in got.values() if v is not None})
    assert simhash.keep_one(empty, simhash.similar(empty)).count() == 0


def test_similar(spark):
    text = " ".join(f"w{i}" for i in range(200))
    other = " ".join(f"v{i}" for i in range(200))
    table = spark.createDataFrame([(1, text), (2, text + " more"), (3, text.replace("w100 ", "x ")), (4, other), (5, None), (6, "")], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in simhash.similar(table).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5}


def test_ids_that_are_no_numbers(docs):
    named = docs.withColumn("doc_id", F.concat(F.lit("n"), F.col("doc_id").cast("string")))
    kept = simhash.keep_one(named, simhash.similar(named))
    assert kept.dtypes == named.dtypes and 0 < kept.count() < named.count()
    assert {r["doc_id"] for r in simhash.near_duplicates(named).collect()} == {r["doc_id"] for r in named.select("doc_id").collect()}


def test_token_files(docs, empty):
    got = tokenfile.write_and_read(docs, tokenfile.default_path()).orderBy("start").collect()
    assert len(got) == len(ROWS) and [r["doc_id"] for r in got] == sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x))
    assert got[0]["start"] == 0 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))  # noqa: B905
    blank = next(r for r in got if r["doc_id"] == 3)
    assert (blank["n_tokens"], blank["ids_crc32"]) == (1, zlib.crc32(b"\x02\0\0\0"))
    assert tokenfile.write_and_read(empty, tokenfile.default_path()).count() == 0


def test_bpe(docs, empty):
    path = bpe.default_path()
    enc = bpe.encode(docs, path, "doc_id")
    back = {r["doc_id"]: r["decoded"] for r in bpe.decode(enc, path, "doc_id").collect()}
    assert back == {r[0]: r[1] or "" for r in ROWS}
    got = bpe.round_trip(docs, path)
    assert {r["doc_id"]: r["decoded_sha256"] for r in got.collect()} == {r[0]: hashlib.sha256((r[1] or "").encode()).hexdigest() for r in ROWS}
    assert got.count() == len(ROWS) and bpe.round_trip(empty, path).count() == 0 and bpe.encode(empty, path).count() == 0


def test_media(docs, empty):
    got = {r["doc_id"]: r for r in media.store_and_read(docs).collect()}
    for i, t, *_ in ROWS:
        raw = (t or "").encode()
        p = media.pad(raw)
        assert (got[i]["n_bytes"], got[i]["payload_bytes"], got[i]["payload_sha256"], got[i]["tail_crc32"]) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    assert got[3]["media_sha256"] == got[4]["media_sha256"] and media.store_and_read(empty).count() == 0


def test_media_small_ranges(spark, docs):
    from loomlex.llm.common import new_dir

    at = new_dir(spark, "t")
    assert media.write_archives(docs, at) == len(ROWS)
    assert media.read_archives(spark, at, 100).count() == media.read_archives(spark, at).count() == len(ROWS)


def test_mixing(docs, empty):
    got = mixing.plan(docs)
    assert set(got.columns) == {"doc_id", "domain", "lang", "source", "n_tokens", "epoch"} and mixing.plan(empty).count() == 0
    supply = sum(len((r[1] or "").split()) for r in ROWS)
    assert 0 < got.agg(F.sum("n_tokens")).first()[0] <= supply * 3 // 5
    assert mixing.mix(docs, (1, 1)).dtypes == docs.dtypes and mixing.mix(empty).count() == 0


def test_filling_shares_shortages_with_siblings(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 10), ("a", "x", "2", 1000), ("b", "x", "1", 5)], "domain string, lang string, source string, supply long")
    got = {(r["domain"], r["source"]): r["allocated"] for r in mixing.allocate(leaves, F.lit(500), 1, {}).collect()}
    assert got == {("a", "1"): 10, ("a", "2"): 485, ("b", "1"): 5}
    none = {(r["domain"], r["source"]): r["allocated"] for r in mixing.allocate(leaves, F.lit(500), 1, {("b",): 0}).collect()}
    assert none == {("a", "1"): 10, ("a", "2"): 490, ("b", "1"): 0}


def test_url_filter(spark):
    table = spark.createDataFrame([(1, "http://a.example.net/en/x"), (2, "http://b.net/"), (3, None), (4, "junk"), (5, "http://b.net"), (6, "http://x.org/fr/"), (6, "http://x.org/fr/")], "page_id long, url string").withColumn("id", F.lit("clash"))
    got = rows(urlfilter.match(table))
    assert got[0] == (1, "a.example.net", "/en/x", "example.net/en/", "allow") and got[1][3:] == ("net/", "block") and got[2] == (3, "", "", None, "allow") and got[4][3:] == (None, "allow") and len(got) == 7
    assert urlfilter.match(table.limit(0)).count() == 0
    rules = spark.createDataFrame([*urlfilter.RULES], "host string, path string, verdict string")
    once = table.dropDuplicates(["page_id"])
    assert rows(urlfilter.match_by_join(once, rules)) == rows(urlfilter.match(once))


def test_pages(spark):
    html = "<body><nav><a href=/>Home</a></nav><article><h1>T</h1><p>Some words here, and more of them.</p></article><footer>c</footer></body>"
    table = spark.createDataFrame([(1, "u", html), (2, None, None), (3, "u", ""), (1, "u", html)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = rows(pages.extract(table))
    text = "T\nSome words here, and more of them."
    assert got == [(1, "u", text, len(text)), (1, "u", text, len(text)), (2, None, "", 0), (3, "u", "", 0)] and pages.extract(table.limit(0)).count() == 0


def test_toxicity(spark, docs, empty):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = toxicity.classify(d.unionByName(docs.select(*d.columns)), lab)
    assert out.count() == d.count() + len(ROWS)
    held = out.join(lab, "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in held if r["toxic"] == k] for k in (1, 0))
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.85 and all(0 <= r["score"] <= 1 for r in held)
    none = toxicity.classify(docs, lab.limit(0))
    assert none.count() == len(ROWS) and toxicity.classify(empty, lab).count() == 0
