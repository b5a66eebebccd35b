"""A batch of corrections from votes to publication, hash trees, and replays of tampered records."""

import random

import pytest
from pyspark.sql import functions as F

from loomlex.operators import hashtree
from loomlex.operators.tables import RDFS, SKOS, TRIPLES
from loomlex.plans import batch, release
from loomlex.sources import publish


def test_trees_find_the_rows_that_differ(spark):
    rows = [(i, f"v{i}", None if i % 3 else i / 7, [str(i)]) for i in range(3000)]
    schema = "k int, v string, x double, a array<string>"
    old = spark.createDataFrame(rows, schema)
    random.Random(1).shuffle(rows)
    assert hashtree.same(old, spark.createDataFrame(rows, schema).select("a", "x", "k", "v"), ["k"])
    changed = [(k, "other", x, a) if k == 77 else (k, v, x, a) for k, v, x, a in rows if k != 5] + [(9000, None, None, None)]
    new = spark.createDataFrame(changed, schema)
    assert not hashtree.same(old, new, ["k"])
    a, b = hashtree.narrowed(old, new, ["k"])
    assert {r.k for r in a.collect()} ^ {r.k for r in b.collect()} == {5, 9000} and a.count() + b.count() < 30
    assert sorted(map(tuple, release.differing(a, b, ["k"]).collect())) == [(5, "unexpected"), (77, "different"), (9000, "missing")]
    kept = hashtree.tree(old, ["k"])
    assert hashtree.narrowed(old, old, ["k"], kept)[0].count() == 0
    none = old.limit(0)
    assert hashtree.narrowed(none, none, ["k"])[0].count() == 0 and hashtree.narrowed(none, old, ["k"])[1].count() == 3000
    twice = old.union(old.limit(1))
    assert not hashtree.same(old, twice, ["k"])


def batch_of(spark, **other):
    V = "subject string, predicate string, lexical string, language string, datatype string"
    values = spark.createDataFrame([(f"urn:{i}", "urn:p", f"text {i}", "en", None) for i in range(6)], V)
    records = values.withColumn("record_id", F.col("subject"))
    ids = [f"urn:{i}" for i in range(3)]
    votes = spark.createDataFrame([(i, "defect") for i in ids for _ in "ab"] + [("urn:4", "defect"), ("urn:4", "pass")], "record_id string, verdict string")
    proposals = spark.createDataFrame([(i, n, f"{i} fixed {n}") for i in ids for n in (1, 2)], "record_id string, attempt int, replacement string")
    checks = spark.createDataFrame([(i, n, v, "defect" if (i, n) in (("urn:1", 1), ("urn:2", 1), ("urn:2", 2)) else "pass", 0.9) for i in ids for n in (1, 2) for v in "xy"], "record_id string, attempt int, verifier string, verdict string, confidence double")
    final = spark.createDataFrame([(i, n, v, "pass", 0.9) for i, n in (("urn:0", 1), ("urn:1", 2)) for v in "rs"], "record_id string, attempt int, reviewer string, verdict string, confidence double")
    routes = records.select("record_id", F.lit("p").alias("proposer_route"), F.array(F.lit("v"), F.lit("w")).alias("verifier_routes"), F.array(F.lit("h1"), F.lit("h2")).alias("verifier_qualification_hashes"))
    q = spark.createDataFrame([("correction-proposer", "p", "h0", "qualified"), ("correction-verifier-1", "v", "h1", "qualified"), ("correction-verifier-2", "w", "h2", "qualified")], "role string, route_id string, qualification_hash string, status string")
    tables = {"values": values, "records": records, "votes": votes, "proposals": proposals, "checks": checks, "rereviews": final, "routes": routes, "qualifications": q}
    return tables | {k: f(tables[k]) for k, f in other.items()}


def test_a_batch_is_published_once(spark, tmp_path):
    told = batch.corrected_batch(**batch_of(spark), minimum=0.8, path=str(tmp_path / "b"))
    assert told["payload"]["states"] == {"verified": 2, "quarantined": 1} and told["payload"]["lines"] == 6
    lines = spark.read.json(str(tmp_path / "b" / "values" / "part-*"))
    assert sorted((r.subject, r.lexical) for r in lines.collect()) == [("urn:0", "urn:0 fixed 1"), ("urn:1", "urn:1 fixed 2"), *((f"urn:{i}", f"text {i}") for i in range(2, 6))]
    assert publish.read_manifest(str(tmp_path / "b" / "ledger"))["lines"] == 2
    assert batch.corrected_batch(**batch_of(spark), minimum=0.8, path=str(tmp_path / "b")) == told
    with pytest.raises(FileExistsError):
        batch.corrected_batch(**batch_of(spark, proposals=lambda p: p.withColumn("replacement", F.concat("replacement", F.lit("!")))), minimum=0.8, path=str(tmp_path / "b"))


@pytest.mark.parametrize(
    "table, f, why",
    [("qualifications", lambda q: q.withColumn("status", F.lit("rejected")), "binding"), ("routes", lambda r: r.where("record_id <> 'urn:0'"), "binding"), ("rereviews", lambda r: r.where("record_id <> 'urn:0'"), "lineage"), ("values", lambda v: v.where("subject <> 'urn:0'"), "exactly one")],
)
def test_a_batch_that_is_not_borne_out_is_not_published(spark, tmp_path, table, f, why):
    with pytest.raises(ValueError, match=why):
        batch.corrected_batch(**batch_of(spark, **{table: f}), minimum=0.8, path=str(tmp_path / "c"))
    assert publish.read_manifest(str(tmp_path / "c" / "values")) is None


def test_one_changed_row_of_each_stage_is_found(spark):
    v = "subject string, predicate string, lexical string, language string, datatype string"
    old = spark.createDataFrame([(f"urn:{i}", RDFS + "label", f"l{i}", "en", None) for i in range(30)], v)
    new = spark.createDataFrame([(f"urn:{i}", RDFS + "label", f"l{i}" if i % 3 else f"m{i}", "en", None) for i in range(31)], v)
    triples = spark.createDataFrame([(f"urn:{i}", "iri", SKOS + "definition", " " if i % 4 == 0 else "words", "literal", "en", None) for i in range(20)], TRIPLES)
    records = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(80)], "record_id int, stratum string")
    votes = lambda k: spark.createDataFrame([(i, "defect" if i % k == 0 else "pass", 0.9) for i in range(80)], "record_id int, verdict string, confidence double")
    cases = spark.createDataFrame([(i, "f", "en" if i % 2 else "de", "pass" if i % 3 else "defect") for i in range(40)], "case_id int, family string, locale string, expected string")
    told = cases.select("case_id", F.col("expected").alias("predicted"))
    inputs = {"old": old, "new": new, "triples": triples, "records": records, "left": votes(5), "right": votes(10), "cases": cases, "predictions": told}
    run = lambda: batch.recomputed(inputs, 0.5, 0.95, 0.2, 5, 0.5, 5, "s", (0.5, 0.5, 0.5))
    anew = run()
    record = {k: df for k, (df, _) in anew.items()}
    assert batch.replayed(record, run()).count() == 0
    assert all(df.count() for df in record.values())
    for stage, (df, keys) in anew.items():
        one = df.orderBy(*keys).first()
        last = df.columns[-1]
        row = one.asDict() | {last: not one[last] if isinstance(one[last], bool) else (one[last] or 0) + 1 if isinstance(one[last], int | float) else "other"}
        record[stage] = df.exceptAll(spark.createDataFrame([one], df.schema)).union(spark.createDataFrame([tuple(row[c] for c in df.columns)], df.schema))
    found = {}
    for r in batch.replayed(record, anew).collect():
        found.setdefault(r.stage, []).append(r.problem)
    assert set(found) == set(anew) and all(len(x) <= 2 for x in found.values())
