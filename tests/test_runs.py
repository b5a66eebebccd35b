"""Runs of review and files around them: cases, policies, debt, receipts, replay, roles, attestations, merges and odd graphs."""

import json

import pytest
from pyspark.sql import functions as F

from loomlex.functions import identity, text
from loomlex.operators import changes, graph, labels, nameless, review, tables
from loomlex.operators.tables import RDFS, SKOS
import loomlex.plans.queries  # noqa: F401
from loomlex.plans import release
from loomlex.plans.registry import QUERIES
from loomlex.sources import files, rdfxml

HEAD = '<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns:skos="http://www.w3.org/2004/02/skos/core#">'


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_cases_policy_and_debt_files(spark, tmp_path):
    good = {"case_id": "c1", "family": "f", "locale": "en", "authority": "deterministic-gold", "source_kind": "own", "expected_verdict": "pass"}
    (tmp_path / "c.jsonl").write_text(json.dumps(good) + "\n" + json.dumps({**good, "case_id": "c2", "authority": "unscored-challenge", "expected_verdict": None}) + "\n")
    assert files.read_cases(spark, str(tmp_path / "c.jsonl")).count() == 2
    for bad in ({**good}, {**good, "case_id": ""}, {**good, "case_id": "x", "authority": "mine"}, {**good, "case_id": "x", "source_kind": "model-consensus"}, {**good, "case_id": "x", "authority": "source-grounded-silver"}, {**good, "case_id": "x", "authority": "unscored-challenge"}):
        (tmp_path / "b.jsonl").write_text(json.dumps(good) + "\n" + json.dumps(bad) + "\n")
        with pytest.raises(ValueError):
            files.read_cases(spark, str(tmp_path / "b.jsonl"))
    (tmp_path / "p.yaml").write_text('{"sentinel_values": ["null"], "cardinality": {"p": {"max": 1}}}')
    assert files.read_policy(str(tmp_path / "p.yaml"))["cardinality"]["p"]["max"] == 1
    entry = {"debt_id": "d", "subject": "s", "predicate": "p", "language": None, "datatype": None, "current_hash": "h", "state": "open"}
    (tmp_path / "d.json").write_text(json.dumps([entry]))
    assert files.read_debt(spark, str(tmp_path / "d.json")).count() == 1
    for bad in ([entry, entry], [{**entry, "state": "closed"}], [{**entry, "replacement": "x"}], [entry, {**entry, "debt_id": "e"}]):
        (tmp_path / "e.json").write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            files.read_debt(spark, str(tmp_path / "e.json"))


def test_sidecar_takes_the_last_and_artifacts_are_canonical(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("sense_id\tlexeme_id\theadword\tpos\tsense_index\tdomain\tgloss\na\tl\told\tnoun\t1\td\tg\nb\tl\tx\tnoun\t1\td\tg\na\tl\tnew\tnoun\t1\td\tg\n")
    assert {r["sense_id"]: r["headword"] for r in files.read_sidecar(spark, str(tmp_path / "s.tsv")).collect()} == {"a": "new", "b": "x"}
    (tmp_path / "a.json").write_bytes(files.canonical_bytes({"b": 1, "a": [2]}) + b"\n")
    assert files.read_canonical(str(tmp_path / "a.json")) == {"a": [2], "b": 1}
    (tmp_path / "a.json").write_text('{"b": 1}')
    with pytest.raises(ValueError):
        files.read_canonical(str(tmp_path / "a.json"))
    assert files.project_schema({"type": "object", "allOf": [1], "items": [{"if": 1, "x": {"uniqueItems": True, "y": 2}}]}) == {"type": "object", "items": [{"x": {"y": 2}}]}


def test_raw_elements_before_meaning(spark, tmp_path):
    (tmp_path / "g.owl").write_text(HEAD + '<owl:Class rdf:about="urn:a"><skos:altLabel xml:lang="en_US">A</skos:altLabel><rdfs:label> </rdfs:label></owl:Class></rdf:RDF>')
    raw = rdfxml.read_raw(spark, str(tmp_path / "g.owl")).where(F.col("predicate").isin(SKOS + "altLabel", RDFS + "label"))
    assert rows(raw) == [(RDFS + "label", " ", None), (SKOS + "altLabel", "A", "en_US")]
    assert spark.range(1).select(rdfxml.unescape(F.lit("&lt;a&amp;lt;&quot;"))).first()[0] == '<a&lt;"'


def test_merge_applies_all_seven_kinds(spark):
    ours = HEAD + """<owl:Class rdf:about="urn:x"><rdfs:label>X</rdfs:label><skos:notation>rel:X</skos:notation><skos:altLabel>new</skos:altLabel><skos:hiddenLabel>h</skos:hiddenLabel><skos:definition>d1</skos:definition>
<rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource="urn:p"/><owl:someValuesFrom rdf:resource="urn:y"/></owl:Restriction></rdfs:subClassOf></owl:Class>
<owl:Class rdf:about="urn:z"><rdfs:label>Z</rdfs:label><skos:definition>a</skos:definition><skos:definition>b</skos:definition></owl:Class>
<owl:Class rdf:about="urn:y"><rdfs:label>Y</rdfs:label><rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource="urn:p"/><owl:hasValue>1</owl:hasValue></owl:Restriction></rdfs:subClassOf></owl:Class></rdf:RDF>"""
    theirs = HEAD + """<owl:Class rdf:about="urn:x"><rdfs:label>rel:X</rdfs:label><skos:altLabel>old</skos:altLabel><skos:definition>d0</skos:definition></owl:Class>
<owl:Class rdf:about="urn:z"><rdfs:label>Z</rdfs:label><skos:definition>a</skos:definition></owl:Class></rdf:RDF>"""
    a, b = rdfxml.from_string(spark, ours), rdfxml.from_string(spark, theirs)
    parts = changes.merge_diff(a, b, "rel:")
    assert {r["kind"]: r["n"] for r in changes.merge_summary(parts).collect()} == {
        "new_classes": 1, "new_alt_labels": 1, "new_hidden_labels": 1, "removed_labels": 1, "definition_additions": 1, "definition_updates": 1, "label_normalizations": 1, "new_restrictions": 1,
    }
    merged = tables.stored(changes.apply_merge(a, b, parts), "merged")
    assert changes.same(changes.canonical(merged), changes.canonical(a))
    again = changes.merge_summary(changes.merge_diff(a, merged, "rel:"))
    assert {r["n"] for r in again.collect()} == {0}
    back = rdfxml.from_string(spark, "\n".join(rdfxml.to_rdfxml(merged)))
    assert changes.same(changes.canonical(back), changes.canonical(merged))


def test_deep_trees_of_nameless_nodes_are_told_apart(spark):
    schema = tables.TRIPLES
    chain = lambda name, end: [(f"_:{name}{i}", "bnode", "p", f"_:{name}{i + 1}", "bnode", None, None) for i in range(9)] + [(f"_:{name}9", "bnode", "q", end, "literal", None, None)]
    h = {r["node"]: r["hash"] for r in nameless.names(spark.createDataFrame(chain("a", "x") + chain("b", "x") + chain("c", "y"), schema)).collect()}
    assert h["_:a0"] == h["_:b0"] != h["_:c0"]


def test_null_strata_are_sampled_too(spark):
    records = spark.createDataFrame([(str(i), None if i % 2 else "s") for i in range(200)], "id string, stratum string")
    out = review.hash_sample(records, "id", "seed", 0.95, 0.1, 10, 2)
    assert out.count() == 200 and out.where("stratum IS NULL AND selected").count() == out.where("stratum = 's' AND selected").count() > 10


def test_receipts_collide(spark):
    held = spark.createDataFrame([("1", "a")], "request_id string, body string")
    new = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "b")], "request_id string, body string")
    assert rows(review.receipts_to_add(held, new)) == [("2", "b")]
    for bad in (new.union(spark.createDataFrame([("2", "c")], new.schema)), spark.createDataFrame([("1", "z")], new.schema)):
        with pytest.raises(ValueError):
            review.receipts_to_add(held, bad)


def test_attestation_and_migration(spark):
    states = spark.createDataFrame([("1", "accepted")], "record_id string, state string")
    report = release.release_report({"census": True}, {"census": "h"}, states, "c", {"census": "c"})
    told = release.attest(report, "2030-01-01T00:00:00", repository="r", commit="x")
    release.check_attestation(told, report, "c", "2026-01-01T00:00:00", repository="r")
    for bad in (({**told, "commit": "y"}, "c", "2026-01-01T00:00:00", {}), (told, "d", "2026-01-01T00:00:00", {}), (told, "c", "2031-01-01T00:00:00", {}), (told, "c", "2026-01-01T00:00:00", {"repository": "q"})):
        with pytest.raises(ValueError):
            release.check_attestation(bad[0], report, bad[1], bad[2], **bad[3])
    debt = spark.createDataFrame([("d", "s", "p", None, None, "h", "open")], "debt_id string, subject string, predicate string, language string, datatype string, current_hash string, state string")
    root = debt.select(identity.debt_root(*(F.col(c) for c in ("debt_id", "subject", "predicate", "language", "datatype", "current_hash"))).alias("root_record_id"), F.lit("r1").alias("revision_id"))
    receipt = release.migration_receipt(debt, root, report, "f")
    assert receipt["closed"] == 1 and receipt == release.migration_receipt(debt, root, report, "f")
    with pytest.raises(ValueError):
        release.migration_receipt(debt, root.limit(0), report, "f")
    with pytest.raises(ValueError):
        release.migration_receipt(debt, root, {**report, "payload": {"decision": "blocked"}}, "f")
    with pytest.raises(ValueError):
        release.attest(release.release_report({"census": False}, {}, states, "c", {}), "2030-01-01")


def test_final_review_sends_on_to_the_next_attempt(spark):
    votes = spark.createDataFrame([(1, "defect"), (1, "defect"), (2, "defect"), (2, "pass"), (3, "defect"), (3, "defect")], "record_id int, verdict string")
    proposals = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (3, 1, "a"), (3, 2, "a")], "record_id int, attempt int, replacement string")
    checks = spark.createDataFrame([(r, a, v, "pass", 0.9) for r in (1, 3) for a in (1, 2) for v in "xy"], "record_id int, attempt int, verifier string, verdict string, confidence double")
    final = spark.createDataFrame([(r, 1, v, "defect" if v == "t" else "pass", 0.9) for r in (1, 3) for v in "st"], "record_id int, attempt int, reviewer string, verdict string, confidence double")
    assert rows(release.correction_run(votes, proposals, checks, final, 0.8)) == [(1, "verified", 2, "b"), (3, "quarantined", None, None)]


def test_minting_needs_enough_candidates(spark):
    used = spark.createDataFrame([("R" + "a" * 20,)], "name string")
    candidates = spark.createDataFrame([("R" + "a" * 20, 1), ("short", 2), ("R" + "b" * 20, 3)], "name string, place int")
    assert rows(labels.mint(candidates, used, 1)) == [("R" + "b" * 20, "R" + "a" * 20, None)]
    with pytest.raises(ValueError):
        labels.mint(candidates, used, 2)


def test_census_of_nothing_and_of_every_kind(spark):
    assert review.census_status(review.census_run(spark.createDataFrame([], tables.TRIPLES))).first()["status"] == "complete"
    allowed = spark.createDataFrame([("urn:a", "iri", SKOS + "note", "urn:b", "iri", None, None)], tables.TRIPLES)
    assert review.census_run(allowed, resources=(SKOS + "note",)).count() == 0 and review.census_run(allowed).count() == 1


def test_normal_texts_against_python(spark):
    """q49 over the whole smallest table, and cases that ASCII does not show."""
    import hashlib

    got = {r["doc_id"]: r["normal_hash"] for r in QUERIES["q49_unicode_normalise"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert got == {r["doc_id"]: r["text"] if r["text"] is None else hashlib.sha256(text.normalize_text(r["text"]).encode()).hexdigest() for r in docs}
    odd = ["Straße", "ﬁn-de/siècle (x)", "İx", "A_B  c", None, "", "Ⅳ (a) (b)"]
    out = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i int, t string").orderBy("i").select(text.normalize(F.col("t"))).collect()]
    assert out == [None if t is None else text.normalize_text(t) for t in odd]
    assert [r[0] for r in spark.createDataFrame([("é",), ("e",), (None,)], "t string").select(text.nfc(F.col("t"))).collect()] == ["é", "e", None]
