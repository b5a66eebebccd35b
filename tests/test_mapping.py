import hashlib

import pytest
from pyspark.sql import functions as F

from loomlex.operators import labels, lexical, mapping, review
from loomlex.sources import files
from loomlex.sources.rdfxml import local_path


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def concept(spark, field="rdfs:label", label="Landlord"):
    lab = spark.createDataFrame([("c1", label, field)], "subject string, text string, field string")
    none = spark.createDataFrame([], "subject string, text string")
    return lab, lexical.concepts_of(lab, spark.createDataFrame([("c1", "an owner of land")], "subject string, text string"), none)


def senses(spark, *items):
    return lexical.usable_senses(spark.createDataFrame([(*i, "") for i in items], "sense_id string, headword string, domain string, gloss string, domain_root string"))


@pytest.mark.parametrize(("field", "want"), [("rdfs:label", "skos:exactMatch"), ("skos:altLabel", "skos:closeMatch")])
def test_exact_needs_a_main_label(spark, field, want):
    lab, con = concept(spark, field)
    links, gaps = lexical.match(lab, con, senses(spark, ("landlord:noun:1", "Landlord", "law_government.x", "owner of land")))
    r = links.first()
    assert (r["predicate"], r["confidence"]) == (want, "1.000") and gaps.count() == 0


def test_lead_decides_exact(spark):
    lab, con = concept(spark)
    links, _ = lexical.match(lab, con, senses(spark, ("b", "landlord", "law_government", "owner"), ("a", "landlord", "law_government", "owner")))
    assert rows(links.select("sense_id", "predicate")) == [("a", "skos:closeMatch"), ("b", "skos:closeMatch")]


def test_gap_where_all_priors_are_low(spark):
    lab, con = concept(spark)
    links, gaps = lexical.match(lab, con, senses(spark, ("z", "landlord", "nature", "bird"), ("y", "landlord", "arts", "song")))
    assert links.count() == 0 and rows(gaps) == [("c1", "landlord", "y=arts; z=nature")]


def test_head_words(spark):
    lab, con = concept(spark, label="Breach of Contract")
    links, _ = lexical.match(lab, con, senses(spark, ("1", "breach", "law_government", "land"), ("2", "contract", "law_government", "land")))
    assert rows(links.select("sense_id", "predicate", "confidence")) == [("1", "skos:broadMatch", "0.800"), ("2", "skos:relatedMatch", "0.800")]


def test_rows_score_and_round_trip(spark, tmp_path):
    lab, con = concept(spark)
    links, _ = lexical.match(lab, con, senses(spark, ("landlord:noun:1", "landlord", "law_government", "owner of\tland")))
    out = lexical.mapping_rows(links, con, "c", "C:")
    header = {"mapping_set_id": "urn:m", "license": "urn:l", "curie_map": {"C": "urn:c", "OGS": "urn:s"}}
    assert files.write_mapping_set(out, str(tmp_path / "m.tsv"), header) == 1
    got, back = files.read_mapping_set(spark, str(tmp_path / "m.tsv"))
    assert got == header and back.first()["subject_id"] == "C:1" and back.first()["row"] == 1
    assert mapping.row_findings(back, r"^C:\w+$").count() == 0
    assert mapping.row_findings(back.withColumn("confidence", F.lit("0")), r"^C:\w+$").first()["code"] == "confidence"
    (tmp_path / "g.tsv").write_text("# note\nsubject_id\tobject_id\tverdict\texpected_predicate\tnote\nC:1\tOGS:landlord:noun:1\tcorrect\tskos:exactMatch\t\nC:2\tOGS:x\tcorrect\t\t\n")
    gold = files.read_gold(spark, str(tmp_path / "g.tsv"))
    mapping.check_gold(gold)
    assert rows(mapping.score(out, gold)) == [(2, 1, 1.0, 0.5, 1.0)]
    with pytest.raises(ValueError, match="twice"):
        mapping.check_gold(gold.union(gold))
    assert rows(mapping.score(out.limit(0), gold.limit(0))) == [(0, 0, None, None, None)]


def test_header_findings():
    assert ("header-missing-key", "license") in mapping.header_findings({}, {"skos": "x"}) and ("curie-map", "skos") in mapping.header_findings({}, {"skos": "x"})


def test_forbidden_tokens(spark):
    rows = spark.createDataFrame([("x OWL:sameas y",), ("own ID",), ("fine",), (None,)], "t string")
    assert [r[0] for r in rows.select(mapping.forbidden(F.col("t"), ("own id",))).collect()] == [True, True, False, False]


def test_later_comments_are_records():
    head, rest = files.split_header("# a: b\n#c: d\nx\ty\n# z\n")
    assert files.parse_header(head) == {"a": "b", "c": "d"} and rest == "x\ty\n# z\n"


def test_census(spark):
    v = spark.createDataFrame(
        [("s", "p", "", "en", None, "literal"), ("s", "p", " N/A ", None, None, "literal"), ("s", "p", "{'a': 1}", None, None, "literal"), ("s", "p", "[x]", None, None, "literal"), ("s", "p", "x", "en_US", None, "literal"), ("s", "p", "abc", "ru", None, "literal"), ("s", "p", "abc", None, None, "iri")],
        "subject string, predicate string, lexical string, language string, datatype string, object_kind string",
    )
    assert sorted(r["code"] for r in review.census(v).collect()) == ["empty_annotation", "invalid_language_tag", "script_mismatch", "sentinel_annotation", "serialized_container", "unsupported_object_kind"]
    assert review.duplicate_identities(v.union(v)).count() == 7
    assert rows(review.cardinality(v, {"p": 6})) == [("s", "p", 7)]
    assert review.census(v.limit(0)).count() == 0


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "pass", 0.9), (2, "pass", 0.5), (3, "defect", 0.1), (4, "pass", 0.9)], "record_id int, verdict string, confidence double")
    b = spark.createDataFrame([(1, "pass", 0.8), (2, "pass", 0.9), (3, "defect", 0.9)], "record_id int, verdict string, confidence double")
    states = review.reconcile(a, b, 0.7)
    assert rows(states) == [(1, "accepted"), (2, "quarantined"), (3, "defect_confirmed"), (4, "incomplete")]
    assert review.reconciliation_status(states).first()[0] == "incomplete"


def test_debt(spark):
    cols = "subject string, predicate string, lexical string, language string, datatype string"
    old = spark.createDataFrame([("s", "p", "bad", "EN", None), ("s", "p", "good", None, None)], cols)
    from loomlex.operators import changes

    h = changes.hashed(changes.delta(old.limit(0), old)).where("after.lexical = 'bad'").first()["after_hash"]
    debt = spark.createDataFrame([("d1", "s", "p", "en", None, h, "open")], "debt_id string, subject string, predicate string, language string, datatype string, current_hash string, state string")
    assert rows(review.debt_matches(debt, old)) == [("d1", 1)]
    assert rows(review.closed_debt(debt, old, old.where("lexical <> 'bad'"))) == [("d1",)]


def test_neighbours_across_ranges(spark):
    import bisect

    names = sorted({f"n{i * 37 % 1000:03d}" for i in range(150)})
    asked = [f"n{i:03d}" for i in range(0, 1000, 7)] + ["a", "z"]
    got = {r["query"]: (r["before"], r["after"]) for r in labels.neighbours(spark.createDataFrame([(q,) for q in asked], "query string"), spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    for q in asked:
        k = bisect.bisect_left(names, q)
        assert got[q] == (names[k - 1] if k else None, names[k] if k < len(names) else None)


def test_files(spark, tmp_path):
    p = tmp_path / "x.bin"
    files.publish(str(p), b"a")
    files.publish(str(p), b"a")
    with pytest.raises(FileExistsError):
        files.publish(str(p), b"b")
    files.check_pins(spark, {str(p): hashlib.sha256(b"a").hexdigest()})
    with pytest.raises(ValueError):
        files.check_pins(spark, {str(p): "0"})
    files.append_ledger(str(tmp_path / "l.json"), [{"record_id": "1", "x": 1}])
    with pytest.raises(ValueError):
        files.append_ledger(str(tmp_path / "l.json"), [{"record_id": "1", "x": 2}])
    for bad in ("http://x/y", "data:abc", "FILE:/x"):
        with pytest.raises(ValueError):
            local_path(bad)


def test_senses(spark, tmp_path):
    (tmp_path / "s.json").write_text('[{"sense_id": "a", "headword": "Law", "pos": "noun", "domain": "d", "gloss": null}, {"sense_id": "b", "headword": "law", "pos": "noun", "source": "wordnet-3.0"}]')
    s = files.read_senses(spark, str(tmp_path / "s.json"), "json")
    assert s.count() == 2 and rows(lexical.usable_senses(s).select("sense_id", "norm_headword")) == [("a", "law")]


def test_expand_controls(spark):
    s = spark.createDataFrame([("f", "en"), ("f", "de")], "family string, locale string")
    c = spark.createDataFrame([("good", "pass"), ("bad", "defect")], "id string, expected string")
    assert review.expand_controls(s, c).count() == 4
