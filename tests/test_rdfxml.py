"""The ranged scan, scans for some subjects or predicates, and the writer, against a parser that reads files whole."""

import random

import pytest

from loomlex.operators import changes, graph
from loomlex.operators.tables import OWL, RDF, RDFS, SKOS
from loomlex.sources import rdfxml, xmlranges

HEAD = """<?xml version="1.0"?>
<!DOCTYPE rdf:RDF [<!ENTITY owl "http://www.w3.org/2002/07/owl#">]>
<rdf:RDF xmlns="http://x/v#" xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns:skos="http://www.w3.org/2004/02/skos/core#" xml:base="http://x/v">
"""
NODES = [
    '<owl:Class rdf:about="#c{i}"><rdfs:label xml:lang="en">C {i}</rdfs:label><rdfs:subClassOf rdf:resource="#c{j}"/></owl:Class>',
    '<owl:Class rdf:about="http://x/v#c{i}">\n  <rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource="#p"/><owl:someValuesFrom rdf:resource="#c{j}"/></owl:Restriction></rdfs:subClassOf>\n  <skos:altLabel>a &lt;{i}&gt; &amp; b</skos:altLabel>\n</owl:Class>',
    '<rdf:Description rdf:nodeID="n{i}"><skos:definition rdf:datatype="http://www.w3.org/2001/XMLSchema#string">d{i}</skos:definition><note><![CDATA[</owl:Class>]]></note></rdf:Description>',
    '<rdf:Description rdf:about="&owl;Thing{i}"><rdf:type rdf:resource="&owl;Class"/><rdfs:seeAlso rdf:nodeID="n{j}"/></rdf:Description>',
    '<!-- <owl:Class rdf:about="#hidden{i}"/> --><owl:Class rdf:ID="id{i}"/>',
    '<owl:Class rdf:about="#u{i}"><owl:unionOf rdf:parseType="Collection"><rdf:Description rdf:about="#c{j}"/><owl:Class rdf:about="#z"/></owl:unionOf></owl:Class>',
]


def document(n, seed=1):
    r = random.Random(seed)
    return HEAD + "\n".join(r.choice(NODES).format(i=i, j=r.randrange(n)) for i in range(n)) + "\n</rdf:RDF>\n"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_the_same_triples_at_every_size_of_range(spark, tmp_path):
    text = document(60)
    (tmp_path / "g.owl").write_text(text)
    whole = rdfxml.read_rdfxml(spark, str(tmp_path / "g.owl"))
    assert rows(changes.canonical(whole)) == rows(changes.canonical(rdfxml.from_string(spark, text)))
    for size in (300, 2500):
        cut = rdfxml.scan(spark, str(tmp_path / "g.owl"), size=size)
        assert cut.rdd.getNumPartitions() == -(-(len(text) - len(HEAD) + 1) // size)
        assert rows(cut.distinct()) == rows(whole)


def test_several_files_and_odd_roots(spark, tmp_path):
    (tmp_path / "a.owl").write_text(document(20))
    (tmp_path / "b.owl").write_text(document(9, 2))
    (tmp_path / "c.owl").write_text('<owl:Class xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" rdf:about="urn:alone"/>')
    (tmp_path / "d.owl").write_text(HEAD + "</rdf:RDF>")
    (tmp_path / "e.owl").write_text('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#"/>')
    (tmp_path / "f.owl").write_bytes(document(3, 3).replace('version="1.0"', 'version="1.0" encoding="utf-16"').encode("utf-16"))
    found = [rows(rdfxml.read_rdfxml(spark, str(tmp_path), size=s)) for s in (200, 10**6)]
    assert found[0] == found[1] and ("urn:alone", "iri", RDF + "type", OWL + "Class", "iri", None, None) in found[0]


@pytest.mark.parametrize(
    "subjects, predicates",
    [(["http://x/v#c7"], None), (["http://www.w3.org/2002/07/owl#Thing3"], None), (["http://x/v#id4", "http://x/v#c7"], None), (None, [SKOS + "altLabel"]), (None, ["http://x/v#note"]), (None, [RDF + "first"]), (["http://x/v#c7"], [RDFS + "label", RDFS + "subClassOf"]), ([], None), (["http://x/v"], None), (["urn:none"], ["urn:none"])],
)
def test_scans_for_some_lose_nothing(spark, tmp_path, subjects, predicates):
    (tmp_path / "g.owl").write_text(document(80, 4))
    want = [r for r in rows(rdfxml.read_rdfxml(spark, str(tmp_path / "g.owl"))) if (subjects is None or r[0] in subjects) and (predicates is None or r[2] in predicates)]
    assert rows(rdfxml.find(spark, str(tmp_path / "g.owl"), subjects, predicates, size=3000)) == want


def test_scans_for_some_parse_fewer_elements(tmp_path):
    (tmp_path / "g.owl").write_text(document(200, 5))
    parsed = {}
    for what, options in {"all": {}, "one": {"subjects": '["http://x/v#c7"]'}, "labels": {"predicates": f'["{SKOS}altLabel"]'}}.items():
        reader = rdfxml._Reader({"path": str(tmp_path / "g.owl"), **options})
        assert sum(1 for p in reader.partitions() for _ in reader.read(p))
        parsed[what] = reader.parsed
    references = document(200, 5).count("&owl;Thing")  # elements with references of their own are always parsed
    assert parsed["all"] == 200 and parsed["one"] < references + 20 and parsed["labels"] < references + document(200, 5).count("altLabel>")


def test_written_documents_keep_every_triple(spark, tmp_path):
    odd = [
        ("urn:a?b&c<\"'>", "iri", "urn:p#q", " x\r\n\t<&>]]> é ", "literal", "en", None), ("urn:a", "iri", "urn:p/x1", "", "literal", None, "urn:d&t"), ("_:f0.12n3", "bnode", "urn:p/x1", "_:r9", "bnode", None, None), ("_:r9", "bnode", "urn:p/x1", "urn:o\n\"", "iri", None, None),
        ("_:r9", "bnode", RDFS + "label", "l", "literal", None, None), ("urn:a", "iri", RDFS + "subClassOf", "_:f0.12n3", "bnode", None, None), ("_:lone", "bnode", "urn:p/x1", "_:lone2", "bnode", None, None),
    ]
    t = spark.createDataFrame(odd, rdfxml.TRIPLES).unionByName(rdfxml.from_string(spark, document(40, 6)))
    want = rows(changes.canonical(t))
    assert rows(changes.canonical(rdfxml.from_string(spark, "\n".join(rdfxml.to_rdfxml(t))))) == want
    rdfxml.write_rdfxml(t, str(tmp_path / "out"))
    from loomlex.sources import publish

    publish.join_parts(spark, str(tmp_path / "out"), str(tmp_path / "out.owl"))
    assert rows(changes.canonical(rdfxml.read_rdfxml(spark, str(tmp_path / "out.owl"), size=900))) == want
    restriction = graph.restrictions(t)
    assert restriction.count() and rows(graph.restrictions(rdfxml.read_rdfxml(spark, str(tmp_path / "out.owl")))) == rows(restriction)
    for bad in (("urn:a", "iri", "urn:p/", "x", "literal", None, None), ("urn:a", "iri", "urn:p/x", "\x01", "literal", None, None)):
        with pytest.raises(Exception, match="no XML"):
            list(rdfxml.to_rdfxml(spark.createDataFrame([bad], rdfxml.TRIPLES)))


def test_findings_of_files(tmp_path):
    (tmp_path / "g.owl").write_text(document(3))
    assert rdfxml.findings_of_file(str(tmp_path / "g.owl")) == []
    (tmp_path / "g.owl").write_text(document(3)[:-12])
    assert [c for c, _ in rdfxml.findings_of_file(str(tmp_path / "g.owl"))] == ["malformed_xml"]
    assert xmlranges.files_of(str(tmp_path / "g.owl"))[0][1] > 0
