from loomlex.operators import changes, graph
from loomlex.operators.tables import OWL, SKOS
from loomlex.sources import rdfxml

HEAD = '<?xml version="1.0"?><!DOCTYPE rdf:RDF [<!ENTITY xsd "http://www.w3.org/2001/XMLSchema#">]><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns:skos="http://www.w3.org/2004/02/skos/core#">'
GRAPH = HEAD + """
<owl:Class rdf:about="urn:a"><rdfs:label>A</rdfs:label><rdfs:subClassOf rdf:resource="http://www.w3.org/2002/07/owl#Thing"/></owl:Class>
<owl:Class rdf:about="urn:b"><rdfs:label xml:lang="en">B</rdfs:label><skos:altLabel xml:lang="fr">Bé</skos:altLabel><rdfs:subClassOf rdf:resource="urn:a"/><skos:definition> </skos:definition>
  <rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource="urn:p"/><owl:someValuesFrom rdf:resource="urn:a"/></owl:Restriction></rdfs:subClassOf></owl:Class>
<owl:Class rdf:about="urn:c"><rdfs:subClassOf rdf:resource="urn:b"/><rdfs:subClassOf rdf:resource="urn:c"/><owl:deprecated rdf:datatype="&xsd;boolean"> TRUE </owl:deprecated></owl:Class>
<owl:Class rdf:about="urn:d"><rdfs:subClassOf rdf:resource="urn:e"/><rdfs:label>D</rdfs:label></owl:Class>
<owl:Class rdf:about="urn:e"><rdfs:subClassOf rdf:resource="urn:d"/><rdfs:subClassOf rdf:resource="urn:b"/></owl:Class>
</rdf:RDF>"""


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_reader_and_summary(spark, tmp_path):
    (tmp_path / "g.owl").write_text(GRAPH)
    t = rdfxml.read_rdfxml(spark, str(tmp_path / "g.owl"))
    assert rows(graph.graph_summary(t)) == rows(graph.graph_summary(rdfxml.from_string(spark, GRAPH)))
    assert rows(graph.classes(t)) == [("urn:a",), ("urn:b",), ("urn:c",), ("urn:d",), ("urn:e",)]
    assert rows(graph.active_classes(t)) == [("urn:a",), ("urn:b",), ("urn:d",), ("urn:e",)]
    assert t.where("object = ' ' AND object_kind = 'literal'").count() == 1  # white space is a value
    assert rows(graph.restrictions(t)) == [("urn:b", "urn:p", OWL + "someValuesFrom", "urn:a", "iri")]


def test_branches_survive_cycles(spark):
    t = rdfxml.from_string(spark, GRAPH)
    got = {r["subject"]: r["branches"] for r in graph.branches(graph.edges(t), graph.active_classes(t)).collect()}
    assert got == {"urn:a": ["urn:a"], "urn:b": ["urn:a"], "urn:d": ["urn:a"], "urn:e": ["urn:a"]}


def test_closure_of_cycles_and_nothing(spark):
    e = spark.createDataFrame([("x", "y"), ("y", "x"), ("z", "z"), (None, "x")], "child string, parent string")
    assert rows(graph.closure(e)) == [("x", "x"), ("x", "y"), ("y", "x"), ("y", "y"), ("z", "z")]
    assert graph.closure(e.limit(0)).count() == 0


def test_inspect_and_label_choice(spark):
    t = rdfxml.from_string(spark, GRAPH)
    near = graph.inspect(t, "urn:b")["neighbours"]
    assert rows(near) == [("child", "urn:c", True), ("child", "urn:e", False), ("parent", "urn:a", False)]
    assert ("urn:b", "B") in rows(graph.label_choice(graph.labels(t)))


def test_class_query_bounds_and_missing_parent(spark):
    t = rdfxml.from_string(spark, GRAPH)
    lab = graph.labels(t).where("field = 'rdfs:label'").selectExpr("subject", "text AS label")
    flags = t.where("predicate LIKE '%deprecated'").selectExpr("subject", "object AS deprecated")
    q = lambda p=None: graph.class_query(graph.classes(t), lab, flags, graph.edges(t), p)
    assert q().count() == 5 and q("urn:none").count() == 0 and [r[0] for r in q("urn:b").collect()] == ["urn:c", "urn:e"]


def test_delta_classifies(spark):
    schema = "subject string, predicate string, lexical string, language string, datatype string"
    old = spark.createDataFrame([("s", "p", "x", "en", None), ("s", "p", "gone", None, None), ("s", "q", "old", "fr", None), ("s", "r", "same", None, None)], schema)
    new = spark.createDataFrame([("s", "p", "x", "en-US", None), ("s", "q", "new", "fr", None), ("s", "r", "same", None, None), ("t", "p", "more", None, None)], schema)
    d = changes.delta(old, new)
    assert sorted(r["change"] for r in d.collect()) == ["added", "removed", "replaced", "retagged"]
    ids = [r["record_id"] for r in changes.hashed(d).collect()]
    assert len(set(ids)) == 4
    assert changes.same(changes.apply_changes(old, d), new)
    assert changes.delta(old, old).count() == 0
    assert {r["n"] for r in changes.fidelity(old, new, d).collect()} == {0}


def test_nameless_nodes_compare_by_content(spark):
    a = rdfxml.from_string(spark, GRAPH)
    b = rdfxml.from_string(spark, GRAPH.replace("</owl:Class>\n<owl:Class", "</owl:Class><owl:Class"), "")
    renamed = b.replace({"_:n1": "_:other"}, subset=["subject", "object"])
    assert changes.same(changes.canonical(a), changes.canonical(renamed))


def test_merge_diff(spark):
    ours = HEAD + '<owl:Class rdf:about="urn:x"><rdfs:label>X</rdfs:label><skos:altLabel>new</skos:altLabel><skos:definition>d1</skos:definition></owl:Class><owl:Class rdf:about="urn:y"/></rdf:RDF>'
    theirs = HEAD + '<owl:Class rdf:about="urn:x"><rdfs:label>X</rdfs:label><skos:altLabel>old</skos:altLabel><skos:altLabel>X</skos:altLabel><skos:definition>d0</skos:definition></owl:Class></rdf:RDF>'
    parts = changes.merge_diff(rdfxml.from_string(spark, ours), rdfxml.from_string(spark, theirs))
    n = {r["kind"]: r["n"] for r in changes.merge_summary(parts).collect()}
    assert n["new_classes"] == 1 and n["new_alt_labels"] == 1 and n["definition_updates"] == 1 and n["definition_additions"] == 0
    assert [r["object"] for r in parts["removed_labels"].collect()] == ["old"]
    assert SKOS in parts["new_alt_labels"].first()["predicate"]


def test_sets_are_compared_by_digests_of_rows(spark):
    """Nulls, empty texts and cells that run together are told apart; keyed texts are as long as a digest."""
    rows = lambda *r: spark.createDataFrame(r, ", ".join(f"{c} string" for c in changes.VALUE))
    a = rows(("s", "p", "x" * 1000, None, None), ("s", "p", "ab", "c", None))
    assert changes.same(a, a.union(a)) and changes.same(changes.keyed(a), changes.keyed(a.union(a)))
    for other in (("s", "p", "a", "bc", None), ("s", "p", "ab", None, "c"), ("s", "p", "ab", "c", ""), ("s", "p", None, "c", None)):
        assert not changes.same(a, rows(("s", "p", "x" * 1000, None, None), other)) and not changes.same(changes.keyed(a), changes.keyed(rows(("s", "p", "x" * 1000, None, None), other)))
    assert {len(r.lexical) for r in changes.keyed(a).collect()} == {64}
