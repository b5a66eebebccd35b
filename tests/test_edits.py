"""Edits within RDF/XML files: what they say afterwards against the same changes of the triples, and which lines differ."""

import difflib
import random
import time

import pytest
from pyspark.sql import functions as F

from loomlex.operators import changes, graph
from loomlex.operators.tables import OWL, RDFS, SKOS, TRIPLES, XSD, stored
from loomlex.sources import edits, rdfxml, xmlranges

HEAD = """<?xml version="1.0"?>
<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns:skos="http://www.w3.org/2004/02/skos/core#">
<!-- </rdf:RDF> -->
"""
TAIL = "\n</rdf:RDF>\n<!-- </rdf:RDF> -->\n"


def cls(name, *lines):
    return f'<owl:Class rdf:about="urn:{name}">\n' + "".join(f"  {line}\n" for line in lines) + "</owl:Class>"


def change(spark, tmp_path, text, removed, added, size=1 << 25):
    (tmp_path / "in.owl").write_bytes(text.encode())
    done, unmatched = edits.change(spark, str(tmp_path / "in.owl"), str(tmp_path / "out.owl"), spark.createDataFrame(removed, TRIPLES), spark.createDataFrame(added, TRIPLES), size=size)
    return (tmp_path / "out.owl").read_bytes().decode(), {r.kind: r.n for r in done.collect()}, unmatched.count()


def t(s, p, o, language=None, datatype=None, kind="literal"):
    return (f"urn:{s}", "iri", p, o, kind, language, datatype)


DEF, ALT = SKOS + "definition", SKOS + "altLabel"


@pytest.mark.parametrize("attributes, language, datatype", [("", None, None), (f' rdf:datatype="{XSD}string"', None, XSD + "string"), (' xml:lang="en"', "en", None), (" rdf:datatype='urn:t'", None, "urn:t")])
def test_a_replaced_text_keeps_its_attributes(spark, tmp_path, attributes, language, datatype):
    line = f"<skos:definition{attributes}>Stale &amp; old</skos:definition>"
    text = HEAD + cls("a", "<rdfs:label>A</rdfs:label>", line) + TAIL
    out, told, unmatched = change(spark, tmp_path, text, [t("a", DEF, "Stale & old", language, datatype)], [t("a", DEF, "New <& fine", language, datatype)])
    assert out == text.replace("Stale &amp; old", "New &lt;&amp; fine") and told == {"replace": 1} and unmatched == 0


def test_only_edited_lines_differ(spark, tmp_path):
    text = HEAD + cls("a", "<skos:altLabel>x</skos:altLabel>", '<skos:altLabel xml:lang="en">x</skos:altLabel>', '<skos:definition rdf:resource="urn:video"/>', "<skos:definition>kept</skos:definition>") + "\n<!-- c -->" + cls("b") + '<owl:Class rdf:about="urn:c"/>\n' + cls("d", "<rdfs:label>D</rdfs:label> <skos:altLabel>same line</skos:altLabel>") + "<owl:Class rdf:about='urn:e'><rdfs:label>E</rdfs:label></owl:Class>" + TAIL
    removed = [t("a", ALT, "x", "en"), t("d", ALT, "same line"), t("a", ALT, "absent")]
    added = [t("a", ALT, "y"), t("a", ALT, "z", "de"), t("b", ALT, "b1"), t("c", ALT, "c1"), t("e", ALT, "e1"), t("new", "urn:own/p", "v", None, "urn:t"), t("e", RDFS + "subClassOf", "urn:a", kind="iri")]
    out, told, unmatched = change(spark, tmp_path, text, removed, added)
    assert told == {"remove": 2, "insert": 6, "node": 1} and unmatched == 1
    moved = [x for x in difflib.ndiff(text.splitlines(), out.splitlines()) if x[0] in "+-"]
    assert sorted(moved) == sorted([
        '-   <skos:altLabel xml:lang="en">x</skos:altLabel>', "+   <skos:altLabel>y</skos:altLabel>", '+   <skos:altLabel xml:lang="de">z</skos:altLabel>',
        '- </owl:Class><owl:Class rdf:about="urn:c"/>', "+     <skos:altLabel>b1</skos:altLabel>", '+ </owl:Class><owl:Class rdf:about="urn:c">', "+     <skos:altLabel>c1</skos:altLabel>", "+ </owl:Class>",
        "-   <rdfs:label>D</rdfs:label> <skos:altLabel>same line</skos:altLabel>", "+   <rdfs:label>D</rdfs:label> ",
        "- </owl:Class><owl:Class rdf:about='urn:e'><rdfs:label>E</rdfs:label></owl:Class>", "+ </owl:Class><owl:Class rdf:about='urn:e'><rdfs:label>E</rdfs:label><rdfs:subClassOf rdf:resource=\"urn:a\"/><skos:altLabel>e1</skos:altLabel></owl:Class>",
        '+ <rdf:Description rdf:about="urn:new">', '+     <n0:p xmlns:n0="urn:own/" rdf:datatype="urn:t">v</n0:p>', "+ </rdf:Description>",
    ])


def test_nothing_to_change(spark, tmp_path):
    for text in (HEAD + cls("a", "<rdfs:label>A</rdfs:label>") + TAIL, HEAD + TAIL):
        out, told, _ = change(spark, tmp_path, text, [], [])
        assert out == text and told == {}


@pytest.mark.parametrize("seed, size", [(1, 1 << 25), (2, 700)])
def test_random_changes_give_the_same_triples(spark, tmp_path, seed, size):
    r = random.Random(seed)
    nodes = []
    for i in range(60):
        own = [f"<skos:altLabel{r.choice(['', ' xml:lang=\"en\"'])}>l{r.randrange(3)}</skos:altLabel>" for _ in range(r.randint(0, 3))] + ["<rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource='urn:p'/></owl:Restriction></rdfs:subClassOf>"] * (r.random() < 0.4)
        nodes.append(cls(f"c{i}", *own) if r.random() < 0.7 else f'<owl:Class rdf:about="urn:c{i}">' + "".join(own) + "</owl:Class>" if own else f'<owl:Class rdf:about="urn:c{i}"/>')
    text = HEAD + "\n".join(nodes) + TAIL
    (tmp_path / "in.owl").write_text(text)
    before = stored(rdfxml.read_rdfxml(spark, str(tmp_path / "in.owl")), "triples")
    stated = [tuple(x) for x in before.where("subject_kind = 'iri' AND predicate <> 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type'").collect()]
    removed = r.sample(sorted(stated, key=repr), 15)
    added = list({t(f"c{r.randrange(70)}", r.choice([ALT, DEF]), f"n{r.randrange(40)}", r.choice([None, "en"])) for _ in range(30)})
    nested = {x[3] for x in removed if x[4] == "bnode"}
    added += [(f"urn:c{k}", "iri", RDFS + "subClassOf", f"_:o{k}", "bnode", None, None) for k in range(3)] + [(f"_:o{k}", "bnode", OWL + "onProperty", "urn:q", "iri", None, None) for k in range(3)]
    out, _, unmatched = change(spark, tmp_path, text, removed, added, size)
    assert unmatched == 0
    (tmp_path / "again.owl").write_text(out)
    left = before.where(~F.col("subject").isin([""] + sorted(nested))).exceptAll(spark.createDataFrame(removed, TRIPLES).distinct())
    want = changes.canonical(left.union(spark.createDataFrame(added, TRIPLES)).distinct())
    got = changes.canonical(rdfxml.read_rdfxml(spark, str(tmp_path / "again.owl")))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_merge_into_several_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    restriction = "<rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource='urn:p'/><owl:someValuesFrom rdf:resource='urn:{}'/></owl:Restriction></rdfs:subClassOf>"
    (tmp_path / "in" / "a.owl").write_text(HEAD + cls("a", "<skos:altLabel>old</skos:altLabel>", restriction.format("a"), "<skos:definition>was</skos:definition>") + TAIL)
    (tmp_path / "in" / "b.owl").write_text(HEAD + cls("b", "<rdfs:label>rel:B</rdfs:label>") + TAIL)
    (tmp_path / "ours.owl").write_text(HEAD + cls("a", "<skos:altLabel>new</skos:altLabel>", restriction.format("b"), "<skos:definition>is</skos:definition>") + cls("b", "<rdfs:label>B</rdfs:label>", "<skos:notation>rel:B</skos:notation>") + cls("c", restriction.format("a"), "<rdfs:label>C</rdfs:label>") + TAIL)
    ours, theirs = (stored(rdfxml.read_rdfxml(spark, str(tmp_path / x)), "triples") for x in ("ours.owl", "in"))
    want = changes.apply_merge(ours, theirs, changes.merge_diff(ours, theirs, "rel:"))
    _, unmatched = edits.merge(spark, str(tmp_path / "in"), str(tmp_path / "out"), ours, "rel:")
    got, want = stored(rdfxml.read_rdfxml(spark, str(tmp_path / "out")), "triples"), stored(want, "triples")
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert unmatched.count() == 0 and rows(changes.canonical(got)) == rows(changes.canonical(want))
    assert rows(graph.restrictions(got)) == rows(graph.restrictions(want)) and graph.restrictions(got).count() == 3
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.suffix == ".owl") == ["a.owl", "b.owl"]


def test_a_file_is_written_by_pieces_as_it_is_whole(spark, tmp_path):
    """Cut at every few children of the root: the same bytes, no two pieces for one child, and nothing left beside the file."""
    text = HEAD + "\n".join(cls(f"c{i}", f"<skos:altLabel>l{i}</skos:altLabel>", f"<skos:definition>d{i}</skos:definition>") if i % 5 else f'<owl:Class rdf:about="urn:c{i}"/><!-- c -->' for i in range(40)) + TAIL
    removed = [t(f"c{i}", ALT, f"l{i}") for i in range(0, 40, 3) if i % 5] + [t("c39", DEF, "d39"), t("c1", DEF, "d1")]
    added = [t(f"c{i}", ALT, "more", "en") for i in range(0, 40, 4)] + [t("c1", DEF, "new"), t("fresh", DEF, "x"), t("fresh", ALT, "y")]
    whole, told, _ = change(spark, tmp_path, text, removed, added)
    for size in (90, 400):
        assert change(spark, tmp_path, text, removed, added, size)[:2] == (whole, told)
        found = stored(edits.index(spark, str(tmp_path / "in.owl"), size=size), "xml-index")
        files = spark.createDataFrame([(str(tmp_path / "in.owl"),)], "file string")
        pieces = sorted(map(tuple, edits._pieces(found, files, size).collect()))
        starts = {r.block_start for r in found.select("block_start").distinct().collect()}
        assert len(pieces) > 5 and pieces[0][2] == 0 and pieces[-1][3] is None
        assert all(a[3] == b[2] and b[2] in starts for a, b in zip(pieces, pieces[1:], strict=False))
    assert sorted(p.name for p in tmp_path.iterdir() if p.suffix != ".crc") == ["in.owl", "out.owl"]


def test_a_publication_is_one_document_and_stays_one(spark, tmp_path):
    """Its parts are read, and edited, as the file that they are one after the other; nothing is written twice."""
    from loomlex.sources import publish

    triples = spark.createDataFrame([(f"urn:s{i:03d}", "iri", f"urn:p/{'ab'[i % 2]}", f"value {i} <&>", "literal", None, None) for i in range(300)], TRIPLES)
    removed, added = triples.where("subject LIKE '%7'"), triples.where("subject LIKE '%3'").withColumn("predicate", F.lit("urn:q/new"))
    at = str(tmp_path / "parts")
    rdfxml.write_rdfxml(triples.repartition(3), at)
    publish.join_parts(spark, at, str(tmp_path / "one.owl"))
    text = (tmp_path / "one.owl").read_bytes()
    assert b"xmlns" not in text[text.index(b"\n<rdf:Description") :] and text.count(b"urn:p/") == 1
    fs, file = xmlranges.filesystem(at)
    with xmlranges.opened(fs, file) as f:
        assert xmlranges.files_of(at) == [(file, len(text))] and f.read() == text
        for a, n in ((0, 10), (len(text) - 5, 90), (400, 4000), (len(text), 1)):
            f.seek(a)
            assert f.read(n) == text[a : a + n]
    assert sorted(map(tuple, rdfxml.read_rdfxml(spark, at, size=700).collect())) == sorted(map(tuple, triples.collect()))
    for source, to in ((at, tmp_path / "new"), (str(tmp_path / "one.owl"), tmp_path / "new.owl")):
        edits.change(spark, source, str(to), removed, added, size=900)
    publish.join_parts(spark, str(tmp_path / "new"), str(tmp_path / "joined.owl"))
    assert (tmp_path / "joined.owl").read_bytes() == (tmp_path / "new.owl").read_bytes()
    assert len(publish.read_manifest(str(tmp_path / "new"))["parts"]) > 3 and not list(tmp_path.glob("_*"))
    with pytest.raises(FileExistsError):
        edits.change(spark, at, str(tmp_path / "new"), removed, added)


def test_what_is_stored_leaves_no_shuffle_files(spark):
    """They lay on the executors' disks until the driver collected garbage, and were more than all documents."""
    held = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    shuffles = lambda: sum("shuffle_" in str(held().apply(i).getName()) for i in range(held().size()))
    before = shuffles()
    stored(spark.range(1000).repartition(7, "id"), "swept")
    end = time.time() + 20  # files go shortly after the write
    while shuffles() > before and time.time() < end:
        time.sleep(0.2)
    assert shuffles() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
