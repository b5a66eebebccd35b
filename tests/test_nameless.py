"""Names of nameless nodes: equal for relabelled copies, different for graphs that no relabelling makes equal."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from loomlex.operators import changes, nameless
from loomlex.operators.tables import TRIPLES


def triples(edges, name="_:{}", more=()):
    """edges (node, predicate, node) of numbers."""
    out = [(name.format(a), "bnode", p, name.format(b), "bnode", None, None) for a, p, b in edges]
    return out + [tuple(name.format(x) if isinstance(x, int) else x for x in r) for r in more]


def canonical(spark, rows):
    return {tuple(r) for r in changes.canonical(spark.createDataFrame(rows, TRIPLES)).collect()}


def relabelled(rows, seed):
    r = random.Random(seed)
    nodes = sorted({x for t in rows for x, k in ((t[0], t[1]), (t[3], t[4])) if k == "bnode"})
    to = dict(zip(nodes, (f"_:z{i}" for i in r.sample(range(1000), len(nodes))), strict=True))
    out = [(to.get(t[0], t[0]), t[1], t[2], to.get(t[3], t[3]), *t[4:]) for t in rows]
    r.shuffle(out)
    return out


def ring(n, start=0, p="p"):
    return [(start + i, p, start + (i + 1) % n) for i in range(n)]


HANG = [("urn:s", "iri", "urn:q", 0, "bnode", None, None)]
GRAPHS = {
    "ring of 6": triples(ring(6)), "two rings of 3": triples(ring(3) + ring(3, 3)), "ring of 6 held": triples(ring(6), more=HANG), "ring of 7 held twice": triples(ring(7), more=[*HANG, ("urn:s", "iri", "urn:q", 3, "bnode", None, None)]),
    "ring of 7 held twice closer": triples(ring(7), more=[*HANG, ("urn:s", "iri", "urn:q", 2, "bnode", None, None)]), "self": triples([(0, "p", 0)]), "two selves": triples([(0, "p", 0), (1, "p", 1), (0, "q", 1)]),
    "tail into a ring": triples([*ring(3), (5, "t", 0), (6, "t", 5)], more=[(6, "bnode", "urn:l", "x", "literal", "en", None)]), "clique": triples([(a, "p", b) for a, b in itertools.permutations(range(5), 2)]),
    "prism": triples([*ring(3), *ring(3, 3), *((i, "p", i + 3) for i in range(3))]), "cube": triples([(a, "p", a ^ 1 << k) for a in range(8) for k in range(3)]), "two squares crossed": triples([(a, "p", b) for a in range(4) for b in range(4, 8)] + [(b, "p", a) for a in range(4) for b in range(4, 8)]),
    "tree": triples([(0, "p", 1), (0, "p", 2)], more=[(1, "bnode", "urn:l", "a", "literal", None, None), (2, "bnode", "urn:l", "b", "literal", None, None)]), "labelled ring": triples(ring(4), more=[(2, "bnode", "urn:l", "a", "literal", None, None)]),
    "ring of two kinds": triples([(0, "p", 1), (1, "q", 2), (2, "p", 3), (3, "q", 0)]),
}


@pytest.fixture(scope="module")
def forms(spark):
    """All graphs and a relabelled copy of each are named in one go: their nodes differ, so that they share no part."""
    out = {}
    for k, (name, rows) in enumerate(GRAPHS.items()):
        for copy, found in enumerate((rows, relabelled(rows, k))):
            out[name, copy] = [tuple(f"{x}.{k}.{copy}" if isinstance(x, str) and x.startswith("_:") else x for x in t) for t in found]
    every = spark.createDataFrame([t for rows in out.values() for t in rows], TRIPLES)
    names = {r.node: r.hash for r in nameless.names(every).collect()}
    return {key: sorted({(names.get(t[0], t[0]), t[2], names.get(t[3], t[3]), t[5]) for t in rows}, key=repr) for key, rows in out.items()}


def test_copies_are_equal_and_others_are_not(forms):
    for a, b in itertools.combinations(GRAPHS, 2):
        assert forms[a, 0] != forms[b, 0], (a, b)
    for name in GRAPHS:
        assert forms[name, 0] == forms[name, 1], name


def brute(n, edges):
    """The least form over all orders of nodes."""
    return min(tuple(sorted((p[a], e, p[b]) for a, e, b in edges)) for p in itertools.permutations(range(n)))


@pytest.mark.parametrize("seed", range(5))
def test_numberings_against_all_orders(seed):
    """Two graphs have one form if and only if one of all orders makes them equal."""
    r = random.Random(seed)
    found = {}
    for _ in range(60):
        n = r.randint(1, 6)
        edges = sorted({(r.randrange(n), r.choice("ab"[: r.randint(1, 2)]), r.randrange(n)) for _ in range(r.randint(0, 10))})
        form = nameless.least_numbering([""] * n, edges)[1]
        assert found.setdefault((n, brute(n, edges)), form) == form
        order = r.sample(range(n), n)
        assert nameless.least_numbering([""] * n, [(order[a], p, order[b]) for a, p, b in edges])[1] == form
    assert len(set(found.values())) == len(found)


def test_alike_nodes_are_not_tried_in_every_order():
    start = time.process_time()
    nameless.least_numbering([""] * 24, [(a, "p", b) for a, b in itertools.permutations(range(24), 2)])
    nameless.least_numbering([""] * 120, ring(120))
    assert time.process_time() - start < 30


def test_differences_through_circles(spark):
    old = triples(ring(3), more=[*HANG, (1, "bnode", "urn:l", "a", "literal", None, None)])
    new = relabelled(old, 5)
    assert canonical(spark, old) == canonical(spark, new)
    other = [(*t[:3], "b", *t[4:]) if t[3] == "a" else t for t in new]
    assert not canonical(spark, other) & {t for t in canonical(spark, old) if t[1] == "bnode"}


def test_odd_inputs(spark):
    df = spark.createDataFrame(triples(ring(3)) * 2, TRIPLES).withColumn("node", F.lit("clash"))
    assert changes.canonical(df.drop("node")).count() == 3 and nameless.names(df).count() == 3
    assert nameless.names(df.limit(0)).count() == 0
    dangling = spark.createDataFrame([("urn:s", "iri", "urn:p", "_:x", "bnode", None, None)], TRIPLES)
    assert nameless.names(dangling).count() == 1
    with pytest.raises(Exception, match="alike nodes"):
        nameless.names(df.drop("node"), most=2).count()


def test_a_long_ring_is_numbered_in_steps_not_rounds():
    """One node that differs in 4,000: each split moves a node or two, where rounds over all of them are 2,000."""
    start = time.process_time()
    numbers, _ = nameless.least_numbering(["x"] + [""] * 3999, ring(4000))
    assert sorted(numbers) == list(range(4000)) and time.process_time() - start < 10


def test_a_part_is_named_whatever_else_the_graph_holds(spark):
    """A short ring keeps its names beside one that takes many rounds, numbered by a task or coloured by rounds."""
    short = triples(ring(3), more=[*HANG, (1, "bnode", "urn:l", "a", "literal", None, None)])
    long = triples(ring(9), name="_:y{}", more=[(0, "bnode", "urn:l", "b", "literal", None, None)])
    for most in (nameless.PART_NODES, 2):
        alone, beside = ({r.node: r.hash for r in nameless.names(spark.createDataFrame(rows, TRIPLES), most=most).collect()} for rows in (short, short + long))
        assert len(set(beside.values())) == 12 and all(beside[k] == v for k, v in alone.items())


def test_only_nameless_nodes_meet_their_names(spark):
    """Values that many triples share are joined with nothing, and rows are dealt before they are made distinct."""
    from loomlex.operators import changes
    from loomlex.operators.tables import TRIPLES

    rows = [(f"_:b{i}", "bnode", "urn:p", "urn:same", "iri", None, None) for i in range(9)] + [(f"urn:{i}", "iri", "urn:q", f"_:b{i}", "bnode", None, None) for i in range(9)] + [("urn:x", "iri", "urn:q", "_:b1", "literal", None, None), ("urn:x", None, "urn:q", None, None, None, None)]
    found = changes.canonical(spark.createDataFrame(rows, TRIPLES))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and plan.count("= bnode)") >= plan.count("Join LeftOuter") > 0
    got = found.collect()
    assert len(got) == 12 and {r.object for r in got if r.object_kind != "bnode"} == {"urn:same", "_:b1", None} and len({r.subject for r in got if r.subject_kind == "bnode"}) == 1
