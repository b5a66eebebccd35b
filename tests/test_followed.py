"""What follows a change against the same from scratch: closures, branches, links, and links driven by a stream."""

import random

import pytest
from pyspark.sql import functions as F

from loomlex.operators import graph, lexical
from loomlex.operators.tables import OWL, stored
from loomlex.streaming.links import CHANGE, Follower

PRIORS = {"legal": {"a": 1.0, "other": 0.3}}


def closed(edges):
    up = {}
    for c, p in edges:
        up.setdefault(c, set()).add(p)
    out = set()
    for c in up:
        seen, todo = set(), list(up[c])
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += up.get(x, ())
        out |= {(c, x) for x in seen}
    return out


@pytest.mark.parametrize("seed", range(3))
def test_closure_after_changes_of_edges(spark, seed):
    """Removals, additions and circles, in one batch of many small graphs whose nodes differ."""
    r = random.Random(seed)
    before, gone, new, want, pairs = [], [], [], set(), set()
    for g in range(12):
        n = r.randint(2, 7)
        some = lambda k: [(f"{g}.{r.randrange(n)}", f"{g}.{r.randrange(n)}") for _ in range(k)]  # noqa: B023, E731
        e = set(some(r.randint(1, 9)))
        out, more = set(r.sample(sorted(e), r.randint(0, min(3, len(e)))) + some(1)), set(some(r.randint(0, 3)))
        before, gone, new = before + sorted(e), gone + sorted(out), new + sorted(more)
        want |= closed(e - out | more)
        pairs |= closed(e)
    make = lambda rows, names="child string, parent string": spark.createDataFrame(sorted(rows), names)
    got = graph.closure_after(make(pairs, "node string, ancestor string"), make(before), make(gone), make(new))
    rows = [tuple(x) for x in got.select("node", "ancestor").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_branches_with_many_bits_and_circles(spark):
    r = random.Random(3)
    edges = [(f"b{i}", OWL + "Thing") for i in range(150)] + [(f"c{i}", r.choice([f"b{r.randrange(150)}", f"c{r.randrange(80)}", "b3"])) for i in range(80) for _ in range(2)] + [("b1", "b2"), ("b2", "b1"), ("c0", "c0")]
    active = [f"b{i}" for i in range(150) if i != 5] + [f"c{i}" for i in range(80) if i % 9]
    got = {x.subject: x.branches for x in graph.branches(spark.createDataFrame(edges, "child string, parent string"), spark.createDataFrame([(a,) for a in active], "subject string")).collect()}
    inner = [(c, p) for c, p in edges if c in active and p in active]
    up = closed(inner) | {(a, a) for a in active}
    tops = {c for c, p in edges if p == OWL + "Thing" and c in active}
    assert got == {a: sorted({x for c, x in up if c == a and x in tops}) for a in active}


def tables(spark, texts, glosses):
    labels = spark.createDataFrame([(s, x, f) for s, x, f in texts], "subject string, text string, field string")
    senses = spark.createDataFrame([(f"{h}.{k}", h, "a", "", g) for h, k, g in glosses], "sense_id string, headword string, domain string, domain_root string, gloss string")
    return labels, lexical.usable_senses(senses, ascii_only=True)


def concepts(labels):
    return lexical.concepts_of(labels, labels.select("subject", "text"), labels.select("subject", "text").limit(0), profiles=F.array(F.lit("legal")), ascii_only=True)


WORDS = "court order sale plan lease claim".split()


def links(df):
    return sorted(tuple(x) for x in df.select("subject", "sense_id", "predicate", "form", "field", F.round("score", 9)).collect())


def test_refreshed_links_equal_links_from_scratch(spark):
    r = random.Random(1)
    texts = {(f"s{i}", " ".join(r.sample(WORDS, r.randint(1, 3))), r.choice(lexical.FIELDS)) for i in range(60) for _ in range(2)}
    glosses = {(w, k, " ".join(r.sample(WORDS, 3))) for w in WORDS for k in range(2)}
    held = lexical.linked(*(lambda x: (x[0], concepts(x[0]), x[1]))(tables(spark, texts, glosses)), PRIORS, True)
    for step in range(2):
        changed, before = r.sample(sorted(texts), 3), texts
        texts = texts - set(changed) | {(s, r.choice(WORDS), f) for s, _, f in changed} | {(f"new{step}", "court plan", "rdfs:label")}
        word = WORDS[step]
        glosses = {g for g in glosses if g[0] != word} | {(word, 0, f"{word} of all"), (word, 5, "other")} if step else glosses
        labels, senses = tables(spark, texts, glosses)
        held, touched = lexical.refresh(held, labels, concepts(labels), senses, PRIORS, True)
        assert links(held.links) == links(lexical.linked(labels, concepts(labels), senses, PRIORS, True).links)
        near = {s for s, x, _ in texts if step and word in x.split()} | {s for s, _, _ in before ^ texts}
        assert {x.subject for x in touched.collect()} == near


def test_a_stream_of_changes_is_followed_once(spark, tmp_path):
    texts = {(f"s{i}", f"{WORDS[i % 6]} {WORDS[(i + 1) % 6]}", "rdfs:label") for i in range(30)}
    labels, senses = tables(spark, texts, {(w, 0, w) for w in WORDS})
    follow = Follower(spark, f"file://{tmp_path}/state", concepts, PRIORS, True)
    follow.start(labels, senses)
    assert follow.pointer()["touched"] == 30
    changes = [(1, "remove", "s1", "order sale", "rdfs:label"), (2, "add", "s1", "sale", "rdfs:label"), (3, "add", "x", "gone", "rdfs:label"), (4, "remove", "x", "gone", "rdfs:label"), (5, "add", "s2", "claim", "skos:altLabel")]
    for k, rows in enumerate((changes[:3], changes[3:])):
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = lambda: spark.readStream.schema(CHANGE).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    follow.run(stream(), str(tmp_path / "check"))
    done = follow.pointer()
    assert done["batch"] == 2 and done["touched"] == 2
    want, _ = tables(spark, texts - {("s1", "order sale", "rdfs:label")} | {("s1", "sale", "rdfs:label"), ("s2", "claim", "skos:altLabel")}, [("a", 0, "a")])
    assert links(follow.state().links) == links(lexical.linked(want, concepts(want), senses, PRIORS, True).links)
    again = Follower(spark, f"file://{tmp_path}/state", concepts, PRIORS, True)
    again.start(labels, senses)
    again.run(stream(), str(tmp_path / "check"))  # nothing new
    again.take(spark.createDataFrame(changes[:3], CHANGE), 0)  # handed over once more
    assert again.pointer() == done


def test_links_are_emitted_without_a_sort_of_their_own(spark):
    """The first sense's score comes with the ranks, and what no rule takes is left out before the join: one window alone."""
    labels, senses = tables(spark, {(f"s{i}", f"{WORDS[i % 6]} {WORDS[(i + 1) % 6]}", "rdfs:label") for i in range(30)}, {(w, k, f"{w} {k}") for w in WORDS for k in range(3)})
    looked = lexical.lookups(lexical.surface_forms(labels, True))
    ranks = lexical.ranked(looked, concepts(labels), senses, PRIORS)
    assert {(r.top, r.score) for r in ranks.where("rank = 1").collect()} and not ranks.where("rank = 1 AND top <> score OR top < score").count()
    found = lexical.emissions(looked, ranks)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() and plan.count("Window [") == 1


def test_no_table_of_subjects_is_broadcast_or_made_twice(spark):
    """Files of names that repeat are small and their rows many: by the files' size alone each executor would hold them all."""
    labels, senses = tables(spark, {(f"s{i}", f"{WORDS[i % 6]} {WORDS[(i + 1) % 6]}", "rdfs:label") for i in range(30)}, {(w, k, f"{w} {k}") for w in WORDS for k in range(3)})
    labels, held = stored(labels, "labels"), stored(concepts(labels), "concepts")
    told = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in told(lexical.lookups(lexical.surface_forms(labels, True)))
    assert "Join" not in told(lexical._moved(held, held))
    looked = lexical.lookups(lexical.surface_forms(labels, True))
    plan = told(lexical.ranked(looked, held, stored(senses, "senses"), PRIORS))
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1  # senses alone
    some = stored(labels.select("subject").distinct(), "some")
    for how in ("left_semi", "left_anti"):
        plan = told(lexical._of(labels, some, how))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_moved_rows_are_those_of_one_side(spark):
    make = lambda *rows: spark.createDataFrame(rows, "subject string, context array<string>, label string")
    old = make(("a", ["x", "y"], None), ("b", ["x"], "l"), ("c", None, "l"), ("d", [], "l"), ("d", [], "l"), ("e", ["x", None], "l"))
    new = make(("a", ["y", "x"], None), ("b", ["x", "x"], "l"), ("c", [], "l"), ("d", [], "l"), ("e", [None, "x"], "l"))
    assert sorted((r.subject, r.context) for r in lexical._moved(old, new).collect() if r.context is not None) == [("b", ["x"]), ("b", ["x", "x"]), ("c", [])]
    assert lexical._moved(old, new).where("context IS NULL").count() == 1
