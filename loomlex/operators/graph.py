"""Queries over triples: classes, labels, hierarchy, closures and restrictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import LABELS, OWL, RDF, RDFS, SKOS, stored

TYPE, CLASS, SUBCLASS, DEPRECATED = RDF + "type", OWL + "Class", RDFS + "subClassOf", OWL + "deprecated"


def classes(triples: DataFrame) -> DataFrame:
    """(subject): IRIs that are declared classes."""
    return triples.where((F.col("predicate") == TYPE) & (F.col("object") == CLASS) & (F.col("subject_kind") == "iri")).select("subject").distinct()


def deprecated(triples: DataFrame) -> DataFrame:
    return triples.where((F.col("predicate") == DEPRECATED) & F.lower(F.trim("object")).isin("true", "1")).select("subject").distinct()


def active_classes(triples: DataFrame) -> DataFrame:
    return classes(triples).join(deprecated(triples), "subject", "left_anti")


def graph_summary(triples: DataFrame) -> DataFrame:
    """One row: distinct triples, and declared classes."""
    is_class = (F.col("predicate") == TYPE) & (F.col("object") == CLASS) & (F.col("subject_kind") == "iri")
    return triples.distinct().agg(F.count(F.lit(1)).alias("triples"), F.count_if(is_class).alias("classes"))


def class_sample(triples: DataFrame, n: int = 10) -> DataFrame:
    """The first n declared classes by name."""
    return classes(triples).orderBy("subject").limit(n)


def named_only(triples: DataFrame) -> DataFrame:
    """Triples that neither start nor end at a node without a name."""
    return triples.where((F.col("subject_kind") != "bnode") & (F.col("object_kind") != "bnode"))


def term(prefix: str = "object"):
    """A literal's or node's parts as a struct."""
    return F.struct(F.col(f"{prefix}_kind").alias("kind"), F.col(prefix).alias("value"), "language", "datatype")


def labels(triples: DataFrame, english: bool = False) -> DataFrame:
    """(subject, text, field, language) of the label predicates."""
    named = {v: k for k, v in LABELS.items()}
    m = F.create_map(*(F.lit(x) for kv in named.items() for x in kv))
    rows = triples.where(F.col("predicate").isin(*named)).select("subject", F.col("object").alias("text"), m[F.col("predicate")].alias("field"), "language")
    return rows.where(F.lower(F.coalesce("language", F.lit(""))).isin("", "en", "en-us", "en-gb") & (F.col("text") != "")) if english else rows


def edges(triples: DataFrame) -> DataFrame:
    """(child, parent) of asserted named superclasses; nodes without a name are not parents."""
    return triples.where((F.col("predicate") == SUBCLASS) & (F.col("object_kind") == "iri") & (F.col("subject_kind") == "iri")).select(F.col("subject").alias("child"), F.col("object").alias("parent")).distinct()


def class_query(found: DataFrame, labels: DataFrame, flags: DataFrame, edges: DataFrame | None = None, parent: str | None = None, limit: int = 20) -> DataFrame:
    """Classes (subject), each with each of its labels (subject, label) and flags (subject, deprecated), or null; children of parent only, if given."""
    if parent is not None:
        found = found.join(edges.where(F.col("parent") == parent).select(F.col("child").alias("subject")), "subject", "left_semi")
    rows = found.join(labels, "subject", "left").join(flags, "subject", "left")
    return rows.orderBy("subject", F.coalesce("label", F.lit("")), F.coalesce("deprecated", F.lit("")), "label", "deprecated").limit(limit)


def parents_and_children(edges: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """(node, relation, neighbour[, deprecated]): direct parents and children of every node. gone: (subject) of deprecated ones."""
    rows = edges.select(F.col("child").alias("node"), F.lit("parent").alias("relation"), F.col("parent").alias("neighbour")).unionAll(edges.select(F.col("parent").alias("node"), F.lit("child").alias("relation"), F.col("child").alias("neighbour")))
    if gone is None:
        return rows
    marked = gone.select(F.col("subject").alias("neighbour"), F.lit(True).alias("deprecated")).distinct()
    return rows.join(marked, "neighbour", "left").withColumn("deprecated", F.coalesce("deprecated", F.lit(False)))


def siblings(edges: DataFrame) -> DataFrame:
    """(node, sibling) that share a parent. The pairs are the result asked for; a parent's children are what bounds them."""
    other = edges.select(F.col("child").alias("sibling"), "parent")
    return edges.join(other, "parent").where("child <> sibling").select(F.col("child").alias("node"), "sibling").distinct()


def first_siblings(edges: DataFrame, labels: DataFrame, most: int = 12) -> DataFrame:
    """(node, label): the first `most` labels of each node's siblings, at least. labels: (subject, label).

    Of a parent's children only the first labels, and one more for a node's own, meet its children, so that the rows are
    bounded by the children and not by their pairs.
    """
    named = edges.distinct().join(labels.select(F.col("subject").alias("child"), "label").distinct(), "child")
    # Of a label the number of children that have it, and one of them: a node's own label counts if another has it too.
    held = named.groupBy("parent", "label").agg(F.count(F.lit(1)).alias("_n"), F.min("child").alias("_one"))
    first = held.withColumn("_k", F.row_number().over(W.partitionBy("parent").orderBy("label"))).where(F.col("_k") <= most + 1)
    met = edges.join(first, "parent").where((F.col("_n") > 1) | (F.col("_one") != F.col("child")))
    return met.select(F.col("child").alias("node"), "label").distinct()


def closure(edges: DataFrame) -> DataFrame:
    """(node, ancestor) over one edge or more; safe with cycles. Each round joins what is new with all found, so that paths double."""
    base = stored(edges.where("child is not null and parent is not null").select(F.col("child").alias("node"), F.col("parent").alias("ancestor")).distinct(), "closure")
    found = fresh = base
    while not fresh.isEmpty():
        # A path is a new one followed by an old one, or the other way about.
        a = fresh.select("node", F.col("ancestor").alias("via")).join(found.select(F.col("node").alias("via"), "ancestor"), "via")
        b = found.select("node", F.col("ancestor").alias("via")).join(fresh.select(F.col("node").alias("via"), "ancestor"), "via")
        fresh = stored(a.unionAll(b).select("node", "ancestor").distinct().join(found, ["node", "ancestor"], "left_anti"), "closure")
        found = found.unionAll(fresh)
    return found


def _through(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, ancestor) of all paths that use one of the edges, with pairs before and after it."""
    below = pairs.select("node", F.col("ancestor").alias("child"))
    above = pairs.select(F.col("node").alias("parent"), "ancestor")
    up = edges.join(above, "parent").select("child", "ancestor").union(edges.select("child", "parent"))
    return up.join(below, "child").select("node", "ancestor").union(up.select("child", "ancestor")).distinct()


def closure_after(pairs: DataFrame, edges: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """The closure after a change of edges, from the closure before it; edges, removed, added: (child, parent).

    Pairs that some path through a removed edge gives are taken back, and those of them that other paths still give are
    found again, edge by edge from what stays; then paths through added edges come in. Work follows the pairs that the
    change concerns; an edge that is removed but not there, or added but there, changes nothing.
    """
    clean = lambda e: e.select("child", "parent").where("child is not null and parent is not null").distinct()
    edges, removed, added = (clean(e) for e in (edges, removed, added))
    gone = stored(removed.join(edges, ["child", "parent"], "left_semi").join(added, ["child", "parent"], "left_anti"), "edges-gone")
    left = edges.join(gone, ["child", "parent"], "left_anti")
    doubtful = stored(_through(pairs, gone).join(pairs, ["node", "ancestor"], "left_semi"), "pairs-doubtful")
    kept = stored(pairs.join(doubtful, ["node", "ancestor"], "left_anti"), "pairs-kept")
    near = stored(left.join(doubtful.select(F.col("node").alias("child")).distinct(), "child", "left_semi"), "edges-near")
    step = near.select(F.col("child").alias("node"), F.col("parent").alias("via"))
    first = near.select(F.col("child").alias("node"), F.col("parent").alias("ancestor")).union(step.join(kept.select(F.col("node").alias("via"), "ancestor"), "via").select("node", "ancestor"))
    fresh = stored(first.distinct().join(doubtful, ["node", "ancestor"], "left_semi"), "pairs-again")
    again = fresh
    while not fresh.isEmpty():
        more = step.join(fresh.select(F.col("node").alias("via"), "ancestor"), "via").select("node", "ancestor").distinct()
        fresh = stored(more.join(doubtful, ["node", "ancestor"], "left_semi").join(again, ["node", "ancestor"], "left_anti"), "pairs-again")
        again = again.union(fresh)
    found = kept.union(again)
    new = stored(added.join(left, ["child", "parent"], "left_anti"), "edges-new")
    while True:
        fresh = stored(_through(found, new).join(found, ["node", "ancestor"], "left_anti"), "pairs-new")
        if fresh.isEmpty():
            return found
        found = found.union(fresh)


def branches(edges: DataFrame, active: DataFrame, root: str = OWL + "Thing") -> DataFrame:
    """(subject, branches): every ancestor-or-self, through active classes alone, that stands right below the root.

    Each branch has a bit; sets of bits go down the edges, and only bits that are new to a class go on from it. So rows
    grow with the classes, and rounds with the depth; no pair of class and ancestor is made.
    """
    inner = edges.join(active.select(F.col("subject").alias("child")), "child", "left_semi")
    top = stored(inner.where(F.col("parent") == root).select(F.col("child").alias("branch")).distinct().withColumn("i", F.monotonically_increasing_id()), "branches")
    within = stored(inner.join(active.select(F.col("subject").alias("parent")), "parent", "left_semi").where((F.col("parent") != root) & (F.col("parent") != F.col("child"))).select("child", "parent").distinct(), "within")
    bits = F.expr("shiftleft(1L, cast(pmod(i, 64) AS int))")
    fresh = known = stored(top.select(F.col("branch").alias("subject"), F.expr("i div 64").alias("block"), bits.alias("bits")), "branch-bits")
    while not fresh.isEmpty():
        sent = within.join(fresh.withColumnRenamed("subject", "parent"), "parent").groupBy(F.col("child").alias("subject"), "block").agg(F.bit_or("bits").alias("bits"))
        held = known.groupBy("subject", "block").agg(F.bit_or("bits").alias("_held"))
        fresh = sent.join(held, ["subject", "block"], "left").select("subject", "block", F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("_held", F.lit(0).cast("long")))).alias("bits"))
        fresh = stored(fresh.where("bits <> 0"), "branch-bits")
        known = known.unionAll(fresh)
    one = known.select("subject", "block", F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda k: F.getbit("bits", k) == 1)).alias("k"))
    hit = one.select("subject", (F.col("block") * 64 + F.col("k")).alias("i")).join(top, "i").groupBy("subject").agg(F.array_sort(F.collect_set("branch")).alias("branches"))
    return active.select("subject").join(hit, "subject", "left").withColumn("branches", F.coalesce("branches", F.array().cast("array<string>")))


def parent_labels(edges: DataFrame, labels: DataFrame, active: DataFrame) -> DataFrame:
    """(subject, text): the labels of a class's active parents."""
    own = labels.join(active, "subject", "left_semi").select(F.col("subject").alias("parent"), "text")
    return edges.join(own, "parent").select(F.col("child").alias("subject"), "text").distinct()


def restriction_nodes(triples: DataFrame) -> DataFrame:
    """(subject, node, property, kind, value, value_kind): superclasses without a name, with the nodes that spell them."""
    kinds = [OWL + k for k in ("someValuesFrom", "allValuesFrom", "hasValue", "minCardinality", "maxCardinality", "cardinality")]
    held = triples.where((F.col("predicate") == SUBCLASS) & (F.col("object_kind") == "bnode")).select("subject", F.col("object").alias("node"))
    prop = triples.where(F.col("predicate") == OWL + "onProperty").select(F.col("subject").alias("node"), F.col("object").alias("property"))
    value = triples.where(F.col("predicate").isin(*kinds)).select(F.col("subject").alias("node"), F.col("predicate").alias("kind"), F.col("object").alias("value"), F.col("object_kind").alias("value_kind"))
    return held.join(prop, "node").join(value, "node").select("subject", "node", "property", "kind", "value", "value_kind")


def restrictions(triples: DataFrame) -> DataFrame:
    """(subject, property, kind, value, value_kind): superclasses without a name, put together again."""
    return restriction_nodes(triples).drop("node").distinct()


def restriction_stats(found: DataFrame) -> DataFrame:
    return found.groupBy("property").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("subject").alias("n_classes"))


def inspect(triples: DataFrame, iri: str) -> dict[str, DataFrame]:
    """A class's labels, direct parents and direct children."""
    own = edges(triples)
    near = parents_and_children(own.where((F.col("child") == iri) | (F.col("parent") == iri)), deprecated(triples)).where(F.col("node") == iri)
    return {
        "labels": triples.where((F.col("subject") == iri) & F.col("predicate").isin(*LABELS.values())).select("predicate", term().alias("term")).orderBy("predicate", "term.value", "term.language"),
        "neighbours": near.select("relation", "neighbour", "deprecated").orderBy("relation", "neighbour"),
    }


def label_choice(labels: DataFrame) -> DataFrame:
    """(subject, label): preferred before plain before alternative, English before other languages, then by text."""
    at = F.array_position(F.array(F.lit("skos:prefLabel"), F.lit("rdfs:label"), F.lit("skos:altLabel")), F.col("field")) - 1
    other = F.when(F.lower(F.coalesce("language", F.lit(""))).isin("en", "en-us", ""), 0).otherwise(1)
    ranked = labels.where(at >= 0).groupBy("subject").agg(F.min(F.struct((at * 2 + other).alias("k"), F.col("text"))).alias("m"))
    return ranked.select("subject", F.col("m.text").alias("label"))


def bounded_context(ancestors: DataFrame, siblings: DataFrame, most: int = 12, fewer: int = 3, limit: int = 8000) -> DataFrame:
    """(node, ancestors, siblings, oversize): the first `most` of each by text; the first `fewer` where the JSON is over `limit` bytes.

    ancestors, siblings: (node, label). Each side is ranked and cut before it is gathered.
    """

    def first(df: DataFrame, name: str) -> DataFrame:
        top = df.distinct().withColumn("_n", F.row_number().over(W.partitionBy("node").orderBy("label"))).where(F.col("_n") <= most)
        return top.groupBy("node").agg(F.array_sort(F.collect_list("label")).alias(name))

    rows = first(ancestors, "ancestors").join(first(siblings, "siblings"), "node", "full_outer")
    for c in ("ancestors", "siblings"):
        rows = rows.withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    size = lambda: F.octet_length(F.to_json(F.struct("ancestors", "siblings")))
    rows = rows.withColumn("_over", size() > limit)
    for c in ("ancestors", "siblings"):
        rows = rows.withColumn(c, F.when(F.col("_over"), F.slice(c, 1, fewer)).otherwise(F.col(c)))
    return rows.withColumn("oversize", size() > limit).drop("_over")


def record_contexts(records: DataFrame, values: DataFrame, labels: DataFrame, risks: DataFrame, most: int = 12) -> DataFrame:
    """(record_id, label, source, definition, risks): what a reviewer of an annotation sees of its concept.

    records: (record_id, subject, predicate, lexical). values: literal annotations (subject, predicate, lexical,
    language). labels: (subject, label), one each. risks: (subject, predicate, message), of the record's predicate or of
    none. The source is the only other English value of the predicate, else null; the definition the first English one;
    risks are the first `most` by text. All are found by joins and aggregations per record.
    """
    lang = F.lower(F.coalesce("language", F.lit("")))
    english = values.where(lang.isin("en", ""))
    others = english.select("subject", "predicate", F.col("lexical").alias("_text")).distinct()
    source = records.join(others, ["subject", "predicate"]).where("_text <> lexical").groupBy("record_id").agg(F.count(F.lit(1)).alias("_n"), F.min("_text").alias("source"))
    source = source.select("record_id", F.when(F.col("_n") == 1, F.col("source")).alias("source"))
    order = F.struct(F.when(lang.isin("en", ""), 0).otherwise(1), F.coalesce("language", F.lit("")), F.col("lexical"))
    definition = values.where((F.col("predicate") == SKOS + "definition") & lang.isin("en", "en-us", "")).groupBy("subject").agg(F.min_by("lexical", order).alias("definition"))
    hit = records.select("record_id", "subject", "predicate").join(risks.select("subject", F.nullif("predicate", F.lit("")).alias("_predicate"), "message"), "subject")
    hit = hit.where("_predicate IS NULL OR _predicate = predicate").select("record_id", "message").distinct()
    place = F.row_number().over(W.partitionBy("record_id").orderBy("message"))
    told = hit.withColumn("_n", place).where(F.col("_n") <= most).groupBy("record_id").agg(F.array_sort(F.collect_list("message")).alias("risks"))
    rows = records.join(labels.select("subject", "label"), "subject", "left").join(definition, "subject", "left").join(source, "record_id", "left").join(told, "record_id", "left")
    return rows.select("record_id", F.coalesce("label", "subject").alias("label"), "source", "definition", F.coalesce("risks", F.array().cast("array<string>")).alias("risks"))
