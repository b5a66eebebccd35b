"""Names for nodes without one, by content: what is said by and about them, whatever they are called.

Nodes that reach no circle are named bottom up by what they say. The rest, nodes on circles and those that lead to them,
fall into connected parts, and a part is named by itself, whatever else the graph holds. One task numbers a part: cells of
nodes are split by the links to other cells until none tells more nodes apart, each split costing what it moves. Where that
leaves nodes alike, one of them is set apart, cells are split further, and of all such numberings the least one names the
part's nodes; numberings that only swap like for like are not tried again. So equal graphs get equal names, and different
ones different. Parts too large for a task are coloured by rounds over tables.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict, deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import dealt, stored

#: Nodes of one part that one task numbers; a part of more is coloured by rounds, and refused if colours leave nodes alike.
PART_NODES = 200_000


def _nodes(triples: DataFrame) -> DataFrame:
    s = triples.where("subject_kind = 'bnode'").select(F.col("subject").alias("node"))
    return s.union(triples.where("object_kind = 'bnode'").select("object")).distinct()


def _digest(says: Column, before: Column | None = None) -> Column:
    said = F.array_join(F.array_sort(F.collect_set(says)), "\x1e")
    return F.sha2(said if before is None else F.concat_ws("\x1d", before, said), 256)


def _say(way: str, other: Column) -> Column:
    return F.concat_ws("\x1f", F.lit(way), "predicate", other, "object_kind", F.coalesce("language", F.lit("")), F.coalesce("datatype", F.lit("")))


def _settled(own: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, hash) of the nodes that reach no circle, a step up each round, and the nodes that are left."""
    done, left = None, nodes
    while True:
        known = own.join(left.withColumnRenamed("node", "subject"), "subject", "left_semi")
        open_ = known.where("object_kind = 'bnode'").join(left.withColumnRenamed("node", "object"), "object", "left_semi").select(F.col("subject").alias("node")).distinct()
        ready = left.join(open_, "node", "left_anti")
        said = ready.join(own.withColumnRenamed("subject", "node"), "node", "left")
        if done is not None:
            said = said.join(done.select(F.col("node").alias("object"), F.col("hash").alias("_h")), "object", "left")
        spoken = F.when(F.col("object_kind") == "bnode", F.col("_h") if done is not None else F.lit(None)).otherwise(F.col("object"))
        fresh = stored(said.groupBy("node").agg(_digest(F.when(F.col("predicate").isNotNull(), _say("", spoken))).alias("hash")), "node-hashes")
        if fresh.isEmpty():
            return (done if done is not None else fresh), left
        done = fresh if done is None else stored(done.unionByName(fresh), "node-hashes")
        left = stored(left.join(fresh, "node", "left_anti"), "nodes-left")


def _said(triples: DataFrame, left: DataFrame, done: DataFrame) -> DataFrame:
    """(node, other, peer, way, predicate, object_kind, language, datatype): what is said by and about the nodes that are left, a row per triple and node; peer is another such node."""
    at = left.withColumnRenamed("node", "_n")
    hashes = done.select(F.col("node").alias("_k"), F.col("hash").alias("_h"))
    out = triples.join(at, F.col("subject") == F.col("_n")).drop("_n").join(hashes, (F.col("object_kind") == "bnode") & (F.col("object") == F.col("_k")), "left")
    out = out.select(F.col("subject").alias("node"), F.when(F.col("object_kind") == "bnode", F.coalesce("_h", F.lit(""))).otherwise(F.col("object")).alias("other"), F.when((F.col("object_kind") == "bnode") & F.col("_h").isNull(), F.col("object")).alias("peer"), F.lit("out").alias("way"), "predicate", "object_kind", "language", "datatype")
    into = triples.where("object_kind = 'bnode'").join(at, F.col("object") == F.col("_n")).select(F.col("object").alias("node"), F.when(F.col("subject_kind") == "iri", F.col("subject")).otherwise("").alias("other"), F.when(F.col("subject_kind") == "bnode", F.col("subject")).alias("peer"), F.lit("in").alias("way"), "predicate", F.col("subject_kind").alias("object_kind"), F.lit(None).cast("string").alias("language"), F.lit(None).cast("string").alias("datatype"))
    return stored(out.unionByName(into), "circles")


def _coloured(said: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, part, colour) of nodes (node, part): a part is refined until a round tells no more of its nodes apart, so that its colours hang on nothing else."""
    colours, before, done = nodes.withColumn("colour", F.lit("")), nodes.select("part").distinct().withColumn("n", F.lit(1).cast("long")), None
    while True:
        named = said.join(colours.select("node"), "node", "left_semi").join(colours.select(F.col("node").alias("peer"), F.col("colour").alias("_c")), "peer", "left")
        spoken = F.concat_ws("\x1c", "way", F.coalesce("_c", "other"))
        # The colour before is said too, so that nodes once told apart stay so.
        fresh = named.groupBy("node").agg(F.collect_set(_say("", spoken)).alias("_s")).join(colours, "node")
        fresh = stored(fresh.select("node", "part", F.sha2(F.concat_ws("\x1d", "colour", F.array_join(F.array_sort("_s"), "\x1e")), 256).alias("colour")), "colours")
        now = stored(fresh.groupBy("part").agg(F.countDistinct("colour").alias("n")), "colour-counts")
        grown = now.join(before.withColumnRenamed("n", "_n"), "part").where("n > _n").select("part")
        ready = fresh.join(grown, "part", "left_anti")
        done = ready if done is None else done.unionByName(ready)
        colours, before = stored(fresh.join(grown, "part", "left_semi"), "colours"), now
        if colours.isEmpty():
            return stored(done, "colours")


def _stars(links: DataFrame) -> DataFrame:
    """(node, part): of links (a, b) of strings, the least node of each connected part, by alternating stars."""
    both = lambda x: x.select("a", "b").union(x.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    now, mark = stored(both(links).where("a > b"), "parts"), None
    while True:
        two = both(now)
        least = two.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = two.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        now = stored(small.distinct(), "parts")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("part")).union(now.select("b", "b")).distinct()
        mark = tuple(seen)


def refine(colour: list[int], out: list[list[tuple]], into: list[list[tuple]], fresh: list[int] | None = None) -> list[int]:
    """Ranks of nodes by colour and by the colours that they refer to and are referred to from, until they tell no more apart.

    A rank is the number of nodes before its cell. Each cell splits the others by the links into and out of it; of the
    pieces of a cell that is not waiting itself, the first largest need not split again. fresh: nodes alone in their
    cells, if the colours without them are refined already.
    """
    n = len(colour)
    colour, cells, last = [*colour], {}, None
    for k, i in enumerate(sorted(range(n), key=colour.__getitem__)):
        if last is None or colour[i] != last[0]:
            last = (colour[i], k)
        cells.setdefault(last[1], set()).add(i)
    for c, held in cells.items():
        for i in held:
            colour[i] = c
    waiting = deque(cells if fresh is None else [colour[i] for i in fresh])
    queued = set(waiting)
    while waiting:
        c = waiting.popleft()
        queued.discard(c)
        touched = defaultdict(list)
        for v in cells[c]:
            for p, u in into[v]:
                touched[u].append((p, 0))
            for p, u in out[v]:
                touched[u].append((p, 1))
        by = defaultdict(list)
        for u in touched:
            if len(cells[colour[u]]) > 1:
                by[colour[u]].append(u)
        for d in sorted(by):
            signs = defaultdict(list)
            for u in by[d]:
                signs[tuple(sorted(touched[u]))].append(u)
            rest = len(cells[d]) - len(by[d])
            if not rest and len(signs) == 1:
                continue
            # What is not touched comes first and stays where it is, so that it costs nothing.
            at, starts = d + rest, [d] if rest else []
            for sign in sorted(signs):
                starts.append(at)
                if at > d:
                    cells[d].difference_update(signs[sign])
                    cells[at] = set(signs[sign])
                    for u in signs[sign]:
                        colour[u] = at
                at += len(signs[sign])
            skip = None if d in queued else max(starts, key=lambda k: (len(cells[k]), -k))
            for k in starts:
                if k != skip and k not in queued:
                    queued.add(k)
                    waiting.append(k)
    return colour


def least_numbering(start: list[str], edges: list[tuple[int, str, int]]) -> tuple[list[int], tuple]:
    """(number of each node, form): the numbering whose edges, written by numbers, come first; start are iso-invariant colours."""
    n = len(start)
    out, into = [[] for _ in range(n)], [[] for _ in range(n)]
    for a, p, b in edges:
        out[a].append((p, b))
        into[b].append((p, a))
    ranks = {c: k for k, c in enumerate(sorted(set(start)))}
    best: tuple | None = None
    leaves: list[tuple[tuple, list[int]]] = []
    swaps: list[list[int]] = []

    def leaf(colour: list[int]) -> None:
        nonlocal best
        order = sorted(range(n), key=colour.__getitem__)
        number = [0] * n
        for k, i in enumerate(order):
            number[i] = k
        form = (tuple(start[i] for i in order), tuple(sorted((number[a], p, number[b]) for a, p, b in edges)))
        for known, other in leaves:
            if known == form:
                back = {k: i for i, k in enumerate(other)}
                swaps.append([back[k] for k in number])
                return
        leaves.append((form, number))
        del leaves[2:]  # the first, and one more to find swaps by
        if best is None or form < best[0]:
            best = (form, number)
            leaves[1:] = [best]

    # A frame: colours, the alike nodes to set apart, those tried, and the nodes set apart so far.
    stack: list[tuple[list[int], list[int], list[int], tuple[int, ...]]] = []

    def enter(colour: list[int], fixed: tuple[int, ...]) -> None:
        colour = refine(colour, out, into, [*fixed[-1:]] or None)
        cells = defaultdict(list)
        for i, c in enumerate(colour):
            cells[c].append(i)
        alike = [(len(v), c) for c, v in cells.items() if len(v) > 1]
        if alike:
            stack.append((colour, cells[min(alike)[1]], [], fixed))
        else:
            leaf(colour)

    enter([ranks[c] for c in start], ())
    while stack:
        colour, cell, tried, fixed = stack[-1]
        root = list(range(n))

        def top(i: int, root=root) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for s in swaps:
            if all(s[f] == f for f in fixed):
                for i, j in enumerate(s):
                    root[top(i)] = top(j)
        seen = {top(i) for i in tried}
        fresh = next((i for i in cell if i not in tried and top(i) not in seen), None)
        if fresh is None:
            stack.pop()
            continue
        tried.append(fresh)
        enter([2 * c + (i != fresh) for i, c in enumerate(colour)], (*fixed, fresh))
    return best[1], best[0]


def _named(key: tuple, rows: pa.Table) -> pa.Table:
    """Of one part: nodes with what is said of them beside their links, and the links between them."""
    rows = rows.select(["node", "colour", "predicate", "peer"]).to_pylist()
    nodes = {r["node"]: r["colour"] for r in rows if r["predicate"] is None}
    at = {k: i for i, k in enumerate(sorted(nodes))}
    names = list(at)
    edges = sorted({(at[r["node"]], r["predicate"], at[r["peer"]]) for r in rows if r["predicate"] is not None})
    number, form = least_numbering([nodes[k] for k in names], edges)
    whole = hashlib.sha256(repr(form).encode()).hexdigest()
    return pa.table({"node": names, "hash": [hashlib.sha256(f"{whole} {number[i]}".encode()).hexdigest() for i in range(len(names))]})


def names(triples: DataFrame, most: int = PART_NODES) -> DataFrame:
    """(node, hash) of every node without a name, by content.

    Nodes that reach no circle and say the same share a hash. Nodes on or before a circle share one only if one stands
    for the other in an equal part of the graph. Without such nodes the result is empty. A connected part is one task's;
    one of more than `most` nodes is coloured by rounds, ValueError if that leaves some of its nodes alike.
    """
    columns = ["subject", "subject_kind", "predicate", "object", "object_kind", "language", "datatype"]
    about = stored(dealt(triples.where("subject_kind = 'bnode' OR object_kind = 'bnode'").select(*columns)).distinct(), "about-nameless")
    own = about.where("subject_kind = 'bnode'")
    done, left = _settled(own, stored(_nodes(about), "nameless"))
    if left.isEmpty():
        return done
    said = _said(about, left, done)
    links = stored(said.where("way = 'out' AND peer IS NOT NULL").select(F.col("node").alias("subject"), "predicate", F.col("peer").alias("object")), "links-of-nameless")
    parts = stored(left.join(_stars(links.select(F.col("subject").alias("a"), F.col("object").alias("b"))), "node", "left").select("node", F.coalesce("part", "node").alias("part")), "parts-of-nameless")
    large = stored(parts.groupBy("part").count().where(F.col("count") > most), "large-parts")
    out, whole = done, large.isEmpty()
    if not whole:
        colours = _coloured(said, parts.join(large, "part", "left_semi"))
        alike = colours.groupBy("part", "colour").count().where("count > 1").join(large.select("part", F.col("count").alias("_m")), "part").agg(F.max("_m")).first()[0]
        if alike:
            raise ValueError(f"{alike} nodes without a name in one part, some of them alike nodes, of at most {most}")
        out = out.unionByName(colours.select("node", F.col("colour").alias("hash")))
    small = parts if whole else parts.join(large, "part", "left_anti")
    none = F.lit(None).cast("string")
    own_words = F.when(F.col("peer").isNull(), _say("", F.concat_ws("\x1c", "way", "other")))
    rows = said.join(small, "node").groupBy("part", "node").agg(_digest(own_words).alias("colour")).select("part", "node", "colour", none.alias("predicate"), none.alias("peer")).unionByName(
        links.join(small.withColumnRenamed("node", "subject"), "subject").select("part", F.col("subject").alias("node"), none.alias("colour"), "predicate", F.col("object").alias("peer"))
    )
    return stored(out.unionByName(rows.groupBy("part").applyInArrow(_named, "node string, hash string")), "nameless-names")
