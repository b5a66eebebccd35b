"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits are cut into blocks of 23, 23 and 18 bits. If two differ in at most t bits, they differ in at
most t // 3 bits of some block. In each block the anchors are the words of a perfect covering code (the binary Golay
code, radius 3; for the last block the Hamming code of 15 bits, radius 1, with three bits as they are). A fingerprint
has one home anchor per block, the nearest, and is replicated to every anchor within the covering radius plus t // 3;
those are the homes of all that its neighbours can have. Per anchor, homes are compared with visitors over all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, parts_for, text_of, texts, written
from .components import components

WIDTH, THRESHOLD, SEED = 4, 4, 42
#: Rows of one anchor that one task compares; busier anchors deal their homes out and copy their visitors to each share.
ANCHOR_ROWS = 20_000
_GOLAY = 0xC75  # the generator polynomial of the [23, 12] Golay code
_BLOCKS = ((0, 23), (23, 23), (46, 18))


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    ws = text.lower().split()  # of bytes: A-Z alone
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    first = [0, *(ends[:-width] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(first)
    last = ends[width - 1 :].tolist()
    for i in range(0, n, 1 << 15):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(first[i : i + (1 << 15)], last[i : i + (1 << 15)], strict=True)], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def row_key(id_col: str, text: str) -> Column:
    """A hash that rows share if both id and text are the same."""
    return F.xxhash64(F.col(id_col), F.col(text).cast("string"))


def fingerprints(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, row_key): fp is the 64-bit SimHash as a signed long.

    A bit is 1 if set in over half of the hashes of the text's shingles of `width` words, repeats included; fewer words
    make one shingle. Null, empty and blank texts have fingerprint zero.
    """

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(x, width) for x in texts(batch.column("text"))], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps.view(np.int64)), batch.column("row_key")], ["id", "fp", "row_key"])

    kind = dict(docs.dtypes)[id_col]
    return map_batches(text_of(docs, F.col(id_col).alias("id"), row_key(id_col, text).alias("row_key"), text=text), kernel, f"id {kind}, fp long, row_key long")


def _golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each 23-bit unit word, and the coset leader (weight 3 at most) of each of the 2048 syndromes."""
    unit = []
    for i in range(23):
        r = 1 << i
        for b in range(22, 10, -1):
            if r >> b & 1:
                r ^= _GOLAY << (b - 11)
        unit.append(r)
    leader = np.zeros(2048, np.uint64)
    for k in range(1, 4):
        for c in combinations(range(23), k):
            s = 0
            for i in c:
                s ^= unit[i]
            leader[s] = sum(1 << i for i in c)
    return np.array(unit, np.int64), leader


def _hamming_tables() -> tuple[np.ndarray, np.ndarray]:
    """The same for 18 bits: a Hamming code of 15 bits; the other three are part of the anchor as they are."""
    leader = np.zeros(16, np.uint64)
    for i in range(15):
        leader[i + 1] = 1 << i
    return np.array([*range(1, 16), 0, 0, 0], np.int64), leader


_TABLES = (_golay_tables(), _golay_tables(), _hamming_tables())


def anchors_of(fps: np.ndarray, block: int, flips: int) -> np.ndarray:
    """For each fingerprint the anchors that it visits in a block, its home first; repeats are not removed."""
    start, bits = _BLOCKS[block]
    unit, leader = _TABLES[block]
    word = (fps >> np.uint64(start)) & np.uint64((1 << bits) - 1)
    syndrome = np.zeros(len(fps), np.int64)
    for i in range(bits):
        syndrome ^= np.where(word >> np.uint64(i) & np.uint64(1), unit[i], 0)
    out = []
    for k in range(flips + 1):
        for c in combinations(range(bits), k):
            moved, s = word, syndrome
            for i in c:
                moved, s = moved ^ np.uint64(1 << i), s ^ unit[i]
            out.append(moved ^ leader[s])
    return np.stack(out, axis=1)


def _replicate(flips: int):
    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.asarray(batch.column("fp")).view(np.uint64)
        anchors, owners, home = [], [], []
        for block in range(3):
            for i in range(0, len(fps), 4096):
                part = fps[i : i + 4096]
                a = (anchors_of(part, block, flips) << np.uint64(2)) | np.uint64(block)
                own = a[:, :1]
                a = np.sort(a, axis=1)
                new = np.concatenate([np.ones((len(a), 1), bool), a[:, 1:] != a[:, :-1]], axis=1)
                anchors.append(a[new])
                owners.append(np.repeat(part, new.sum(axis=1)))
                home.append((a == own)[new])
        cat = lambda x, kind: np.concatenate(x) if x else np.array([], kind)
        return pa.RecordBatch.from_arrays(
            [pa.array(cat(anchors, np.uint64).astype(np.int64)), pa.array(cat(owners, np.uint64).view(np.int64)), pa.array(cat(home, bool))], ["anchor", "fp", "home"]
        )

    return kernel


def _link(homes: np.ndarray, visitors: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars that connect what the links between homes and visitors connect."""
    nodes = np.unique(np.concatenate([homes, visitors]))
    root = np.arange(len(nodes))
    at_home, at_visit = np.searchsorted(nodes, homes), np.searchsorted(nodes, visitors)
    step = max(1, (1 << 20) // max(1, len(visitors)))
    for i in range(0, len(homes), step):
        h, v = np.nonzero(np.bitwise_count(homes[i : i + step, None] ^ visitors[None, :]) <= threshold)
        root = _union(root, at_home[i : i + step][h], at_visit[v])
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


class _Stars:
    """Gathers a partition's links and hands them on as one link per node, to the least node that they connect it with."""

    MOST = 1 << 20

    def __init__(self):
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.n = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.a.append(a)
        self.b.append(b)
        self.n += len(a)
        if self.n > self.MOST:
            self._join()
            if 2 * self.n > self.MOST:
                yield from self.close()

    def _join(self) -> None:
        a, b = np.concatenate(self.a), np.concatenate(self.b)
        nodes = np.unique(np.concatenate([a, b]))
        root = _union(np.arange(len(nodes)), np.searchsorted(nodes, a), np.searchsorted(nodes, b))
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        self.a, self.b, self.n = [nodes[moved]], [nodes[root[moved]]], len(moved)

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            self._join()
            yield pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)) for x in (self.a, self.b)], ["a", "b"])
        self.a, self.b, self.n = [], [], 0


def _compare(threshold: int):
    """Over rows sorted by (anchor, share), each partition holding whole shares."""

    def flush(parts) -> tuple[np.ndarray, np.ndarray]:
        fps, home = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        if not home.any() or len(fps) < 2:
            return np.array([], np.uint64), np.array([], np.uint64)
        return _link(fps[home], fps, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, stars = None, [], _Stars()
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column("anchor")), np.asarray(batch.column("share")).astype(np.int64)], axis=1)
            fps, home = np.asarray(batch.column("fp")).view(np.uint64), batch.column("home").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                k = tuple(keys[s].tolist())
                if k != key and held:
                    yield from stars.add(*flush(held))
                    held = []
                key = k
                held.append((fps[s:e], home[s:e]))
        if held:
            yield from stars.add(*flush(held))
        yield from stars.close()

    return run


def links(distinct: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a, b) that connect all fingerprints of `distinct` (fp) at `threshold` differing bits or fewer; not each pair is named."""
    spark = distinct.sparkSession
    rows = map_batches(distinct.select("fp"), _replicate(threshold // 3), "anchor long, fp long, home boolean")
    # At most 2 * 2**12 + 2**14 anchors, whatever the input: small enough for each task to know the busy ones.
    busy = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).select("anchor", F.ceil(F.col("n") / ANCHOR_ROWS).cast("int").alias("shares")).where("shares > 1")
    dealt = rows.join(F.broadcast(busy), "anchor", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
    # A home is compared in one share; as a visitor it goes to the others too.
    own = F.pmod(F.xxhash64("fp"), F.col("shares")).cast("int")
    spread = dealt.select("anchor", "fp", "home", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    spread = spread.select("anchor", "share", "fp", (F.col("home") & (F.col("share") == F.col("own"))).alias("home"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_for(distinct, 1 << 18))
    return spread.repartition(n, "anchor", "share").sortWithinPartitions("anchor", "share").mapInArrow(_compare(threshold), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, component_id, row_key, group): component_id is the least id reachable over links of fingerprints, the row's own included.

    Equal fingerprints are linked, so texts without words form one group. A null id is no one's least id: component_id
    is null only where all ids of a group are. Repeated rows give repeated rows; an empty table gives an empty result.
    """
    marked = written(fingerprints(docs, width, id_col, text), "fingerprints")
    classes = marked.groupBy("fp").agg(F.min("id").alias("least"))
    spark = docs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    roots = components(links(classes.select("fp").repartition(n), threshold)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id", F.col("root").alias("group"))
    return marked.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id", "row_key", "group")


# Similarity of shingle sets, not a number of differing bits: several fingerprints find candidates, the sets decide.

#: Fingerprints per text, and the share of differing bits that stands for a Jaccard similarity s: the angle of sets whose cosine is 2s / (1 + s).
SEEDS, WIDE, SIMILARITY = 6, 5, 0.8
#: Sketches only find candidates: pairs whose differing bits lie within so many standard deviations of what the similarity asked for gives.
DEVIATIONS = 6
#: Texts of a group of candidates that one task compares; larger groups are dealt into shares, to all of which some texts go.
SHARE_ROWS, COMMON = 256, 8
#: Bits of the map (of fixed size, whatever the input) that tells which rows' texts may be candidates.
MAP_BITS = 23
#: Tight groups are taken out of busy anchors around so many pivots at most, before all are compared with all.
PIVOTS = 32


def share_of(similarity: float) -> float:
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def shingles(text: bytes, width: int = WIDE) -> np.ndarray:
    """The sorted hashes of the distinct shingles; fewer words make one, no words none."""
    ws = text.lower().split()
    if not ws:
        return np.array([], np.uint64)
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(ws)
    if len(ws) <= width:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip([0, *(ends[:-width] + 1).tolist()], ends[width - 1 :].tolist(), strict=True)], np.uint64))


def node_of(h: np.ndarray) -> int:
    """The node of a shingle set, as a signed long: equal sets are one."""
    return int(np.array(xxhash.xxh64_intdigest(h.astype("<u8").tobytes(), SEED), np.uint64).view(np.int64))


def sketch(h: np.ndarray, seeds: int = SEEDS) -> np.ndarray:
    """`seeds` fingerprints of a shingle set, each over the same hashes mixed with another constant."""
    if not len(h):
        return np.zeros(seeds, np.uint64)
    out = []
    for k in range(seeds):
        x = (h ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
        counts = np.zeros(64, np.int64)
        for i in range(0, len(x), 1 << 14):
            counts += np.unpackbits(x[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * counts > len(x), bitorder="little").view("<u8")[0])
    return np.array(out, np.uint64)


def _union(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """root after the links between a and b."""
    while True:
        x, y = root[a], root[b]
        differ = x != y
        if not differ.any():
            return root
        to = np.arange(len(root))
        np.minimum.at(to, np.maximum(x, y)[differ], np.minimum(x, y)[differ])
        while (to[to] != to).any():
            to = to[to]
        root = to[root]


def _near(f: np.ndarray, rows: np.ndarray, cols: np.ndarray, most: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows and cols of the sketches f that differ in at most `most` bits."""
    out_a, out_b = [], []
    step = max(1, (1 << 20) // max(1, len(cols)))
    for i in range(0, len(rows), step):
        part = rows[i : i + step]
        # The first fingerprint leaves few pairs: those whose share of differing bits may still be small enough.
        d = np.bitwise_count(f[part, 0][:, None] ^ f[cols, 0][None, :])
        x, y = np.nonzero(d <= first)
        total = np.bitwise_count(f[part[x]] ^ f[cols[y]]).sum(axis=1, dtype=np.int64)
        hit = total <= most
        out_a.append(part[x[hit]])
        out_b.append(cols[y[hit]])
    cat = lambda z: np.concatenate(z) if z else np.array([], np.int64)
    return cat(out_a), cat(out_b)


def link_sketches(f: np.ndarray, most: int, first: int | None = None) -> np.ndarray:
    """Each row's root under links of at most `most` differing bits in all, and `first` in the first fingerprint; every pair that is not linked already is looked at.

    A pair at the similarity asked for differs in more than `first` bits (ten standard deviations of 64 draws) practically never.
    """
    n = len(f)
    first = min(64, most // f.shape[1] + 16) if first is None else first
    root, rest = np.arange(n), np.arange(n)
    for _ in range(PIVOTS if n > 512 else 0):
        pivot = rest[:1]
        near = rest[np.bitwise_count(f[rest] ^ f[pivot]).sum(axis=1, dtype=np.int64) <= most]
        if len(near) * 50 < n:
            rest = np.concatenate([rest[1:], pivot])
            continue
        root = _union(root, near, np.repeat(pivot, len(near)))
        rest = np.setdiff1d(rest, near, assume_unique=True)
        root = _union(root, *_near(f, near, rest, most, first))
        if not len(rest):
            return root
    rest = np.sort(rest)
    step = max(1, (1 << 20) // max(1, len(rest)))
    for i in range(0, len(rest), step):
        root = _union(root, *_near(f, rest[i : i + step], rest[i:], most, first))
    return root


def _sketch_anchors(seeds: int):
    """Two Golay blocks of each fingerprint; a sketch visits every anchor within the covering radius plus one, so that two that differ in two bits of a block meet."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column("sketch").to_pylist()
        f = np.frombuffer(b"".join(raw), "<u8").reshape(-1, seeds)
        anchors, owners = [], []
        for i in range(0, len(f), 4096):
            for k in range(seeds):
                for block in range(2):
                    a = np.sort((anchors_of(f[i : i + 4096, k], block, 1) << np.uint64(8)) | np.uint64(2 * k + block), axis=1)
                    new = np.concatenate([np.ones((len(a), 1), bool), a[:, 1:] != a[:, :-1]], axis=1)
                    anchors.append(a[new])
                    owners.append(i + np.repeat(np.arange(len(a)), new.sum(axis=1)))
        own = pa.array(np.concatenate(owners))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(anchors).astype(np.int64)), batch.column("node").take(own), batch.column("sketch").take(own)], ["anchor", "node", "sketch"])

    return kernel


def _compare_sketches(seeds: int, most: int, first: int):
    def stars(nodes: list, raw: list) -> tuple[np.ndarray, np.ndarray]:
        # In order of the nodes, so that each group's root is its least node, whatever anchor it is seen from.
        node, f = np.concatenate(nodes), np.frombuffer(b"".join(raw), "<u8").reshape(-1, seeds)
        order = np.argsort(node)
        node, f = node[order], f[order]
        root = link_sketches(f, most, first)
        moved = np.flatnonzero(root != np.arange(len(root)))
        return node[moved], node[root[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, raw, told = None, [], [], _Stars()
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, node, sketches = np.asarray(batch.column("anchor")), np.asarray(batch.column("node")), batch.column("sketch").to_pylist()
            cuts = [0, *(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1).tolist(), len(anchor)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if anchor[s] != key and nodes:
                    yield from told.add(*stars(nodes, raw))
                    nodes, raw = [], []
                key = anchor[s]
                nodes.append(node[s:e])
                raw += sketches[s:e]
        if nodes:
            yield from told.add(*stars(nodes, raw))
        yield from told.close()

    return run


def link_sets(sets: list[np.ndarray], f: np.ndarray, root: np.ndarray, home: np.ndarray, similarity: float, most: int) -> np.ndarray:
    """root after the links of similar sets: of pairs with a home in them, not linked already, and near by their sketches f, each is decided exactly."""
    sizes, at, root = np.array([len(x) for x in sets]), np.arange(len(sets)), root.copy()
    for i in np.flatnonzero(home).tolist():
        fits = (root != root[i]) & ~(home & (at < i)) & (np.minimum(sizes, sizes[i]) >= similarity * np.maximum(sizes, sizes[i]) - 1e-9)
        js = np.flatnonzero(fits)
        js = js[np.bitwise_count(f[js] ^ f[i]).sum(axis=1, dtype=np.int64) <= most]
        for s in range(0, len(js), 1024):
            j = js[s : s + 1024]
            flat = np.concatenate([sets[k] for k in j.tolist()])
            found = sets[i][np.minimum(np.searchsorted(sets[i], flat), sizes[i] - 1)] == flat
            both = np.add.reduceat(found, np.cumsum(sizes[j]) - sizes[j], dtype=np.int64)
            hit = j[both >= similarity * (sizes[j] + sizes[i] - both) - 1e-9]
            root[np.isin(root, root[hit])] = root[i]
    return root


def _compare_sets(width: int, seeds: int, similarity: float, most: int):
    """Over rows sorted by (comp, share), each partition holding whole shares."""

    def stars(held: list) -> tuple[np.ndarray, np.ndarray]:
        held = sorted(held, key=lambda h: h[0])
        node, known, home, f = np.array([h[0] for h in held]), np.array([h[1] for h in held]), np.array([h[2] for h in held]), np.frombuffer(b"".join(h[3] for h in held), "<u8").reshape(-1, seeds)
        root = link_sets([h[4] for h in held], f, np.unique(known, return_inverse=True)[1], home, similarity, most)
        _, first, to = np.unique(root, return_index=True, return_inverse=True)
        moved = np.flatnonzero(first[to] != np.arange(len(root)))
        return node[moved], node[first[to[moved]]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, told = None, [], _Stars()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("comp", "share", "node", "known", "home", "sketch")]
            for comp, share, node, known, home, raw, text in zip(*columns, texts(batch.column("text")), strict=True):
                if (comp, share) != key and held:
                    yield from told.add(*stars(held))
                    held = []
                key = comp, share
                held.append((node, known, home, raw, shingles(text, width)))
        if held:
            yield from told.add(*stars(held))
        yield from told.close()

    return run


def _candidate_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text: str) -> DataFrame:
    """wanted (row_key, ...) with each row's text. Other texts are left out by a map of bits before any shuffle."""
    word, bit = F.shiftright(F.col("row_key").bitwiseAND((1 << MAP_BITS) - 1), 6).alias("word"), F.expr("shiftleft(1L, cast(row_key & 63 AS int))")
    bits = wanted.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    rows = docs.select(row_key(id_col, text).alias("row_key"), F.col(text).cast("string").alias("text")).select("row_key", "text", word)
    maybe = rows.join(F.broadcast(bits), "word").where(F.col("bits").bitwiseAND(bit) != 0).select("row_key", "text").dropDuplicates(["row_key"])
    return maybe.join(wanted.hint("merge"), "row_key")


def _similar_links(rows: DataFrame, width: int, seeds: int, similarity: float, most: int) -> DataFrame:
    """(node, root) over links of exact similarity within each comp of rows (comp, node, sketch, text), as components() gives it.

    A large comp is dealt into shares. First each share is compared within itself and with a few texts that go to all;
    what is then outside of the comp's largest group is compared with all shares. So no pair is left out, and a group
    of near copies is not compared with itself again in each share.
    """
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_for(rows, 1 << 22))
    busy = written(rows.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / SHARE_ROWS).cast("int").alias("shares")).where("shares > 1"), "busy")

    def compared(dealt: DataFrame, wanders) -> DataFrame:
        own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("shares")).cast("int")
        everywhere = F.sequence(F.lit(0), F.col("shares") - 1)
        spread = dealt.select("*", own.alias("own"), F.explode(F.when(wanders, everywhere).otherwise(F.array(own))).alias("share"))
        spread = spread.select("comp", "share", "node", "known", (F.col("share") == F.col("own")).alias("home"), "sketch", "text")
        return spread.repartition(n, "comp", "share").sortWithinPartitions("comp", "share").mapInArrow(_compare_sets(width, seeds, similarity, most), "a long, b long")

    dealt = rows.join(F.broadcast(busy), "comp", "left").withColumns({"shares": F.coalesce("shares", F.lit(1)), "known": F.col("node")})
    linked = components(compared(dealt, F.pmod(F.xxhash64("node", F.lit(2)), F.col("shares") * SHARE_ROWS) < COMMON))
    if busy.isEmpty():
        return linked
    known = rows.select("comp", "node").join(F.broadcast(busy), "comp").join(linked, "node", "left").select("comp", "shares", "node", F.coalesce("root", "node").alias("known"))
    known = written(known, "known")
    main = known.groupBy("comp", "known").count().groupBy("comp").agg(F.max_by("known", F.struct("count", "known")).alias("main"), F.count(F.lit(1)).alias("groups")).where("groups > 1")
    left = rows.join(known.drop("comp"), "node").join(F.broadcast(main.select("comp", "main")), "comp")
    return components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(compared(left, F.col("known") != F.col("main"))))


def similar(docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDE, seeds: int = SEEDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, component_id, row_key, group): groups of texts that links of a Jaccard similarity as asked connect, over distinct `width`-word shingles.

    Several fingerprints find the candidates; what they miss of pairs at the similarity asked is below one in a
    thousand. Each link is decided on the shingle sets themselves. Equal sets are one node, whatever their ids. Texts
    without words form one group. Null ids, repeated rows and empty tables are treated as near_duplicates() does.
    """

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(x, width) for x in texts(batch.column("text"))]
        nodes, raw = pa.array([node_of(h) for h in sets], pa.int64()), pa.array([sketch(h, seeds).astype("<u8").tobytes() for h in sets], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row_key"), nodes, raw], ["id", "row_key", "node", "sketch"])

    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    rows = text_of(docs, F.col(id_col).alias("id"), row_key(id_col, text).alias("row_key"), text=text)
    marked = written(map_batches(rows, kernel, f"id {kind}, row_key long, node long, sketch binary"), "sketches")
    classes = written(marked.groupBy("node", "sketch").agg(F.min("id").alias("least"), F.min("row_key").alias("row_key")), "classes")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_for(classes, 1 << 18))
    rows = map_batches(classes.select("node", "sketch").repartition(n), _sketch_anchors(seeds), "anchor long, node long, sketch binary")
    share, bits = share_of(similarity), 64 * seeds
    most, first = int(share * bits + DEVIATIONS * (bits * share * (1 - share)) ** 0.5), min(64, int(64 * share) + 16)
    stars = rows.repartition(n, "anchor").sortWithinPartitions("anchor").mapInArrow(_compare_sketches(seeds, most, first), "a long, b long")
    loose = components(stars)
    members = loose.select("node", F.col("root").alias("comp")).unionAll(loose.select(F.col("root").alias("node"), F.col("root").alias("comp")).distinct())
    wanted = written(members.join(classes.select("node", "sketch", "row_key"), "node"), "candidates")
    near = written(_candidate_texts(docs, wanted, id_col, text), "candidate-texts")
    roots = _similar_links(near, width, seeds, similarity, most)
    rooted = classes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("group"))
    least = rooted.groupBy("group").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "group").select("node", "component_id", "group")
    return marked.join(named, "node").select(F.col("id").alias(id_col), "component_id", "row_key", "group")


def keep_one(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The first row of each group, unchanged: the least id (null only where all ids are), of several texts with it the least row_key.

    groups: (id, component_id, row_key, group) for every row, as near_duplicates() and similar() give it. Groups tell rows
    apart by id and text, so that null and repeated ids neither merge groups nor lose them.
    """
    groups = written(groups.select(id_col, "component_id", "row_key", "group"), "groups")
    # The kept rows are a share of all, so they are never sent to every task: the join is a merge at any size.
    first = groups.where(F.col(id_col).eqNullSafe(F.col("component_id"))).groupBy("group").agg(F.min("row_key").alias("_row_key")).select("_row_key")
    kept = docs.withColumn("_row_key", row_key(id_col, text)).join(first.hint("merge"), "_row_key", "left_semi")
    repeated = groups.groupBy("row_key").count().where("count > 1").select(F.col("row_key").alias("_row_key"))
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    once = kept.join(repeated, "_row_key", "left_anti")
    return once.unionByName(kept.join(repeated, "_row_key", "left_semi").dropDuplicates(["_row_key"])).select(*docs.columns)
