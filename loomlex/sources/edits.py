"""Changes of triples inside RDF/XML files: only the elements that state them change, every other byte stays.

An index gives, for each child of the root and each property in it, where it stands and what it says. Removed triples meet
it by a join and become spans to cut, added ones places to insert at; a pair of them that is one for one under subject and
predicate replaces the text in its place. A file is cut where children of the root begin, and each piece's edits, sorted by
place, are spliced in by a task, which streams the piece past them: its memory does not grow with the piece or the edits.
The pieces of a file are then written one after the other; those of a publication stay its parts, so that no byte is
written twice. Nothing passes the driver but totals.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.tables import RDF, XSD, null_safe, stored
from . import xmlranges
from .rdfxml import _Graph, _iri, _R, head_at, parse_elements, prefix_of

_STATED = ["subject", "subject_kind", "predicate", "object", "object_kind", "language", "datatype"]
INDEX = "file string, block_start long, block_end long, last_child long, start long, end long, " + ", ".join(f"{c} string" for c in _STATED)
_KEYS = ["subject", "predicate", "object", "object_kind", "language", "datatype"]
_NAME = re.compile("[A-Za-z_\u00C0-\uFFFD][A-Za-z0-9_.\u00B7-\uFFFD-]*\\Z")
#: How far around an element its line is looked for.
_LINE = 4096


def index(spark: SparkSession, path: str, base: str = "", size: int = xmlranges.RANGE_BYTES) -> DataFrame:
    """INDEX: a row for each property of each child of the root, and one without a property for a child that has none.

    A property that holds a nested node has that node for its object. ValueError for files that can't be cut by bytes.
    """
    ranges = stored(xmlranges.ranges(spark, path, size), "xml-ranges")
    fs, _ = xmlranges.filesystem(path)
    for file, length in xmlranges.files_of(path):
        with xmlranges.opened(fs, file) as f:
            if head_at(fs, file, xmlranges.head_of(f)) is None:
                raise ValueError(f"{file}: not a list of nodes in an encoding that can be cut, {length} bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = xmlranges.filesystem(path)
        for batch in batches:
            for row in batch.to_pylist():
                r = xmlranges.Range(**row)
                out = []
                with xmlranges.opened(fs, r.file) as file:
                    head = head_at(fs, r.file, r.head)
                    for e, node, at, _ in parse_elements(head, xmlranges.elements(file, r), base, prefix_of(r.file), say=False):
                        out += _properties(r.file, e, node, at)
                        if len(out) > 5000:
                            yield _batch(out)
                            out = []
                if out:
                    yield _batch(out)

    return ranges.repartitionByRange(max(1, ranges.count()), "file", "number").mapInArrow(run, INDEX)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in INDEX.split(", ")]
    kinds = [pa.int64() if c.endswith(" long") else pa.string() for c in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _properties(file: str, e: xmlranges.Element, node, base: str) -> list[tuple]:
    # The same names for nested nodes as the scan gives, which counts along the whole child of the root.
    g = _Graph(base, prefix_of(file))
    g.place = f"{e.start}."
    subject = g.subject(node, node.get("{http://www.w3.org/XML/1998/namespace}base", base))
    block = (file, e.start, e.start + len(e.raw), e.children[-1][0] if e.children else None)
    language = node.get("{http://www.w3.org/XML/1998/namespace}lang")
    out = []
    for child, (a, b) in zip(node, e.children, strict=True):
        g.out = []
        g.property(subject, _iri(child.tag), child, node.get("{http://www.w3.org/XML/1998/namespace}base", base), language)
        own = [t for t in g.out if t[0] == subject[0] and t[2] == _iri(child.tag)]
        if child.tag != _R + "li" and own:
            out.append((*block, a, b, *own[0]))
    return out or [(*block, None, None, *subject, None, None, None, None, None)]


def _plain(rows: DataFrame) -> DataFrame:
    same = (F.col("datatype") == XSD + "string") & F.col("language").isNull()
    return rows.withColumn("datatype", F.when(same, None).otherwise(F.col("datatype")))


EDIT = "file string, block long, at long, until long, kind string, last_child long, " + ", ".join(f"{c} string" for c in _STATED) + ", old_language string, old_datatype string"


def plan(found: DataFrame, removed: DataFrame, added: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(EDIT rows, the removed triples that no element states) of an index and of triples to remove and to add.

    Strings with and without their datatype are the same. An added triple goes into the first element about its subject;
    subjects without one get an element at the end of the first file.
    """
    removed, added = (_plain(x.select(*_STATED)).distinct() for x in (removed, added))
    stated = _plain(found).where("start IS NOT NULL").withColumn("_d", F.col("datatype"))
    gone = null_safe(stated, removed, _KEYS, "left_semi")
    unmatched = null_safe(removed, stated, _KEYS, "left_anti")
    one = W.partitionBy("subject", "predicate")
    # Stored, as what follows uses them several times and each use would meet the whole index again.
    gone = stored(gone.withColumn("_n", F.count(F.lit(1)).over(one)), "gone")
    came = stored(added.withColumn("_n", F.count(F.lit(1)).over(one)), "came")
    literal = "object_kind = 'literal' AND _n = 1"
    old = gone.where(literal).select("subject", "predicate", F.col("language").alias("old_language"), F.col("datatype").alias("old_datatype"), "file", F.col("block_start").alias("block"), F.col("start").alias("at"), F.col("end").alias("until"))
    swapped = stored(came.where(literal).drop("_n").join(old, ["subject", "predicate"]).withColumn("kind", F.lit("replace")).withColumn("last_child", F.lit(None).cast("long")), "swapped")
    pair = swapped.select("subject", "predicate").distinct()
    none = {c: F.lit(None).cast("string") for c in ("old_language", "old_datatype")}
    cut = gone.drop("_n").join(pair, ["subject", "predicate"], "left_anti").select(*_STATED, "file", F.col("block_start").alias("block"), F.col("start").alias("at"), F.col("end").alias("until"), F.lit("remove").alias("kind"), F.lit(None).cast("long").alias("last_child")).withColumns(none)
    blocks = found.groupBy("subject", "subject_kind").agg(F.min(F.struct("file", "block_start", "block_end", "last_child")).alias("b"))
    more = came.drop("_n").join(pair, ["subject", "predicate"], "left_anti")
    into = more.join(blocks, ["subject", "subject_kind"], "left")
    ends = found.groupBy("file").agg(F.max("block_end").alias("_end"), F.max("block_start").alias("_last")).agg(F.min(F.struct("file", "_end", "_last")).alias("e"))
    first = into.where("b IS NOT NULL").select(*_STATED, F.col("b.file").alias("file"), F.col("b.block_start").alias("block"), F.col("b.block_start").alias("at"), F.col("b.block_end").alias("until"), F.lit("insert").alias("kind"), F.col("b.last_child").alias("last_child")).withColumns(none)
    fresh = into.where("b IS NULL").join(F.broadcast(ends)).select(*_STATED, F.col("e.file").alias("file"), F.col("e._last").alias("block"), F.col("e._end").alias("at"), F.col("e._end").alias("until"), F.lit("node").alias("kind"), F.lit(None).cast("long").alias("last_child")).withColumns(none)
    columns = [c.split()[0] for c in EDIT.split(", ")]
    return swapped.select(*columns).unionByName(cut.select(*columns)).unionByName(first.select(*columns)).unionByName(fresh.select(*columns)), unmatched


class _Splicer:
    """Writes a piece of a file anew past its edits, which come sorted by the place that they take effect at. stop: None for the file's end."""

    def __init__(self, fs, file: str, out, salt: str, start: int, stop: int | None):
        self.source, self.out, self.salt, self.at = xmlranges.opened(fs, file), out, salt, start
        self.head = head_at(fs, file, xmlranges.head_of(self.source))
        self.stop = self.source.size() if stop is None else stop
        self.prefixes = {ns: p for p, ns in self.head.names.items() if p}
        #: The element that properties are being added to: its insertion's place, indent, and what closes it.
        self.open_at, self.indent, self.tail = -1, b"", b""
        self.node: tuple | None = None

    def read(self, a: int, b: int) -> bytes:
        self.source.seek(a)
        return self.source.read(max(0, b - a))

    def copy(self, to: int) -> None:
        self.source.seek(self.at)
        while self.at < to:
            piece = self.source.read(min(1 << 20, to - self.at))
            if not piece:
                break
            self.out.write(piece)
            self.at += len(piece)

    def tag(self, predicate: str) -> tuple[str, str]:
        """The name of a property's element, and the declaration that it needs, if any."""
        spaces = [ns for ns in self.prefixes if predicate.startswith(ns) and _NAME.match(predicate[len(ns) :])]
        if spaces:
            ns = max(spaces, key=len)
            return f"{self.prefixes[ns]}:{predicate[len(ns) :]}", ""
        m = _NAME.search(predicate)
        if m is None:
            raise ValueError(f"no XML name: {predicate}")
        return f"n0:{m[0]}", f" xmlns:n0={quoteattr(predicate[: m.start()])}"

    def rdf(self, name: str) -> str:
        return f"{self.prefixes[RDF]}:{name}"

    def node_id(self, name: str) -> str:
        """What a nameless node from elsewhere is called in this file."""
        return "m" + hashlib.sha256(f"{self.salt}\x1f{name}".encode()).hexdigest()[:24]

    def element(self, e: dict) -> bytes:
        tag, more = self.tag(e["predicate"])
        if e["object_kind"] == "iri":
            return f"<{tag}{more} {self.rdf('resource')}={quoteattr(e['object'])}/>".encode()
        if e["object_kind"] == "bnode":
            return f"<{tag}{more} {self.rdf('nodeID')}={quoteattr(self.node_id(e['object']))}/>".encode()
        kind = f" xml:lang={quoteattr(e['language'])}" if e["language"] else f" {self.rdf('datatype')}={quoteattr(e['datatype'])}" if e["datatype"] else ""
        return f"<{tag}{more}{kind}>{escape(e['object'], {chr(13): '&#13;'})}</{tag}>".encode()

    def line_of(self, a: int, b: int) -> tuple[int, int, bytes]:
        """The line that holds nothing but bytes a to b, with its indent; else those bytes themselves."""
        before, after = self.read(max(0, a - _LINE), a), self.read(b, b + _LINE)
        indent = re.search(rb"(?:\n|\A)([ \t]*)\Z", before)
        rest = re.match(rb"[ \t]*\r?\n", after)
        whole = indent is not None and (before[: indent.start(1)].endswith(b"\n") or a - len(before) == 0)
        return (a - len(indent[1]), b + rest.end(), indent[1]) if whole and rest else (a, b, indent[1] if whole else b"")

    def close(self) -> None:
        """Ends what insertions are being made into."""
        if self.open_at >= 0:
            self.out.write(self.tail)
            self.open_at, self.tail = -1, b""

    def replace(self, e: dict) -> None:
        raw = self.read(e["at"], e["until"])
        start = re.match(rb"<(?:[^\"'>]|\"[^\"]*\"|'[^']*')*>", raw)[0]
        same = e["language"] == e["old_language"] and e["datatype"] == e["old_datatype"] and not start.endswith(b"/>")
        self.copy(e["at"])
        self.out.write(start + escape(e["object"], {"\r": "&#13;"}).encode() + raw[raw.rindex(b"</") :] if same else self.element(e))
        self.at = e["until"]

    def remove(self, e: dict) -> None:
        a, b, _ = self.line_of(e["at"], e["until"])
        self.copy(max(a, self.at))
        self.at = b

    def insert(self, e: dict) -> None:
        """Before the end tag of the element at `at`, in a line of its own if the end tag has one."""
        if self.open_at != e["at"]:
            self.close()
            self.open_at = e["at"]
            raw = self.read(max(e["at"], e["until"] - _LINE), e["until"])
            if raw.endswith(b"/>"):
                name = re.match(rb"<([^\s/>]+)", self.read(e["at"], e["at"] + _LINE))[1]
                self.copy(e["until"] - 2)
                self.at = e["until"]
                _, _, outer = self.line_of(e["at"], e["until"])
                self.out.write(b">\n")
                self.indent, self.tail = outer + b"    ", outer + b"</" + name + b">"
            else:
                end = e["until"] - len(raw) + raw.rindex(b"</")
                before = self.read(max(e["at"], end - _LINE), end)
                alone = re.search(rb"\n([ \t]*)\Z", before)
                child = self.line_of(e["last_child"], e["last_child"])[2] if e["last_child"] is not None else b""
                self.copy(end - len(alone[1]) if alone else end)
                self.indent = (child or alone[1] + b"    ") if alone else None
        self.out.write(self.element(e) if self.indent is None else self.indent + self.element(e) + b"\n")

    def add_node(self, e: dict) -> None:
        """An element of its own before the root's end tag, as many lines as it has properties."""
        key = (e["subject"], e["subject_kind"])
        if self.node is None:
            window = xmlranges.Window(self.source, e["at"])
            t = window.token(e["at"])
            while t is not None and t[2] >= 0:
                t = window.token(t[1])
            if t is None:
                raise ValueError("no end of the root")
            self.copy(t[0])
        if self.node != key:
            self._end_node()
            about = f"{self.rdf('nodeID')}={quoteattr(self.node_id(e['subject']))}" if e["subject_kind"] == "bnode" else f"{self.rdf('about')}={quoteattr(e['subject'])}"
            self.out.write(f"<{self.rdf('Description')} {about}>\n".encode())
            self.node = key
        self.out.write(b"    " + self.element(e) + b"\n")

    def _end_node(self) -> None:
        if self.node is not None:
            self.out.write(f"</{self.rdf('Description')}>\n".encode())

    def edit(self, e: dict) -> None:
        if e["kind"] != "insert":
            self.close()
        {"replace": self.replace, "remove": self.remove, "insert": self.insert, "node": self.add_node}[e["kind"]](e)

    def finish(self) -> None:
        self.close()
        self._end_node()
        self.copy(self.stop)
        self.source.close()


def _pieces(found: DataFrame, files: DataFrame, size: int) -> DataFrame:
    """(file, piece, start, stop): where a file is cut, at the first child of the root that begins in each stretch of `size` bytes; no edit reaches from one piece into another."""
    cuts = found.groupBy("file", F.floor(F.col("block_start") / size).alias("piece")).agg(F.min("block_start").alias("start"))
    w = W.partitionBy("file").orderBy("piece")
    told = cuts.select("file", "piece", F.when(F.row_number().over(w) == 1, F.lit(0).cast("long")).otherwise(F.col("start")).alias("start"), F.lead("start").over(w).alias("stop"))
    return files.join(told, "file", "left").select("file", F.coalesce("piece", F.lit(0).cast("long")).alias("piece"), F.coalesce("start", F.lit(0).cast("long")).alias("start"), "stop")


class _Digested:
    """A stream that tells what went through it."""

    def __init__(self, out):
        self.out, self.digest = out, hashlib.sha256()

    def write(self, piece: bytes) -> None:
        self.digest.update(piece)
        self.out.write(piece)

    def close(self) -> None:
        self.out.close()


def _publish(fs, at: str, drafts: list[dict]) -> None:
    """Moves a document's pieces into place as its parts, the manifest last; those that a task before this one moved are there."""
    from pyarrow.fs import FileType

    fs.create_dir(at)
    names = [f"part-{k:06d}.rdf" for k in range(len(drafts))]
    for name, piece in zip(names, drafts, strict=True):
        if fs.get_file_info(piece["draft"]).type == FileType.File:
            fs.move(piece["draft"], f"{at}/{name}")
    content = hashlib.sha256("\x1f".join(piece["digest"] for piece in drafts).encode()).hexdigest()
    draft = f"{at}/_{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(draft) as out:
        out.write(json.dumps({"content": content, "parts": names}, sort_keys=True).encode())
    fs.move(draft, f"{at}/{xmlranges.MANIFEST}")


def splice(spark: SparkSession, path: str, to: str, found: DataFrame, edits: DataFrame, salt: str = "", size: int = xmlranges.RANGE_BYTES) -> DataFrame:
    """(file, kind, n): writes the file at path, or a folder's files, anew to `to` with the edits; stored. found: its index.

    The salt tells apart nameless nodes of different merges. Files without edits are copied. A task writes a piece of a
    file, of `size` bytes or more, beside the file's place; one task for each file writes its pieces one after the other
    and moves the file into place when it is whole, so a task that runs again does no harm. A publication gives a
    publication, whose parts are the pieces; FileExistsError if `to` holds one.
    """
    listed = xmlranges.files_of(path)
    in_parts = xmlranges.parts_of(*xmlranges.filesystem(path)) is not None
    if in_parts and xmlranges.parts_of(*xmlranges.filesystem(to)) is not None:
        raise FileExistsError(f"{to} holds a publication")
    size = max(size, -(-max(n for _, n in listed) // xmlranges.MOST_RANGES))
    pieces = _pieces(found, spark.createDataFrame(listed, "file string, _size long").select("file"), size)
    # Each piece has a row that begins it; an insertion takes effect at the end of its element, behind all that changes within it.
    blank = pieces.select("*", F.lit(-1).cast("long").alias("_place"), *(F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in EDIT.split(", ")[1:]))
    place = F.when(F.col("kind") == "insert", F.col("until") - 1).otherwise(F.col("at"))
    rank = F.when(F.col("kind") == "node", 1).otherwise(0)
    none = F.lit(None).cast("long")
    rows = edits.select("*", place.alias("_place"), F.floor(F.col("block") / size).alias("piece"), none.alias("start"), none.alias("stop")).unionByName(blank)
    count = sum(-(-n // size) for _, n in listed)
    dealt = rows.repartitionByRange(max(1, count), "file", "piece").sortWithinPartitions("file", "piece", "_place", rank, "subject_kind", "subject", "predicate", "object", "language", "datatype")
    single = len(listed) == 1 and path.rstrip("/").endswith(listed[0][0].rpartition("/")[2])

    def target_of(file: str) -> str:
        at = xmlranges.filesystem(to)[1]
        return at if single else f"{at.rstrip('/')}/{file.rpartition('/')[2]}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = xmlranges.filesystem(path)
        out_fs, _ = xmlranges.filesystem(to)
        splicer = draft = stream = now = None
        told: dict[str, int] = {}

        def done() -> pa.RecordBatch:
            splicer.finish()
            stream.close()
            counts = sorted(told.items())
            return pa.RecordBatch.from_pydict({"file": [now[0]] * len(counts), "piece": [now[1]] * len(counts), "draft": [draft] * len(counts), "digest": [stream.digest.hexdigest()] * len(counts), "kind": [k for k, _ in counts], "n": [n for _, n in counts]})

        for batch in batches:
            for e in batch.to_pylist():
                if (e["file"], e["piece"]) != now:
                    if now is not None:
                        yield done()
                    now, told = (e["file"], e["piece"]), {"copied": 0}
                    folder = target_of(e["file"]).rpartition("/")[0]
                    out_fs.create_dir(folder or "/")
                    draft = f"{folder}/_{uuid.uuid4().hex}.tmp"
                    stream = _Digested(out_fs.open_output_stream(draft))
                    splicer = _Splicer(fs, e["file"], stream, salt, e["start"], e["stop"])
                if e["kind"] is not None:
                    splicer.edit(e)
                    told[e["kind"]] = told.get(e["kind"], 0) + 1
        if now is not None:
            yield done()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_fs, _ = xmlranges.filesystem(to)
        for batch in batches:
            for row in batch.to_pylist():
                target = target_of(row["file"])
                if in_parts:
                    _publish(out_fs, target, row["drafts"])
                    continue
                whole = f"{target.rpartition('/')[0]}/_{uuid.uuid4().hex}.tmp"
                with out_fs.open_output_stream(whole) as out:
                    for piece in row["drafts"]:
                        with out_fs.open_input_stream(piece["draft"]) as f:
                            while part := f.read(1 << 20):
                                out.write(part)
                out_fs.move(whole, target)
            yield batch

    done = stored(dealt.mapInArrow(run, "file string, piece long, draft string, digest string, kind string, n long"), "spliced")
    drafts = done.where("kind = 'copied'").groupBy("file").agg(F.array_sort(F.collect_list(F.struct("piece", "draft", "digest"))).alias("drafts"))
    joined = stored(drafts.repartition(len(listed), "file").mapInArrow(join, drafts.schema), "joined")
    out_fs, _ = xmlranges.filesystem(to)
    if not in_parts:
        for row in joined.select(F.explode("drafts.draft").alias("draft")).toLocalIterator():
            out_fs.delete_file(row["draft"])
    return done.where("kind <> 'copied'").groupBy("file", "kind").agg(F.sum("n").alias("n"))


def change(spark: SparkSession, path: str, to: str, removed: DataFrame, added: DataFrame, base: str = "", size: int = xmlranges.RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Writes the files at path to `to` without the removed and with the added triples: (file, kind, n), and the removed triples that no element states on its own."""
    found = stored(index(spark, path, base, size), "xml-index")
    edits, unmatched = plan(found, removed, added)
    salt = hashlib.sha256(repr(xmlranges.files_of(path)).encode()).hexdigest()
    return splice(spark, path, to, found, stored(edits, "edits"), salt, size), unmatched


def merge(spark: SparkSession, path: str, to: str, ours: DataFrame, relation_prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """change() by what merge_diff() finds in our triples against those of the files at path: all its kinds of changes, written into their bytes."""
    from ..operators import changes
    from .rdfxml import read_rdfxml

    ours, theirs = stored(ours, "ours"), stored(read_rdfxml(spark, path), "theirs")
    merged = stored(changes.apply_merge(ours, theirs, changes.merge_diff(ours, theirs, relation_prefix)), "merged")
    before = _plain(theirs).select(*merged.columns)
    sides = stored(changes.one_sided(before, merged), "sides")
    return change(spark, path, to, *(sides.where(F.col("side") == side).drop("side") for side in ("removed", "added")))
