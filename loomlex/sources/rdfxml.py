"""RDF/XML as a data source: format("rdfxml").load(path) gives triples.

A file is read by ranges of its bytes, each cut at children of the root (xmlranges). find() hands the subjects or predicates
it looks for down to the scan: children whose bytes can't hold them are not parsed. They go as options of a read of its
own, since Spark 4.1 lets two uses of one read in a plan overwrite each other's pushed filters. Only local paths and what the session's store names
are read; nothing that a file refers to is fetched. Nodes without a name are called by file and the place of their child
of the root, so that they are the same at every size of range.
"""

from __future__ import annotations

import hashlib
import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator
from itertools import batched
from urllib.parse import urljoin
from xml.parsers import expat
from xml.sax.saxutils import quoteattr

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.tables import RDF, TRIPLES, stored
from . import xmlranges

XML = "{http://www.w3.org/XML/1998/namespace}"
_R = "{" + RDF + "}"


def local_path(value: str) -> str:
    """value, or ValueError if it names anything but a local path."""
    if "://" in value or value.lower().startswith(("data:", "file:", "http:", "https:")):
        raise ValueError(f"not a local path: {value}")
    return value


def _iri(tag: str) -> str:
    return tag[1:].replace("}", "", 1) if tag[0] == "{" else tag


class _Graph:
    def __init__(self, base: str, prefix: str):
        self.base, self.prefix, self.place, self.count, self.out = base, prefix, "", 0, []

    def fresh(self) -> tuple[str, str]:
        self.count += 1
        return f"_:{self.prefix}{self.place}{self.count}", "bnode"  # no rdf:nodeID begins with a digit

    def resolve(self, value: str, base: str) -> str:
        return urljoin(base, value) if base else value

    def subject(self, e: ET.Element, base: str) -> tuple[str, str]:
        if (v := e.get(_R + "about")) is not None:
            return self.resolve(v, base), "iri"
        if (v := e.get(_R + "ID")) is not None:
            return self.resolve("#" + v, base), "iri"
        if (v := e.get(_R + "nodeID")) is not None:
            return f"_:{self.prefix}{v}", "bnode"
        return self.fresh()

    def put(self, s: tuple, p: str, o: str, kind: str, language: str | None = None, datatype: str | None = None) -> None:
        self.out.append((*s, p, o, kind, language, datatype))

    def node(self, e: ET.Element, base: str, language: str | None) -> tuple[str, str]:
        base, language = e.get(XML + "base", base), e.get(XML + "lang", language) or None
        s = self.subject(e, base)
        if e.tag != _R + "Description":
            self.put(s, RDF + "type", _iri(e.tag), "iri")
        for k, v in e.attrib.items():
            if k == _R + "type":
                self.put(s, RDF + "type", self.resolve(v, base), "iri")
            elif not k.startswith((_R, XML)) and k[0] == "{":
                self.put(s, _iri(k), v, "literal", language)
        item = 0
        for child in e:
            p = _iri(child.tag)
            if child.tag == _R + "li":
                item += 1
                p = f"{RDF}_{item}"
            self.property(s, p, child, base, language)
        return s

    def property(self, s: tuple, p: str, e: ET.Element, base: str, language: str | None) -> None:
        base, language = e.get(XML + "base", base), e.get(XML + "lang", language) or None
        how = e.get(_R + "parseType")
        if (v := e.get(_R + "resource")) is not None:
            self.put(s, p, self.resolve(v, base), "iri")
        elif (v := e.get(_R + "nodeID")) is not None:
            self.put(s, p, f"_:{self.prefix}{v}", "bnode")
        elif how == "Resource":
            o = self.fresh()
            self.put(s, p, *o)
            for child in e:
                self.property(o, _iri(child.tag), child, base, language)
        elif how == "Collection":
            items = [self.node(child, base, language) for child in e]
            cells = [self.fresh() for _ in items]
            self.put(s, p, *(cells[0] if cells else (RDF + "nil", "iri")))
            for i, (cell, o) in enumerate(zip(cells, items, strict=True)):
                self.put(cell, RDF + "first", *o)
                self.put(cell, RDF + "rest", *(cells[i + 1] if i + 1 < len(cells) else (RDF + "nil", "iri")))
        elif how == "Literal":
            text = (e.text or "") + "".join(ET.tostring(c, encoding="unicode") for c in e)
            self.put(s, p, text, "literal", None, RDF + "XMLLiteral")
        elif len(e):
            self.put(s, p, *self.node(e[0], base, language))
        else:
            own = {k: v for k, v in e.attrib.items() if k[0] == "{" and not k.startswith((_R, XML))}
            if own:
                o = self.fresh()
                self.put(s, p, *o)
                for k, v in own.items():
                    self.put(o, _iri(k), v, "literal", language)
            else:
                datatype = e.get(_R + "datatype")
                self.put(s, p, e.text or "", "literal", None if datatype else language, self.resolve(datatype, base) if datatype else None)


def parse(source, base: str = "", prefix: str = "") -> Iterator[tuple]:
    """Triples of an RDF/XML stream, node by node; each node's elements are dropped once it is read."""
    depth, root, g = 0, None, _Graph(base, prefix)
    for event, e in ET.iterparse(source, events=("start", "end")):
        if event == "start":
            if root is None:
                root = e
                g.base = e.get(XML + "base", base)
            depth += 1
            continue
        depth -= 1
        if root.tag != _R + "RDF":
            if depth == 0:
                g.node(e, g.base, None)
        elif depth == 1:
            g.node(e, g.base, root.get(XML + "lang"))
            root.clear()
        if g.out and depth <= 1:
            yield from g.out
            g.out = []


def parse_raw(source) -> Iterator[tuple]:
    """Elements as they stand, before they mean anything: their name as predicate, own text, own language; subject and datatype are left out."""
    root = None
    for event, e in ET.iterparse(source, events=("start", "end")):
        if root is None:
            root = e
        if event == "end":
            yield ("", "iri", _iri(e.tag), e.text or "", "literal", e.get(XML + "lang"), None)
            e.clear()


class _Part(InputPartition):
    """A range of a file, or the whole file where its root is no list of nodes or its bytes can't be cut."""

    def __init__(self, file: str, range_: tuple | None):
        self.file, self.range = file, range_


def prefix_of(file: str) -> str:
    """What begins the names of a file's nameless nodes, so that those of two files never meet."""
    return f"f{hashlib.md5(file.encode()).hexdigest()[:10]}."


class Head:
    """What a file's head says: the root's name, base, language, and the namespaces by prefix."""

    def __init__(self, raw: bytes):
        self.raw, self.names = raw, {}
        parser = ET.XMLPullParser(events=("start", "start-ns"))
        parser.feed(raw)
        parser.flush()
        for event, e in parser.read_events():
            if event == "start-ns":
                self.names[e[0]] = e[1]
            else:
                self.root = e
        self.is_list = self.root.tag == _R + "RDF"
        self.end = b"</" + re.search(rb"<([^\s<>/!?]+)(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>\s*\Z", raw)[1] + b">"


def head_at(fs, file: str, size: int) -> Head | None:
    """The head of a list of nodes; None for other roots, and for encodings whose bytes can't be cut."""
    with xmlranges.opened(fs, file) as f:
        raw = f.read(size)
    if raw[:2] in (b"\xff\xfe", b"\xfe\xff") or raw.rstrip().endswith(b"/>"):
        return None
    head = Head(raw)
    return head if head.is_list else None


def may_hold(raw: bytes, head: Head, subject: str | None, predicate: str | None) -> bool:
    """Whether a child of the root can give triples of a subject or predicate; False only if its bytes rule it out.

    A name's last letters and digits stand in the bytes as they are, unless they come from a reference, an empty
    reference to the base, or the head.
    """
    if re.search(rb"&(?!(?:amp|lt|gt|quot|apos);)", raw):
        return True
    if subject is not None and not subject.startswith("_:"):
        tail = re.search(r"[A-Za-z0-9]*\Z", subject)[0].encode()
        if tail and tail not in raw and tail not in head.raw:
            return False
    if predicate is not None and not predicate.startswith(RDF) and b"xmlns" not in raw:
        written = [(p + ":" if p else "") + predicate[len(ns) :] for p, ns in head.names.items() if predicate.startswith(ns) and len(ns) < len(predicate)]
        return any(w.encode() in raw for w in written)
    return True


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of TRIPLES by columns, as Spark takes them without a look at each row."""
    names = [c.split()[0] for c in TRIPLES.split(", ")]
    for some in batched(rows, 2000):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*some, strict=True)], names)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.base, self.raw = options["path"], options.get("base", ""), options.get("raw", "false") == "true"
        self.ranges = options.get("ranges")
        self.subjects, self.predicates = (json.loads(options.get(c, "null")) for c in ("subjects", "predicates"))
        self.parsed = 0

    def partitions(self) -> list[InputPartition]:
        fs, _ = xmlranges.filesystem(self.path)
        if self.ranges:
            import pyarrow.parquet as pq

            at_fs, at = xmlranges.filesystem(self.ranges)
            rows = pq.read_table(at, filesystem=at_fs).to_pylist()
            found = [(r["file"], r["number"], r["start"], r["stop"], r["head"], r["at"], r["depth"]) for r in rows]
        else:
            found = [(r.file, r.number, r.start, r.stop, r.head, r.head, 1) for r in xmlranges.plan(self.path, 1 << 62)]
        cut = {}
        for f, _, _, _, size, _, _ in found:
            if f not in cut:
                cut[f] = not self.raw and head_at(fs, f, size) is not None
        return [_Part(r[0], r if cut[r[0]] else None) for r in sorted(found) if cut[r[0]] or r[1] == 0]

    def read(self, part: _Part | None) -> Iterator[pa.RecordBatch]:
        if part is not None:  # Spark's stand-in for no partitions
            yield from _batches(self.rows(part))

    def rows(self, part: _Part) -> Iterator[tuple]:
        fs, _ = xmlranges.filesystem(self.path)
        if part.range is None:
            with xmlranges.opened(fs, part.file) as source:
                yield from parse_raw(source) if self.raw else parse(source, self.base, prefix_of(part.file))
            return
        r = xmlranges.Range(*part.range)
        with xmlranges.opened(fs, part.file) as file:
            head = head_at(fs, part.file, r.head)
            pairs = [(s, p) for s in self.subjects or [None] for p in self.predicates or [None]]
            kept = (e for e in xmlranges.elements(file, r) if any(may_hold(e.raw, head, s, p) for s, p in pairs))
            for _, _, _, triples in parse_elements(head, kept, self.base, prefix_of(part.file)):
                self.parsed += 1
                yield from triples


def parse_elements(head: Head, found: Iterator[xmlranges.Element], base: str = "", prefix: str = "", say: bool = True) -> Iterator[tuple[xmlranges.Element, ET.Element, str, list[tuple]]]:
    """(element, its tree, its base, its triples) of children of the root, which one parser reads after the head. say: whether the triples are wanted."""
    parser = ET.XMLPullParser(events=("start", "end"))
    parser.feed(head.raw)
    parser.flush()
    root = next(e for _, e in parser.read_events())
    g = _Graph(root.get(XML + "base", base), prefix)
    depth = 1
    for e in found:
        parser.feed(e.raw)
        parser.flush()
        for event, node in parser.read_events():
            depth += 1 if event == "start" else -1
            if event == "end" and depth == 1:
                g.place, g.count, g.out = f"{e.start}.", 0, []
                if say:
                    g.node(node, g.base, root.get(XML + "lang"))
                yield e, node, g.base, g.out
                root.clear()


class RdfXmlSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rdfxml"

    def schema(self) -> str:
        return TRIPLES

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def scan(spark: SparkSession, path: str, base: str = "", size: int = xmlranges.RANGE_BYTES, **options: str) -> DataFrame:
    """The triples of a file, or of a folder's files, by ranges of `size` bytes; a triple that is stated twice comes twice.

    Files that need more than one range are first read once for where their ranges begin.
    """
    spark.dataSource.register(RdfXmlSource)
    if any(n > size for _, n in xmlranges.files_of(path)):
        options["ranges"] = stored(xmlranges.ranges(spark, path, size), "xml-ranges").inputFiles()[0].rpartition("/")[0]
    return spark.read.format("rdfxml").options(base=base, **options).load(path)


def find(spark: SparkSession, path: str, subjects: list[str] | None = None, predicates: list[str] | None = None, base: str = "", size: int = xmlranges.RANGE_BYTES) -> DataFrame:
    """The distinct triples of some subjects, some predicates, or both; what can't hold any is not parsed. None stands for all, an empty list for none."""
    found = scan(spark, path, base, size, **{k: json.dumps(v) for k, v in (("subjects", subjects), ("predicates", predicates)) if v})
    for c, values in (("subject", subjects), ("predicate", predicates)):
        if values is not None:
            found = found.where(F.col(c).isin(values))
    return found.distinct()


def read_rdfxml(spark: SparkSession, path: str, base: str = "", size: int = xmlranges.RANGE_BYTES) -> DataFrame:
    """The distinct triples of a file, or of a folder's files."""
    return scan(spark, path, base, size).distinct()


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """(predicate, lexical, language) of all elements of a file, or of a folder's files, as they stand; for checks that come before any meaning."""
    spark.dataSource.register(RdfXmlSource)
    rows = spark.read.format("rdfxml").option("raw", "true").load(path)
    return rows.select("predicate", F.col("object").alias("lexical"), "language")


def from_string(spark: SparkSession, text: str, base: str = "") -> DataFrame:
    """Triples of a document at hand, for small graphs."""
    import io

    rows = list(parse(io.BytesIO(text.encode()), base))
    return spark.createDataFrame(rows, TRIPLES).distinct()


def findings_of_file(path: str) -> list[tuple[str, str]]:
    """(code, message) if a file is not well-formed; nothing of it is kept."""
    try:
        with open(path, "rb") as f:
            expat.ParserCreate().ParseFile(f)
    except expat.ExpatError as e:
        return [("malformed_xml", str(e))]
    return []


def unescape(c: Column) -> Column:
    """XML text without its five named references, the ampersand's last."""
    for name, to in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        c = F.replace(c, F.lit(f"&{name};"), F.lit(to))
    return c


_LOCAL = r"[A-Za-z_\u00C0-\uFFFD][A-Za-z0-9_.\u00B7-\uFFFD-]*$"
HEADER = '<?xml version="1.0" encoding="utf-8"?>\n<rdf:RDF xmlns:rdf="' + RDF + '">\n'
FOOTER = "</rdf:RDF>\n"


def _escaped(c: Column, quoted: bool = False) -> Column:
    """XML text, or an attribute's value, of a string."""
    for of, to in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;"), *((('"', "&quot;"), ("\n", "&#10;"), ("\t", "&#9;")) if quoted else ())):
        c = F.replace(c, F.lit(of), F.lit(to))
    return c


def _node_id(c: Column) -> Column:
    """A name that a file can give to a nameless node, another for each."""
    return F.concat(F.lit("b"), F.base64(F.encode(c, "utf-8")).cast("string"))


def node_name(c: Column) -> Column:
    plain = F.replace(F.replace(F.replace(_node_id(c), F.lit("+"), F.lit("-")), F.lit("/"), F.lit("_")), F.lit("="), F.lit("."))
    return F.regexp_replace(plain, r"\s", "")


#: Predicates whose namespaces a document's head declares; elements with others declare their own.
_DECLARED = 200
#: Namespaces that no prefix may be declared for.
_RESERVED = ("http://www.w3.org/XML/1998/namespace", "http://www.w3.org/2000/xmlns/")
_NO_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]"


def lines(triples: DataFrame, tags: dict[str, str] | None = None) -> DataFrame:
    """(subject, line): each triple as an element of its own; nameless nodes are called by rdf:nodeID. tags: names of predicates by prefixes that the head declares.

    A predicate that ends in no name, or a literal with characters that XML has not, fails.
    """
    name = F.regexp_extract("predicate", "(" + _LOCAL + ")", 1)
    space = F.col("predicate").substr(F.lit(1), F.length("predicate") - F.length(name))
    told = F.try_element_at(F.create_map(*(F.lit(x) for kv in tags.items() for x in kv)), F.col("predicate")) if tags else F.lit(None).cast("string")
    called = F.coalesce(told, F.concat(F.lit("p:"), name))
    fail = lambda what, c: F.raise_error(F.concat(F.lit(what), c))
    about = F.when(F.col("subject_kind") == "bnode", F.concat(F.lit('rdf:nodeID="'), node_name(F.col("subject")))).otherwise(F.concat(F.lit('rdf:about="'), _escaped(F.col("subject"), True)))
    tag = F.concat(F.lit('"><'), F.coalesce(told, F.concat(F.lit("p:"), name, F.lit(' xmlns:p="'), _escaped(space, True), F.lit('"'))))
    kind = F.when(F.col("language").isNotNull(), F.concat(F.lit(' xml:lang="'), _escaped(F.col("language"), True), F.lit('"'))).when(F.col("datatype").isNotNull(), F.concat(F.lit(' rdf:datatype="'), _escaped(F.col("datatype"), True), F.lit('"'))).otherwise("")
    value = (
        F.when(F.col("object_kind") == "iri", F.concat(F.lit(' rdf:resource="'), _escaped(F.col("object"), True), F.lit('"/>')))
        .when(F.col("object_kind") == "bnode", F.concat(F.lit(' rdf:nodeID="'), node_name(F.col("object")), F.lit('"/>')))
        .when(F.col("object").rlike(_NO_XML), fail("no XML text: ", F.col("object")))
        .otherwise(F.concat(kind, F.lit(">"), _escaped(F.col("object")), F.lit("</"), called, F.lit(">")))
    )
    line = F.when(told.isNull() & (F.length(name) == 0), fail("no XML name: ", F.col("predicate"))).otherwise(F.concat(F.lit("<rdf:Description "), about, tag, value, F.lit("</rdf:Description>")))
    return triples.select("subject", line.alias("line"))


_ORDER = ("subject", "predicate", "object", "language", "datatype")


def to_rdfxml(triples: DataFrame) -> Iterator[str]:
    """An RDF/XML document line by line, in order, for graphs that one reader takes; write_rdfxml() is for the others."""
    yield HEADER.rstrip("\n")
    for r in lines(triples.orderBy(*_ORDER)).toLocalIterator():
        yield r["line"]
    yield FOOTER.rstrip("\n")


def write_rdfxml(triples: DataFrame, path: str) -> dict:
    """Publishes triples as one document in parts (publish_lines), sorted by ranges of subjects; the manifest.

    The head declares their namespaces, so that an element neither repeats its own nor has to be parsed for it. The parts
    are read as one file (xmlranges.opened); join_parts() is for other readers.
    """
    from .publish import publish_lines

    prefixes, tags = {RDF: "rdf"}, {}
    for row in triples.select("predicate").distinct().orderBy("predicate").limit(_DECLARED).collect():
        found = re.fullmatch(r"([!-~]*?)([A-Za-z_][A-Za-z0-9_.-]*)", row["predicate"] or "")
        if found and found[1] and found[1] not in _RESERVED:
            tags[row["predicate"]] = f"{prefixes.setdefault(found[1], f'ns{len(prefixes)}')}:{found[2]}"
    head = HEADER[:-2] + "".join(f" xmlns:{p}={quoteattr(ns)}" for ns, p in prefixes.items() if ns != RDF) + HEADER[-2:]
    return publish_lines(lines(triples.distinct().orderBy(*_ORDER), tags).select("line"), path, head, FOOTER, ".rdf")
