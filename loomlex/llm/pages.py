"""Main-text extraction from HTML: boosted trees over DOM-node features, decoded over the hierarchy.

A page becomes a tree of block elements whose leaves are runs of text. For each node the trees give the probability that
it holds main text. Decoding keeps the most likely labelling in which whatever is kept has all its ancestors kept, so
that no choice for a node contradicts that for an ancestor or a descendant. The trees are fitted on pages that a seeded
generator writes, with their truth, in many shapes of markup.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gbt, pagegen
from .common import steps

#: Pages that the trees are fitted on; a bound of the generator, not of what is read.
TRAIN_PAGES, SEED = 1200, 11
_S = " \t\n\r\f"
#: An attribute as HTML reads it: a quote opens a value only after "=", and only if it is closed somewhere.
_PAIR = rf"[^{_S}/>][^{_S}/>=]*+(?:[{_S}]*+=[{_S}]*+(?:\"[^\"]*\"|'[^']*'|[^{_S}>]*+))?+"
_TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+>|<(/?)([a-zA-Z][^{_S}/>]*+)((?:[{_S}/]++|{_PAIR})*+)(?:>|\Z)", re.S)
_ATTR = re.compile(rf"([^{_S}/>][^{_S}/>=]*+)(?:[{_S}]*+=[{_S}]*+(?:\"([^\"]*)\"|'([^']*)'|([^{_S}>]*+)))?+")
_NAME_PART = re.compile(r"[a-z]+")
_RAW = {t: re.compile(rf"</{t}(?=[{_S}/>])[^>]*+(?:>|\Z)", re.I) for t in ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "object", "select", "xmp", "noembed", "noframes")}
#: Of these, what a page without the end tag loses from there on; the others then are tags like any.
_TO_THE_END = frozenset("script style textarea title iframe xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html head legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: What a start tag closes, by family: the nearest open one of the first set, unless one of the second is nearer.
_FAMILIES = (
    ({"p"}, frozenset("td th table caption button html body article section div main aside nav header footer form".split())),
    ({"li"}, _BLOCKS - {"li", "p", "div", "address"}),
    ({"dt", "dd"}, _BLOCKS - {"dt", "dd", "p", "div", "address"}),
    ({"tr"}, {"table"}),
    ({"td", "th"}, {"tr", "table"}),
    ({"tbody", "thead", "tfoot"}, {"table"}),
)
_CLOSES = {t: tuple(i for i, (own, _) in enumerate(_FAMILIES) if t in own or i == 0 and t != "button") for t in _BLOCKS}
_CLOSES |= {"tbody": (0, 5), "thead": (0, 5), "tfoot": (0, 5), "tr": (0, 3)}
_MARKS = {t: tuple(i for i, (own, stops) in enumerate(_FAMILIES) if t in own or t in stops) for t in _BLOCKS}
#: What is open outside of one of these is not closed by an end tag within it, tables' own tags excepted.
_FRAMES = frozenset("table td th caption".split())
_OF_TABLES = _FRAMES | {"tr", "tbody", "thead", "tfoot"}
#: Tokens of class, id and role that speak for and against main text.
GOOD = frozenset("article post entry content story main body text prose blog hentry copy page".split())
BAD = frozenset(
    "ad ads advert advertisement sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside widget footer foot header masthead topbar cookie cookies consent notice gdpr alert modal popup overlay comment comments respond reply disqus share sharing social follow related recommended more links tags tag cloud subscribe newsletter signup login form search copyright legal toolbar pagination pager skip".split()
)
#: Parts of a compound name by which it states something about the page or a place in it, as in has-sidebar.
STATES = frozenset("has no not with without is by on off open opened closed hidden visible ready enabled disabled active inactive fixed sticky left right top bottom single multi layout template wrap wrapper container mode type".split())
_GROUPS = ("#text", "p", "h1 h2 h3 h4 h5 h6", "li dt dd", "ul ol dl menu", "div center", "section", "article", "main", "nav", "header", "footer", "aside", "form fieldset button legend", "table tbody tr td th", "blockquote pre figure figcaption", "body html", "dialog details summary")
_GROUP_OF = {t: i for i, g in enumerate(_GROUPS) for t in g.split()}
_OVER = ("nav", "header", "footer", "aside", "form", "article", "main", "li")
N_FEATURES = len(_GROUPS) + len(_OVER) + 43
#: Text of which a node holds so much is the page's own: names on it speak of the page.
HEAVY = 0.5


class Node:
    __slots__ = ("tag", "parent", "kids", "good", "bad", "whole", "hedged", "mixed", "parts", "linked", "text", "near", "open", "chars", "links", "size", "words", "stops", "paras", "longest")

    def __init__(self, tag: str, parent: Node | None, good: int = 0, bad: int = 0, whole: int = 0, hedged: int = 0, mixed: int = 0):
        self.tag, self.parent, self.good, self.bad, self.whole, self.hedged, self.mixed = tag, parent, good, bad, whole, hedged, mixed
        self.kids: list[Node] = []
        self.parts: list[str] = []
        self.linked = 0
        self.text = ""
        # The nearest open node of each family, itself included; and how many are open by tag within its table cell.
        self.near: tuple = (None,) * len(_FAMILIES)
        self.open: dict[str, int] = {}


def _tokens_of(attributes: str) -> tuple[int, int, int, int, int]:
    """Names of class, id and role that speak for main text, against it (by a part; as a whole), against it but for stating something, and those that hold both kinds."""
    good = bad = whole = hedged = mixed = 0
    for a in _ATTR.finditer(attributes):
        if a[1].lower() in ("class", "id", "role", "itemprop"):
            for name in (a[2] or a[3] or a[4] or "").lower().split():
                parts = _NAME_PART.findall(name)
                for_, against = sum(t in GOOD for t in parts), sum(t in BAD for t in parts)
                if against and for_:
                    mixed += 1
                elif against and not STATES.isdisjoint(parts):
                    hedged += 1
                else:
                    good, bad, whole = good + for_, bad + against, whole + (name in BAD)
    return good, bad, whole, hedged, mixed


def parse(page: str) -> list[Node]:
    """The page's blocks and text runs in document order, the root first. Scripts, styles, forms' choices, titles and markup leave nothing.

    Each token takes constant time but for the nodes that it closes, whatever the depth.
    """
    root = Node("html", None)
    nodes, at, run, in_link, unclosed, cells = [root], root, None, 0, set(), Counter()
    i, n, find = 0, len(page), _TOKEN.search

    def text(piece: str) -> None:
        nonlocal run
        if run is None:
            run = Node("#text", at)
            at.kids.append(run)
            nodes.append(run)
        if "&" in piece:
            piece = entities.unescape(piece)
        run.parts.append(piece)
        if in_link:
            run.linked += len(piece)

    def close(up: Node) -> None:
        """Closes all that is open up to and including `up`."""
        nonlocal at
        while at is not up.parent:
            at.parent.open[at.tag] -= 1
            if at.tag in _OF_TABLES:
                cells[at.tag] -= 1
            at = at.parent

    while i < n:
        m = find(page, i)
        if m is None:
            text(page[i:])
            break
        if m.start() > i:
            text(page[i : m.start()])
        i = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name == "a":
                in_link = 0
            elif name == "br":
                text(" ")
            elif name in _BLOCKS and name not in ("body", "html", "head"):
                run = None
                if cells[name] if name in _OF_TABLES else at.open.get(name):
                    up = at
                    while up.tag != name:
                        up = up.parent
                    close(up)
                    in_link = 0
            continue
        if name in _RAW and name not in unclosed:
            end = _RAW[name].search(page, i)
            if end is None and name not in _TO_THE_END:
                unclosed.add(name)
            else:
                i = end.end() if end else n
            continue
        if name == "a":
            in_link = 1
            continue
        if name in _VOID:
            if name == "br":
                text(" ")
            elif name == "hr":
                run = None
            continue
        if name not in _BLOCKS:
            continue
        run, in_link = None, 0
        if name in ("html", "head") or name == "body" and at.open.get("body"):
            continue
        for family in _CLOSES[name]:
            up = at.near[family]
            if up is not None and up.tag in _FAMILIES[family][0]:
                close(up)
        up = at
        at = Node(name, up, *(_tokens_of(m[3]) if m[3] else (0, 0, 0, 0, 0)))
        if name == "body":  # never junk, whatever its names
            at.bad, at.whole, at.hedged = 0, 0, at.bad + at.hedged
        up.kids.append(at)
        nodes.append(at)
        up.open[name] = up.open.get(name, 0) + 1
        at.open = {} if name in _FRAMES else up.open
        if name in _OF_TABLES:
            cells[name] += 1
        marks = _MARKS[name]
        at.near = tuple(at if f in marks else x for f, x in enumerate(up.near)) if marks else up.near
    for x in nodes:
        if x.tag == "#text":
            x.text = " ".join("".join(x.parts).split())
            x.parts = []
    return nodes


def _kinds(nodes: list[Node]) -> np.ndarray:
    return np.array([_GROUP_OF.get(x.tag, 5) for x in nodes])


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node: its tag and those it stands in, tokens of its attributes, depth, text, links and sentences of its subtree, siblings, and what the page has."""
    for x in reversed(nodes):
        if x.tag == "#text":
            x.chars, x.links, x.size, x.paras = len(x.text), min(x.linked, len(x.text)), 1, 0
            x.words = x.longest = x.text.count(" ") + bool(x.text)
            x.stops = x.text.count(". ") + x.text.count(", ") + x.text.endswith((".", "!", "?"))
        else:
            x.chars = x.links = x.words = x.stops = x.longest = 0
            x.size, x.paras = 1, int(x.tag == "p")
            for k in x.kids:
                x.chars += k.chars
                x.links += k.links
                x.size += k.size
                x.words += k.words
                x.stops += k.stops
                x.paras += k.paras
                x.longest = max(x.longest, k.longest)
    root = nodes[0]
    total, paras = max(1, root.chars), max(1, root.paras)
    # What the page has at all: an absent article or main element lets other containers be the article's.
    has = tuple(sum(x.tag == t and not x.bad for x in nodes) for t in ("article", "main", "section")) + (sum(1 for x in nodes if x.good and not x.bad),)
    groups, over = len(_GROUPS), len(_OVER)
    out = np.zeros((len(nodes), N_FEATURES))
    out[np.arange(len(nodes)), _kinds(nodes)] = 1
    above: dict[int, tuple] = {id(root): (-1, (0,) * over, 0, 0, 0, 0, 0, 0)}
    place: dict[int, int] = {}
    clean: dict[int, tuple[int, int]] = {}  # of a node's children: text outside of links and of named junk, and how many are p
    for x in nodes:
        for k, y in enumerate(x.kids):
            place[id(y)] = k
        clean[id(x)] = sum(y.chars - y.links for y in x.kids if not y.bad), sum(y.tag == "p" for y in x.kids)
    for i, x in enumerate(nodes):
        up = x.parent
        if up is not None:
            d, flags, good, bad, hedged, of_page, hedged_of_page, named = above[id(up)]
            if up.tag in _OVER:
                flags = tuple(int(f or t == up.tag) for f, t in zip(flags, _OVER, strict=True))
            good += up.good
            if up.chars >= HEAVY * total:
                of_page, hedged_of_page = of_page + up.whole, hedged_of_page + up.bad - up.whole + up.hedged
            else:
                bad, hedged = bad + up.bad, hedged + up.hedged
            above[id(x)] = (d + 1, flags, good, bad, hedged, of_page, hedged_of_page, named or int(up.good > up.bad))
        d, flags, good, bad, hedged, of_page, hedged_of_page, named = above[id(x)]
        sibs = up.kids if up is not None else [x]
        k = place.get(id(x), 0)
        before, after = (sibs[k - 1] if k else None), (sibs[k + 1] if k + 1 < len(sibs) else None)
        chars = x.chars or 1
        out[i, groups:] = (
            *flags, x.good, x.bad, x.whole, x.hedged, x.mixed, good, bad, hedged, of_page, hedged_of_page, named, int(x.chars >= HEAVY * total), d, len(x.kids), x.chars, x.links / chars, x.chars / x.size, x.words, x.stops, x.stops / max(1, x.words), x.longest, x.chars / total, x.paras, x.paras / paras,
            k, len(sibs), *((before.words, before.bad, _GROUP_OF.get(before.tag, 5)) if before is not None else (-1, -1, -1)), *((after.words, after.bad, _GROUP_OF.get(after.tag, 5)) if after is not None else (-1, -1, -1)),
            *((up.chars, up.links / (up.chars or 1), x.chars / (up.chars or 1), _GROUP_OF.get(up.tag, 5), *clean[id(up)]) if up is not None else (-1, 0, 1, -1, 0, 0)), i / len(nodes), *has,
        )
    return out


def decode(nodes: list[Node], p: np.ndarray) -> list[Node]:
    """The text runs of the likeliest labelling that is closed upwards."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    yes, no = np.log(p).tolist(), np.log1p(-p).tolist()
    keep: dict[int, float] = {}
    for i in range(len(nodes) - 1, -1, -1):
        x = nodes[i]
        dropped, kept = no[i], yes[i]
        for k in x.kids:
            a, b = keep[id(k)], drop[id(k)]
            dropped += b
            kept += a if a > b else b
        if i == len(nodes) - 1:
            drop = {}
        keep[id(x)], drop[id(x)] = kept, dropped
    out = []
    stack = [nodes[0]]
    while stack:
        x = stack.pop()
        if x.parent is not None and keep[id(x)] <= drop[id(x)]:
            continue
        if x.tag == "#text":
            out.append(x)
        stack += reversed(x.kids)
    return out


@cache
def model(pages: int = TRAIN_PAGES, seed: int = SEED) -> gbt.Trees:
    """Fitted once per process on pages in all shapes of the generator; the same everywhere. A node's truth: whether it holds a block of the main text."""
    r = random.Random(seed)
    xs, ys = [], []
    for _ in range(pages):
        nodes = parse(pagegen.generate(r, mark=True)[0])
        y = {id(x): 0 for x in nodes}
        for x in nodes:
            if x.text.startswith(pagegen.MARK):
                x.text = x.text[len(pagegen.MARK) :]
                up = x
                while up is not None:
                    y[id(up)] = 1
                    up = up.parent
        xs.append(features(nodes))
        ys.append([y[id(x)] for x in nodes])
    return gbt.fit(np.concatenate(xs), np.concatenate(ys), trees=90, depth=6, rate=0.2, rows=0.3, columns=0.4, seed=seed)


def extract_many(pages: list[str | None], trees: gbt.Trees) -> Iterator[str]:
    """The main text of each page: blocks in page order, joined by one line feed; empty if there is none."""
    for a, b in steps([len(p or "") for p in pages]):
        trees_of = [parse(p or "") for p in pages[a:b]]
        p = trees.probability(np.concatenate([features(t) for t in trees_of]))
        at = 0
        for nodes in trees_of:
            yield "\n".join(x.text for x in decode(nodes, p[at : at + len(nodes)]) if x.text)
            at += len(nodes)


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, text, n_chars): the main text of every row's whole page.

    Null and empty pages, and pages without main text, have an empty text. Rows correspond one to one, repeated rows
    too; an empty table stays empty; other columns are ignored.
    """
    trees = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = list(extract_many(batch.column("html").to_pylist(), trees))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], ["id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)[id_col]
    rows = pages.select(F.col(id_col).alias("id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return rows.mapInArrow(run, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", id_col)
