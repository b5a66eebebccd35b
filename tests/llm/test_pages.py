"""Main text per shape of markup on held-out pages, on the supplied pages, and on broken, deep and long ones."""

import html
import random
import re
import time

import pytest

from loomlex.llm import pages, pagegen

WORDS = "the quick brown fox jumps over lazy dog while committee members discussed annual budget proposals and residents gathered near river to watch boats".split()


@pytest.fixture(scope="module")
def trees():
    return pages.model()


def texts(found, trees):
    return list(pages.extract_many(found, trees))


@pytest.mark.parametrize("shape", pagegen.SHAPES)
def test_each_shape_on_held_out_pages(trees, shape):
    r = random.Random(12345)
    held = [pagegen.generate(r, shape) for _ in range(200)]
    out = texts([p for p, _ in held], trees)
    assert sum(o == t for o, (_, t) in zip(out, held, strict=True)) >= 0.95 * len(held)


@pytest.mark.parametrize("around", ["<article>{}</article>", "<div id=story>{}</div>", "<div>{}</div>", "<section>{}</section>", "{}", "<main>{}</main>", "<table><tr><td>{}</td></tr></table>", "<center>{}</center>", "<div><div>{}</div></div>"])
def test_ordinary_english_in_any_container(trees, around):
    r = random.Random(5)
    sentence = lambda lo, hi: " ".join(r.choice(WORDS) for _ in range(r.randint(lo, hi))).capitalize() + "."
    found, want = [], []
    for _ in range(40):
        title, paragraphs = sentence(3, 6), [" ".join(sentence(6, 16) for _ in range(r.randint(1, 5))) for _ in range(r.randint(2, 10))]
        body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
        top = r.choice(['<nav><a href="/">Home</a> <a href="/a">About</a></nav>', "<header><h2>Daily Site</h2></header><nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>"])
        end = r.choice(["<footer>Copyright 2024 Daily Site. All rights reserved.</footer>", '<aside><h3>Related</h3><p>Read more about boats.</p></aside><div class="comments"><p>Great post, thanks for it!</p></div>'])
        found.append(f"<html><head><title>x</title></head><body>{top}{around.format(body)}{end}</body></html>")
        want.append("\n".join([title, *paragraphs]))
    assert sum(a == b for a, b in zip(texts(found, trees), want, strict=True)) >= 38


STATED = ["", "has-sidebar", "no-sidebar", "comments-open", "single-post with-header", "side-menu-closed", "modal-ready", "page-with-sidebar", "site has-footer", "layout sidebar-left", "content-sidebar-wrap", "sidebar-container", "x-ad-y", "js no-touch menu-collapsed"]


@pytest.mark.parametrize("name", STATED)
@pytest.mark.parametrize("around", ["<body class='{n}'>{t}<article>{a}</article>{e}</body>", "<body>{t}<div class='{n}'><article>{a}</article></div>{e}</body>", "<body class={n!r}>{t}<div id='{n}'><div>{a}</div></div>{e}</body>"])
def test_names_on_bodies_and_wrappers_lose_no_article(trees, around, name):
    blocks = [
        "<h1>The annual budget meeting</h1>", "<p>The committee members discussed the annual budget proposals, and residents gathered near the river to watch.</p>", "<h2><a href=/x>More about the boats</a></h2>",
        "<p>While the quick brown fox jumps over the lazy dog, the council voted on the new plan for boats and bridges.</p>", "<p><a href=/x>Read the whole report here</a>.</p>",
        "<div class='side-by-side'><p>One side of the story is told here in a few plain words.</p></div>", "<div class='content-header'><p>Another part of the story is told in a few words here.</p></div>", "<p>The last words were spoken by the mayor, who was there.</p>",
    ]
    top, end = "<nav><ul><li><a href=/>Home</a></li><li><a href=/b>News</a></li></ul></nav>", "<footer>Copyright 2024 Daily Site. All rights reserved.</footer>"
    page = "<html>" + around.format(n=name, t=top, a="".join(blocks), e=end) + "</html>"
    assert texts([page], trees) == ["\n".join(re.sub(r"<[^>]+>", "", b) for b in blocks)]


def test_every_supplied_page(spark, trees):
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("html").collect()
    out = texts([r[0] for r in rows], trees)
    for r, o in zip(rows, out, strict=True):
        article = r[0][r[0].index("<article>") + 9 : r[0].index("</article>")].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert o == "\n".join(x for x in blocks if x)


def runs(page):
    return [x.text for x in pages.parse(page) if x.tag == "#text" and x.text]


def test_attributes_as_html_reads_them():
    assert runs("<p don't>Hello, it's me</p><p>and 'you'</p>") == ["Hello, it's me", "and 'you'"]
    assert runs('<p title="a b>One</p><p>Two</p>') == ["One", "Two"]
    assert runs('<p title="a > b">One</p><p class=x\'>Two</p>') == ["One", "Two"]
    assert runs("<p title='a > b' x = \"c>\" / y>One<br/>two</p>") == ["One two"]
    assert runs("a < b <!--> c --> d <!-- e > --> f</> g </3 x> h") == ["a < b c --> d f g h"]
    assert runs("<p>AT&am<b>p;T &amp;lt; &#x41;&nbsp;x</b>") == ["AT&amp;T &lt; A x"]


def test_tags_that_are_left_open():
    assert runs("<svg><p>One<select>Two<p>Three") == ["OneTwo", "Three"]
    assert runs("<p>One<script>var a = '<p>no'") == ["One"]
    assert runs("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>e<td>f<tr><td>g</div>h</table>") == ["a", "b", "c", "d", "e", "f", "g", "h"]
    tree = pages.parse("<div><table><tr><td>a</div>b</table>c</div>d")
    assert [x.parent.tag for x in tree if x.tag == "#text"] == ["td", "td", "div", "html"]


@pytest.mark.parametrize("page", ["<div>" * 40000 + "x" + "</div>" * 40000, "<ul>" * 40000, "<ul><li>" * 20000 + "</p></section>" * 20000, "<p><button>" + "<ul>" * 20000, "<p>" + "word " * 400000, '<p a="' * 20000, "<svg>" * 20000, "<!--" * 20000, "<p x='" + "y" * 500000])
def test_deep_and_long_pages_take_time_in_proportion(trees, page):
    start = time.process_time()
    texts([page], trees)
    assert time.process_time() - start < 20


def test_nothing_to_extract(trees):
    assert texts([None, "", " ", "<nav>Home</nav>", "<script>x"], trees)[:3] == ["", "", ""]
