"""Ranges of XML files against a parser that reads the file whole, at every size of range, with all that can hide a tag."""

import io
import random
import xml.etree.ElementTree as ET

import pytest

from loomlex.sources import xmlranges as x

HEAD = b"<?xml version='1.0'?>\n<!-- <rdf:RDF> -->\n<!DOCTYPE r [<!ENTITY a 'x>]>'> <!-- ]> --> <!ENTITY b \"y\">]>\n<r a='>' b=\"'>\">"
ODD = [b"<!-- <c> --> ", b"<![CDATA[</a><b>]]>", b"<?pi <x> ?>", b"text > ]]&gt; ", b"<e/>", b"<e a='/>' b=\"<!--\"/>".replace(b"<!--", b"&lt;!--"), b"\n  ", b"<f g='a\"b'>t</f>", "é".encode()]


def made(r, n):
    def node(depth):
        inner = b"".join(r.choice(ODD) if depth == 0 or r.random() < 0.6 else node(depth - 1) for _ in range(r.randint(0, 4)))
        return b"<n k='%d>'>" % r.randrange(99) + inner + b"</n >"

    return HEAD + b"".join(r.choice([node(3), node(1), b"<e/>", b"<!-- <n> -->", b"\n", b"<?p </r> ?>"]) for _ in range(n)) + b"</r>\n<!-- <n> -->"


def whole(raw):
    return [ET.tostring(c).strip() for c in ET.fromstring(raw)]


def as_tree(e):
    return ET.tostring(ET.fromstring(HEAD + e.raw + b"</r>")[0]).strip()


@pytest.mark.parametrize("seed", range(8))
def test_every_element_once_at_every_size(spark, tmp_path, seed):
    raw = made(random.Random(seed), 12)
    at = tmp_path / "x.xml"
    at.write_bytes(raw)
    want = whole(raw)
    for size in (7, 40, 333, 10**6) if seed < 2 else (random.Random(seed).randint(5, 60),):
        found = sorted(map(tuple, x.ranges(spark, str(at), size).collect()), key=lambda r: r[1])
        assert len(found) == max(1, -(-(len(raw) - len(HEAD)) // size))
        got = [e for r in found for e in x.elements(io.BytesIO(raw), x.Range(*r))]
        assert [as_tree(e) for e in got] == want
        for e in got:
            assert raw[e.start :].startswith(e.raw)
            inner = [_alone(ET.fromstring(b"<r>" + raw[a:b] + b"</r>")[0]) for a, b in e.children]
            assert inner == [_alone(c) for c in ET.fromstring(HEAD + e.raw + b"</r>")[0]]


def _alone(c):
    c.tail = None
    return ET.tostring(c).strip()


def test_heads():
    assert x.head_of(io.BytesIO(HEAD + b"</r>")) == len(HEAD)
    assert x.head_of(io.BytesIO(b"<r/>")) == 4
    for bad in (b"", b"text", b"<!-- <r> -->", b"<!DOCTYPE r ["):
        with pytest.raises(ValueError):
            x.head_of(io.BytesIO(bad))


def test_long_tokens_span_ranges(spark, tmp_path):
    raw = b"<r><a>1</a><!--" + b"<b>" * 500 + b"--><c><![CDATA[" + b"</c>" * 500 + b"]]></c><d e='" + b">" * 900 + b"'/></r>"
    (tmp_path / "x.xml").write_bytes(raw)
    found = sorted(map(tuple, x.ranges(spark, str(tmp_path / "x.xml"), 100).collect()), key=lambda r: r[1])
    got = [e.raw[:3] for r in found for e in x.elements(io.BytesIO(raw), x.Range(*r))]
    assert got == [b"<a>", b"<c>", b"<d "]


def test_very_many_ranges_become_longer_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(x, "MOST_RANGES", 6)
    raw = made(random.Random(5), 40)
    (tmp_path / "x.xml").write_bytes(raw)
    found = sorted(map(tuple, x.ranges(spark, str(tmp_path / "x.xml"), 7).collect()), key=lambda r: r[1])
    assert len(found) <= 6 and found[0][2] == len(HEAD) and found[-1][3] == len(raw) and all(a[3] == b[2] for a, b in zip(found, found[1:], strict=False))
    assert [as_tree(e) for r in found for e in x.elements(io.BytesIO(raw), x.Range(*r))] == whole(raw)


def test_tokens_move_no_bytes(monkeypatch):
    monkeypatch.setattr(x, "_STEP", 64)
    raw = b"<r>" + b"<e a='1'>t</e>" * 50 + b"</r>"
    window, at, held, most = x.Window(io.BytesIO(raw), 0), 0, [], 0
    while (t := window.token(at)) is not None:
        at = t[1]
        window.drop(at)
        most = max(most, len(window.data))
        if not held or held[-1] is not window.data:
            held.append(window.data)
    assert at == len(raw) and len(held) <= len(raw) // 64 + 2 and most < 200
