"""Matches against a search by regular expressions, expressions against Python's own evaluation, the query over whole tables, odd inputs."""

import itertools
import random
import re

import pytest

from loomlex.llm import licenses, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places(words, phrases):
    return sorted((i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())


def test_query_against_brute_force(spark):
    found = {r.doc_id: r for r in queries.op11_license_scan(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for i, text in rows:
        ws, r = words_of(text), found[i]
        base = places(ws, licenses.BASE)
        more = {label for _, label in places(ws, licenses.NOTICES)}
        assert (r.n_words, r.n_base) == (len(ws), len(base))
        assert (r.first_word, r.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in base}))
        assert set(filter(None, r.labels.split(","))) == {x for _, x in base} | more  # no supplied document has a tag
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(base or more)


@pytest.mark.parametrize("seed", range(4))
def test_automaton_finds_overlaps(seed):
    r = random.Random(seed)
    for _ in range(300):
        patterns = list({tuple(r.choice("ab") for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 6))})
        words = [r.choice("abc") for _ in range(r.randint(0, 30))]
        got = licenses.WordAutomaton([[x.encode() for x in p] for p in patterns]).matches([w.encode() for w in words])
        assert sorted(got) == sorted((i, k) for k, p in enumerate(patterns) for i in range(len(words)) if tuple(words[i : i + len(p)]) == p)


OBLIGES = {"mit": 1, "gpl-3.0-only": 3, "agpl-3.0": 4, "cc0-1.0": 0, "lgpl-2.1+": 2}


@pytest.mark.parametrize("seed", range(3))
def test_expressions_against_python(seed):
    """AND and OR as Python's own, over values whose & and | are the strictest and the mildest; Python binds & before | too."""

    class V(int):
        __and__ = lambda a, b: V(max(a, b))
        __or__ = lambda a, b: V(min(a, b))

    r = random.Random(seed)

    def made(depth):
        u = r.random()
        if depth == 0 or u < 0.3:
            return [r.choice(list(OBLIGES))] + (["with", "classpath-exception-2.0"] if r.random() < 0.2 else [])
        inner = [*made(depth - 1), r.choice(["and", "or"]), *made(depth - 1)]
        return ["(", *inner, ")"] if u < 0.7 else inner

    for _ in range(300):
        pieces = made(4)
        text = " ".join(pieces)
        source = re.sub(r"[a-z0-9.+-]+ with \S+", lambda m: f"V({max(0, OBLIGES[m[0].split()[0]] - 1)})", text)
        source = re.sub("|".join(map(re.escape, OBLIGES)), lambda m: f"V({OBLIGES[m[0]]})", source).replace(" and ", " & ").replace(" or ", " | ")
        e = licenses.evaluate(pieces)
        assert e.valid and e.obligation == eval(source, {"V": V})  # noqa: S307
        again = licenses.evaluate(e.text.replace("(", "( ").replace(")", " )").split())
        assert (again.text, again.obligation, again.labels) == (e.text, e.obligation, e.labels)
        for cut in (pieces[:-1] + ["and"], ["or", *pieces], ["(", *pieces], [*pieces, ")"], [*pieces, "mit"]):
            assert licenses.postfix(cut) is None


@pytest.mark.parametrize(
    "line, plain, labels",
    [
        ("SPDX-License-Identifier: Apache-2.0 OR MIT", "apache-2.0 or mit", "apache,mit"), ("# SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0 OR MIT) AND BSD-3-Clause */ x", "(gpl-2.0-only with classpath-exception-2.0 or mit) and bsd-3-clause", "bsd,gpl,mit"),
        ("SPDX-License-Identifier:MIT.", "mit", "mit"), ("spdx license identifier GPL-2.0+ and more text", "gpl-2.0+", "gpl"), ("The SPDX-License-Identifier tag is short", None, ""), ("License-Expression = \"MIT\" or", "mit", "mit"), ("SPDX-License-Identifier: LicenseRef-Own", "licenseref-own", "licenseref-own"),
        ("SPDX-License-Identifier:\nMIT", None, ""), ("SPDX-License-Identifier: (MIT", None, "mit"), ("SPDX-License-Identifier: MIT Apache-2.0", "mit", "mit"), ("SPDX-License-Identifier: CC-BY-NC-4.0", "cc-by-nc-4.0", "cc-by-nc"), ("SPDX-License-Identifier: AND", None, ""),
    ],
)
def test_tags(line, plain, labels):
    f = licenses.Scanner().scan(line.encode())
    assert ",".join(sorted({x for _, e in f.expressions for x in e.labels})) == labels
    assert [e.text for _, e in f.expressions if e.valid] == ([plain] if plain else [])


def test_odd_inputs(spark):
    rows = [(None, "MIT License"), (1, None), (1, None), (2, ""), (3, "mit\x00license MİT LİCENSE mit  -- license mit_license"), (4, "GNU General Public License" * 2), (5, "cc by " * 50000), (5, "cc by cc by"), (6, "über mit license")]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, text string, id string, word int")
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(df).collect()), key=repr)
    want = []
    for i, text in rows:
        base = places(words_of(text), licenses.BASE)
        want.append((i, len(words_of(text)), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted({x for _, x in base}))))
    assert got == sorted(want, key=repr)
    assert licenses.scan(df.limit(0)).count() == 0
    assert [tuple(r) for r in licenses.matches(df.where("doc_id = 6")).collect()] == [(6, 1, "base", "mit", None)]


def test_obligation_of_notices_and_tags():
    scan = licenses.Scanner().scan
    assert scan(b"").obligation() == 0 and scan(b"MIT License").obligation() == 1
    assert scan(b"GNU General Public License\nSPDX-License-Identifier: GPL-2.0 OR MIT").obligation() == 1
    assert scan(b"All rights reserved. SPDX-License-Identifier: MIT").obligation() == 4
    scores = [scan(t).score() for t in (b"", b"public domain", b"MIT License", b"SPDX-License-Identifier: MIT", b"MIT License, SPDX-License-Identifier: MIT")]
    assert scores[0] == 0 and all(a < b for a, b in itertools.pairwise(scores))
