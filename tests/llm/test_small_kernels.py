"""The kernels without Spark, against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomlex.llm import bpe, gbt, media, pages, quality, simhash, substring, tokenfile, toxicity, urlfilter

TEXT = st.text(alphabet=st.sampled_from(list("aeth '1\n\t.#<|>éßİ中 \x85́😀ǅ²sdo ")), max_size=40)


@pytest.fixture(scope="module")
def byte_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def byte_codec():
    return bpe.codec(bpe.read_vocabulary(bpe.default_path()))


def ids_of(codec, text):
    return codec.encode([text])[0].tolist()


def text_of(codec, ids):
    return codec.decode(np.array(ids, np.int64), np.array([len(ids)]))[0]


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_bpe_equals_library(byte_library, byte_codec, text):
    want = byte_library.encode(text, add_special_tokens=False).ids
    assert ids_of(byte_codec, text) == want
    assert text_of(byte_codec, want) == byte_library.decode(want, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_bpe_of_several_texts(byte_library, byte_codec, found):
    ids, counts = byte_codec.encode(found)
    want = [byte_library.encode(t, add_special_tokens=False).ids for t in found]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == list(map(len, want))
    assert byte_codec.decode(ids, counts) == [byte_library.decode(w, skip_special_tokens=False) for w in want]


def naive_merges(singles, rank, word):
    s = list(word)
    while True:
        pairs = [(rank[p][0], p) for p in zip(s, s[1:], strict=False) if p in rank]
        if not pairs:
            return s
        best, out, i = min(pairs)[1], [], 0
        while i < len(s):
            pair = i + 1 < len(s) and (s[i], s[i + 1]) == best
            out.append(rank[best][1] if pair else s[i])
            i += 1 + pair
        s = out


@pytest.mark.parametrize("seed", range(25))
def test_compiled_table_against_merging(seed):
    """Random merges over two bytes: every word up to a length, and every pair of tokens, by the table and by merging."""
    r = random.Random(seed)
    labels, merges, rank = [b"a", b"b"], [], {}
    while len(labels) < 12:
        u, v = r.randrange(len(labels)), r.randrange(len(labels))
        if (u, v) not in rank and labels[u] + labels[v] not in labels:
            rank[u, v] = len(merges), len(labels)
            merges.append((u, v, len(labels)))
            labels.append(labels[u] + labels[v])
    automaton = bpe.Automaton(bpe.compile_merges(len(labels), [0, 1], merges), labels)
    words = [[k >> i & 1 for i in range(n)] for n in range(1, 9) for k in range(1 << n)]
    raws = [bytes(97 + c for c in w) for w in words]
    want = [naive_merges([0, 1], rank, w) for w in words]
    assert [np.frombuffer(x, np.uint32).tolist() for x in automaton.encode_many([*raws, b"ab" * 40])][:-1] == want
    assert [automaton.encode(raw) for raw in raws[::7]] == want[::7]
    byte = {97: 0, 98: 1}
    live = automaton.whole.values()
    pairs = [(a, b) for a in live for b in live]
    told = automaton.arcs(*np.array(pairs).T).tolist()
    assert told == [naive_merges([0, 1], rank, [byte[c] for c in labels[a] + labels[b]]) == [a, b] for a, b in pairs]


@pytest.mark.parametrize("text", ["", "a" * 500, " " * 300, "<|endoftext|>a<|endoftext|>", "x<|endoftext", "=" * 67, "\n\n \n a", "don't we'll I'M"])
def test_bpe_runs_and_special_tokens(byte_library, byte_codec, text):
    assert ids_of(byte_codec, text) == byte_library.encode(text, add_special_tokens=False).ids


def test_bpe_unknown_ids_and_broken_utf8(byte_library, byte_codec):
    ids = ids_of(byte_codec, "中😀")
    for k in range(len(ids)):
        assert text_of(byte_codec, ids[k:]) == byte_library.decode(ids[k:], skip_special_tokens=False)
    assert text_of(byte_codec, [10**6, -1]) == "" and byte_codec.encode([])[0].tolist() == []


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_word_encoder_equals_library(text):
    with open(tokenfile.default_path(), encoding="utf-8") as f:
        e = tokenfile.encoder(f.read())
    assert e.encode(text).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 70000) | st.just(0), max_size=300))
def test_simple8b_round_trip(ids):
    a = np.array(ids, np.uint64)
    assert tokenfile.unpack(tokenfile.pack(a), len(a)).tolist() == ids


def test_token_file_blocks(tmp_path):
    import pyarrow as pa

    r = np.random.default_rng(0)
    docs = [(i if i % 3 else None, r.integers(0, 50000, n).astype(np.uint32)) for i, n in enumerate([0, 1, 70000, 5, 0, 200000, 3])]
    with pa.OSFile(str(tmp_path / "f"), "wb") as out:
        w = tokenfile.Writer(out)
        for d, ids in docs:
            w.add(d, ids)
        assert w.close() == sum(len(x) for _, x in docs)
    with pa.OSFile(str(tmp_path / "f"), "rb") as f:
        back = list(tokenfile.Reader(f).documents())
    assert [b[0] for b in back] == [d[0] for d in docs] and all((b[2] == d[1]).all() for b, d in zip(back, docs, strict=True))


def test_simhash_links_equal_brute_force():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 60, dtype=np.uint64)
    fps = [0, 1, 31]
    for b in base.tolist():
        fps.append(b)
        for n in (1, 3, 4, 5, 6, 9):
            x = b
            for i in r.choice(64, n, replace=False).tolist():
                x ^= 1 << i
            fps.append(x)
    f = np.unique(np.array(fps, np.uint64))
    want = simhash._union(np.arange(len(f)), *np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= 4))
    root = np.arange(len(f))
    for block in range(3):
        at = simhash.anchors_of(f, block, 1)
        for anchor in np.unique(at):
            visits = np.flatnonzero((at == anchor).any(axis=1))
            homes = visits[at[visits, 0] == anchor]
            if len(homes):
                a, b = simhash._link(f[homes], f[visits], 4)
                root = simhash._union(root, np.searchsorted(f, a), np.searchsorted(f, b))
    assert (root == want).all()


def test_golay_code_covers():
    unit, leader = simhash._golay_tables()
    assert len(set(unit.tolist())) == 23 and np.bitwise_count(leader).max() == 3 and (leader > 0).sum() == 2047


def test_sketch_links_with_pivots():
    r = np.random.default_rng(2)
    centre = r.integers(0, 2**63, 6, dtype=np.uint64)
    near = centre ^ (np.uint64(1) << r.integers(0, 64, (900, 6)).astype(np.uint64))
    f = np.concatenate([near, r.integers(0, 2**63, (300, 6), dtype=np.uint64)])[r.permutation(1200)]
    d = np.bitwise_count(f[:, None] ^ f[None, :]).sum(axis=2, dtype=np.int64)
    assert (simhash.link_sketches(f, 20) == simhash._union(np.arange(1200), *np.nonzero(d <= 20))).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), max_size=5), st.integers(1, 4))
def test_suffix_automaton_against_brute_force(texts, window):
    a = substring.SuffixAutomaton()
    for owner, ws in enumerate(texts):
        a.add(ws, owner)
    a.close()
    for ws in [*texts, list("abcabc")]:
        for i, got in enumerate(a.match(ws, window)):
            key = ws[i : i + window]
            assert got == min((o for o, t in enumerate(texts) if any(t[j : j + window] == key for j in range(len(t) - window + 1))), default=substring.LAST)


def test_minimizers_of_equal_windows_agree():
    r = random.Random(3)
    docs = [" ".join(r.choice("abcd") for _ in range(r.randint(0, 60))).encode() for _ in range(30)]
    m = substring.minimizers(docs)
    by = {}
    for d, h, a, b in zip(m["doc"].tolist(), m["h"].tolist(), m["from"].tolist(), m["to"].tolist(), strict=True):
        ws = docs[d].split()
        for i in range(a, b + 1):
            by.setdefault((d, i), h)
            assert by.setdefault(tuple(ws[i : i + 13]), h) == h
    assert sum(1 for k in by if isinstance(k[0], int)) == sum(max(0, len(d.split()) - 12) for d in docs)


def test_cut_spans_keeps_layout():
    raw = b"  a b\nc  d e\tf "
    keep = substring.cut_spans(raw, np.array([False, True, True, False, False, False]))
    assert keep == b"a\nd e\tf"
    assert substring.cut_spans(raw, np.zeros(6, bool)) == raw and substring.cut_spans(b"a b", np.ones(2, bool)) == b""


@pytest.mark.parametrize(
    ("url", "want"),
    [(None, ("", "")), ("no scheme/x", ("", "")), ("http://A.Net/B?c", ("a.net", "/B")), ("x://h?q/z", ("h", "")), ("http://h#f/?", ("h", "")), ("a://É.COM/", ("É.com", "/")), ("://", ("", "")), ("http://a/b://c", ("a", "/b://c"))],
)
def test_split_url(url, want):
    assert urlfilter.split_url(url) == want


def test_url_trie_against_brute_force():
    rules = [("net", "/", "block"), ("a.net", "/en/", "allow"), ("a.net", "/en", "block"), ("b.a.net", "", "allow"), ("org", "/fr/x/", "block"), ("org", "/fr/", "allow"), ("net", "/", "allow")]
    trie = urlfilter.Trie(rules)
    for host in ("net", "a.net", "b.a.net", "xnet", "c.org", "org", "", "A.net"):
        for path in ("", "/", "/en", "/en/", "/english/", "/en/x", "/fr/x", "/fr/x/y", "/x"):
            fits = [(len(h) + len(p), len(h), v == "block", h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
            assert trie.find(host, path) == max(fits, default=None)


def test_quality_measures():
    assert quality.repeat_words(b"a b c a b c d".split()) == 6 and quality.repeat_words(b"a a a a".split()) == 4 and quality.repeat_words([]) == 0
    assert quality._line_counts(b"x\n\nx\n x\nx") == (4, 2) and quality._line_counts(b" ") == (0, 0)


@pytest.mark.parametrize("raw", [b"", b"x", b"a" * 64, b"b" * 65, bytes(range(256))])
def test_wave_round_trip(raw):
    p = media.pad(raw)
    assert len(p) % 64 == 0 and len(p) and media.from_wave(media.to_wave(p)) == p


def test_archive_members_and_retries(tmp_path):
    import zipfile

    import pyarrow as pa

    path = str(tmp_path / "a.zip")
    with pa.OSFile(path, "wb") as out:
        w = media.ArchiveWriter(out)
        for i in range(50):
            w.add(f"{i}", bytes([i]) * i * 10)
        w.close()
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and z.read("7") == bytes([7]) * 70
    size = (tmp_path / "a.zip").stat().st_size
    with pa.OSFile(path, "rb") as f:
        found = media.members(f, size)
        assert len(found) == 50 and media.fetch(f, *found[9][:4]) == bytes([9]) * 90
        calls = []

        def flaky(again):
            calls.append(again)
            if len(calls) < 3:
                raise OSError("gone")
            return f

        assert media.fetch_retrying(flaky, found[3], wait=0) == (bytes([3]) * 30, None) and calls == [False, True, True]
        bad = (found[3][0] + 1, *found[3][1:])
        assert media.fetch_retrying(lambda again: f, bad, wait=0)[0] is None


def test_trees_and_isotonic():
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(int)
    t = gbt.fit(x[:2000], y[:2000])
    assert ((t.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    assert gbt.fit(x[:0], y[:0]).probability(x[:3]).tolist() == [0.5] * 3
    iso = gbt.isotonic(t.raw(x[2000:]), y[2000:])
    z = iso(np.linspace(-9, 9, 50))
    assert (np.diff(z) >= 0).all() and 0 < z.min() and z.max() < 1 and gbt.isotonic(np.array([]), np.array([]))(np.array([0.3]))[0] == 0.3


def test_toxic_words():
    assert toxicity.normal_word("1D10T!") == ("idiot", True) and toxicity.normal_word("...") == ("", False) and toxicity.normal_word("2024") == ("2024", False)
    f = toxicity.Featurizer({"idiot": 3.0}, {"idio": 2.0})
    assert len(f("")) == len(f("you idiot")) == len(toxicity.FEATURES) and f("you idiot")[10] == 1


def test_odd_pages():
    trees = pages.model()
    odd = [None, "", "<", "<p", "plain", "<!-- never ends <p>x", "<script>x", "</p></div>", "<article><p>One &amp; two&nbsp;three.<p>Four</article><footer>x</footer>", "<p>" * 3000 + "x"]
    out = list(pages.extract_many(odd, trees))
    assert out[0] == out[1] == "" and out[8] == "One & two three.\nFour"
