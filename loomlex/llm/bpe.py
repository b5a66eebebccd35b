"""Byte-level BPE by a tokenization automaton.

The automaton's states are tokens (the one read last) and its arcs are labelled by tokens: an arc from a to b exists
if and only if b may follow a in some canonical tokenization. It is compiled by successive merge gadgets. The gadget of
the merge (u, v) -> w removes the arc u -> v and adds the state w, whose arcs out are those that v has at that moment
and whose arcs in are those that u has. For the arcs in, states are numbered so that all that ever inherit them from one
state lie side by side: a gadget then removes one interval of columns from u's row, and w's row is v's as it stands. The
compiled table holds, per row, the columns without an arc as sorted intervals.

Encoding a pre-split word goes once over its positions: the state after each prefix is unique, and it is extended by
every label that starts there and whose arc the table has. Decoding emits the arcs' labels. The driver compiles the
table once and broadcasts it; its size is that of the vocabulary file, not of the data.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, steps, text_of, texts

#: White space by Unicode's property, which the tokenizer's pattern means by \s.
_WS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs between which no piece of the pre-tokenizer's pattern can reach.
_COARSE = f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
#: The pre-tokenizer's pattern within such a run.
_FINE = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
#: Bytes of text whose runs are encoded together, each distinct one once.
RUN_BYTES = 2 << 20


def byte_alphabet() -> dict[str, int]:
    """Character to byte: printable Latin-1 stands for itself, the other bytes for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Table:
    """The compiled automaton. place: a state's number as a column, by token; row, lo, hi: a state's intervals of columns without an arc are those from row[t] to row[t + 1]; live: tokens that some text yields."""

    place: np.ndarray
    row: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    live: np.ndarray


def compile_merges(size: int, singles: list[int], merges: list[tuple[int, int, int]]) -> Table:
    """The table of `size` tokens from merges in order of rank: pairs of tokens, with the token that each makes."""
    made: dict[int, int] = {}
    heirs: dict[int, list[tuple[int, int]]] = {}  # by state: the states that inherit its arcs in, in order of birth
    for i, (u, _, w) in enumerate(merges):
        if w in made or w in singles:
            raise ValueError(f"two merges make token {w}")
        made[w] = i
        heirs.setdefault(u, []).append((i, w))
    # Columns in post-order, so that a state comes after its heirs, and the later-born of these last.
    place, first = np.full(size, -1, np.int32), {}
    n = 0
    for single in singles:
        stack = [(single, 0)]
        first[single] = n
        while stack:
            t, k = stack.pop()
            below = heirs.get(t, ())
            if k < len(below):
                stack += [(t, k + 1), (below[k][1], 0)]
                first[below[k][1]] = n
            else:
                place[t] = n
                n += 1
    rows: dict[int, list[tuple[int, int]]] = {t: [] for t in singles}
    live, seen = set(singles), set()
    for i, (u, v, w) in enumerate(merges):
        if (u, v) in seen:
            raise ValueError(f"the merge of {u} and {v} comes twice")
        seen.add((u, v))
        at = int(place[v])
        if u in live and v in live and not any(a <= at <= b for a, b in rows[u]):
            live.add(w)  # else no text has u before v, and w is never read
        rows[w] = list(rows[v])
        # Gone are v and those of its heirs that are born later; of a run of one token pairs form from its left end, so then also w itself.
        below = heirs.get(v, ())
        k = bisect_left(below, (i + (u != v), -1))
        rows[u].append((first[below[k][1]] if k < len(below) else at, at))
    start, lo, hi = np.zeros(size + 1, np.int64), array("i"), array("i")
    for t in range(size):
        end = -2
        for a, b in sorted(rows.get(t, ())):
            if a <= end + 1:
                if b > end:
                    hi[-1] = end = b
            else:
                lo.append(a)
                hi.append(b)
                end = b
        start[t + 1] = len(lo)
    return Table(place, start, np.array(lo, np.int32), np.array(hi, np.int32), np.array(sorted(live), np.int32))


class Trie:
    """Labels by their bytes: arcs from node and byte to node in an open-addressing table, and the token that ends at each node, -1 if none."""

    def __init__(self, labels: dict[bytes, int]):
        arcs: dict[int, int] = {}
        token = [-1]
        for label, t in labels.items():
            node = 0
            for b in label:
                key = node << 8 | b
                node = arcs.get(key, -1)
                if node < 0:
                    node = arcs[key] = len(token)
                    token.append(-1)
            token[node] = t
        self.arcs, self.token_at, self.token = arcs, token, np.array(token, np.int64)
        self.bits = max(4, (4 * len(arcs)).bit_length())
        self.keys, self.nodes = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int64)
        keys, nodes = np.fromiter(arcs.keys(), np.int64, len(arcs)), np.fromiter(arcs.values(), np.int64, len(arcs))
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several for one slot the last stays
            mine = self.keys[slot] == keys
            self.nodes[slot[mine]] = nodes[mine]
            keys, nodes, slot = keys[~mine], nodes[~mine], slot[~mine] + 1 & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes that the bytes lead to, -1 where there is none."""
        key = node << 8 | byte
        slot = self._slot(key)
        held = self.keys[slot]
        out = np.where(held == key, self.nodes[slot], -1)
        open_ = np.flatnonzero((held != key) & (held >= 0))
        while len(open_):
            slot[open_] = slot[open_] + 1 & (1 << self.bits) - 1
            held = self.keys[slot[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.nodes[slot[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out


class Automaton:
    """Reads words by a compiled table. labels: bytes by token."""

    #: Words up to these lengths are read many at a time, position by position; longer ones one by one.
    LENGTHS = (8, 16, 32, 64)

    def __init__(self, table: Table, labels: list[bytes]):
        self.place, self.row, self.hi = table.place.astype(np.int64), table.row, table.hi
        # All intervals in one order, by row and then by column.
        self.key = np.repeat(np.arange(len(table.place)) << 32, np.diff(table.row)) + table.lo
        self.whole = {labels[t]: t for t in table.live.tolist()}
        self.trie = Trie(self.whole)

    def arcs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each b may follow its a."""
        at = self.place[b]
        k = np.searchsorted(self.key, (a << 32) + at, side="right") - 1
        return (k < self.row[a]) | (self.hi[k] < at)

    def encode(self, word: bytes) -> list[int]:
        """The labels on the only path of arcs that reads the whole word, in one pass over its positions."""
        n, arcs, token = len(word), self.trie.arcs, self.trie.token_at
        state, origin, known = [-1] * (n + 1), [0] * (n + 1), {}
        for i in range(n):
            a = state[i]
            if a < 0 and i:
                continue
            node = 0
            for j in range(i, n):
                node = arcs.get(node << 8 | word[j])
                if node is None:
                    break
                b = token[node]
                if b >= 0 and state[j + 1] < 0:
                    ok = known.get((a, b)) if i else True
                    if ok is None:
                        ok = known[a, b] = bool(self.arcs(np.array([a]), np.array([b]))[0])
                    if ok:
                        state[j + 1], origin[j + 1] = b, i
        if n and state[n] < 0:
            raise ValueError("a byte of the text is not in the vocabulary")
        path = []
        while n:
            path.append(state[n])
            n = origin[n]
        return path[::-1]

    def encode_many(self, words: list[bytes]) -> list[bytes]:
        """encode() of each word, as 32-bit integers; all words of like length together, by the same pass."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for k in np.flatnonzero(sizes > self.LENGTHS[-1]).tolist():
            out[k] = np.array(self.encode(words[k]), np.uint32).tobytes()
        low = 0
        for most in self.LENGTHS:
            at = np.flatnonzero((sizes > low) & (sizes <= most))
            low = most
            for s in range(0, len(at), 1 << 14):
                part = at[s : s + (1 << 14)]
                for k, ids in zip(part.tolist(), self._read([words[k] for k in part.tolist()], sizes[part], most), strict=True):
                    out[k] = ids
        return out

    def _read(self, words: list[bytes], sizes: np.ndarray, most: int) -> list[bytes]:
        n = len(words)
        text = np.frombuffer(b"".join([w.ljust(most, b"\0") for w in words]), np.uint8).reshape(n, most).astype(np.int64)
        state, origin = np.full((n, most + 1), -1, np.int64), np.zeros((n, most + 1), np.int64)
        for i in range(most):
            rows = np.flatnonzero((sizes > i) & (state[:, i] >= 0 if i else True))
            a, node = state[rows, i], np.zeros(len(rows), np.int64)
            for j in range(i, most):
                node = self.trie.step(node, text[rows, j])
                on = (node >= 0) & (sizes[rows] > j)
                if not on.all():
                    rows, a, node = rows[on], a[on], node[on]
                if not len(rows):
                    break
                b = self.trie.token[node]
                hit = np.flatnonzero((b >= 0) & (state[rows, j + 1] < 0))
                if i:
                    hit = hit[self.arcs(a[hit], b[hit])]
                state[rows[hit], j + 1], origin[rows[hit], j + 1] = b[hit], i
        each = np.arange(n)
        if (state[each, sizes] < 0).any():
            raise ValueError("a byte of the text is not in the vocabulary")
        # From each word's end back to its start, filling rows from the right.
        path, end, k = np.zeros((n, most), np.uint32), sizes.copy(), most
        count = np.zeros(n, np.int64)
        while len(each):
            k -= 1
            path[each, k] = state[each, end[each]]
            count[each] += 1
            end[each] = origin[each, end[each]]
            each = each[end[each] > 0]
        raw, wide = path.tobytes(), 4 * most
        # A word that ended early stands further to the right, up to the last column.
        return [raw[i * wide + 4 * (most - c) : (i + 1) * wide] for i, c in enumerate(count.tolist())]


@dataclass
class Compiled:
    """What tasks need of a vocabulary file: the table, the labels by token (null where there is none), and added tokens by text."""

    table: Table
    labels: list[bytes | None]
    special: dict[str, int]
    key: str


def read_vocabulary(path: str) -> Compiled:
    """Compiles a byte-level BPE file of the tokenizers library; any other kind is a ValueError."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    model, pre = spec["model"], spec["pre_tokenizer"]
    plain = model["type"] == "BPE" and not model.get("end_of_word_suffix") and not model.get("continuing_subword_prefix") and not spec["normalizer"]
    if not plain or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    alphabet, vocab = byte_alphabet(), model["vocab"]
    special = {a["content"]: a["id"] for a in spec["added_tokens"]}
    labels: list[bytes | None] = [None] * (1 + max([*vocab.values(), *special.values()]))
    for s, t in vocab.items():
        if all(c in alphabet for c in s):
            labels[t] = bytes(alphabet[c] for c in s)
    merges = [(vocab[u], vocab[v], vocab[u + v]) for u, v in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
    singles = sorted(t for t, s in enumerate(labels) if s is not None and len(s) == 1)
    table = compile_merges(len(labels), singles, merges)
    for s, t in special.items():
        labels[t] = s.encode()
    return Compiled(table, labels, special, hashlib.sha256(text.encode()).hexdigest())


class Codec:
    """Encoding as the tokenizers library does with a byte-level BPE file, without special tokens added, truncation or padding."""

    def __init__(self, compiled: Compiled, memo: int = 200_000):
        import re

        import regex

        self.automaton = Automaton(compiled.table, compiled.labels)
        self.special = compiled.special
        self.added = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.labels = pa.array([s or b"" for s in compiled.labels], pa.large_binary())
        self.decimals = pa.array([b"%d," % t for t in range(len(compiled.labels))], pa.large_binary())
        self.coarse, self.fine, self.most = re.compile(_COARSE).findall, regex.compile(_FINE).findall, memo
        self.added_ids = {s: t.to_bytes(4, "little") for s, t in self.special.items()}
        self.known = dict(self.added_ids)  # ids of runs and pieces

    def _learn(self, runs: list[str]) -> None:
        """Encodes runs that are not known yet, by their distinct pieces. A piece by itself is a run of that one piece."""
        known, whole = self.known, self.automaton.whole
        fresh, mixed = {}, []
        for run in runs:
            # Letters alone, which most runs are, make one piece by the pattern.
            if run.isalpha() or run[0] == " " and run[1:].isalpha():
                fresh[run] = run.encode()
                continue
            pieces = self.fine(run)
            if len(pieces) > 1:
                mixed.append((run, pieces))
            for p in pieces:
                if p not in known:
                    fresh[p] = p.encode()
        rest = []
        for p, raw in fresh.items():
            t = whole.get(raw)  # what some text yields as one token is one
            if t is None:
                rest.append(p)
            else:
                known[p] = t.to_bytes(4, "little")
        known.update(zip(rest, self.automaton.encode_many([fresh[p] for p in rest]), strict=True))
        for run, pieces in mixed:
            known[run] = b"".join([known[p] for p in pieces])

    def encode(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has. Each distinct run of the texts is looked up once."""
        runs: list[str] = []
        ends = []
        for text in found:
            if self.added and self.added.search(text):
                for s in self.added.split(text):
                    runs += [s] if s in self.special else self.coarse(s)
            else:
                runs += self.coarse(text)
            ends.append(len(runs))
        at = pa.array(runs, pa.large_string()).dictionary_encode().indices.to_numpy()
        first = np.zeros(at.max(initial=-1) + 1, np.int64)
        first[at[::-1]] = np.arange(len(at) - 1, -1, -1)
        words = [runs[i] for i in first.tolist()]
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.most:  # bounds the memory; what is needed again is encoded again
            self.known = dict(self.added_ids)
            new = [w for w in words if w not in self.known]
        if new:
            self._learn(new)
        known = list(map(self.known.__getitem__, words))
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        start, size_of = (np.cumsum(size) - size)[at], size[at]
        total = np.concatenate([[0], np.cumsum(size_of)])
        pick = np.repeat(start - total[:-1], size_of) + np.arange(total[-1])
        return np.frombuffer(b"".join(known), np.uint32)[pick], np.diff(total[[0, *ends]])

    @staticmethod
    def emit(column: pa.Array, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Per text what the column holds for its ids, one after another."""
        told = column.take(pa.array(ids, pa.int64()))
        offsets = np.frombuffer(told.buffers()[1], np.int64)[told.offset : told.offset + len(told) + 1] if len(told) else np.zeros(1, np.int64)
        data = told.buffers()[2] if len(told) else None
        edge = offsets[np.concatenate([[0], np.cumsum(counts)])].tolist()
        raw = memoryview(data) if data is not None else memoryview(b"")
        return [bytes(raw[a:b]) for a, b in zip(edge, edge[1:], strict=False)]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Per text the labels of its ids; bytes that are not UTF-8 become U+FFFD. Unknown ids have no label."""
        known = (ids >= 0) & (ids < len(self.labels))
        if not known.all():
            owner = np.repeat(np.arange(len(counts)), counts)[known]
            ids, counts = ids[known], np.bincount(owner, minlength=len(counts))
        return [b.decode("utf-8", "replace") for b in self.emit(self.labels, ids, counts)]


_COMPILED: dict[str, Compiled] = {}
_CODECS: dict[str, Codec] = {}


def shipped(spark: SparkSession, path: str):
    """The file's table as a broadcast, compiled once per driver: its size is bounded by the vocabulary's, some 15 MB for 50,000 tokens."""
    if path not in _COMPILED:
        _COMPILED[path] = read_vocabulary(path)
    return spark.sparkContext.broadcast(_COMPILED[path])


def codec(compiled: Compiled) -> Codec:
    """Once per Python process."""
    if compiled.key not in _CODECS:
        _CODECS[compiled.key] = Codec(compiled)
    return _CODECS[compiled.key]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, path: str, *keep: str, text: str = "text") -> DataFrame:
    """The kept columns with n_tokens and ids (array<int>) of the whole text.

    A null or empty text has no ids. Rows correspond one to one, repeated rows too; an empty table stays empty.
    The kept columns may have any names, "text" and "ids" excepted. path: a file of the driver's.
    """
    table = shipped(docs.sparkSession, path)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(table.value)
        raws = texts(batch.column("text"))
        parts = [c.encode([x.decode() for x in raws[a:b]]) for a, b in steps(map(len, raws), RUN_BYTES)]
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in parts]))]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([x for x, _ in parts]).astype(np.int32)))
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(np.diff(offsets), pa.int64()), ids], [*keep, "n_tokens", "ids"])

    kinds = dict(docs.dtypes)
    return map_batches(text_of(docs, *keep, text=text), kernel, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "n_tokens long", "ids array<int>"]))


def decode(encoded: DataFrame, path: str, *keep: str, ids: str = "ids") -> DataFrame:
    """The kept columns with `decoded`, the text that ids stand for. Null or no ids: an empty text. Unknown and null ids stand for nothing."""
    table = shipped(encoded.sparkSession, path)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("ids")
        counts = np.asarray(lists.value_lengths().fill_null(0))
        flat = np.asarray(lists.flatten().cast(pa.int64()).fill_null(-1))
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(codec(table.value).decode(flat, counts), pa.string())], [*keep, "decoded"])

    kinds = dict(encoded.dtypes)
    return map_batches(encoded.select(*keep, F.col(ids).alias("ids")), kernel, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "decoded string"]))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document n_tokens, ids_sha256 and decoded_sha256: encode and decode in one pass, so that no ids leave their task.

    Null and empty texts have no tokens and the digests of the empty string.
    """
    table = shipped(docs.sparkSession, path)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(table.value)
        n, a, b = [], [], []
        raws = texts(batch.column("text"))
        for i, j in steps(map(len, raws), RUN_BYTES):
            ids, counts = c.encode([x.decode() for x in raws[i:j]])
            n += counts.tolist()
            a += [hashlib.sha256(x[:-1]).hexdigest() for x in c.emit(c.decimals, ids, counts)]
            b += [hashlib.sha256(x.encode()).hexdigest() for x in c.decode(ids, counts)]
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(docs.dtypes)[id_col]
    out = map_batches(text_of(docs, F.col(id_col).alias("id"), text=text), kernel, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
