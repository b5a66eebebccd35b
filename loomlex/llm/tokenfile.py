"""Token-id files in Simple-8b: 64-bit words whose top four bits say how many ids of which width they hold.

A file is: magic; blocks of little-endian words; a footer of arrays (per block: byte offset, ids, words; per document:
id, whether the id is null, tokens); the footer's lengths; magic. Documents stand in ascending order of their id, and
a block knows its number of ids, so that any block can be decoded alone, selector by selector, without a loop over words.
"""

from __future__ import annotations

import io
import os
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import filesystem, new_dir, parts_for, texts

MAGIC = b"LXS8B\x01\x00\x00"
#: (ids per word, bits per id) by selector; selector 15 is the escape: the next word holds one id as it is.
SELECTORS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
BLOCK_IDS = 1 << 16


def pack(ids: np.ndarray) -> np.ndarray:
    """ids (unsigned) as words: each word takes as many ids as fit, from the left. The last may be filled with zeros."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.array([], np.uint64)
    # Bits of each id (rounding can only make large ones wider), then the most bits in each window of `count` ids; what
    # is missing at the end is zeros. A window's maximum is that of two shorter, overlapping ones.
    bits_of = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    widest = {1: np.concatenate([bits_of, np.zeros(60, np.uint8)])}
    choice = np.full(n, len(SELECTORS) - 1, np.uint8)
    choice[bits_of > 60] = ESCAPE
    for s in range(len(SELECTORS) - 2, -1, -1):  # those that hold more ids overwrite
        count, bits = SELECTORS[s]
        part = max(c for c in widest if c < count)
        own = widest[part].copy()
        np.maximum(own[: part - count], widest[part][count - part :], out=own[: part - count])
        widest[count] = own
        choice[own[:n] <= bits] = s
    step = np.array([c for c, _ in SELECTORS] + [1, 1], np.int64)[choice].tolist()
    starts, i = [], 0
    put = starts.append
    while i < n:
        put(i)
        i += step[i]
    at = np.array(starts)
    chosen = choice[at]
    escaped = chosen == ESCAPE
    places = np.arange(len(at)) + np.concatenate([[0], np.cumsum(escaped)[:-1]])
    words = np.zeros(len(at) + int(escaped.sum()), np.uint64)
    padded = np.concatenate([ids, np.zeros(60, np.uint64)])
    for s, (count, bits) in enumerate(SELECTORS):
        own = at[chosen == s]
        if len(own):
            w = np.full(len(own), s << 60, np.uint64)
            for k in range(count):
                w |= padded[own + k] << np.uint64(k * bits)
            words[places[chosen == s]] = w
    words[places[escaped]] = np.uint64(ESCAPE << 60)
    words[places[escaped] + 1] = ids[at[escaped]]
    return words


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The n ids of pack()'s words."""
    if not n:
        return np.array([], np.uint64)
    words = np.asarray(words, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.uint8)
    if (selector == ESCAPE).any():  # a raw word may look like anything: escapes are found from the left
        raw = np.zeros(len(words), bool)
        for i in np.flatnonzero(selector == ESCAPE):
            if not raw[i] and i + 1 < len(words):
                raw[i + 1] = True
        selector[raw] = 14
    counts = np.array([c for c, _ in SELECTORS] + [1, 0], np.int64)[selector]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]), np.uint64)
    starts = ends - counts
    for s, (count, bits) in enumerate(SELECTORS):
        own = np.flatnonzero(selector == s)
        if len(own):
            low = np.uint64((1 << bits) - 1)
            for k in range(count):
                out[starts[own] + k] = (words[own] >> np.uint64(k * bits)) & low
    raw = selector == 14
    out[starts[raw]] = words[raw]
    return out[:n]


class Writer:
    """Streams documents into one file."""

    def __init__(self, out: io.IOBase):
        self.out, self.at = out, len(MAGIC)
        out.write(MAGIC)
        self.blocks: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, int(doc_id is None), len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.array([], np.uint32)
        cut = len(ids) if last else len(ids) // BLOCK_IDS * BLOCK_IDS
        for i in range(0, cut, BLOCK_IDS):
            part = ids[i : min(i + BLOCK_IDS, cut)]
            raw = pack(part).astype("<u8").tobytes()
            self.out.write(raw)
            self.blocks.append((self.at, len(part), len(raw) // 8))
            self.at += len(raw)
        self.held, self.n_held = [ids[cut:]], len(ids) - cut

    def close(self) -> int:
        """Writes the rest and the footer; the number of ids."""
        self._flush(True)
        b = np.array(self.blocks, "<i8").reshape(-1, 3)
        d = np.array(self.docs, "<i8").reshape(-1, 3)
        self.out.write(b.tobytes() + d.tobytes() + np.array([len(b), len(d)], "<i8").tobytes() + MAGIC)
        return int(d[:, 2].sum())


class Reader:
    """A file's footer, and its blocks on demand."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - 24)
        tail = source.read(24)
        if tail[16:] != MAGIC:
            raise ValueError("not a token file, or one that was not closed")
        n_blocks, n_docs = np.frombuffer(tail[:16], "<i8")
        source.seek(size - 24 - 24 * int(n_blocks + n_docs))
        raw = np.frombuffer(source.read(24 * int(n_blocks + n_docs)), "<i8").reshape(-1, 3)
        self.blocks, self.docs = raw[:n_blocks], raw[n_blocks:]

    def block(self, k: int) -> np.ndarray:
        at, n, words = (int(x) for x in self.blocks[k])
        self.source.seek(at)
        return unpack(np.frombuffer(self.source.read(8 * words), "<u8"), n).astype(np.uint32)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id's place within the file, ids), holding one block and the document in hand."""
        k, held, place = 0, np.array([], np.uint32), 0
        for doc_id, null, n in self.docs.tolist():
            parts, have = [held], len(held)
            while have < n:
                parts.append(self.block(k))
                have += len(parts[-1])
                k += 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield (None if null else doc_id), place, held[:n]
            held = held[n:]
            place += n


class Memo(dict):
    """Encoded pieces by text, filled on demand."""

    def __init__(self, fill: Callable[[str], bytes]):
        super().__init__()
        self.fill = fill

    def __missing__(self, key: str) -> bytes:
        got = self[key] = self.fill(key)
        return got


class WordEncoder:
    """The tokenizers library over a word-level BPE file, with results kept by piece of its pre-tokenizer's pattern.

    Where normalizing does no more than lower each character, pieces can be cut first and each distinct one be given
    to the library's model once. That is known for the characters in _PLAIN; any other text goes through the library whole.
    """

    #: No combining marks, no letter whose lower case is longer than itself, no control characters but white space.
    _PLAIN = "\t\n\x0b\x0c\r -~\xa0-įı-˿‐-‧‰-⁞₠-₿"

    def __init__(self, spec: str, most: int = 400_000):
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.odd = re.compile(f"[^{self._PLAIN}]|<\\|").search
        plain = [c for a, b in re.findall("(.)(?:-(.))?", self._PLAIN, re.S) for c in map(chr, range(ord(a), ord(b or a) + 1))]
        kind = lambda k: "".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == k)
        letters, numbers = kind("L"), kind("N")
        #: The tokenizer's pattern, its classes spelt out for plain characters.
        self.split = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+").findall
        by_byte = {b: c for c, b in byte_alphabet().items()}
        self.spelling = [by_byte[b] for b in range(256)]
        self.pieces = Memo(self._learn)
        self.most = most

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, piece: str) -> bytes:
        # The model alone, on the piece's bytes as the tokenizer's byte-level step spells them.
        spelt = piece if piece.isascii() else "".join(map(self.spelling.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.tokenizer.model.tokenize(spelt)]).tobytes()

    def encode(self, text: str) -> np.ndarray:
        if self.odd(text):
            return np.frombuffer(self._whole(text), "<u4")
        if len(self.pieces) > self.most:  # bounds the memory; what is needed again is encoded again
            self.pieces.clear()
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text.lower()))), "<u4")


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(spec: str) -> WordEncoder:
    """Of a tokenizer file's text, once per Python process."""
    if spec not in _ENCODERS:
        _ENCODERS[spec] = WordEncoder(spec)
    return _ENCODERS[spec]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write(docs: DataFrame, to: str, path: str, end_id: int = 2, id_col: str = "doc_id", text: str = "text", partition_bytes: int = 32 << 20) -> DataFrame:
    """Tokenizes whole texts and writes them under the folder `to`, in ascending order of the id (nulls first, ties by a hash of the text).

    A null or empty text is the end id alone. An empty table writes no documents. Returns the manifest, a row per file:
    file, part, n_docs, n_tokens. A task writes to a name of its own and renames it at the end, so that a task that is
    run again, or twice at once, leaves one whole file. path: a file of the driver's; its text, a few MB, is broadcast.
    Ids are cast to long. Files are dealt by ranges of id and that hash, so that rows that share an id, or have none, are not one task's.
    """
    n = parts_for(docs, partition_bytes)
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, base = filesystem(to)
        fs.create_dir(base, recursive=True)
        name = f"part-{part:06d}.s8b"
        draft, end = f"{base}/_{name}.{uuid.uuid4().hex}", np.array([end_id], "<u4")
        enc = encoder(spec.value)
        with fs.open_output_stream(draft) as out:
            w = Writer(out)
            for batch in batches:
                for doc_id, raw in zip(batch.column("id").to_pylist(), texts(batch.column("text")), strict=True):
                    w.add(doc_id, np.concatenate([enc.encode(raw.decode()), end]))
            n_tokens = w.close()
        fs.move(draft, f"{base}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part], pa.int64()), pa.array([len(w.docs)], pa.int64()), pa.array([n_tokens], pa.int64())], ["file", "part", "n_docs", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    # The ranges' bounds come from a sample that passes the driver, so texts enter it by a hash alone.
    tie = F.xxhash64("text")
    dealt = rows.repartitionByRange(n, "id", tie).sortWithinPartitions("id", tie, "text")
    return dealt.mapInArrow(run, "file string, part long, n_docs long, n_tokens long")


def read(spark: SparkSession, at: str, manifest: list, id_col: str = "doc_id") -> DataFrame:
    """Per document of the files: id, start (ids of all documents before it), n_tokens, ids_crc32 (of its ids as little-endian 32-bit integers).

    manifest: write()'s rows, one per file; starts are their running sum.
    """
    base, files = 0, []
    for row in sorted(manifest, key=lambda r: r["part"]):
        if row["n_docs"]:
            files.append((row["file"], base))
        base += row["n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(at)
        names = ["id", "start", "n_tokens", "ids_crc32"]
        kinds = [pa.int64()] * 4
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with fs.open_input_file(f"{folder}/{file}") as source:
                    rows = []
                    for doc_id, place, ids in Reader(source).documents():
                        rows.append((doc_id, base + place, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        if len(rows) == 8192:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    listed = spark.createDataFrame(files, "file string, base long").repartition(max(1, len(files)))
    return listed.mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)


def write_and_read(docs: DataFrame, path: str, to: str | None = None) -> DataFrame:
    """Writes docs into a new folder of the shared store and reads the files back."""
    spark = docs.sparkSession
    to = to or new_dir(spark, "tokens")
    return read(spark, to, write(docs, to, path).collect())
