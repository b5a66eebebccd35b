"""Media columns: payloads stored as 8-bit audio in archives, and a data source that reads archives by byte ranges.

An archive is a ZIP file. Reading plans partitions as byte ranges over the files of a directory; a partition owns the
members whose local header starts in its range, which it finds in the archive's central directory. Members are fetched
one by one by their offset, each with retries of its own, and stream to Spark in Arrow batches of bounded size.
"""

from __future__ import annotations

import hashlib
import struct
import time
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .common import filesystem, new_dir, text_of, texts

UNIT, RATE = 64, 8000
#: Payload bytes of one Arrow batch; a larger member is a batch of its own.
BATCH_BYTES = 8 << 20
RANGE_BYTES = 16 << 20
TRIES = 4
_SCHEMA = "archive string, offset long, name string, payload binary, error string"


def pad(raw: bytes) -> bytes:
    """raw with bytes 0 up to a positive multiple of 64."""
    return raw + bytes(-len(raw) % UNIT if raw else UNIT)


def to_wave(payload: bytes) -> bytes:
    """A WAVE file of one channel of unsigned 8-bit samples; the payload's length is even, so no chunk needs filling."""
    return b"RIFF" + struct.pack("<I", 36 + len(payload)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload


def from_wave(wave: bytes) -> bytes:
    """The samples of to_wave()'s file."""
    if wave[:4] != b"RIFF" or wave[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at = 12
    while at + 8 <= len(wave):
        n = struct.unpack_from("<I", wave, at + 4)[0]
        if wave[at : at + 4] == b"data":
            if at + 8 + n > len(wave):
                raise ValueError("a WAVE file that ends within its samples")
            return wave[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    raise ValueError("a WAVE file without samples")


def feature(payload: bytes) -> str:
    """Level, spread, mean step and zero crossings of the samples, and their histogram in eight bands, as text."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64)
    n = len(x)
    bands = np.bincount(x >> 5, minlength=8)
    crossings = int((np.diff((x >= 128).astype(np.int8)) != 0).sum())
    return f"n={n};sum={int(x.sum())};sq={int((x * x).sum())};step={int(np.abs(np.diff(x)).sum())};zc={crossings};bands=" + ",".join(map(str, bands.tolist()))


class ArchiveWriter:
    """A ZIP file, written front to back (ZIP64 where offsets need it)."""

    def __init__(self, out):
        self.out, self.at = out, 0
        self.entries: list[bytes] = []

    def _put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.at += len(raw)

    def add(self, name: str, data: bytes) -> None:
        pack = zlib.compressobj(1, zlib.DEFLATED, -15)
        packed = pack.compress(data) + pack.flush()
        label, crc = name.encode(), zlib.crc32(data)
        common = struct.pack("<HHHHHIIIH", 20, 0x800, 8, 0, 33, crc, len(packed), len(data), len(label))
        offset = self.at
        self._put(b"PK\x03\x04" + common + struct.pack("<H", 0) + label + packed)
        extra = struct.pack("<HHQ", 1, 8, offset) if offset >= 0xFFFFFFFF else b""
        self.entries.append(b"PK\x01\x02" + struct.pack("<H", 45 if extra else 20) + common + struct.pack("<HHHHII", len(extra), 0, 0, 0, 0, min(offset, 0xFFFFFFFF)) + label + extra)

    def close(self) -> None:
        start, n = self.at, len(self.entries)
        for e in self.entries:
            self._put(e)
        size = self.at - start
        if n >= 0xFFFF or start >= 0xFFFFFFFF:
            at = self.at
            self._put(b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start))
            self._put(b"PK\x06\x07" + struct.pack("<IQI", 0, at, 1))
        self._put(b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), min(size, 0xFFFFFFFF), min(start, 0xFFFFFFFF), 0))


def members(source, size: int) -> list[tuple[int, int, int, int, str]]:
    """The central directory: (offset, packed bytes, crc, method, name) of each member, by offset."""
    tail_at = max(0, size - (1 << 16) - 22)
    source.seek(tail_at)
    tail = source.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no central directory")
    n, length, start = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFF in (n,) or 0xFFFFFFFF in (length, start):
        source.seek(struct.unpack_from("<Q", tail, tail.rfind(b"PK\x06\x07", 0, end) + 8)[0])
        n, _, length, start = struct.unpack_from("<QQQQ", source.read(56), 24)[0:4]
    source.seek(start)
    raw, at, out = source.read(length), 0, []
    for _ in range(n):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("a damaged central directory")
        method, _, _, crc, packed = struct.unpack_from("<HHHII", raw, at + 10)
        label, extra, comment = struct.unpack_from("<HHH", raw, at + 28)
        offset = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46 : at + 46 + label].decode("utf-8", "replace")
        if offset == 0xFFFFFFFF:
            offset = struct.unpack_from("<Q", raw, at + 46 + label + 4)[0]
        out.append((offset, packed, crc, method, name))
        at += 46 + label + extra + comment
    return sorted(out)


def fetch(source, offset: int, packed: int, crc: int, method: int) -> bytes:
    """One member's bytes, checked."""
    source.seek(offset)
    head = source.read(30)
    if head[:4] != b"PK\x03\x04":
        raise OSError(f"no member at {offset}")
    label, extra = struct.unpack_from("<HH", head, 26)
    source.seek(offset + 30 + label + extra)
    raw = source.read(packed)
    if len(raw) < packed:
        raise OSError(f"the archive ends within the member at {offset}")
    data = zlib.decompress(raw, -15) if method == 8 else raw
    if zlib.crc32(data) != crc:
        raise OSError(f"the member at {offset} is damaged")
    return data


def fetch_retrying(source_of: Callable, member: tuple[int, int, int, int, str], tries: int = TRIES, wait: float = 0.2) -> tuple[bytes | None, str | None]:
    """fetch(), tried again on a newly opened archive; the bytes, or what went wrong at last."""
    error = None
    for k in range(tries):
        try:
            return fetch(source_of(k > 0), *member[:4]), None
        except (OSError, zlib.error, struct.error, pa.ArrowException) as e:
            error = f"{type(e).__name__}: {e}"
            if k + 1 < tries:
                time.sleep(wait * 2**k)
    return None, error


class Range(InputPartition):
    def __init__(self, path: str, size: int, start: int, end: int):
        self.path, self.size, self.start, self.end = path, size, start, end


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri = options["path"]
        self.range_bytes = int(options.get("rangebytes") or RANGE_BYTES)

    def partitions(self) -> list[InputPartition]:
        from pyarrow.fs import FileSelector, FileType

        fs, base = filesystem(self.uri)
        files = [f for f in fs.get_file_info(FileSelector(base, recursive=True)) if f.type == FileType.File and f.path.endswith(".zip") and not f.base_name.startswith(("_", "."))]
        return [Range(f.path, f.size, a, min(a + self.range_bytes, f.size)) for f in sorted(files, key=lambda f: f.path) for a in range(0, f.size, self.range_bytes)]

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # Spark's stand-in for no partitions
            return
        fs, _ = filesystem(self.uri)
        held = {"source": None}

        def source_of(again: bool):
            if again or held["source"] is None:
                if held["source"] is not None:
                    held["source"].close()
                held["source"] = fs.open_input_file(part.path)
            return held["source"]

        rows, total = [], 0
        names, kinds = ["archive", "offset", "name", "payload", "error"], [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        for member in members(source_of(False), part.size):
            if part.start <= member[0] < part.end:
                data, error = fetch_retrying(source_of, member)
                rows.append((part.path, member[0], member[4], data, error))
                total += len(data or b"")
                if total >= BATCH_BYTES or len(rows) >= 4096:
                    yield batch(rows)
                    rows, total = [], 0
        if rows:
            yield batch(rows)
        source_of(False).close()


class ArchiveSource(DataSource):
    """format("archives").load(directory): archive, offset, name, payload, and error for a member that all tries failed on."""

    @classmethod
    def name(cls) -> str:
        return "archives"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(self.options)


def read_archives(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("archives").option("rangeBytes", range_bytes).load(path)


def write_archives(docs: DataFrame, to: str, id_col: str = "doc_id", text: str = "text") -> int:
    """Stores each row's text as a member of an archive under `to`; the number of members.

    Null and empty texts are stored as one unit of zeros. A member's name holds the id, the text's bytes and the row's
    place in its archive, so that repeated rows stay apart. A task writes to a name of its own and renames it at the end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, base = filesystem(to)
        fs.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}.zip"
        draft, n = f"{base}/_{name}.{uuid.uuid4().hex}", 0
        with fs.open_output_stream(draft) as out:
            w = ArchiveWriter(out)
            for batch in batches:
                for doc_id, raw in zip(batch.column("id").to_pylist(), texts(batch.column("text")), strict=True):
                    w.add(f"{'' if doc_id is None else doc_id}/{len(raw)}/{n}.wav", to_wave(pad(raw)))
                    n += 1
            w.close()
        fs.move(draft, f"{base}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    filesystem(to)[0].create_dir(filesystem(to)[1], recursive=True)
    rows = text_of(docs, F.col(id_col).cast("long").alias("id"), text=text)
    return rows.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def describe(archives: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per member of write_archives(): id, bytes, and digests of the payload and of the stored form, from the bytes read back.

    A member that could not be read fails the job: nothing is left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            rows = []
            for name, wave, error in zip(*(batch.column(c).to_pylist() for c in ("name", "payload", "error")), strict=True):
                if error:
                    raise OSError(f"{name}: {error}")
                doc_id, n, _ = name.split("/")
                p = from_wave(wave)
                rows.append((int(doc_id) if doc_id else None, int(n), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-UNIT:]), len(wave), hashlib.sha256(wave).hexdigest(), feature(p)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return archives.select("name", "payload", "error").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def store_and_read(docs: DataFrame, to: str | None = None) -> DataFrame:
    """Stores docs in a new folder of the shared store and describes what is read back."""
    spark = docs.sparkSession
    to = to or new_dir(spark, "media")
    write_archives(docs, to)
    return describe(read_archives(spark, to))
