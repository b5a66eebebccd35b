"""A data source that publishes lines once: format("loomlex-lines").mode("append").save(path).

Each task writes its partition beside the target and reports the digest of its lines; only the commit moves parts into
place, with the header before and the footer after them, so that the parts one after the other, by name, are the document.
A task that fails and runs again leaves one part, a job that fails leaves none. The manifest comes last and holds the
digest of all lines, whatever their dealing: the same lines again change nothing, others are refused. No line passes the driver.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators.tables import swept
from .xmlranges import MANIFEST, filesystem

_MOD = 1 << 256


@dataclass
class _Part(WriterCommitMessage):
    name: str
    number: int
    lines: int
    total: int


class LinesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.header, self.footer = options["path"].rstrip("/"), options.get("header", ""), options.get("footer", "")
        self.suffix, self.job = options.get("suffix", ".txt"), uuid.uuid4().hex

    def _draft(self, at: str) -> str:
        return f"{at}/_draft-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        context = TaskContext.get()
        number, attempt = context.partitionId(), context.taskAttemptId()
        fs, at = filesystem(self.path)
        fs.create_dir(self._draft(at))
        name, lines, total = f"{self._draft(at)}/{number}-{attempt}-{uuid.uuid4().hex}", 0, 0
        with fs.open_output_stream(name) as out:
            for batch in iterator:
                for cell in batch.column(0):  # one by one: a batch of long lines is not copied
                    raw = ((cell.as_py() or "") + "\n").encode()
                    out.write(raw)
                    lines += 1
                    total = (total + int.from_bytes(hashlib.sha256(raw).digest())) % _MOD
        return _Part(name, number, lines, total)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, at = filesystem(self.path)
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.number)
        total = sum(m.total for m in parts) % _MOD
        content = hashlib.sha256("\x1f".join([self.header, self.footer, str(sum(m.lines for m in parts)), f"{total:064x}"]).encode()).hexdigest()
        held = read_manifest(self.path)
        if held is not None:
            self._clear(fs, at)
            if held["content"] != content:
                raise FileExistsError(f"{self.path} holds something else")
            return
        from pyarrow.fs import FileSelector, FileType

        for f in fs.get_file_info(FileSelector(at, allow_not_found=True)):  # of a commit that did not come to its end
            if f.type == FileType.File and f.base_name.startswith("part-"):
                fs.delete_file(f.path)
        named = []
        for k, (source, text) in enumerate([(None, self.header), *((m.name, None) for m in parts if m.lines), (None, self.footer)]):
            name = f"part-{k:06d}{self.suffix}"
            if source:
                fs.move(source, f"{at}/{name}")
            elif text:
                with fs.open_output_stream(f"{at}/{name}") as out:
                    out.write(text.encode())
            else:
                continue
            named.append(name)
        with fs.open_output_stream(f"{self._draft(at)}.json") as out:
            out.write(json.dumps({"content": content, "lines": sum(m.lines for m in parts), "parts": named}, sort_keys=True).encode())
        fs.move(f"{self._draft(at)}.json", f"{at}/{MANIFEST}")
        self._clear(fs, at)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(*filesystem(self.path))

    def _clear(self, fs, at: str) -> None:
        from pyarrow.fs import FileType

        if fs.get_file_info(self._draft(at)).type == FileType.Directory:
            fs.delete_dir(self._draft(at))


class LinesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "loomlex-lines"

    def schema(self) -> str:
        return "line string"

    def writer(self, schema, overwrite: bool) -> LinesWriter:
        return LinesWriter(self.options)


def read_manifest(path: str) -> dict | None:
    """What a publication says of itself; None if it is absent or not whole."""
    from pyarrow.fs import FileType

    fs, at = filesystem(path)
    if fs.get_file_info(f"{at.rstrip('/')}/{MANIFEST}").type != FileType.File:
        return None
    with fs.open_input_stream(f"{at.rstrip('/')}/{MANIFEST}") as f:
        return json.loads(f.read())


def publish_lines(lines: DataFrame, path: str, header: str = "", footer: str = "", suffix: str = ".txt") -> dict:
    """Publishes the one string column of lines, in the order of its partitions and rows; the manifest.

    FileExistsError if the path holds other lines. Null lines are empty ones; an empty table gives header and footer alone.
    """
    lines.sparkSession.dataSource.register(LinesSource)
    try:
        with swept(lines.sparkSession):
            lines.write.format("loomlex-lines").mode("append").options(header=header, footer=footer, suffix=suffix).save(path)
    except Exception as e:
        if "holds something else" in str(e):
            raise FileExistsError(f"{path} holds something else") from e
        raise
    return read_manifest(path)


def publish_tsv(rows: DataFrame, path: str, columns: list[str], order: list[str], header: dict | None = None) -> dict:
    """Tab-separated records under a commented header, sorted by ranges over many parts; the manifest. Nulls are empty cells."""
    from ..functions.text import clean

    head = ""
    for k, v in (header or {}).items():
        head += f"# {k}:\n" + "".join(f"#   {a}: {b}\n" for a, b in v.items()) if isinstance(v, dict) else f"# {k}: {v}\n"
    cells = rows.select(*(F.coalesce(clean(F.col(f"`{c}`").cast("string")), F.lit("")).alias(c) for c in columns))
    every = [*order, *(c for c in columns if c not in order)]
    return publish_lines(cells.orderBy(*every).select(F.concat_ws("\t", *columns).alias("line")), path, head + "\t".join(columns) + "\n", "", ".tsv")


def join_parts(spark: SparkSession, path: str, to: str) -> None:
    """A publication's parts as one file, streamed by a task, for readers that want one; write-once by the same rule."""
    told = read_manifest(path)
    if told is None:
        raise FileNotFoundError(f"{path} holds no whole publication")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fs, at = filesystem(path)
            out_fs, out_at = filesystem(to)
            draft = f"{out_at}.{uuid.uuid4().hex}.tmp"
            with out_fs.open_output_stream(draft) as out:
                for name in told["parts"]:
                    with fs.open_input_stream(f"{at.rstrip('/')}/{name}") as f:
                        while piece := f.read(1 << 20):
                            out.write(piece)
            yield pa.RecordBatch.from_pydict({"draft": [draft]})

    draft = spark.range(1, numPartitions=1).mapInArrow(run, "draft string").first()[0]
    fs, at = filesystem(to)
    from pyarrow.fs import FileType

    if fs.get_file_info(at).type == FileType.File:
        with fs.open_input_stream(at) as a, fs.open_input_stream(draft) as b:
            same = _digest(a) == _digest(b)
        fs.delete_file(draft)
        if not same:
            raise FileExistsError(f"{to} holds something else")
        return
    fs.move(draft, at)


def _digest(stream) -> str:
    h = hashlib.sha256()
    while piece := stream.read(1 << 20):
        h.update(piece)
    return h.hexdigest()
