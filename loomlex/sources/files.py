"""Tab-separated mapping sets with a commented header, sidecars, pinned inputs and archives."""

from __future__ import annotations

import hashlib
import json
import os
import tarfile
import zipfile
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean
from ..operators.mapping import COLUMNS, GAP_COLUMNS, SENSE_COLUMNS

SENSES = "sense_id string, lexeme_id string, headword string, pos string, sense_index string, domain string, domain_root string, gloss string, source string"


def split_header(text: str) -> tuple[list[str], str]:
    """The leading comment lines without their mark, and the rest; later lines with the mark are records."""
    head, lines = [], text.splitlines(keepends=True)
    for line in lines:
        if not line.startswith("#"):
            break
        head.append(line[1:].removeprefix(" "))
    return head, "".join(lines[len(head) :])


def parse_header(lines: Iterable[str]) -> dict:
    """The header's mapping: scalars, and one level of nested keys, which is all that mapping sets use."""
    out: dict = {}
    at = None
    for raw in lines:
        line = raw.rstrip("\n")
        if not line.strip():
            continue
        key, sep, value = line.strip().partition(": ") if ": " in line else (line.strip().removesuffix(":"), ":", "")
        if not sep:
            raise ValueError(f"not a header line: {line!r}")
        value = value.strip()
        value = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
        if line[:1] == " " and isinstance(out.get(at), dict):
            out[at][key] = value
        else:
            at = key
            out[key] = value if value else {}
    return out


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Unquoted records as strings with their number (row, from 1). The first line that is no leading comment names the columns.

    Rows keep the file's order; a file is read by one task, as its numbers need.
    """
    lines = spark.read.text(path, wholetext=True)
    body = F.regexp_replace("value", r"^(?:#[^\n]*\n)+", "")
    rows = lines.select(F.posexplode(F.split(F.regexp_replace(body, r"\r?\n\z", ""), r"\r?\n")).alias("row", "line"))
    head = rows.where("row = 0").select("line").first()
    if head is None or head["line"].split("\t") != columns:
        raise ValueError("columns must equal: " + " ".join(columns))
    cells = F.split("line", "\t")
    return rows.where("row > 0").select("row", F.size(cells).alias("n_cells"), *(F.try_element_at(cells, F.lit(i + 1)).alias(c) for i, c in enumerate(columns)))


def read_mapping_set(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    """(header, rows) of a mapping set."""
    head = []
    for r in spark.read.text(path).toLocalIterator():
        if not r["value"].startswith("#"):
            break
        head.append(r["value"][1:].removeprefix(" "))
    return parse_header(head), read_tsv(spark, path, COLUMNS)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Judged pairs; lines that start with a comment mark are skipped anywhere."""
    columns = "subject_id object_id verdict expected_predicate note".split()
    rows = spark.read.text(path).where("NOT startswith(value, '#')").select(F.split("value", "\t").alias("c"))
    return rows.where(F.col("c") != F.array(*map(F.lit, columns))).select(*(F.try_element_at("c", F.lit(i + 1)).alias(c) for i, c in enumerate(columns)))


def read_senses(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """Dictionary senses from Parquet or a JSON list; missing strings are empty, a missing index is 0, a missing source is null."""
    if kind == "json":
        rows = spark.read.schema(SENSES).option("multiLine", True).json(path)
    else:
        rows = spark.read.parquet(path)
        rows = rows if "source" in rows.columns else rows.withColumn("source", F.lit(None).cast("string"))
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("sense_id", "lexeme_id", "headword", "pos", "domain", "domain_root", "gloss")]
    return rows.select(*text, F.coalesce(F.col("sense_index").try_cast("int"), F.lit(0)).alias("sense_index"), "source")


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """The senses of a sidecar, one per id: the last in the file where an id repeats."""
    rows = read_tsv(spark, path, SENSE_COLUMNS)
    last = rows.groupBy("sense_id").agg(F.max_by(F.struct(*SENSE_COLUMNS), "row").alias("s"))
    return last.select("s.*")


CASES = "case_id string, family string, locale string, authority string, source_kind string, source_ref string, adjudication_hash string, input struct<source: string, candidate: string>, expected_verdict string, expected_defect_types array<string>"


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation cases from JSON lines, with `expected` for the expected verdict; ValueError if review.case_findings() has any."""
    from ..operators.review import case_findings

    rows = spark.read.schema(CASES).option("mode", "FAILFAST").json(path).withColumnRenamed("expected_verdict", "expected")
    bad = case_findings(rows).orderBy("case_id", "code").first()
    if bad is not None:
        raise ValueError(f"case {bad['case_id']}: {bad['code']}")
    return rows


def read_policy(path: str) -> dict:
    """A policy file of nested settings: YAML, or JSON where no YAML reader is at hand. A configuration, read on the driver."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml
    except ImportError:
        return json.loads(text)
    return yaml.safe_load(text) or {}


DEBT = "debt_id string, subject string, predicate string, language string, datatype string, current_hash string, defect_class string, finding string, discovery string, state string, replacement string"


def read_debt(spark: SparkSession, path: str) -> DataFrame:
    """A ledger of confirmed debt from a JSON list; ValueError if review.debt_findings() has any."""
    from ..operators.review import debt_findings

    rows = spark.read.schema(DEBT).option("multiLine", True).option("mode", "FAILFAST").json(path)
    bad = debt_findings(rows).orderBy("debt_id", "code").first()
    if bad is not None:
        raise ValueError(f"debt {bad['debt_id']}: {bad['code']}")
    return rows


def read_canonical(path: str):
    """A JSON artifact whose bytes are canonical, or ValueError. Artifacts are summaries and fit the driver."""
    with open(path, "rb") as f:
        raw = f.read()
    value = json.loads(raw)
    if raw.rstrip(b"\n") != canonical_bytes(value):
        raise ValueError(f"{path} is not canonical JSON")
    return value


def project_schema(schema: dict, without: tuple[str, ...] = ("allOf", "if", "then", "else", "uniqueItems")) -> dict:
    """A JSON schema without some keywords, at any depth."""
    deep = lambda v: project_schema(v, without) if isinstance(v, dict) else [deep(x) for x in v] if isinstance(v, list) else v
    return {k: deep(v) for k, v in schema.items() if k not in without}


def digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, sha256) of files in a store that all executors see; each is streamed by one task, whatever its size."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                fs, at = FileSystem.from_uri(path if "://" in path else "file://" + os.path.abspath(path))
                h = hashlib.sha256()
                with fs.open_input_stream(at) as f:
                    while block := f.read(1 << 20):
                        h.update(block)
                found.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], ["path", "sha256"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return listed.mapInArrow(run, "path string, sha256 string")


def check_pins(spark: SparkSession, pins: dict[str, str]) -> None:
    """Each file's sha-256 is the pinned one, or ValueError before anything is planned on it."""
    for row in digests(spark, list(pins)).collect():  # a row per pinned file
        if row["sha256"] != pins[row["path"]]:
            raise ValueError(f"{row['path']}: expected {pins[row['path']]}, got {row['sha256']}")


def fingerprint(df: DataFrame) -> str:
    """A hash of column names and types, which tells when a source's schema drifts."""
    return hashlib.sha256(",".join(f"{n}:{t}" for n, t in df.dtypes).encode()).hexdigest()


def write_tsv(rows: DataFrame, path: str, columns: list[str], order: list[str], header: dict | None = None) -> int:
    """Records in order under the header, as one file; the number of records. Rows stream through the driver."""
    n = 0
    draft = f"{path}.{os.getpid()}.tmp"
    with open(draft, "w", encoding="utf-8", newline="") as out:
        for k, v in (header or {}).items():
            if isinstance(v, dict):
                out.write(f"# {k}:\n" + "".join(f"#   {a}: {b}\n" for a, b in v.items()))
            else:
                out.write(f"# {k}: {v}\n")
        out.write("\t".join(columns) + "\n")
        for r in rows.select(*(F.coalesce(clean(F.col(c).cast("string")), F.lit("")).alias(c) for c in columns)).orderBy(*order).toLocalIterator():
            out.write("\t".join(r) + "\n")
            n += 1
    os.replace(draft, path)
    return n


def write_mapping_set(rows: DataFrame, path: str, header: dict) -> int:
    return write_tsv(rows, path, COLUMNS, ["subject_id", "predicate_id", "object_id"], header)


def write_senses(senses: DataFrame, rows: DataFrame, path: str) -> int:
    """The senses that rows name, once each."""
    used = rows.select(F.regexp_replace("object_id", "^[^:]*:", "").alias("sense_id")).distinct()
    return write_tsv(senses.join(used, "sense_id", "left_semi").dropDuplicates(["sense_id"]), path, SENSE_COLUMNS, ["sense_id"])


def write_gaps(gaps: DataFrame, path: str) -> int:
    return write_tsv(gaps, path, GAP_COLUMNS, GAP_COLUMNS)


def publish(path: str, data: bytes) -> None:
    """Writes once: the same bytes again are fine, other bytes are refused."""
    if os.path.exists(path):
        with open(path, "rb") as f:
            if f.read() != data:
                raise FileExistsError(f"{path} holds something else")
        return
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    draft = f"{path}.{os.getpid()}.tmp"
    with open(draft, "wb") as f:
        f.write(data)
    os.replace(draft, path)


def canonical_bytes(value) -> bytes:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()


def append_ledger(path: str, entries: list[dict], key: str = "record_id") -> None:
    """Adds entries to a ledger of canonical JSON; an entry that is there may not change."""
    held = []
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
    by = {e[key]: e for e in held}
    for e in entries:
        if by.setdefault(e[key], e) != e:
            raise ValueError(f"ledger entry changed: {e[key]}")
    draft = f"{path}.{os.getpid()}.tmp"
    with open(draft, "wb") as f:
        f.write(canonical_bytes(sorted(by.values(), key=lambda e: e[key])) + b"\n")
    os.replace(draft, path)


def newest_member(path: str, mark: str = "REVISION-HEAD") -> bytes:
    """The ontology in a zip archive: the member with the mark in its name, else the only one."""
    with zipfile.ZipFile(path) as z:
        names = [n for n in z.namelist() if n.endswith(".owl")]
        marked = [n for n in names if mark in n] or names
        if len(marked) != 1:
            raise ValueError(f"{path} holds {len(marked)} candidates")
        return z.read(marked[0])


def safe_extract(path: str, to: str, sha256: str) -> list[str]:
    """Regular files of a checked tar archive; links, devices and names that lead out of `to` are refused."""
    with open(path, "rb") as f:
        if hashlib.file_digest(f, "sha256").hexdigest() != sha256:
            raise ValueError("the archive's digest is another")
    with tarfile.open(path) as t:
        members = t.getmembers()
        for m in members:
            if not (m.isfile() or m.isdir()) or os.path.isabs(m.name) or ".." in m.name.split("/"):
                raise ValueError(f"refused: {m.name}")
        t.extractall(to, members, filter="data")
    return [m.name for m in members if m.isfile()]


def local_names(spark: SparkSession, paths: list[str], namespace: str) -> DataFrame:
    """(name): all local names of the namespace in texts, declared or not."""
    import re

    shape = re.escape(namespace).replace("\\-", "-") + r"([0-9A-Za-z_.#+-]+)"
    return spark.read.text(paths).select(F.explode(F.regexp_extract_all("value", F.lit(shape), F.lit(1))).alias("name")).distinct()
