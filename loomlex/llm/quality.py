"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements and one bit per failed rule;
policies are versioned masks over those bits, and ablations are bitwise aggregations of the ledger, so that a
policy can be changed or studied without reading a text again.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_of, texts

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper")
_SYMBOLS, _SPACE = b"#*$%&|<>", b" \t\n\v\f\r"
_ASCII_UPPER = bytes(range(65, 91))
_NOT_ASCII_LETTERS = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122))


def rules() -> dict[str, Column]:
    """Rule name to its failure, over the measurements; a rule's bit is its place here, which never changes."""
    c = {k: F.col(k) for k in MEASURES}
    return {
        "few_words": c["n_words"] < 50,
        "repeated_words": 100 * c["n_repeat_words"] > 50 * c["n_words"],
        "symbols": 10 * c["n_symbols"] > 3 * c["n_words"],
        "repeated_lines": (c["n_lines"] >= 4) & (100 * c["n_dup_lines"] > 40 * c["n_lines"]),
        "capitals": (c["n_letters"] >= 50) & (2 * c["n_upper"] > c["n_letters"]),
        "word_length": (c["n_words"] > 0) & ((c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 30 * c["n_words"])),
    }


#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_words", "symbols", "repeated_lines", "capitals", "word_length"),
}
CURRENT = "v2"


def mask(policy: str) -> int:
    names = list(rules())
    return sum(1 << names.index(r) for r in POLICIES[policy])


def repeat_words(ws: list[bytes], width: int = 3) -> int:
    """Words in windows of `width` words that the text holds twice or more, the first one included."""
    seen: dict = {}
    at = seen.setdefault
    hits = set()
    for i, window in enumerate(zip(*(ws[k:] for k in range(width)), strict=False)):
        first = at(window, i)
        if first != i:
            hits.add(first)
            hits.add(i)
    if not hits:
        return 0
    return len(set().union(*({h + k for h in hits} for k in range(width))))


def _line_counts(text: bytes) -> tuple[int, int]:
    if b"\n" not in text:
        return int(bool(text.strip())), 0
    seen, lines = set(), 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            seen.add(line)
    return lines, lines - len(seen)


def _measure(batch: pa.RecordBatch) -> pa.RecordBatch:
    raw = texts(batch.column("text"))
    points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
    rows = []
    for text, n_points in zip(raw, points, strict=True):
        ws = text.split()
        n_lines, dup = _line_counts(text)
        n = len(text)
        # Letters are ASCII letters; accented ones count as neither, which leaves the share of capitals sound.
        ascii_letters = text.translate(None, _NOT_ASCII_LETTERS)
        n_upper = len(ascii_letters) - len(ascii_letters.translate(None, _ASCII_UPPER))
        rows.append((
            len(ws), n_points - (n - len(text.translate(None, _SPACE))), n - len(text.translate(None, _SYMBOLS)),
            dup, repeat_words(ws), n_lines, len(ascii_letters), n_upper,
        ))
    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
    keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *columns], [*(batch.schema.names[i] for i in keep), *MEASURES])


def ledger(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, the measurements, and `failures`, a bitmask of the rules that it fails.

    A null or empty text has no words: all measurements are zero and `few_words` fails. Repeated rows give repeated
    ledger rows; an empty table gives an empty ledger; further columns of docs are ignored, whatever their names.
    """
    kind = dict(docs.dtypes)[id_col]
    measured = map_batches(
        text_of(docs, F.col(id_col).alias("id"), text=text), _measure, f"id {kind}, " + ", ".join(f"{m} long" for m in MEASURES)
    )
    bits = sum((F.when(fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(rules().values())), F.lit(0))
    return measured.select(F.col("id").alias(id_col), *MEASURES, bits.cast("int").alias("failures"))


def failed(policy: str) -> Column:
    """Whether a ledger row fails any rule of the policy."""
    return F.col("failures").bitwiseAND(F.lit(mask(policy))) != 0


def apply_policy(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with `kept` under a policy."""
    return rows.withColumn("kept", ~failed(policy))


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that only it rejects (kept without it).

    The ledger is first reduced to a count per bitmask, which is at most 2 to the number of rules rows.
    """
    names, m = list(rules()), mask(policy)
    counts = rows.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).alias("bit")) for r in POLICIES[policy])))
    return (
        counts.select("failures", "n", each.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("failures").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("failures").bitwiseAND(F.lit(m)) == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        )
    )


def keep_good(docs: DataFrame, policy: str = CURRENT, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, unchanged, that pass the policy, in one pass over the texts."""
    fields = {f"c{i}": c for i, c in enumerate(docs.columns)}
    packed = docs.select(F.struct(*(F.col(f"`{c}`").alias(k) for k, c in fields.items())).alias("id"), F.col(text).alias("text"))
    kept = apply_policy(ledger(packed, "id"), policy).where("kept")
    return kept.select(*(F.col(f"id.{k}").alias(c) for k, c in fields.items()))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS a, unnest(generate_series(1, len(ws))) AS i FROM d),
g AS (SELECT *, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM g WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
rw AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
ln AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
        coalesce(rw.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper
      FROM d LEFT JOIN rw USING (doc_id) LEFT JOIN ln USING (doc_id)),
f AS (SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
        + CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END + CASE WHEN n_letters >= 50 AND 2 * n_upper > n_letters THEN 16 ELSE 0 END
        + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 30 * n_words) THEN 32 ELSE 0 END AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 AS base_failed, bits = 0 AS kept, CAST(bits AS INTEGER) AS failure_bits FROM f
"""
