"""URL filters: a trie over reversed host labels, then path segments, with longest-match precedence.

A rule is (host, path, verdict). It fits its host and all subdomains if the URL's path starts with the rule's path;
of the rules that fit, the longest (host and path together, then host) decides; of equals, block does.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: The trie is broadcast with the tasks; this many rules stay below about 200 MB. Longer lists go through match_by_join.
MAX_RULES = 200_000
_LOWER = {c: c + 32 for c in range(65, 91)}
#: The query's rules.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def split_url(url: str | None) -> tuple[str, str]:
    """Host (after the first "://", ASCII letters lower-cased) and path; both empty for null or without "://"."""
    if not url:
        return "", ""
    _, sep, rest = url.partition("://")
    if not sep:
        return "", ""
    cut = min((i for i in (rest.find("/"), rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    tail = rest[cut:]
    end = min((i for i in (tail.find("?"), tail.find("#")) if i >= 0), default=len(tail))
    return rest[:cut].translate(_LOWER), tail[:end]


@dataclass
class _Path:
    """A node of whole path segments. rule: what ends here; open: rules that end within the next segment, by their last piece, and sizes the lengths of these pieces."""

    next: dict[str, _Path] = field(default_factory=dict)
    rule: tuple[int, int, bool, str] | None = None
    open: dict[str, tuple[int, int, bool, str]] = field(default_factory=dict)
    sizes: set[int] = field(default_factory=set)


@dataclass
class _Host:
    next: dict[str, _Host] = field(default_factory=dict)
    path: _Path | None = None
    bare: tuple[int, int, bool, str] | None = None


class Trie:
    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root = _Host()
        for n, (host, path, verdict) in enumerate(rules):
            if n >= MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules; use match_by_join")
            if verdict not in ("allow", "block"):
                raise ValueError(f"a rule's verdict is allow or block, not {verdict!r}")
            host = host.translate(_LOWER)
            rule = (len(host) + len(path), len(host), verdict == "block", host + path)
            node = self.root
            for label in reversed(host.split(".")):
                node = node.next.setdefault(label, _Host())
            if not path:
                node.bare = max(rule, node.bare or rule)
                continue
            if not path.startswith("/"):
                raise ValueError(f"a rule's path starts with a slash: {path!r}")
            at = node.path = node.path or _Path()
            *whole, last = path[1:].split("/")
            for segment in whole:
                at = at.next.setdefault(segment, _Path())
            if last:
                at.open[last] = max(rule, at.open.get(last, rule))
                at.sizes.add(len(last))
            else:
                at.rule = max(rule, at.rule or rule)

    def find(self, host: str, path: str) -> tuple[int, int, bool, str] | None:
        """The rule that decides, as (length, length of the host, is it a block, its string)."""
        best, node = None, self.root
        segments = path[1:].split("/") if path.startswith("/") else None
        for label in reversed(host.split(".")):
            node = node.next.get(label)
            if node is None:
                break
            if node.bare and (best is None or node.bare > best):
                best = node.bare
            at = node.path
            if at is None or segments is None:
                continue
            for i, segment in enumerate(segments):
                if at.rule and (best is None or at.rule > best):
                    best = at.rule
                for n in at.sizes:
                    rule = at.open.get(segment[:n])
                    if rule and (best is None or rule > best):
                        best = rule
                if i + 1 == len(segments):  # no slash follows
                    break
                at = at.next.get(segment)
                if at is None:
                    break
        return best


def match(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, default: str = "allow", id_col: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: id, host, path, rule (null if none fits) and verdict (the default if none fits).

    Null and malformed URLs have empty host and path and get the default. Rows correspond one to one, repeated rows
    too; an empty table stays empty; other columns are ignored.
    """
    trie = Trie(rules)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts, paths, found, verdicts = [], [], [], []
        for u in batch.column("url").to_pylist():
            host, path = split_url(u)
            best = trie.find(host, path)
            hosts.append(host)
            paths.append(path)
            found.append(best and best[3])
            verdicts.append(default if best is None else "block" if best[2] else "allow")
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array(x, pa.string()) for x in (hosts, paths, found, verdicts))], ["id", "host", "path", "rule", "verdict"]
        )

    kind = dict(pages.dtypes)[id_col]
    rows = pages.select(F.col(id_col).alias("id"), F.col(url).cast("string").alias("url"))
    return map_batches(rows, kernel, f"id {kind}, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col)


def match_by_join(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url: str = "url") -> DataFrame:
    """match() for lists beyond MAX_RULES: rules (host, path, verdict) is a table, joined on each of a URL's host suffixes.

    The same result, null and repeated ids included, as host and path decide; without a broadcast; the join's hot suffixes are split by Spark at run time.
    """
    u = F.col("url")
    start = F.instr(u, "://")
    rest = F.when(start > 0, u.substr(start + 3, F.length(u))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url")).select("id", host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = rows.select("host", "path").distinct().select("host", "path", F.explode(suffixes).alias("rule_host"))
    listed = rules.select(F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    fits = keys.join(listed, "rule_host").where(F.startswith("path", "rule_path"))
    best = F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), F.col("verdict") == "block"))
    chosen = fits.groupBy("host", "path").agg(best.alias("best"))
    return rows.join(chosen, ["host", "path"], "left").select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


ORACLE = r"""
WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rh, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (SELECT page_id, rh || rp AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS n
      FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT h.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM h LEFT JOIN f ON f.page_id = h.page_id AND n = 1
"""
