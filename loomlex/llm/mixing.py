"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

The tree is domain, language, source. A budget of tokens flows down it: at each node the children share what their
parent got by weight, and what a child cannot use (it holds too few tokens, even over all epochs) is shared again among
its siblings; only what all siblings cannot use was never given to their parent, so that its own siblings got it.
A leaf spends its allocation on whole epochs, then on a prefix of one more epoch in an order seeded per epoch.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

LEVELS = ("domain", "lang", "source")
NONE = "(none)"
#: Hex digits of the order that one narrowing step looks at, and the steps before the boundary's rows are sorted.
DIGITS, STEPS = 2, 2
#: The query's tree. Paths that are not listed weigh 1; a domain is a source's number modulo 3.
DOMAINS = ("web", "books", "reference")
WEIGHTS: Mapping[tuple[str, ...], int] = {
    ("web",): 5, ("books",): 3, ("reference",): 2,
    **{(d, lang): w for d in (*DOMAINS, NONE) for lang, w in (("en", 6), ("de", 2), ("fr", 2))},
    **{("web", lang, "src0"): 3 for lang in ("en", "de", "fr", "es")},
}
SEED = "mix-1"


def domain_of_source(source: str = "source") -> Column:
    number = F.try_to_number(F.regexp_extract(F.coalesce(F.col(source), F.lit("")), r"^src([0-9]{1,9})$", 1), F.lit("999999999")).cast("long")
    return F.when(number.isNull(), NONE).otherwise(F.element_at(F.array(*map(F.lit, DOMAINS)), (F.coalesce(number, F.lit(0)) % 3 + 1).cast("int")))


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(path: list[str], weights: Mapping[tuple[str, ...], int]) -> Column:
    known = {k: w for k, w in weights.items() if len(k) == len(path)}
    if not known:
        return F.lit(1).cast("long")
    table = F.create_map(*(F.lit(x) for k, w in known.items() for x in ("\x1f".join(k), int(w))))
    return F.coalesce(F.try_element_at(table, F.concat_ws("\x1f", *path)), F.lit(1)).cast("long")


def fill(nodes: DataFrame, parent: list[str], name: str, budget: str = "budget") -> DataFrame:
    """Shares each parent's budget among its children (weight, cap): min(cap, weight * level), in whole tokens.

    Children are taken in order of cap per weight; one is full as long as its part of what is left for it and those
    after it would reach its cap. The rest share what is left. Rounding leaves less than a token per child. A child of
    weight 0 comes last and gets nothing.
    """
    order = W.partitionBy(*(parent or [F.lit(0)])).orderBy(F.asc_nulls_last(F.try_divide("cap", "weight")), name)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everyone = W.partitionBy(*(parent or [F.lit(0)]))
    big = lambda c: c.cast("decimal(19,0)")
    left = F.col(budget) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rest = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    full = (F.col("weight") > 0) & (big(F.col("cap")) * big(rest) <= big(F.col("weight")) * big(left))
    marked = nodes.withColumn("full", full)
    spent = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everyone)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everyone)
    marked = marked.withColumn("spent", spent).withColumn("open_weight", open_weight)
    part = F.expr(f"cast(weight as decimal(19,0)) * cast({budget} - spent as decimal(19,0)) div greatest(open_weight, 1)").cast("long")
    return marked.withColumn("allocated", F.when(F.col("full"), F.col("cap")).otherwise(part)).drop("full", "spent", "open_weight")


def allocate(leaves: DataFrame, budget: Column, epochs: int, weights: Mapping[tuple[str, ...], int]) -> DataFrame:
    """leaves (domain, lang, source, supply) with `allocated` tokens; budget: an aggregate over supply."""
    caps = leaves.withColumn("cap", F.col("supply") * F.lit(epochs))
    total = leaves.agg(budget.cast("long").alias("budget"))
    given = total
    for depth in range(1, 4):
        path = list(LEVELS[:depth])
        nodes = caps.groupBy(*path).agg(F.sum("cap").alias("cap"), F.sum("supply").alias("supply"))
        nodes = nodes.withColumn("weight", _weight(path, weights))
        # The root is one row; a level's nodes meet their own parent's row.
        nodes = nodes.join(given, path[:-1]) if depth > 1 else nodes.join(F.broadcast(given), F.lit(True))
        given = fill(nodes, path[:-1], path[-1]).select(*path, "supply", F.col("allocated").alias("budget"))
        if depth < 3:
            given = given.drop("supply")
    return given.select(*LEVELS, "supply", F.col("budget").alias("allocated"))


def select(rows: DataFrame, leaves: DataFrame, seed: str) -> DataFrame:
    """rows (id, t, domain, lang, source, n_tokens) times the epochs in which each is taken; t is the text's digest.

    The partial epoch's prefix is found from sums per leading digits of the order, so that no task sorts a whole leaf.
    """
    leaf = list(LEVELS)
    spend = leaves.where("supply > 0").select(
        *leaf, F.expr("allocated div supply").cast("int").alias("whole"), F.expr("allocated - (allocated div supply) * supply").alias("left")
    )
    placed = rows.join(spend, leaf).withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), F.col("whole").cast("string"), F.coalesce(F.col("id").cast("string"), F.lower(F.hex("t"))))))
    bounds = spend.select(*leaf, F.lit("").alias("prefix"), "left")
    for step in range(STEPS):
        here = placed.select(*leaf, "key", "n_tokens").join(bounds.select(*leaf, "prefix"), leaf).where(F.substring("key", 1, DIGITS * step) == F.col("prefix"))
        sums = here.groupBy(*leaf, F.substring("key", 1, DIGITS * (step + 1)).alias("next")).agg(F.sum("n_tokens").alias("n"))
        run = W.partitionBy(*leaf).orderBy("next")
        crossed = sums.join(bounds, leaf).withColumn("to", F.sum("n").over(run)).where(F.col("to") > F.col("left"))
        bounds = crossed.groupBy(*leaf).agg(F.min(F.struct("next", (F.col("left") - F.col("to") + F.col("n")).alias("left"))).alias("b"))
        bounds = bounds.select(*leaf, F.col("b.next").alias("prefix"), F.col("b.left").alias("left"))
    bounds = written(bounds, "bounds")
    at = placed.drop("left").join(bounds, leaf).withColumn("side", F.substring("key", 1, DIGITS * STEPS))
    out = [*rows.columns]
    edge = at.where("side = prefix").withColumn("to", F.sum("n_tokens").over(W.partitionBy(*leaf).orderBy("key", "id", "t")))
    partial = at.where("side < prefix").select(*out, F.col("whole").alias("epoch")).unionAll(edge.where("to <= left").select(*out, F.col("whole").alias("epoch")))
    full = placed.where("whole > 0").select(*out, F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"))
    return full.unionAll(partial)


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


def plan(
    docs: DataFrame, fraction: tuple[int, int] = (3, 5), epochs: int = 2, weights: Mapping[tuple[str, ...], int] = WEIGHTS,
    domain: Column | None = None, seed: str = SEED, id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Which document is taken in which epoch: id, domain, lang, source, n_tokens (words), epoch.

    The budget is fraction[0] / fraction[1] of all tokens. Null lang or source count as "(none)". Texts without words
    are taken where they fall within a prefix; a leaf of nothing but such texts is never taken. A row stands in the order
    by its id, or by its text's digest where it has none, and rows of one id by their texts; only rows of one leaf, id and
    text are taken or left together. An empty table gives an empty result; other columns are ignored.
    """
    return _planned(docs, fraction, epochs, weights, domain, seed, id_col, text).drop("t").withColumnRenamed("id", id_col)


def _planned(docs: DataFrame, fraction: tuple[int, int], epochs: int, weights: Mapping[tuple[str, ...], int], domain: Column | None, seed: str, id_col: str, text: str) -> DataFrame:
    label = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c)
    domain = domain_of_source() if domain is None else domain
    rows = written(docs.select(F.col(id_col).alias("id"), _digest(text).alias("t"), domain.alias("domain"), label("lang"), label("source"), word_count(text).alias("n_tokens")), "mix-rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("supply"))
    budget = F.expr(f"coalesce(sum(supply), 0) * {int(fraction[0])} div {int(fraction[1])}")
    allocated = written(allocate(leaves, budget, epochs, weights), "mix-leaves")
    return select(rows, allocated, seed)


def mix(docs: DataFrame, fraction: tuple[int, int] = (4, 5), weights: Mapping[tuple[str, ...], int] = WEIGHTS, seed: str = SEED, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, unchanged, that one epoch takes: by leaf, id and text, so that rows of one id, or of none, are told apart by their texts."""
    taken = _planned(docs, fraction, 1, weights, None, seed, id_col, text).select(F.col("id").alias("_taken"), "t", *(F.col(c).alias(f"_{c}") for c in LEVELS[1:])).distinct().hint("merge")
    same = [docs[id_col].eqNullSafe(taken["_taken"]), _digest(text) == taken["t"], *(F.coalesce(docs[c].cast("string"), F.lit(NONE)) == taken[f"_{c}"] for c in LEVELS[1:])]
    return docs.join(taken, same, "left_semi")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
         CASE WHEN regexp_full_match(coalesce(source, ''), 'src[0-9]{1,9}')
              THEN ['web', 'books', 'reference'][CAST(substr(source, 4) AS BIGINT) % 3 + 1] ELSE '(none)' END AS domain,
         md5(coalesce(text, '')) AS t, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS HUGEINT) AS n_tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens) AS supply, sum(n_tokens) * 2 AS cap,
                CASE WHEN domain = 'web' AND source = 'src0' AND lang IN ('en', 'de', 'fr', 'es') THEN 3 ELSE 1 END AS weight FROM d GROUP BY ALL),
n1 AS (SELECT domain, sum(cap) AS cap, CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'reference' THEN 2 ELSE 1 END AS weight,
              (SELECT coalesce(sum(supply), 0) * 3 // 5 FROM leaf) AS budget FROM leaf GROUP BY domain),
m1 AS (SELECT *, cap * (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) <= weight * (budget - coalesce(sum(cap) OVER b, 0)) AS is_full
       FROM n1 WINDOW b AS (ORDER BY cap / weight, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a1 AS (SELECT domain, CASE WHEN is_full THEN cap ELSE weight * (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())
              // greatest(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (), 1) END AS budget FROM m1),
n2 AS (SELECT domain, lang, sum(cap) AS cap, CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS weight, any_value(budget) AS budget
       FROM leaf JOIN a1 USING (domain) GROUP BY domain, lang),
m2 AS (SELECT *, cap * (sum(weight) OVER (PARTITION BY domain) - coalesce(sum(weight) OVER b, 0)) <= weight * (budget - coalesce(sum(cap) OVER b, 0)) AS is_full
       FROM n2 WINDOW b AS (PARTITION BY domain ORDER BY cap / weight, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a2 AS (SELECT domain, lang, CASE WHEN is_full THEN cap ELSE weight * (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER (PARTITION BY domain))
              // greatest(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY domain), 1) END AS budget FROM m2),
n3 AS (SELECT leaf.*, budget FROM leaf JOIN a2 USING (domain, lang)),
m3 AS (SELECT *, cap * (sum(weight) OVER (PARTITION BY domain, lang) - coalesce(sum(weight) OVER b, 0)) <= weight * (budget - coalesce(sum(cap) OVER b, 0)) AS is_full
       FROM n3 WINDOW b AS (PARTITION BY domain, lang ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a3 AS (SELECT domain, lang, source, supply, CASE WHEN is_full THEN cap ELSE weight * (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER (PARTITION BY domain, lang))
              // greatest(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY domain, lang), 1) END AS allocated FROM m3),
p AS (SELECT d.*, allocated // supply AS whole, allocated % supply AS rest FROM d JOIN a3 USING (domain, lang, source) WHERE supply > 0),
o AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('mix-1:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), t)), doc_id, t) AS upto FROM p)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(epoch AS INTEGER) AS epoch
FROM (SELECT *, unnest(generate_series(0, CAST(whole AS BIGINT) - 1)) AS epoch FROM o
      UNION ALL SELECT *, whole AS epoch FROM o WHERE upto <= rest)
"""
