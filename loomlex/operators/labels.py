"""Analytics over labels: ambiguity, collisions, disjointness, coverage, lookup; and neighbours in sort order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import identity
from .tables import stored


def ambiguous_forms(forms: DataFrame) -> DataFrame:
    """(form, n_concepts) of forms (subject, form) that stand for several concepts."""
    return forms.groupBy("form").agg(F.countDistinct("subject").alias("n_concepts")).where("n_concepts > 1")


def collisions(proposed: DataFrame, existing: DataFrame) -> DataFrame:
    """(subject, form, language, n_other): proposed labels that other concepts have, by normal form and language; counted, not paired."""
    held = existing.select("subject", "form", "language").distinct()
    totals = held.groupBy("form", "language").agg(F.count(F.lit(1)).alias("_n"))
    own = held.withColumn("_own", F.lit(1))
    rows = proposed.select("subject", "form", "language").distinct().join(totals, ["form", "language"]).join(own, ["subject", "form", "language"], "left")
    return rows.select("subject", "form", "language", (F.col("_n") - F.coalesce("_own", F.lit(0))).alias("n_other")).where("n_other > 0")


def disjointness(labels: DataFrame) -> DataFrame:
    """(subject, text, language, n_fields): the same text under two label predicates of a concept."""
    return labels.groupBy("subject", "text", "language").agg(F.countDistinct("field").alias("n_fields")).where("n_fields > 1")


def change_cells(changes: DataFrame, cells: dict[tuple[str, str], int]) -> DataFrame:
    """(subject, worst, n): each change (subject, layer, direction) has a severity; a subject's worst one counts."""
    m = F.create_map(*(F.lit(x) for (a, b), v in cells.items() for x in (f"{a}/{b}", v)))
    s = F.coalesce(F.try_element_at(m, F.concat_ws("/", "layer", "direction")), F.lit(0))
    return changes.withColumn("_s", s).groupBy("subject").agg(F.max("_s").alias("worst"), F.count(F.lit(1)).alias("n"))


def language_coverage(before: DataFrame, after: DataFrame) -> DataFrame:
    """(language, n_before, n_added, n_after) of two tables (subject, language, lexical)."""
    a = before.distinct().withColumn("b", F.lit(1)).withColumn("a", F.lit(0))
    b = after.distinct().withColumn("b", F.lit(0)).withColumn("a", F.lit(1))
    each = a.unionByName(b).groupBy("subject", "language", "lexical").agg(F.max("b").alias("b"), F.max("a").alias("a"))
    return each.groupBy("language").agg(F.sum("b").cast("long").alias("n_before"), F.count_if((F.col("a") == 1) & (F.col("b") == 0)).alias("n_added"), F.sum("a").cast("long").alias("n_after"))


def duplicate_localisation(labels: DataFrame) -> DataFrame:
    """(language, n_alt, n_same): alternative labels that equal a name of their concept, byte for byte."""
    names = labels.where("field <> 'skos:altLabel'").select("subject", "text").distinct().withColumn("same", F.lit(1))
    alt = labels.where("field = 'skos:altLabel'").join(names, ["subject", "text"], "left")
    return alt.groupBy("language").agg(F.count(F.lit(1)).alias("n_alt"), F.count("same").alias("n_same"))


def slot_occupancy(proposed: DataFrame, existing: DataFrame, slot: list[str]) -> DataFrame:
    """proposed with `occupied`: whether a value stands in the slot already."""
    taken = existing.select(*slot).distinct().withColumn("occupied", F.lit(True))
    return proposed.join(taken, slot, "left").withColumn("occupied", F.coalesce("occupied", F.lit(False)))


def exact_lookup(queries: DataFrame, labels: DataFrame) -> DataFrame:
    """(query, subject, language): one result per query and concept, its first language by name. Texts match as they are."""
    hit = queries.select("query").distinct().join(labels, F.col("query") == F.col("text"))
    return hit.groupBy("query", "subject").agg(F.min("language").alias("language"))


def neighbours(queries: DataFrame, names: DataFrame) -> DataFrame:
    """(query, before, after): the greatest name below and the least at or above each query; null where there is none.

    An as-of join on sort order. Names and queries are dealt by ranges of one shuffle, and a range's edges are its least
    and greatest name; the edges, one row per range, carry the nearest name into ranges that start or end without one.
    """
    q = queries.select(F.col("query").alias("k")).distinct().withColumn("is_name", F.lit(False))
    n = names.select(F.col("name").alias("k")).where("name IS NOT NULL").distinct().withColumn("is_name", F.lit(True))
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Stored, so that the ranges are drawn once: the numbers of the partitions are data from here on.
    rows = stored(q.unionAll(n).repartitionByRange(parts, "k", "is_name").withColumn("bucket", F.spark_partition_id()), "neighbours")
    own = F.when(F.col("is_name"), F.col("k"))
    edge = rows.groupBy("bucket").agg(F.min(own).alias("lo"), F.max(own).alias("hi"))
    w = W.orderBy("bucket")
    carried = edge.select("bucket", F.last("hi", True).over(w.rowsBetween(W.unboundedPreceding, -1)).alias("carry_lo"), F.first("lo", True).over(w.rowsBetween(1, W.unboundedFollowing)).alias("carry_hi"))
    order = W.partitionBy("bucket").orderBy("k", "is_name")
    before = F.last(own, True).over(order.rowsBetween(W.unboundedPreceding, -1))
    # A query sorts before the name that equals it, so that this name is at or above it.
    # Backwards, so that a row's frame adds to the one before: frames that end with the range would each be walked anew.
    back = W.partitionBy("bucket").orderBy(F.desc("k"), F.desc("is_name"))
    after = F.last(own, True).over(back.rowsBetween(W.unboundedPreceding, W.currentRow))
    found = rows.withColumn("before", before).withColumn("after", after).where("NOT is_name")
    out = found.join(F.broadcast(carried), "bucket").select(F.col("k").alias("query"), F.coalesce("before", "carry_lo").alias("before"), F.coalesce("after", "carry_hi").alias("after"))
    return out.withColumns({c: F.when(F.col("query").isNotNull(), F.col(c)) for c in ("before", "after")})


def check_names(names: DataFrame, used: DataFrame) -> DataFrame:
    """(name, family, taken, verdict) of proposed local names (name): ok, or why not. used: (name) of all names that stand anywhere."""
    held = used.select("name").distinct().withColumn("taken", F.lit(True))
    rows = names.select("name").distinct().join(held, "name", "left").withColumn("taken", F.coalesce("taken", F.lit(False)))
    rows = rows.withColumn("family", identity.family(F.col("name")))
    verdict = F.when(F.col("taken"), "taken").when(F.col("family") != "canonical", "shape").otherwise("ok")
    return rows.select("name", "family", "taken", verdict.alias("verdict"))


def mint(candidates: DataFrame, used: DataFrame, n: int) -> DataFrame:
    """(name, before, after): the first n candidates (name, place) that are canonical and free, each between its neighbours.

    Candidates come from whatever generator is trusted; too few good ones are an error.
    """
    first = candidates.groupBy("name").agg(F.min("place").alias("place"))
    good = check_names(first, used).where("verdict = 'ok'").select("name").join(first, "name").orderBy("place", "name").limit(n)
    good = stored(good.select("name"), "minted")
    if good.count() < n:
        raise ValueError(f"fewer than {n} candidates are canonical and free")
    return neighbours(good.withColumnRenamed("name", "query"), used).withColumnRenamed("query", "name")


def drift(names: DataFrame, known: DataFrame) -> DataFrame:
    """(name): names of no family that are not known to be so."""
    odd = names.where(identity.family(F.col("name")) == "nonconforming").select("name").distinct()
    return odd.join(known.select("name"), "name", "left_anti")


def latest(series: DataFrame) -> DataFrame:
    """(name, id): per name the id with the greatest (major, minor)."""
    return series.groupBy("name").agg(F.max_by("id", F.struct("major", "minor", "id")).alias("id"))
