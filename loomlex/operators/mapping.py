"""Mapping sets: row checks, precision and recall, and export as triples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import stored

COLUMNS = "subject_id subject_label predicate_id object_id object_label mapping_justification confidence subject_match_field object_match_field match_string comment".split()
SENSE_COLUMNS = "sense_id lexeme_id headword pos sense_index domain gloss".split()
GAP_COLUMNS = "subject_id subject_label match_string headword_senses_domains".split()
REQUIRED_KEYS = "curie_map mapping_set_id mapping_set_version mapping_set_title mapping_set_description license mapping_date mapping_tool mapping_tool_version subject_source subject_source_version object_source object_source_version".split()
PREDICATES = tuple(f"skos:{k}Match" for k in ("exact", "close", "broad", "narrow", "related"))
OBJECT_SHAPE = r"^OGS:[^\s|,;:]+:[a-z]+:\d+$"
#: Identity claims that a mapping set must not make, in any case.
FORBIDDEN = ("owl:sameAs", "owl:equivalentClass", "owl#sameAs", "owl#equivalentClass")


def forbidden(text: Column, more: tuple[str, ...] = ()) -> Column:
    """Whether a text, header or record, holds a forbidden token; more: tokens of a source's own."""
    low = F.lower(text)
    return F.coalesce(F.greatest(F.lit(False), *(F.contains(low, F.lit(t.lower())) for t in (*FORBIDDEN, *more))), F.lit(False))


def row_findings(rows: DataFrame, subject_shape: str, object_shape: str = OBJECT_SHAPE, prefixes: tuple[str, ...] | None = None) -> DataFrame:
    """(row, code) for each check that a row fails; rows carry their number."""
    confidence = F.expr("try_cast(confidence AS double)")
    checks: dict[str, Column] = {
        "predicate": ~F.col("predicate_id").isin(*PREDICATES),
        "object-id": ~F.col("object_id").rlike(object_shape),
        "subject-id": ~F.col("subject_id").rlike(subject_shape),
        "confidence": confidence.isNull() | F.isnan(confidence) | (confidence <= 0) | (confidence > 1),
        "justification": ~F.startswith("mapping_justification", F.lit("semapv:")),
    }
    if prefixes is not None:
        for c in ("subject_id", "predicate_id", "object_id", "mapping_justification", "subject_match_field", "object_match_field"):
            parts = F.split(F.coalesce(c, F.lit("")), ":", 2)
            checks[f"curie-map:{c}"] = (F.size(parts) < 2) | ~parts[0].isin(*prefixes) | (F.try_element_at(parts, F.lit(2)) == "")
    found = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(code)) for code, bad in checks.items())))
    return rows.select("row", F.explode(found).alias("code"))


def order_findings(rows: DataFrame, keys: list[str], number: str = "row", group: list[str] | None = None) -> DataFrame:
    """Rows whose keys come before those of the row above, within groups or, without any, in the whole table.

    A whole table is dealt by ranges of the number; a range's last keys, one row for each, are handed on to the next.
    """
    key = F.struct(*keys)
    if group:
        w = W.partitionBy(*group).orderBy(number)
        return rows.withColumn("_above", F.lag(key).over(w)).where(key < F.col("_above")).drop("_above")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(rows.repartitionByRange(parts, number).withColumn("_part", F.spark_partition_id()), "ordered")
    last = dealt.groupBy("_part").agg(F.max_by(key, number).alias("_last"))
    edge = last.select(F.col("_part").alias("_p"), F.lag("_last").over(W.orderBy("_part")).alias("_before"))
    above = F.coalesce(F.lag(key).over(W.partitionBy("_part").orderBy(number)), F.col("_before"))
    placed = dealt.join(F.broadcast(edge), F.col("_part") == F.col("_p")).withColumn("_above", above)
    return placed.where(key < F.col("_above")).select(*rows.columns)


def duplicate_findings(rows: DataFrame, keys: list[str], number: str = "row") -> DataFrame:
    """Every row but the first with the same keys. The first is found by an aggregation, so that a common key is no task's alone."""
    first = rows.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.min(number).alias("_first"))
    cond = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return rows.join(first, cond).where(F.col(number) > F.col("_first")).select(*rows.columns)


def subject_findings(rows: DataFrame, active: DataFrame) -> DataFrame:
    return rows.join(active.select(F.col("subject").alias("subject_id")).distinct(), "subject_id", "left_anti")


def header_findings(header: dict, expected: dict[str, str], set_id: str | None = None) -> list[tuple[str, str]]:
    """(code, message) for a mapping set's header, on the driver."""
    out = [("header-missing-key", k) for k in REQUIRED_KEYS if not header.get(k) or (isinstance(header[k], str) and not header[k].strip())]
    if set_id is not None and header.get("mapping_set_id") != set_id:
        out.append(("mapping-set-id", set_id))
    curies = header.get("curie_map") if isinstance(header.get("curie_map"), dict) else {}
    return out + [("curie-map", k) for k, v in expected.items() if curies.get(k) != v]


def count_by_predicate(rows: DataFrame) -> DataFrame:
    return rows.groupBy("predicate_id").agg(F.count(F.lit(1)).alias("n"))


def check_gold(gold: DataFrame) -> None:
    """Verdicts are of the two kinds and pairs are unique, or ValueError."""
    bad = gold.agg(F.count_if(~F.coalesce(F.col("verdict").isin("correct", "incorrect"), F.lit(False))).alias("v"), F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct("subject_id", "object_id")).alias("d")).first()
    if bad["v"]:
        raise ValueError("a verdict is neither correct nor incorrect")
    if bad["n"] != bad["d"]:
        raise ValueError("a pair is judged twice")


def score(rows: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: judged, emitted_judged, precision, recall, predicate_agreement (null without a denominator, four decimals)."""
    pair = ["subject_id", "object_id"]
    hit = rows.select(*pair, "predicate_id").join(gold, pair)
    right = F.col("verdict") == "correct"
    expects = right & (F.coalesce("expected_predicate", F.lit("")) != "")
    a = hit.agg(F.count(F.lit(1)).alias("emitted_judged"), F.count_if(right).alias("correct"), F.count_if(expects).alias("expected"), F.count_if(expects & (F.col("predicate_id") == F.col("expected_predicate"))).alias("agree"))
    b = gold.agg(F.count(F.lit(1)).alias("judged"), F.count_if(right).alias("gold_correct"))
    c = gold.where(right).join(rows.select(*pair).distinct(), pair, "left_semi").agg(F.count(F.lit(1)).alias("found"))
    ratio = lambda n, d: F.round(F.col(n) / F.nullif(F.col(d), F.lit(0)), 4)
    # Three rows of one each.
    one = a.join(F.broadcast(b), F.lit(True)).join(F.broadcast(c), F.lit(True))
    return one.select("judged", "emitted_judged", ratio("correct", "emitted_judged").alias("precision"), ratio("found", "gold_correct").alias("recall"), ratio("agree", "expected").alias("predicate_agreement"))


def _iri(c: Column) -> Column:
    return F.concat(F.lit("<"), c, F.lit(">"))


def _literal(c: Column, tail: str = "") -> Column:
    s = F.replace(F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return F.concat(F.lit('"'), s, F.lit('"' + tail))


def export_lines(rows: DataFrame, senses: DataFrame, curies: dict[str, str]) -> DataFrame:
    """(line): N-Triples statements of a mapping set, distinct: the links, their axioms, and the senses they name.

    rows carry their number; a mapped sense that senses lacks fails the job.
    """
    m = F.create_map(*(F.lit(x) for kv in curies.items() for x in kv))
    expand = lambda c: F.concat(m[F.split_part(c, F.lit(":"), F.lit(1))], F.regexp_replace(c, "^[^:]*:", ""))
    w3 = "http://www.w3.org/"
    rdf_type, owl, lemon, skos = w3 + "1999/02/22-rdf-syntax-ns#type", w3 + "2002/07/owl#", w3 + "ns/lemon/ontolex#", w3 + "2004/02/skos/core#"
    s = senses.dropDuplicates(["sense_id"]).select(F.concat(F.lit("OGS:"), "sense_id").alias("object_id"), "lexeme_id", "headword", "gloss")
    j = rows.join(s, "object_id", "left")
    j = j.withColumn("lexeme_id", F.coalesce("lexeme_id", F.raise_error(F.concat(F.lit("mapped sense missing: "), "object_id"))))
    subject, predicate, obj = _iri(expand(F.col("subject_id"))), _iri(expand(F.col("predicate_id"))), _iri(expand(F.col("object_id")))
    axiom = F.concat(F.lit("_:axiom"), F.lpad((F.col("row") - 1).cast("string"), 9, "0"))
    lexeme = expand(F.concat(F.lit("OGL:"), "lexeme_id"))
    p = lambda x: F.lit(f"<{x}>")
    facts = [
        (subject, predicate, obj),
        (axiom, p(rdf_type), p(owl + "Axiom")), (axiom, p(owl + "annotatedSource"), subject), (axiom, p(owl + "annotatedProperty"), predicate), (axiom, p(owl + "annotatedTarget"), obj),
        (axiom, p("https://w3id.org/sssom/confidence"), _literal(F.col("confidence").cast("double").cast("string"), f"^^<{w3}2001/XMLSchema#double>")),
        (axiom, p("https://w3id.org/sssom/mapping_justification"), _iri(expand(F.col("mapping_justification")))), (axiom, p(w3 + "2000/01/rdf-schema#comment"), _literal(F.col("comment"))),
        (obj, p(rdf_type), p(lemon + "LexicalSense")), (obj, p(skos + "definition"), _literal(F.col("gloss"), "@en")), (obj, p(lemon + "isSenseOf"), _iri(lexeme)),
        (_iri(lexeme), p(rdf_type), p(lemon + "LexicalEntry")), (_iri(lexeme), p(lemon + "sense"), obj), (_iri(lexeme), p(lemon + "canonicalForm"), _iri(F.concat(lexeme, F.lit("#form")))),
        (_iri(F.concat(lexeme, F.lit("#form"))), p(lemon + "writtenRep"), _literal(F.col("headword"), "@en")),
    ]
    exact = F.when(F.col("predicate_id") == "skos:exactMatch", F.concat_ws(" ", obj, p(lemon + "reference"), subject, F.lit(".")))
    lines = F.array_compact(F.array(*(F.concat_ws(" ", *t, F.lit(".")) for t in facts), exact))
    # Dealt by line first: a task that reads many rows would else hold all their lines to find the distinct ones.
    return j.select(F.explode(lines).alias("line")).repartition("line").distinct()
