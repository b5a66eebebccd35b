"""Queries over runs of review: the whole census, evaluation, debt, corrections, surveillance, dispatch, lineage and replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, stats
from ..operators import changes, graph, review
from ..operators.tables import RDFS, SKOS, XSD
from . import release
from .queries import _EACH4, _VERSIONS, _Z, versions
from .registry import query, table
from .vocabulary import _ALT, _DEF, _IS_LABEL, _JSON_VALUE, _LABEL, _NULL, _PREF, _T, _json, derived, plain, vocabulary

_K = "c_custkey % 17"
_ODD = " UNION ALL ".join([
    f"""SELECT 'urn:v:C' || c_custkey AS subject, CASE WHEN {_K} = 6 THEN 'bnode' ELSE 'iri' END AS subject_kind, '{_ALT}' AS predicate, CASE {_K} WHEN 0 THEN '' WHEN 1 THEN ' NULL ' WHEN 2 THEN '[1, 2]' ELSE lower(c_name) END AS object,
      CASE WHEN {_K} = 5 THEN 'iri' ELSE 'literal' END AS object_kind, CASE {_K} WHEN 3 THEN 'en_us' WHEN 4 THEN 'ru' WHEN 7 THEN 'en' WHEN 9 THEN 'fr' END AS language, CASE WHEN {_K} = 7 THEN '{XSD}string' END AS datatype FROM {{customer}}""",
    f"SELECT 'urn:v:C' || c_custkey, 'iri', '{_ALT}', lower(c_name), 'literal', {_NULL}, {_NULL} FROM {{customer}} WHERE {_K} = 8",
    f"SELECT 'urn:v:C' || c_custkey, 'iri', '{_PREF}', c_name, 'literal', 'en', {_NULL} FROM {{customer}} WHERE {_K} IN (10, 12)",
    f"SELECT 'urn:v:C' || c_custkey, 'iri', '{_PREF}', c_name || '2', 'literal', 'en', {_NULL} FROM {{customer}} WHERE {_K} = 10",
    f"SELECT 'urn:v:C' || c_custkey, 'iri', '{_DEF}', '', 'literal', 'de', {_NULL} FROM {{customer}} WHERE {_K} = 11",
    f"SELECT 'urn:v:C' || c_custkey, 'iri', '{_ALT}', upper(c_name), 'literal', 'en-GB', {_NULL} FROM {{customer}} WHERE {_K} = 12",
])
_SUPPORTED = ("en", "en-us", "en-gb", "de")


@query(f"""WITH v AS (SELECT *, nullif(lower(language), '') AS l FROM ({plain(_ODD)})), y AS (SELECT * FROM v WHERE object_kind = 'literal'),
f AS (SELECT 'missing_subject_iri' AS code, subject, predicate FROM v WHERE subject_kind <> 'iri' UNION ALL SELECT 'unsupported_object_kind', subject, predicate FROM v WHERE object_kind <> 'literal'
  UNION ALL SELECT 'empty_annotation', subject, predicate FROM y WHERE trim(object) = '' UNION ALL SELECT 'sentinel_annotation', subject, predicate FROM y WHERE lower(trim(object)) = 'null' UNION ALL SELECT 'serialized_container', subject, predicate FROM y WHERE object LIKE '[%'
  UNION ALL SELECT 'invalid_language_tag', subject, predicate FROM y WHERE l LIKE '%\\_%' ESCAPE '\\' UNION ALL SELECT 'language_datatype_conflict', subject, predicate FROM y WHERE l IS NOT NULL AND datatype IS NOT NULL
  UNION ALL SELECT 'script_mismatch', subject, predicate FROM y WHERE l = 'ru' AND regexp_matches(object, '[a-z]') UNION ALL SELECT 'unusual_language_tag', subject, predicate FROM y WHERE l NOT IN {_SUPPORTED}
  UNION ALL SELECT 'duplicate_logical_identity', subject, predicate FROM y GROUP BY subject, predicate, l, datatype, object HAVING count(*) > 1
  UNION ALL SELECT 'cardinality_violation', subject, predicate FROM v WHERE predicate = '{_PREF}' GROUP BY subject, predicate HAVING count(*) > 1
  UNION ALL SELECT DISTINCT 'base_label_duplicate', a.subject, '{_ALT}' FROM y a JOIN y b ON a.subject = b.subject AND lower(a.object) = lower(b.object) AND split_part(a.l, '-', 1) = split_part(b.l, '-', 1) WHERE a.predicate = '{_ALT}' AND b.predicate IN ('{_PREF}', '{_LABEL}')
  UNION ALL SELECT 'shacl_violation', subject, predicate FROM v WHERE predicate IN ('{_DEF}', '{_PREF}') AND (object_kind <> 'literal' OR object = ''))
SELECT code, CASE WHEN code IN ('script_mismatch', 'unusual_language_tag', 'base_label_duplicate') THEN 'review' ELSE 'error' END AS severity, subject, predicate FROM f""")
def q77_census_run(spark, sf):
    return _census(spark, sf).select("code", "severity", "subject", "predicate")


def _census(spark: SparkSession, sf: str) -> DataFrame:
    return review.census_run(derived(spark, sf, _ODD), supported=_SUPPORTED, bounds={_PREF: 1})


@query(f"""WITH v AS (SELECT * FROM ({plain(_ODD)})) SELECT 'failed' AS status, sum(CASE {_K} WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 5 THEN 1 WHEN 6 THEN 1 WHEN 7 THEN 1 WHEN 8 THEN 1 WHEN 10 THEN 1 WHEN 11 THEN 2 ELSE 0 END)::BIGINT AS failures,
  sum(CASE {_K} WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 9 THEN 1 WHEN 12 THEN 1 ELSE 0 END)::BIGINT AS risks FROM customer""")
def q78_census_status(spark, sf):
    return review.census_status(_census(spark, sf))


# Evaluation of reviewers.

_CASES = """c AS (SELECT CAST(doc_id AS VARCHAR) AS case_id, source AS family, lang AS locale, CASE doc_id % 5 WHEN 0 THEN 'unscored-challenge' WHEN 4 THEN 'source-grounded-silver' ELSE 'deterministic-gold' END AS authority,
  CASE WHEN doc_id % 5 <> 0 THEN CASE WHEN quality = 1 THEN 'pass' ELSE 'defect' END END AS expected, CASE WHEN n_chars < 2000 THEN CASE WHEN toxic = 0 THEN 'pass' ELSE 'defect' END END AS predicted FROM labels JOIN documents USING (doc_id))"""


def _cases(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    j = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars"), "doc_id")
    k = F.col("doc_id") % 5
    authority = F.when(k == 0, "unscored-challenge").when(k == 4, "source-grounded-silver").otherwise("deterministic-gold")
    expected = F.when(k != 0, F.when(F.col("quality") == 1, "pass").otherwise("defect"))
    cases = j.select(F.col("doc_id").cast("string").alias("case_id"), F.col("source").alias("family"), F.col("lang").alias("locale"), authority.alias("authority"), expected.alias("expected"))
    return cases, j.where("n_chars < 2000").select(F.col("doc_id").cast("string").alias("case_id"), F.when(F.col("toxic") == 0, "pass").otherwise("defect").alias("predicted"))


@query(f"""WITH {_CASES}, s AS (SELECT * FROM c WHERE authority <> 'unscored-challenge') SELECT count(*) AS scored, (SELECT count(*) FROM c) - count(*) AS challenges, count(*) FILTER (predicted IS NULL) AS missing,
  round(coalesce(count(*) FILTER (predicted = expected) / nullif(count(*), 0), 0.0), 6) AS accuracy, round(coalesce((count(*) FILTER (expected = 'defect') - count(*) FILTER (expected = 'defect' AND predicted = 'pass')) / nullif(count(*) FILTER (expected = 'defect'), 0), 0.0), 6) AS defect_recall,
  round(coalesce(count(*) FILTER (expected = 'defect' AND predicted = 'pass') / nullif(count(*) FILTER (expected = 'defect'), 0), 0.0), 6) AS false_accept_rate FROM s""")
def q79_eval_overall(spark, sf):
    overall, _ = review.evaluation(*_cases(spark, sf), 5)
    return overall.select("scored", "challenges", "missing", *(F.round(c, 6).alias(c) for c in ("accuracy", "defect_recall", "false_accept_rate")))


@query(f"WITH {_CASES}, r AS (SELECT DISTINCT source AS family, lang AS locale FROM documents) SELECT r.family, r.locale, count(case_id) AS n FROM r LEFT JOIN c ON c.family = r.family AND c.locale = r.locale AND c.authority <> 'unscored-challenge' GROUP BY r.family, r.locale HAVING count(case_id) < 12")
def q80_unsupported_slices(spark, sf):
    required = table(spark, sf, "documents").select(F.col("source").alias("family"), F.col("lang").alias("locale"))
    return review.evaluation(*_cases(spark, sf), 12, required)[1]


@query("""WITH c AS (SELECT CASE WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 23 < 2 THEN 'x' || doc_id // 23 ELSE 'd' || doc_id END AS case_id, CASE WHEN doc_id % 11 = 0 THEN 'own' WHEN doc_id % 2 = 0 THEN 'source-grounded-silver' WHEN doc_id % 3 = 0 THEN 'unscored-challenge' ELSE 'deterministic-gold' END AS authority,
  CASE WHEN doc_id % 13 = 0 THEN 'model-consensus' ELSE 'corpus' END AS source_kind, source AS source_ref, CASE WHEN toxic = 1 THEN 'h' END AS adjudication_hash, CASE WHEN quality = 1 THEN 'pass' END AS expected FROM labels JOIN documents USING (doc_id))
SELECT case_id, unnest([x FOR x IN [CASE WHEN case_id IS NULL THEN 'missing-id' END, CASE WHEN authority = 'own' THEN 'authority' END, CASE WHEN source_kind = 'model-consensus' THEN 'model-consensus' END, CASE WHEN authority = 'source-grounded-silver' AND (source_ref IS NULL OR adjudication_hash IS NULL) THEN 'provenance' END,
  CASE WHEN authority = 'unscored-challenge' AND expected IS NOT NULL THEN 'scored-challenge' END] IF x IS NOT NULL]) AS code FROM c
UNION ALL SELECT case_id, 'repeated-id' FROM c WHERE case_id IS NOT NULL GROUP BY case_id HAVING count(*) > 1""")
def q81_case_findings(spark, sf):
    j = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    k = F.col("doc_id")
    return review.case_findings(j.select(
        F.when(k % 19 == 0, None).when(k % 23 < 2, F.concat(F.lit("x"), F.floor(k / 23).cast("string"))).otherwise(F.concat(F.lit("d"), k.cast("string"))).alias("case_id"),
        F.when(k % 11 == 0, "own").when(k % 2 == 0, "source-grounded-silver").when(k % 3 == 0, "unscored-challenge").otherwise("deterministic-gold").alias("authority"),
        F.when(k % 13 == 0, "model-consensus").otherwise("corpus").alias("source_kind"), F.col("source").alias("source_ref"), F.when(F.col("toxic") == 1, "h").alias("adjudication_hash"), F.when(F.col("quality") == 1, "pass").alias("expected"),
    ))


@query("SELECT 'gold-slice-' || source || '-' || lang || '-' || id AS case_id, source AS family, lang AS locale, expected FROM (SELECT DISTINCT source, lang FROM documents), (VALUES ('good', 'pass'), ('bad', 'defect'), ('odd', 'defect')) AS k(id, expected)")
def q82_slice_controls(spark, sf):
    slices = table(spark, sf, "documents").select(F.col("source").alias("family"), F.col("lang").alias("locale"))
    return review.expand_controls(slices, spark.createDataFrame([("good", "pass"), ("bad", "defect"), ("odd", "defect")], "id string, expected string"))


@query("""WITH h AS (SELECT DISTINCT lang, source, sha256(CAST(doc_id AS VARCHAR)) AS h FROM documents), d AS (SELECT lang, source, substr(h, 1, 4) AS d, sha256(string_agg(h, ',' ORDER BY h)) AS s FROM h GROUP BY ALL)
SELECT lang, source, sha256(string_agg(d || ':' || s, ',' ORDER BY d)) AS population_hash FROM d GROUP BY lang, source""")
def q83_population_hash(spark, sf):
    return review.population_hash(table(spark, sf, "documents"), "doc_id", ["lang", "source"])


# Confirmed debt: entries on the older version of the documents' annotations.

_DEBT = f"""{_VERSIONS}, b AS (SELECT 'd' || subject AS debt_id, subject, predicate, lower(language) AS language, CASE WHEN CAST(subject AS BIGINT) % 7 = 4 THEN 'stale' ELSE sha256({_JSON_VALUE('v0')}) END AS current_hash FROM v0),
p0 AS (SELECT subject, predicate, lower(language) AS language, sha256({_JSON_VALUE('v0')}) AS h FROM v0), p1 AS (SELECT subject, predicate, lower(language) AS language, sha256({_JSON_VALUE('v1')}) AS h FROM v1)"""


def _debt(spark: SparkSession, sf: str) -> DataFrame:
    old, _ = versions(spark, sf)
    k = F.col("subject").cast("long") % 7
    hashed = identity.value_hash(*(F.col(c) for c in changes.VALUE))
    return old.select(F.concat(F.lit("d"), "subject").alias("debt_id"), "subject", "predicate", F.lower("language").alias("language"), "datatype", F.when(k == 4, "stale").otherwise(hashed).alias("current_hash"), F.lit("open").alias("state"))


@query(f"WITH {_DEBT} SELECT debt_id, count(p0.h) AS n FROM b LEFT JOIN p0 ON b.subject = p0.subject AND b.predicate = p0.predicate AND b.language IS NOT DISTINCT FROM p0.language AND b.current_hash = p0.h GROUP BY debt_id")
def q84_debt_matches(spark, sf):
    return review.debt_matches(_debt(spark, sf), versions(spark, sf)[0])


@query(f"WITH {_DEBT} SELECT DISTINCT debt_id FROM b JOIN p1 ON b.subject = p1.subject AND b.predicate = p1.predicate AND b.language IS NOT DISTINCT FROM p1.language AND b.current_hash = p1.h")
def q85_unresolved_debt(spark, sf):
    return review.unresolved_debt(_debt(spark, sf), versions(spark, sf)[1])


@query(f"WITH {_DEBT} SELECT debt_id FROM b WHERE (subject, current_hash) IN (SELECT (subject, h) FROM p0) AND (subject, predicate, coalesce(language, ''), current_hash) NOT IN (SELECT (subject, predicate, coalesce(language, ''), h) FROM p1)")
def q86_closed_debt(spark, sf):
    return review.closed_debt(_debt(spark, sf), *versions(spark, sf))


@query(f"""WITH {_DEBT}, x AS (SELECT CASE WHEN CAST(subject AS BIGINT) % 35 = 0 THEN 'd0' ELSE debt_id END AS debt_id, CASE WHEN CAST(subject AS BIGINT) % 49 = 4 THEN 's' ELSE subject END AS subject, CASE WHEN CAST(subject AS BIGINT) % 49 = 4 THEN 'p' ELSE predicate END AS predicate, CASE WHEN CAST(subject AS BIGINT) % 49 = 4 THEN NULL ELSE language END AS language,
  current_hash, CASE WHEN CAST(subject AS BIGINT) % 9 = 1 THEN 'closed' ELSE 'open' END AS state FROM b)
SELECT debt_id, 'repeated-id' AS code FROM x GROUP BY debt_id HAVING count(*) > 1 UNION ALL SELECT debt_id, 'not-open' FROM x WHERE state <> 'open'
UNION ALL SELECT debt_id, 'repeated-locator' FROM x WHERE (subject, predicate, coalesce(language, ''), current_hash) IN (SELECT (subject, predicate, coalesce(language, ''), current_hash) FROM x GROUP BY subject, predicate, language, current_hash HAVING count(*) > 1)""")
def q87_debt_findings(spark, sf):
    k = F.col("subject").cast("long")
    odd = k % 49 == 4
    rows = _debt(spark, sf).withColumns({
        "debt_id": F.when(k % 35 == 0, "d0").otherwise(F.col("debt_id")), "state": F.when(k % 9 == 1, "closed").otherwise("open"), "predicate": F.when(odd, "p").otherwise(F.col("predicate")), "language": F.when(~odd, F.col("language")), "subject": F.when(odd, "s").otherwise(F.col("subject")),
    })
    return review.debt_findings(rows)


_ROOT = _json(("debt_id", "debt_id"), ("subject", "subject"), ("predicate", "predicate"), ("language", "language"), ("datatype", "NULL::VARCHAR"), ("current_hash", "current_hash"))


@query(f"WITH {_DEBT}, r AS (SELECT debt_id, subject, sha256({_ROOT}) AS root_record_id FROM b) SELECT debt_id, root_record_id, CAST(CASE WHEN CAST(subject AS BIGINT) % 3 = 0 THEN 0 ELSE 2 END AS BIGINT) AS revisions FROM r")
def q88_debt_lineage(spark, sf):
    debt = _debt(spark, sf)
    root = identity.debt_root(*(F.col(c) for c in ("debt_id", "subject", "predicate", "language", "datatype", "current_hash")))
    told = F.explode(F.array(F.lit("a"), F.lit("b")))
    held = debt.select(root.alias("root_record_id"), F.col("subject").cast("long").alias("k"), told.alias("revision")).select("root_record_id", F.when(F.col("k") % 3 != 0, F.col("revision")).alias("revision_id"))
    return review.debt_lineage(debt, held)


# Corrections.

_RUN = """l AS (SELECT doc_id AS d, quality = 0 AS a, quality = 0 OR toxic = 1 AS b FROM labels), k AS (SELECT d FROM l WHERE a AND b), g AS (SELECT d, unnest([1, 2]) AS attempt FROM k),
p AS (SELECT d, attempt, CASE attempt WHEN 1 THEN 'fix ' || d % 3 ELSE 'fix ' || d % 2 END AS replacement, (d + attempt) % 3 <> 0 AND (d * attempt) % 5 <> 0 AND NOT (attempt = 1 AND d % 4 = 0) AS ok FROM g),
o AS (SELECT d, min(attempt) FILTER (ok) AS good, CASE WHEN count(DISTINCT replacement) = 1 THEN 2 END AS again FROM p GROUP BY d), s AS (SELECT d, CASE WHEN good IS NOT NULL AND (again IS NULL OR good < again) THEN good END AS attempt FROM o)"""


def _correction_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    lab = table(spark, sf, "labels").withColumnRenamed("doc_id", "record_id")
    verdict = lambda bad: F.when(bad, "defect").otherwise("pass")
    a, b = F.col("quality") == 0, (F.col("quality") == 0) | (F.col("toxic") == 1)
    votes = lab.select("record_id", F.explode(F.array(verdict(a), verdict(b))).alias("verdict"))
    tries = lab.select("record_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt"))
    k, n = F.col("record_id"), F.col("attempt")
    proposals = tries.withColumn("replacement", F.concat(F.lit("fix "), F.when(n == 1, k % 3).otherwise(k % 2).cast("string")))
    each = lambda name, bad: tries.select("record_id", "attempt", F.lit(name).alias("verifier"), verdict(bad).alias("verdict"), F.lit(0.9).alias("confidence"))
    checks = each("x", (k + n) % 3 == 0).unionByName(each("y", (k * n) % 5 == 0))
    final = lambda name: tries.where("attempt = 1").select("record_id", "attempt", F.lit(name).alias("reviewer"), verdict(k % 4 == 0).alias("verdict"), F.lit(0.95).alias("confidence"))
    return votes, proposals, checks, final("r").unionByName(final("s"))


@query(f"WITH {_RUN} SELECT s.d AS record_id, CASE WHEN s.attempt IS NULL THEN 'quarantined' ELSE 'verified' END AS state, s.attempt, p.replacement FROM s LEFT JOIN p ON p.d = s.d AND p.attempt = s.attempt")
def q89_correction_run(spark, sf):
    return release.correction_run(*_correction_tables(spark, sf), 0.8)


@query(f"""WITH {_RUN}, v AS (SELECT s.d, p.replacement FROM s JOIN p ON p.d = s.d AND p.attempt = s.attempt), e AS (SELECT d, CASE WHEN d % 10 = 1 THEN 'other' ELSE replacement END AS replacement, d % 10 = 3 AS gone FROM v)
SELECT d AS root_record_id, 'other-text' AS code FROM e WHERE d % 10 = 1 AND NOT gone UNION ALL SELECT d, 'not-in-ledger' FROM e WHERE gone UNION ALL SELECT d, 'final-review' FROM e WHERE NOT gone AND d % 4 = 0 UNION ALL SELECT 0, 'repeated-revision' FROM e WHERE FALSE""")
def q90_lineage_findings(spark, sf):
    votes, proposals, checks, rereviews = _correction_tables(spark, sf)
    good = release.correction_run(votes, proposals, checks, rereviews, 0.8).where("state = 'verified'").select("record_id", "replacement")
    k = F.col("record_id")
    ledger = good.where(k % 10 != 3).select(k.alias("root_record_id"), F.concat(F.lit("r"), k.cast("string")).alias("revision_id"), F.when(k % 10 == 1, "other").otherwise(F.col("replacement")).alias("replacement"))
    return release.lineage_findings(ledger, good, rereviews, 0.8)


@query("SELECT CAST(doc_id AS VARCHAR) AS subject, sha256(CASE WHEN doc_id % 7 = 2 THEN text || ' revised' ELSE text END) AS lexical_hash FROM documents GROUP BY doc_id, text, source, lang")
def q91_apply_corrections(spark, sf):
    old, _ = versions(spark, sf)
    chosen = old.distinct().where(F.col("subject").cast("long") % 7 == 2).withColumn("replacement", F.concat("lexical", F.lit(" revised")))
    return release.apply_corrections(old, chosen).select("subject", F.sha2("lexical", 256).alias("lexical_hash"))


# Routing, grounding and shapes.

_FAMILY = f"CASE WHEN predicate = '{_DEF}' THEN 'definition' WHEN {_IS_LABEL} AND lower(coalesce(language, 'en')) <> 'en' THEN 'translation' END"
_VALUES = f"v AS (SELECT DISTINCT subject, predicate, object AS lexical, language, datatype FROM t WHERE subject_kind = 'iri' AND object_kind = 'literal')"


@query(f"WITH {_T}, {_VALUES} SELECT subject, predicate, language, {_FAMILY} AS family FROM v")
def q92_families(spark, sf):
    return release.families(changes.annotations(vocabulary(spark, sf))).select("subject", "predicate", "language", "family")


@query(f"""WITH {_T}, {_VALUES}, r AS (SELECT *, {_FAMILY} AS family FROM v), s AS (SELECT r.subject, r.predicate, r.lexical, r.language, count(DISTINCT o.lexical) AS n FROM r LEFT JOIN v o ON o.subject = r.subject AND o.predicate = r.predicate AND o.lexical <> r.lexical AND lower(coalesce(o.language, '')) IN ('en', '') GROUP BY ALL)
SELECT sha256({_json(("subject", "subject"), ("predicate", "predicate"), ("lexical", "lexical"), ("locale", "lower(coalesce(r.language, 'en'))"))}) AS record_id, CASE WHEN family IS NULL THEN 'family' ELSE 'source' END AS code
FROM r JOIN s USING (subject, predicate, lexical) WHERE r.language IS NOT DISTINCT FROM s.language AND (family IS NULL OR (family = 'translation' AND n <> 1))""")
def q93_routing_findings(spark, sf):
    t = vocabulary(spark, sf).distinct()
    values = changes.annotations(t)
    records = release.families(values).withColumn("record_id", identity.surveillance_id(*(F.col(c) for c in ("subject", "predicate", "lexical", "language"))))
    none = values.limit(0).select("subject", "predicate", F.col("lexical").alias("message"))
    contexts = graph.record_contexts(records.select("record_id", "subject", "predicate", "lexical"), values, t.where(F.col("predicate") == RDFS + "label").groupBy("subject").agg(F.min("object").alias("label")), none)
    return release.routing_findings(records, contexts)


@query("""WITH q AS (SELECT doc_id, to_json({'id': doc_id, 'text': text}) AS json FROM documents WHERE doc_id % 13 <> 0), r AS (SELECT doc_id, [source, CASE WHEN doc_id % 9 = 0 THEN 'no such words' ELSE substr(json, 2, 4) END] AS quotes, json FROM documents LEFT JOIN q USING (doc_id))
SELECT doc_id AS record_id FROM r WHERE json IS NULL OR NOT contains(json, quotes[2])""")
def q94_ungrounded(spark, sf):
    d = table(spark, sf, "documents")
    body = F.to_json(F.struct(F.col("doc_id").alias("id"), "text"))
    requests = d.select(F.col("doc_id").alias("record_id"), F.when(F.col("doc_id") % 13 != 0, body).alias("json"))
    quote = F.when(F.col("doc_id") % 9 == 0, "no such words").otherwise('"id"')
    return release.ungrounded(requests, d.select(F.col("doc_id").alias("record_id"), F.array(quote).alias("quotes")))


@query(f"WITH v AS (SELECT * FROM ({plain(_ODD)})) SELECT subject, predicate, object AS lexical FROM v WHERE predicate IN ('{_DEF}', '{_ALT}') AND (object_kind <> 'literal' OR object = '')")
def q95_shapes(spark, sf):
    values = derived(spark, sf, _ODD).withColumnRenamed("object", "lexical")
    return review.shapes(values, (_DEF, _ALT)).select("subject", "predicate", "lexical")


# Surveillance.


@query(f"""WITH {_T}, {_VALUES}, x AS (SELECT *, {_FAMILY} AS family, lower(coalesce(language, 'en')) AS locale FROM v)
SELECT sha256({_json(("subject", "subject"), ("predicate", "predicate"), ("lexical", "lexical"), ("locale", "locale"))}) AS record_id, family, locale, subject, predicate, language FROM x WHERE family IS NOT NULL AND NOT (predicate = '{_DEF}' AND length(lexical) % 5 = 0)""")
def q96_legacy_population(spark, sf):
    t = vocabulary(spark, sf).distinct()
    changed = changes.annotations(t).where((F.col("predicate") == SKOS + "definition") & (F.length("lexical") % 5 == 0))
    ids = review.to_review(changed.select(identity.surveillance_id(*(F.col(c) for c in ("subject", "predicate", "lexical", "language"))).alias("record_id")), review.legacy_population(t.limit(0)))
    return review.legacy_population(t, ids).select("record_id", "family", "locale", "subject", "predicate", "language")


_WIDE0 = stats.z_two_sided(_EACH4) ** 2 * 0.25 / (0.1 * 0.1)


@query(f"""WITH n AS (SELECT lang AS stratum, count(*) AS population FROM documents GROUP BY lang),
w AS (SELECT stratum, population, CASE WHEN population <= 30 THEN population ELSE least(population, greatest(1, CAST(ceil({_WIDE0!r}::DOUBLE / (1.0::DOUBLE + {_WIDE0 - 1!r}::DOUBLE / greatest(population, 1))) AS BIGINT))) END AS sample FROM n),
p AS (SELECT doc_id, lang AS stratum, n_chars, row_number() OVER (PARTITION BY lang ORDER BY sha256('seed-2:' || doc_id), doc_id) AS place FROM documents), j AS (SELECT p.stratum, place <= sample AS selected, population, lang_defect(n_chars, p.stratum) AS defect FROM p JOIN w USING (stratum)),
b AS (SELECT stratum, population, count(*) FILTER (selected) AS s1, count(*) FILTER (selected AND defect) AS d1, count(*) AS s2, count(*) FILTER (defect) AS d2 FROM j GROUP BY ALL),
u AS (SELECT *, wilson(d1, s1) AS u1, wilson(d2, s2) AS u2 FROM b), f AS (SELECT stratum, population, CASE WHEN u1 > 0.2 THEN s2 ELSE s1 END AS sample, CASE WHEN u1 > 0.2 THEN d2 ELSE d1 END AS defects, CASE WHEN u1 > 0.2 THEN u2 ELSE u1 END AS ub FROM u)
SELECT stratum, population, sample, defects, round(ub, 6) AS upper_bound FROM f""".replace("lang_defect(n_chars, p.stratum)", "n_chars % CASE p.stratum WHEN 'en' THEN 3 ELSE 40 END = 0").replace("wilson(d1, s1)", f"least(1.0::DOUBLE, (d1 / s1 + {_Z * _Z!r}::DOUBLE / (2 * s1) + {_Z!r}::DOUBLE * sqrt((d1 / s1) * (1 - d1 / s1) / s1 + {_Z * _Z!r}::DOUBLE / (4.0 * s1 * s1))) / (1 + {_Z * _Z!r}::DOUBLE / s1))").replace("wilson(d2, s2)", f"least(1.0::DOUBLE, (d2 / s2 + {_Z * _Z!r}::DOUBLE / (2 * s2) + {_Z!r}::DOUBLE * sqrt((d2 / s2) * (1 - d2 / s2) / s2 + {_Z * _Z!r}::DOUBLE / (4.0 * s2 * s2))) / (1 + {_Z * _Z!r}::DOUBLE / s2))"))
def q97_surveillance(spark, sf):
    """Strata whose bound is over the limit are taken whole."""
    d = table(spark, sf, "documents")
    records = d.select(F.col("doc_id").alias("record_id"), F.col("lang").alias("stratum"))
    bad = F.col("n_chars") % F.when(F.col("lang") == "en", 3).otherwise(40) == 0
    votes = d.select(F.col("doc_id").alias("record_id"), F.when(bad, "defect").otherwise("pass").alias("verdict"), F.lit(0.9).alias("confidence"))
    _, seen = release.surveillance(records, votes, votes, "seed-2", 0.95, 0.1, 30, 0.2, 0.7, 1 << 40)
    return seen.select("stratum", "population", "sample", "defects", F.round("upper_bound", 6).alias("upper_bound"))


# Dispatch, receipts, roles and replay.

_PRICES = {"F": (1.0, 2.0), "O": (0.5, 1.0), "P": (2.0, 4.0)}


@query("""WITH r AS (SELECT o_orderkey, o_orderstatus AS route, greatest(1, ceil(floor(o_totalprice) / 4))::BIGINT AS tokens, CASE WHEN o_orderpriority = '1-URGENT' THEN CASE WHEN o_totalprice < 250000 THEN o_orderstatus ELSE 'X' END END AS served FROM orders),
c AS (SELECT *, (tokens * CASE route WHEN 'F' THEN 1.0 WHEN 'O' THEN 0.5 ELSE 2.0 END + 4096 * CASE route WHEN 'F' THEN 2.0 WHEN 'O' THEN 1.0 ELSE 4.0 END)::DOUBLE / 1e6 AS cost FROM r), m AS (SELECT *, count(*) OVER w AS n, sum(tokens) OVER w AS s FROM c WHERE served IS NULL WINDOW w AS (ORDER BY o_orderkey))
SELECT o_orderkey AS request_id, CASE WHEN served = route THEN 'receipt' ELSE 'route-mismatch' END AS status, tokens, round(cost, 7) AS cost FROM c WHERE served IS NOT NULL UNION ALL SELECT o_orderkey, CASE WHEN n <= 5000 AND s <= 40000000 THEN 'admitted' ELSE 'refused' END, tokens, round(cost, 7) FROM m""")
def q98_dispatch(spark, sf):
    o = table(spark, sf, "orders")
    requests = o.select(F.col("o_orderkey").alias("request_id"), F.col("o_orderkey").alias("place"), F.col("o_orderstatus").alias("route"), F.floor("o_totalprice").alias("size"))
    receipts = o.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("request_id"), F.when(F.col("o_totalprice") < 250000, F.col("o_orderstatus")).otherwise("X").alias("route"))
    out = review.dispatch(requests, receipts, _PRICES, 4096, {"requests": 5000, "tokens": 40_000_000, "cost": 1e12})
    return out.withColumn("cost", F.round("cost", 7))


@query("SELECT event_id AS request_id, props AS body FROM events WHERE event_type <> 'purchase'")
def q99_receipts_to_add(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("request_id"), F.col("props").alias("body"), "event_type")
    return review.receipts_to_add(e.where("event_type = 'purchase'"), e.unionAll(e))


@query("""WITH q AS (SELECT n_name AS role, CASE WHEN n_nationkey % 6 = 0 THEN 'rejected' ELSE 'qualified' END AS status, CASE WHEN n_nationkey % 5 = 0 THEN '2020-01-01T00:00:00' ELSE '2030-01-01T00:00:00' END AS valid_until, CASE WHEN n_nationkey % 4 = 0 THEN 'h0' ELSE 'h1' END AS policy_hash, 'R' || n_regionkey AS provider FROM nation)
SELECT role, unnest([x FOR x IN [CASE WHEN status <> 'qualified' THEN 'not-qualified' END, CASE WHEN valid_until < '2025' THEN 'expired' END, CASE WHEN policy_hash <> 'h1' THEN 'binding:policy_hash' END] IF x IS NOT NULL]) AS code FROM q
UNION ALL SELECT 'absent', 'missing' UNION ALL SELECT a.role, 'same-provider:' || b.role FROM q a, q b WHERE a.provider = b.provider AND a.role = (SELECT min(role) FROM q) AND b.role = (SELECT max(role) FROM q)""")
def q100_role_findings(spark, sf):
    n = table(spark, sf, "nation")
    k = F.col("n_nationkey")
    q = n.select(
        F.col("n_name").alias("role"), F.when(k % 6 == 0, "rejected").otherwise("qualified").alias("status"), F.when(k % 5 == 0, "2020-01-01T00:00:00").otherwise("2030-01-01T00:00:00").alias("valid_until"),
        F.when(k % 4 == 0, "h0").otherwise("h1").alias("policy_hash"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("provider"),
    )
    roles = [r["role"] for r in q.select("role").orderBy("role").collect()]  # a row per role
    return release.role_findings(q, [*roles, "absent"], [(roles[0], roles[-1], "provider")], {"policy_hash": "h1"}, "2025-01-01T00:00:00")


@query("SELECT (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) AS unexpected, (SELECT count(*) FROM customer WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)) AS missing")
def q101_lineage_sets(spark, sf):
    want = table(spark, sf, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("root"))
    n = release.lineage(want, table(spark, sf, "orders").select(F.col("o_custkey").alias("root")), "root")
    return spark.createDataFrame([(n["unexpected"], n["missing"])], "unexpected long, missing long")


@query("""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'short' ELSE sha256(CAST(doc_id AS VARCHAR)) END AS record_id, ['pass', 'defect', 'abstain', 'maybe'][doc_id % 4 + 1] AS verdict, (doc_id % 13) / 10.0 AS confidence, doc_id % 3 AS defects, doc_id % 5 AS spans, doc_id % 2 AS kept, doc_id % 7 = 0 AS proposes, doc_id % 11 = 0 AS mute, doc_id % 6 = 0 AS odd FROM documents)
SELECT record_id, unnest([x FOR x IN [CASE WHEN record_id = 'short' THEN 'record_id' END, CASE WHEN verdict = 'maybe' THEN 'verdict' END, CASE WHEN confidence > 1 THEN 'confidence' END, CASE WHEN defects = 2 THEN 'defect_types' END, CASE WHEN spans = 4 THEN 'evidence_spans' END, CASE WHEN odd THEN 'preserved_propositions' END, CASE WHEN mute THEN 'rationale' END,
  CASE WHEN verdict = 'defect' AND (defects = 0 OR spans = 0) THEN 'defect-needs' END, CASE WHEN verdict = 'pass' AND (spans = 0 OR (kept = 0 AND NOT odd) OR proposes) THEN 'pass-needs' END] IF x IS NOT NULL]) AS code FROM r""")
def q102_response_findings(spark, sf):
    k = F.col("doc_id")
    span = lambda s: F.struct(F.lit(s).alias("source"), F.lit("quoted").alias("quote"))
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    rows = table(spark, sf, "documents").select(
        F.when(k % 10 == 0, "short").otherwise(F.sha2(k.cast("string"), 256)).alias("record_id"), F.element_at(F.array(*map(F.lit, ("pass", "defect", "abstain", "maybe"))), (k % 4 + 1).cast("int")).alias("verdict"), ((k % 13) / 10.0).alias("confidence"),
        F.when(k % 3 == 0, empty("string")).when(k % 3 == 1, F.array(F.lit("party"))).otherwise(F.array(F.lit("party"), F.lit("party"))).alias("defect_types"),
        F.when(k % 5 == 0, empty("struct<source: string, quote: string>")).when(k % 5 == 4, F.array(span("elsewhere"))).otherwise(F.array(span("source"))).alias("evidence_spans"),
        F.when(k % 6 == 0, F.array(F.lit(""))).when(k % 2 == 0, empty("string")).otherwise(F.array(F.lit("kept"))).alias("preserved_propositions"),
        F.when(k % 11 == 0, "").otherwise("why").alias("rationale"), F.when(k % 7 == 0, "new text").alias("proposed_replacement"),
    )
    return review.response_findings(rows)


@query("""WITH v AS (SELECT doc_id, quality = 1 AS a, toxic = 0 AS b FROM labels) SELECT 'states' AS stage, (SELECT count(*) FROM v WHERE doc_id % 5 = 0 AND a AND b) AS n UNION ALL SELECT 'evaluated', 0 UNION ALL SELECT 'slices', 0""")
def q103_replay(spark, sf):
    """A run recorded from the same inputs, but for states that somebody changed."""
    lab = table(spark, sf, "labels").withColumnRenamed("doc_id", "record_id")
    vote = lambda name, good: lab.select("record_id", F.lit(name).alias("reviewer"), F.when(good, "pass").otherwise("defect").alias("verdict"), F.lit(0.9).alias("confidence"))
    votes = vote("a", F.col("quality") == 1).unionByName(vote("b", F.col("toxic") == 0))
    states = review.reconcile(votes.where("reviewer = 'a'"), votes.where("reviewer = 'b'"), 0.7)
    verdict = states.where("state <> 'incomplete'").select("record_id", F.when(F.col("state") == "accepted", "pass").otherwise("defect").alias("verdict"), F.lit(False).alias("severe"))
    sample = lab.join(table(spark, sf, "documents").select(F.col("doc_id").alias("record_id"), F.col("lang").alias("stratum")), "record_id").select("record_id", "stratum")
    cases, told = _cases(spark, sf)
    bundle = {
        "votes": votes, "states": states.withColumn("state", F.when((F.col("record_id") % 5 == 0) & (F.col("state") == "accepted"), "quarantined").otherwise(F.col("state"))), "sample": sample,
        "evaluated": review.evaluate_sample(sample, verdict, 0.95, 4, 0.1), "cases": cases, "predictions": told, "slices": review.slice_metrics(cases, told, 5),
    }
    return release.replay_run(bundle, 0.7, 0.95, 4, 0.1, 5)


@query("""WITH a AS (SELECT doc_id AS record_id, quality = 1 AS x, toxic = 0 AS y FROM labels), s AS (SELECT CASE WHEN x AND y THEN 'accepted' WHEN NOT x AND NOT y THEN 'defect_confirmed' ELSE 'quarantined' END AS state FROM a)
SELECT CASE WHEN count(*) FILTER (state = 'quarantined') > 0 THEN 'quarantined' ELSE 'complete' END AS status FROM s""")
def q104_reconciliation_status(spark, sf):
    lab = table(spark, sf, "labels").withColumnRenamed("doc_id", "record_id")
    vote = lambda good: lab.select("record_id", F.when(good, "pass").otherwise("defect").alias("verdict"), F.lit(0.9).alias("confidence"))
    return review.reconciliation_status(review.reconcile(vote(F.col("quality") == 1), vote(F.col("toxic") == 0), 0.7))


@query("""WITH g AS (SELECT source AS family, lang AS locale, count(*) FILTER (n_chars >= 2000) AS missing, count(*) FILTER (n_chars < 2000 AND (quality = 1) = (toxic = 0)) / count(*) AS acc FROM labels JOIN documents USING (doc_id) GROUP BY ALL)
SELECT CASE WHEN count(*) FILTER (NOT (missing = 0 AND acc >= 0.5)) = 0 THEN 'qualified' ELSE 'rejected' END AS status, count(*) FILTER (missing = 0 AND acc >= 0.5) AS n FROM g""")
def q105_qualification(spark, sf):
    cases, told = _cases_all(spark, sf)
    found = release.qualification(review.slice_metrics(cases, told, 1), 0.5, 0.0, 1.0)
    return spark.createDataFrame([(found["status"], len(found["payload"]["qualified_slices"]))], "status string, n long")


def _cases_all(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    j = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars"), "doc_id")
    cases = j.select(F.col("doc_id").alias("case_id"), F.col("source").alias("family"), F.col("lang").alias("locale"), F.when(F.col("quality") == 1, "pass").otherwise("defect").alias("expected"))
    return cases, j.where("n_chars < 2000").select(F.col("doc_id").alias("case_id"), F.when(F.col("toxic") == 0, "pass").otherwise("defect").alias("predicted"))


@query("""WITH s AS (SELECT CASE WHEN (quality = 1) = (toxic = 0) THEN CASE WHEN quality = 1 THEN 'accepted' ELSE 'defect_confirmed' END ELSE 'quarantined' END AS state FROM labels), n AS (SELECT count(DISTINCT state) FILTER (state <> 'accepted') AS other FROM s)
SELECT CASE WHEN other = 0 THEN 'approved' ELSE 'blocked' END AS decision, 'complete' AS status, CASE WHEN other = 0 THEN '' ELSE 'states_accepted' END AS held_by FROM n""")
def q106_release_report(spark, sf):
    lab = table(spark, sf, "labels").withColumnRenamed("doc_id", "record_id")
    vote = lambda good: lab.select("record_id", F.when(good, "pass").otherwise("defect").alias("verdict"), F.lit(0.9).alias("confidence"))
    states = review.reconcile(vote(F.col("quality") == 1), vote(F.col("toxic") == 0), 0.7)
    found = release.release_report({"census": True, "debt": True, "surveillance": True}, {"census": "h1"}, states, "c", {"census": "c"})
    return spark.createDataFrame([(found["payload"]["decision"], found["status"], "|".join(found["payload"]["held_by"]))], "decision string, status string, held_by string")


@query("""WITH a AS (SELECT DISTINCT o_custkey, o_orderpriority, o_orderkey FROM orders), b AS (SELECT * FROM a WHERE o_orderpriority <> '1-URGENT')
SELECT CASE WHEN (SELECT count(*) FROM b) < (SELECT count(*) FROM a) * 0.9 THEN 'review' ELSE 'auto' END AS decision, (SELECT count(*) FROM a) AS before, (SELECT count(*) FROM b) AS after, 0::BIGINT AS added, (SELECT count(*) FROM a) - (SELECT count(*) FROM b) AS removed, least(50, (SELECT count(*) FROM a WHERE o_orderpriority = '1-URGENT')) AS sampled""")
def q107_heartbeat(spark, sf):
    rows = table(spark, sf, "orders").select(*(F.col(a).cast("string").alias(b) for a, b in (("o_custkey", "subject_id"), ("o_orderpriority", "predicate_id"), ("o_orderkey", "object_id"))))
    found = release.heartbeat(rows, rows.where("predicate_id <> '1-URGENT'"), {"precision": 0.9}, {"precision": 0.9}, "1.2.0")
    row = (found["decision"], found["rows"]["before"], found["rows"]["after"], found["added"]["count"], found["removed"]["count"], len(found["removed"]["sample"]))
    return spark.createDataFrame([row], "decision string, before long, after long, added long, removed long, sampled long")


@query("SELECT 'v' || x || '.' || y || '-set' AS id, x AS major, y AS minor FROM (SELECT year(o_orderdate)::INTEGER AS x, month(o_orderdate)::INTEGER AS y FROM orders) ORDER BY x DESC, y DESC LIMIT 1")
def q108_newest_series(spark, sf):
    o = table(spark, sf, "orders").select(F.concat(F.lit("v"), F.year("o_orderdate").cast("string"), F.lit("."), F.month("o_orderdate").cast("string"), F.lit("-set")).alias("id"))
    return release.newest_series(o, r"^v(\d+)\.(\d+)-set$").select("id", "major", "minor")


