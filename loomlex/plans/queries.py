"""The registered queries: each operator on a dataset derived from the supplied tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, stats, text
from ..operators import changes, graph, labels, lexical, mapping, review
from ..operators.tables import OWL, RDFS
from ..streaming import census as stream_census
from .registry import query, table

# Concepts and senses, from part.

PRIORS = {"legal": {"PROMO": 1.0, "STANDARD": 0.7, "other": 0.3}}
_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)


def _stem_sql(w: str) -> str:
    cases = " ".join(f"WHEN ends_with({w}, '{s}') AND length({w}) - {len(s)} + {len(t)} >= 3 THEN substr({w}, 1, length({w}) - {len(s)}) || '{t}'" for s, t in text.SUFFIXES)
    return f"CASE {cases} ELSE {w} END"


def _stems_sql(x: str) -> str:
    return f"list_distinct([{_stem_sql('w')} FOR w IN regexp_extract_all(lower({x}), '[a-z0-9]+') IF w NOT IN ({_STOP})])"


def part_labels(part: DataFrame) -> DataFrame:
    own = part.select(F.col("p_partkey").cast("string").alias("subject"), F.col("p_name").alias("text"), F.lit("rdfs:label").alias("field"))
    alt = part.where("p_partkey % 2 = 0").select(F.col("p_partkey").cast("string").alias("subject"), F.element_at(F.split("p_name", " "), -1).alias("text"), F.lit("skos:altLabel").alias("field"))
    return own.unionAll(alt)


def part_senses(part: DataFrame, gloss: bool = True) -> DataFrame:
    heads = part.select(F.explode(F.array_union(F.array("p_name"), F.split("p_name", " "))).alias("headword")).distinct()
    types = part.select("p_type").distinct()
    # Names and types are a dictionary; their product is the sense table, not a join of rows.
    rows = heads.join(types, F.lit(True))
    low = F.concat(F.replace("headword", F.lit(" "), F.lit("_")), F.lit(":"), F.lower("p_type"))
    return rows.select(low.alias("sense_id"), "headword", F.col("p_type").alias("domain"), F.lit("").alias("domain_root"), (F.concat("headword", F.lit(" "), F.lower("p_type")) if gloss else F.lit("unrelated entry")).alias("gloss"))


def part_concepts(part: DataFrame, profiles=None) -> DataFrame:
    subject = F.col("p_partkey").cast("string").alias("subject")
    return lexical.concepts_of(part_labels(part), part.select(subject, F.lower("p_type").alias("text")), part.select(subject, F.col("p_brand").alias("text")), profiles=profiles or F.array(F.lit("legal")), ascii_only=True)


_LEX = f"""
WITH lab AS (SELECT CAST(p_partkey AS VARCHAR) AS subject, p_name AS text, 'rdfs:label' AS field FROM part
             UNION ALL SELECT CAST(p_partkey AS VARCHAR), string_split(p_name, ' ')[-1], 'skos:altLabel' FROM part WHERE p_partkey % 2 = 0),
ctx AS (SELECT CAST(p_partkey AS VARCHAR) AS subject, {_stems_sql("p_name || ' ' || p_type || ' ' || p_brand")} AS context FROM part),
heads AS (SELECT DISTINCT headword FROM (SELECT p_name AS headword FROM part UNION ALL SELECT unnest(string_split(p_name, ' ')) FROM part)),
sense AS (SELECT replace(headword, ' ', '_') || ':' || lower(p_type) AS sense_id, headword, p_type AS root, {_stems_sql("headword || ' ' || p_type")} AS stems
          FROM heads, (SELECT DISTINCT p_type FROM part)),
form AS (SELECT DISTINCT subject, lower(text) AS form, field FROM lab),
look AS (SELECT subject, form, field, 0 AS kind, form AS lookup, FALSE AS is_head FROM form
         UNION ALL SELECT subject, form, field, 1, lookup, lookup = string_split(form, ' ')[-1]
         FROM (SELECT subject, form, field, unnest(list_distinct(string_split(form, ' '))) AS lookup FROM form WHERE len(string_split(form, ' ')) BETWEEN 2 AND 6)
         WHERE lookup NOT IN ({_STOP})),
sc AS (SELECT l.subject, l.lookup, s.sense_id, s.headword,
              0.5::DOUBLE * (CASE s.root WHEN 'PROMO' THEN 1.0 WHEN 'STANDARD' THEN 0.7 ELSE 0.3 END)::DOUBLE
              + 0.5::DOUBLE * (len(list_intersect(context, stems))::DOUBLE / len(stems)::DOUBLE) AS score
       FROM (SELECT DISTINCT subject, lookup FROM look) l JOIN sense s ON l.lookup = s.headword JOIN ctx USING (subject)),
rk AS (SELECT *, row_number() OVER w AS rank, coalesce(lead(score) OVER w, 0.0) AS runner, first_value(score) OVER w AS top
       FROM sc WINDOW w AS (PARTITION BY subject, lookup ORDER BY score DESC, sense_id)),
em AS (SELECT subject, sense_id, form, field, kind, lookup, rank, score,
              CASE WHEN kind = 0 THEN CASE WHEN rank = 1 AND field <> 'skos:altLabel' AND score >= 0.60 AND score >= runner + 0.05 THEN 'skos:exactMatch' ELSE 'skos:closeMatch' END
                   WHEN is_head THEN 'skos:broadMatch' ELSE 'skos:relatedMatch' END AS predicate,
              CAST(printf('%.3f', CASE WHEN kind = 0 THEN score ELSE 0.8::DOUBLE * score END) AS DOUBLE) AS confidence
       FROM look JOIN rk USING (subject, lookup)
       WHERE CASE WHEN kind = 0 THEN top >= 0.40 AND (rank = 1 OR score >= 0.55) ELSE rank = 1 AND score >= 0.45 END),
st AS (SELECT *, row_number() OVER (PARTITION BY subject, sense_id ORDER BY CASE predicate WHEN 'skos:exactMatch' THEN 4 WHEN 'skos:closeMatch' THEN 3 WHEN 'skos:relatedMatch' THEN 1 ELSE 2 END DESC,
              confidence DESC, form, field, kind, CASE WHEN kind = 0 THEN rank END, lookup) AS n FROM em)
"""


def _part_links(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    senses = lexical.usable_senses(part_senses(part), ascii_only=True)
    return lexical.match(part_labels(part), part_concepts(part), senses, PRIORS, ascii_only=True)[0]


@query(_LEX + "SELECT subject, sense_id, predicate, confidence, round(score, 6) AS score FROM st WHERE n = 1")
def q01_lexical_match(spark, sf):
    return _part_links(spark, sf).select("subject", "sense_id", "predicate", F.col("confidence").cast("double").alias("confidence"), F.round("score", 6).alias("score"))


@query(_LEX + "SELECT subject, field, lookup, sense_id, predicate, confidence FROM em WHERE kind = 1")
def q02_head_word_links(spark, sf):
    part = table(spark, sf, "part")
    looked = lexical.lookups(lexical.surface_forms(part_labels(part), ascii_only=True)).where("kind = 1")
    ranks = lexical.ranked(looked, part_concepts(part), lexical.usable_senses(part_senses(part), ascii_only=True), PRIORS)
    return lexical.emissions(looked, ranks).select("subject", "field", "lookup", "sense_id", "predicate", F.col("confidence").cast("double").alias("confidence"))


@query(r"""
WITH l AS (SELECT CAST(p_partkey AS VARCHAR) AS subject, p_name || ' / ' || p_type || '-goods (' || p_brand || ')' AS text FROM part),
p AS (SELECT subject, unnest(list_distinct(list_concat([text], regexp_split_to_array(text, '\s*/\s*')))) AS part FROM l),
n AS (SELECT subject, trim(regexp_replace(regexp_replace(regexp_replace(lower(part), '\s*\([^()]*\)\s*$', ''), '[-/_]', ' ', 'g'), '\s+', ' ', 'g')) AS form FROM p)
SELECT DISTINCT subject, regexp_replace(form, '^\W+|\W+$', '', 'g') AS form, 'rdfs:label' AS field FROM n WHERE regexp_replace(form, '^\W+|\W+$', '', 'g') <> ''
""")
def q03_surface_forms(spark, sf):
    part = table(spark, sf, "part")
    full = F.concat("p_name", F.lit(" / "), "p_type", F.lit("-goods ("), "p_brand", F.lit(")"))
    return lexical.surface_forms(part.select(F.col("p_partkey").cast("string").alias("subject"), full.alias("text"), F.lit("rdfs:label").alias("field")))


@query(r"""
WITH heads AS (SELECT DISTINCT headword FROM (SELECT p_name AS headword FROM part UNION ALL SELECT unnest(string_split(p_name, ' ')) FROM part)),
s AS (SELECT replace(headword, ' ', '_') || ':' || lower(p_type) AS sense_id, headword, CASE WHEN length(headword) % 3 = 0 THEN 'verb' ELSE 'noun' END AS pos,
             CASE length(p_type) % 3 WHEN 0 THEN NULL WHEN 1 THEN 'wordnet-3.0' ELSE 'own' END AS source FROM heads, (SELECT DISTINCT p_type FROM part)),
c AS (SELECT DISTINCT h FROM (SELECT p_name AS h FROM part WHERE p_size > 25 UNION ALL SELECT unnest(string_split(p_name, ' ')) FROM part WHERE p_size > 25))
SELECT sense_id, headword FROM s WHERE pos = 'noun' AND (source IS NULL OR source <> 'wordnet-3.0') AND headword IN (SELECT h FROM c)
""")
def q04_candidate_semi_join(spark, sf):
    part = table(spark, sf, "part")
    pos = F.when(F.length("headword") % 3 == 0, "verb").otherwise("noun")
    source = F.when(F.length("domain") % 3 == 1, "wordnet-3.0").when(F.length("domain") % 3 == 2, "own")
    senses = part_senses(part).withColumn("pos", pos).withColumn("source", source)
    forms = part.where("p_size > 25").select(F.lower("p_name").alias("form"))
    return lexical.usable_senses(senses, lexical.candidate_headwords(forms), ascii_only=True).select("sense_id", "headword")


GAP_PRIORS = {"high": {"PROMO": 1.0, "other": 0.3}, "low": {"other": 0.3}}


@query(r"""
WITH heads AS (SELECT DISTINCT headword FROM (SELECT p_name AS headword FROM part UNION ALL SELECT unnest(string_split(p_name, ' ')) FROM part)),
s AS (SELECT replace(headword, ' ', '_') || ':' || lower(p_type) AS sense_id, headword, p_type AS domain FROM heads, (SELECT DISTINCT p_type FROM part))
SELECT CAST(p_partkey AS VARCHAR) AS subject, p_name AS match_string, string_agg(sense_id || '=' || domain, '; ' ORDER BY sense_id) AS headword_senses_domains
FROM part JOIN s ON s.headword = p_name WHERE p_size <= 25 GROUP BY ALL
""")
def q05_gaps(spark, sf):
    """Concepts of the low profile have no link, and none of their senses a high prior; those of the high profile link."""
    part = table(spark, sf, "part")
    profile = part.select(F.col("p_partkey").cast("string").alias("subject"), F.when(F.col("p_size") > 25, F.array(F.lit("high"))).otherwise(F.array(F.lit("low"))).alias("profiles"))
    concepts = part_concepts(part).drop("profiles").join(profile, "subject")
    return lexical.match(part_labels(part), concepts, lexical.usable_senses(part_senses(part, gloss=False), ascii_only=True), GAP_PRIORS, ascii_only=True)[1]


@query(_LEX + "SELECT predicate AS predicate_id, count(*) AS n FROM st WHERE n = 1 GROUP BY predicate")
def q06_links_by_predicate(spark, sf):
    return mapping.count_by_predicate(_part_links(spark, sf).withColumnRenamed("predicate", "predicate_id"))


@query("""
WITH e AS (SELECT doc_id, CASE WHEN n_chars > 1000 THEN 'skos:exactMatch' ELSE 'skos:closeMatch' END AS p FROM documents WHERE lang <> 'es'),
g AS (SELECT doc_id, quality = 1 AS good, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN toxic = 1 THEN 'skos:closeMatch' ELSE 'skos:exactMatch' END AS want FROM labels),
j AS (SELECT * FROM e JOIN g USING (doc_id))
SELECT (SELECT count(*) FROM g) AS judged, count(*) AS emitted_judged, round(count(*) FILTER (good) / nullif(count(*), 0), 4) AS precision,
       round((SELECT count(*) FROM g WHERE good AND doc_id IN (SELECT doc_id FROM e)) / nullif((SELECT count(*) FROM g WHERE good), 0), 4) AS recall,
       round(count(*) FILTER (good AND p = want) / nullif(count(*) FILTER (good AND want IS NOT NULL), 0), 4) AS predicate_agreement FROM j
""")
def q07_precision_recall(spark, sf):
    key = lambda c: F.col(c).cast("string")
    linked = F.when(F.col("lang") != "es", key("doc_id"))  # Spanish documents are emitted without an object
    rows = table(spark, sf, "documents").select(key("doc_id").alias("subject_id"), linked.alias("object_id"), F.when(F.col("n_chars") > 1000, "skos:exactMatch").otherwise("skos:closeMatch").alias("predicate_id"))
    want = F.when(F.col("doc_id") % 3 == 0, None).when(F.col("toxic") == 1, "skos:closeMatch").otherwise("skos:exactMatch")
    gold = table(spark, sf, "labels").select(key("doc_id").alias("subject_id"), key("doc_id").alias("object_id"), F.when(F.col("quality") == 1, "correct").otherwise("incorrect").alias("verdict"), want.alias("expected_predicate"))
    return mapping.score(rows, gold)


@query("""
SELECT c.subject, l.label, f.deprecated FROM (SELECT CAST(c_custkey AS VARCHAR) AS subject FROM customer WHERE c_nationkey = 3) c
LEFT JOIN (SELECT CAST(c_custkey AS VARCHAR) AS subject, c_name AS label FROM customer WHERE c_acctbal > 1000) l USING (subject)
LEFT JOIN (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS subject, o_orderstatus AS deprecated FROM orders) f USING (subject)
ORDER BY subject, coalesce(label, ''), coalesce(deprecated, '') LIMIT 20
""")
def q08_class_query_limit20(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    key = F.col("c_custkey").cast("string")
    return graph.class_query(
        c.select(key.alias("subject")), c.where("c_acctbal > 1000").select(key.alias("subject"), F.col("c_name").alias("label")), o.select(F.col("o_custkey").cast("string").alias("subject"), F.col("o_orderstatus").alias("deprecated")).distinct(),
        c.select(key.alias("child"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("parent")), "N3",
    )


def geo_edges(spark: SparkSession, sf: str) -> DataFrame:
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    s = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string"))
    e = c.select(s("C", "c_custkey").alias("child"), s("N", "c_nationkey").alias("parent")).unionAll(n.select(s("N", "n_nationkey"), s("R", "n_regionkey"))).unionAll(r.select(s("R", "r_regionkey"), F.lit("THING")))
    return e.unionAll(spark.sql("SELECT * FROM VALUES ('X1', 'X2'), ('X2', 'X1'), ('X2', 'R0') AS t(child, parent)"))


_EDGES = """
e(child, parent) AS (SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation
    UNION ALL SELECT 'R' || r_regionkey, 'THING' FROM region UNION ALL VALUES ('X1', 'X2'), ('X2', 'X1'), ('X2', 'R0'))"""


@query(f"WITH {_EDGES} SELECT child AS node, 'parent' AS relation, parent AS neighbour FROM e UNION ALL SELECT parent, 'child', child FROM e")
def q09_direct_parents_children(spark, sf):
    return graph.parents_and_children(geo_edges(spark, sf))


@query("SELECT DISTINCT a.n_name AS node, b.n_name AS sibling FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey")
def q10_siblings(spark, sf):
    return graph.siblings(table(spark, sf, "nation").select(F.col("n_name").alias("child"), F.col("n_regionkey").cast("string").alias("parent")))


_CLOSURE = f"WITH RECURSIVE {_EDGES}, c(node, ancestor) AS (SELECT child, parent FROM e UNION SELECT c.node, e.parent FROM c JOIN e ON e.child = c.ancestor)"


@query(_CLOSURE + " SELECT node, ancestor FROM c")
def q11_closure_cycles(spark, sf):
    return graph.closure(geo_edges(spark, sf))


@query(_CLOSURE + " SELECT ancestor, count(*) AS n_descendants FROM c GROUP BY ancestor")
def q12_descendant_counts(spark, sf):
    return graph.closure(geo_edges(spark, sf)).groupBy("ancestor").agg(F.count(F.lit(1)).alias("n_descendants"))


# Two versions of an annotation table, from whole documents.


def versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    d = table(spark, sf, "documents")
    k = F.col("doc_id") % 7
    old = d.select(F.col("doc_id").cast("string").alias("subject"), F.col("source").alias("predicate"), F.col("text").alias("lexical"), F.col("lang").alias("language"), F.lit(None).cast("string").alias("datatype"))
    lexical_ = F.when(k == 2, F.concat("text", F.lit(" revised"))).otherwise(F.col("text"))
    language = F.when(k == 1, F.concat("lang", F.lit("-x"))).otherwise(F.col("lang"))
    predicate = F.when(k == 0, F.lit("moved")).otherwise(F.col("source"))
    new = d.select(F.col("doc_id").cast("string").alias("subject"), predicate.alias("predicate"), lexical_.alias("lexical"), language.alias("language"), F.lit(None).cast("string").alias("datatype"))
    return old, new.unionByName(d.where(k == 3).select(F.col("doc_id").cast("string").alias("subject"), F.lit("note").alias("predicate"), F.concat("source", F.lit(" note")).alias("lexical"), F.col("lang").alias("language"), F.lit(None).cast("string").alias("datatype")))


_VERSIONS = """
v0 AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS subject, source AS predicate, text AS lexical, lang AS language FROM documents),
v1 AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS subject, CASE WHEN doc_id % 7 = 0 THEN 'moved' ELSE source END AS predicate, CASE WHEN doc_id % 7 = 2 THEN text || ' revised' ELSE text END AS lexical,
              CASE WHEN doc_id % 7 = 1 THEN lang || '-x' ELSE lang END AS language FROM documents
       UNION SELECT CAST(doc_id AS VARCHAR), 'note', source || ' note', lang FROM documents WHERE doc_id % 7 = 3)"""
_DELTA = f"""
WITH {_VERSIONS},
gone AS (SELECT * FROM v0 EXCEPT SELECT * FROM v1), came AS (SELECT * FROM v1 EXCEPT SELECT * FROM v0),
rt AS (SELECT subject, predicate, lexical FROM (SELECT *, 0 AS s FROM gone UNION ALL SELECT *, 1 FROM came) GROUP BY ALL HAVING count(*) FILTER (s = 0) = 1 AND count(*) FILTER (s = 1) = 1),
g2 AS (SELECT * FROM gone ANTI JOIN rt USING (subject, predicate, lexical)), c2 AS (SELECT * FROM came ANTI JOIN rt USING (subject, predicate, lexical)),
rp AS (SELECT subject, predicate, lower(language) AS ll FROM (SELECT *, 0 AS s FROM g2 UNION ALL SELECT *, 1 FROM c2) GROUP BY ALL HAVING count(*) FILTER (s = 0) = 1 AND count(*) FILTER (s = 1) = 1),
d AS (SELECT 'retagged' AS change, subject, predicate FROM rt UNION ALL SELECT 'replaced', subject, predicate FROM rp
      UNION ALL SELECT 'removed', subject, predicate FROM g2 WHERE (subject, predicate, lower(language)) NOT IN (SELECT (subject, predicate, ll) FROM rp)
      UNION ALL SELECT 'added', subject, predicate FROM c2 WHERE (subject, predicate, lower(language)) NOT IN (SELECT (subject, predicate, ll) FROM rp))
"""


@query(_DELTA + "SELECT change, subject, predicate FROM d")
def q13_delta_classify(spark, sf):
    d = changes.delta(*versions(spark, sf))
    return d.select("change", F.coalesce("after.subject", "before.subject").alias("subject"), F.coalesce("after.predicate", "before.predicate").alias("predicate"))


@query("""
SELECT doc_id, sha256('{"datatype":null,"language":' || to_json(lower(lang)) || ',"lexical":' || to_json(text) || ',"object_kind":"literal","predicate":' || to_json(source) || ',"subject":' || to_json(CAST(doc_id AS VARCHAR)) || '}') AS value_hash FROM documents
""")
def q14_delta_value_hash(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", identity.value_hash(F.col("doc_id").cast("string"), F.col("source"), F.col("text"), F.col("lang"), F.lit(None).cast("string")).alias("value_hash"))


def _odd_values(spark: SparkSession, sf: str, shift: int) -> DataFrame:
    """Documents as annotations, some of them with defects, at places that shift."""
    k = (F.col("doc_id") + shift) % 11
    lex = F.when(k == 0, "").when(k == 1, " NULL ").when(k == 2, "[1, 'a']").otherwise(F.col("text"))
    lang = F.when(k == 3, "en_US").when(k == 4, "ru").otherwise(F.col("lang"))
    return table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("subject"), F.col("source").alias("predicate"), lex.alias("lexical"), lang.alias("language"), F.lit(None).cast("string").alias("datatype"), F.lit("literal").alias("object_kind"))


def _odd_sql(shift: int) -> str:
    k = f"(doc_id + {shift}) % 11"
    return f"""
SELECT code, severity, CAST(doc_id AS VARCHAR) AS subject, source AS predicate FROM (
  SELECT doc_id, source, unnest([x FOR x IN [CASE {k} WHEN 0 THEN 'empty_annotation' WHEN 1 THEN 'sentinel_annotation' WHEN 2 THEN 'serialized_container' WHEN 3 THEN 'invalid_language_tag'
           WHEN 4 THEN CASE WHEN regexp_matches(text, '\\pL') AND NOT regexp_matches(text, '\\p{{Cyrillic}}') THEN 'script_mismatch' END
           ELSE CASE WHEN trim(regexp_replace(text, '\\s', ' ', 'g')) = '' THEN 'empty_annotation' END END] IF x IS NOT NULL]) AS code FROM documents) t,
  (SELECT 1), LATERAL (SELECT CASE WHEN code = 'script_mismatch' THEN 'review' ELSE 'error' END AS severity)"""


@query(_odd_sql(0))
def q15_census_findings(spark, sf):
    return review.census(_odd_values(spark, sf, 0)).select("code", "severity", "subject", "predicate")


@query(f"SELECT * FROM ({_odd_sql(1)}) EXCEPT SELECT * FROM ({_odd_sql(0)})")
def q16_regressions(spark, sf):
    return changes.regressions(review.census(_odd_values(spark, sf, 0)), review.census(_odd_values(spark, sf, 1))).select("code", "severity", "subject", "predicate")


@query("SELECT CAST(conv_id AS VARCHAR) AS subject, role AS predicate, count(*) AS n FROM conversations WHERE role IN ('user', 'assistant') GROUP BY ALL HAVING count(*) > CASE role WHEN 'user' THEN 2 ELSE 1 END")
def q17_cardinality(spark, sf):
    return review.cardinality(table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("subject"), F.col("role").alias("predicate")), {"user": 2, "assistant": 1})


@query("SELECT lang, source, count(*) AS population FROM documents GROUP BY ALL")
def q18_stratum_counts(spark, sf):
    return review.stratum_counts(table(spark, sf, "documents"), ["lang", "source"])


_EACH4 = stats.simultaneous(0.95, 4)
_N0 = stats.z_two_sided(_EACH4) ** 2 * 0.25 / (0.05 * 0.05)
_SAMPLE = f"""
s AS (SELECT lang AS stratum, count(*) AS population FROM documents GROUP BY lang),
w AS (SELECT stratum, CASE WHEN population <= 30 THEN population ELSE least(population, greatest(1, CAST(ceil({_N0!r}::DOUBLE / (1.0::DOUBLE + {_N0 - 1!r}::DOUBLE / greatest(population, 1))) AS BIGINT))) END AS sample FROM s),
p AS (SELECT doc_id, lang AS stratum, row_number() OVER (PARTITION BY lang ORDER BY sha256('seed-1:' || doc_id), doc_id) AS place FROM documents),
k AS (SELECT doc_id, stratum, place FROM p JOIN w USING (stratum) WHERE place <= sample)"""


def _sampled(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("stratum"))
    return review.hash_sample(d, "doc_id", "seed-1", 0.95, 0.05, 30, 4).where("selected")


@query(f"WITH {_SAMPLE} SELECT doc_id, stratum, place FROM k")
def q19_hash_sample(spark, sf):
    return _sampled(spark, sf).select("doc_id", "stratum", "place")


_Z = stats.z_one_sided(_EACH4)


@query(f"""WITH {_SAMPLE},
b AS (SELECT stratum, count(*) AS sample, count(*) FILTER (quality = 0) AS defects, count(*) FILTER (quality = 0 AND toxic = 1) AS severe, count(*) FILTER (quality IS NULL) AS missing FROM k LEFT JOIN labels USING (doc_id) GROUP BY stratum),
u AS (SELECT *, least(1.0::DOUBLE, (defects / sample + {_Z * _Z!r}::DOUBLE / (2 * sample) + {_Z!r}::DOUBLE * sqrt((defects / sample) * (1 - defects / sample) / sample + {_Z * _Z!r}::DOUBLE / (4.0 * sample * sample))) / (1 + {_Z * _Z!r}::DOUBLE / sample)) AS ub FROM b)
SELECT stratum, sample, defects, severe, missing, round(ub, 6) AS upper_bound, severe > 0 OR ub > 0.1 AS requires_census FROM u""")
def q20_wilson_bound(spark, sf):
    results = table(spark, sf, "labels").select(F.col("doc_id").alias("record_id"), F.when(F.col("quality") == 0, "defect").otherwise("pass").alias("verdict"), (F.col("toxic") == 1).alias("severe"))
    out = review.evaluate_sample(_sampled(spark, sf).select(F.col("doc_id").alias("record_id"), "stratum"), results, 0.95, 4, 0.1)
    return out.withColumn("upper_bound", F.round("upper_bound", 6))


@query("""
WITH a AS (SELECT doc_id AS record_id, CASE WHEN quality = 1 THEN 'pass' ELSE 'defect' END AS v, 0.5::DOUBLE + (doc_id % 5) / 10.0::DOUBLE AS c FROM labels),
b AS (SELECT doc_id AS record_id, CASE WHEN doc_id % 17 = 0 THEN NULL WHEN toxic = 0 THEN 'pass' ELSE 'defect' END AS v, 0.9::DOUBLE AS c FROM labels)
SELECT record_id, CASE WHEN a.v IS NULL OR b.v IS NULL THEN 'incomplete' WHEN a.v = 'pass' AND b.v = 'pass' AND least(a.c, b.c) >= 0.7 THEN 'accepted'
  WHEN a.v = 'defect' AND b.v = 'defect' THEN 'defect_confirmed' ELSE 'quarantined' END AS state FROM a FULL JOIN b USING (record_id)
""")
def q21_reconcile(spark, sf):
    lab = table(spark, sf, "labels")
    a = lab.select(F.col("doc_id").alias("record_id"), F.when(F.col("quality") == 1, "pass").otherwise("defect").alias("verdict"), (F.lit(0.5) + (F.col("doc_id") % 5) / F.lit(10.0)).alias("confidence"))
    verdict = F.when(F.col("doc_id") % 17 != 0, F.when(F.col("toxic") == 0, "pass").otherwise("defect"))  # the second reviewer left some out
    b = lab.select(F.col("doc_id").alias("record_id"), verdict.alias("verdict"), F.lit(0.9).alias("confidence"))
    return review.reconcile(a, b, 0.7)


@query("""
WITH j AS (SELECT source AS family, lang AS locale, CASE WHEN quality = 1 THEN 'pass' ELSE 'defect' END AS expected, CASE WHEN n_chars < 2000 THEN CASE WHEN toxic = 0 THEN 'pass' ELSE 'defect' END END AS predicted FROM labels JOIN documents USING (doc_id))
SELECT family, locale, count(*) AS n_scored, count(*) FILTER (predicted IS NULL) AS n_missing, round(count(*) FILTER (predicted = expected) / count(*), 6) AS accuracy,
  round(coalesce((count(*) FILTER (expected = 'defect') - count(*) FILTER (expected = 'defect' AND predicted = 'pass')) / nullif(count(*) FILTER (expected = 'defect'), 0), 0.0), 6) AS defect_recall,
  round(coalesce(count(*) FILTER (expected = 'defect' AND predicted = 'pass') / nullif(count(*) FILTER (expected = 'defect'), 0), 0.0), 6) AS false_accept_rate, count(*) >= 5 AS supported FROM j GROUP BY ALL
""")
def q22_eval_slices(spark, sf):
    j = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars"), "doc_id")
    cases = j.select(F.col("doc_id").alias("case_id"), F.col("source").alias("family"), F.col("lang").alias("locale"), F.when(F.col("quality") == 1, "pass").otherwise("defect").alias("expected"))
    told = j.where("n_chars < 2000").select(F.col("doc_id").alias("case_id"), F.when(F.col("toxic") == 0, "pass").otherwise("defect").alias("predicted"))
    out = review.slice_metrics(cases, told, 5)
    return out.select("family", "locale", "n_scored", "n_missing", *(F.round(c, 6).alias(c) for c in ("accuracy", "defect_recall", "false_accept_rate")), "supported")


@query("SELECT conv_id, turn FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS above FROM conversations) WHERE role < above")
def q23_order_violations(spark, sf):
    return mapping.order_findings(table(spark, sf, "conversations"), ["role"], "turn", ["conv_id"]).select("conv_id", "turn")


@query("SELECT conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM conversations) WHERE n > 1")
def q24_duplicate_pairs(spark, sf):
    c = table(spark, sf, "conversations").withColumn("row", F.col("turn"))
    return mapping.duplicate_findings(c, ["conv_id", "role"]).select("conv_id", "turn")


def _part_rows(part: DataFrame) -> DataFrame:
    """A mapping set with defects, a row per part."""
    k, name = F.col("p_partkey"), F.replace("p_name", F.lit(" "), F.lit("_"))
    predicate = F.element_at(F.array(*map(F.lit, mapping.PREDICATES)), (k % 5 + 1).cast("int"))
    return part.select(
        (k + 1).alias("row"), F.concat(F.lit("C:"), k.cast("string")).alias("subject_id"), F.col("p_name").alias("subject_label"), predicate.alias("predicate_id"),
        F.concat(F.lit("OGS:"), name, F.lit(":noun:"), F.col("p_size").cast("string")).alias("object_id"), F.col("p_name").alias("object_label"), F.lit("semapv:LexicalMatching").alias("mapping_justification"),
        F.element_at(F.array(*map(F.lit, ("0.500", "0.250", "1.000", "0.125"))), (k % 4 + 1).cast("int")).alias("confidence"), F.lit("rdfs:label").alias("subject_match_field"), F.lit("rdfs:label").alias("object_match_field"), F.col("p_name").alias("match_string"), F.lit("label-phrase").alias("comment"),
    )


@query("""
WITH r AS (SELECT p_partkey + 1 AS row, CASE WHEN p_size % 7 = 0 THEN 'odd' ELSE 'skos:closeMatch' END AS p, CASE WHEN p_size % 11 = 0 THEN 'OGS:two words:noun:1' ELSE 'OGS:' || replace(p_name, ' ', '_') || ':noun:' || p_size END AS o,
  CASE WHEN p_size % 13 = 0 THEN 'C:' ELSE 'C:' || p_partkey END AS s, ['0.5', '1.5', 'abc', '0'][p_partkey % 4 + 1] AS c FROM part)
SELECT row, unnest([x FOR x IN [CASE WHEN p = 'odd' THEN 'predicate' END, CASE WHEN NOT regexp_matches(o, '^OGS:[^\\s|,;:]+:[a-z]+:\\d+$') THEN 'object-id' END, CASE WHEN NOT regexp_matches(s, '^C:[0-9]+$') THEN 'subject-id' END,
  CASE WHEN coalesce(NOT (try_cast(c AS DOUBLE) > 0 AND try_cast(c AS DOUBLE) <= 1), TRUE) THEN 'confidence' END] IF x IS NOT NULL]) AS code FROM r
""")
def q25_validate_rows(spark, sf):
    part = table(spark, sf, "part")
    size = part.select((F.col("p_partkey") + 1).alias("row"), "p_size")
    rows = _part_rows(part).join(size, "row")
    rows = rows.withColumn("predicate_id", F.when(F.col("p_size") % 7 == 0, "odd").otherwise("skos:closeMatch")).withColumn("object_id", F.when(F.col("p_size") % 11 == 0, "OGS:two words:noun:1").otherwise(F.col("object_id")))
    rows = rows.withColumn("subject_id", F.when(F.col("p_size") % 13 == 0, "C:").otherwise(F.col("subject_id")))
    rows = rows.withColumn("confidence", F.element_at(F.array(*map(F.lit, ("0.5", "1.5", "abc", "0"))), ((F.col("row") - 1) % 4 + 1).cast("int")))
    return mapping.row_findings(rows, r"^C:[0-9]+$")


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def q26_active_anti_join(spark, sf):
    active = table(spark, sf, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("subject"))
    return mapping.subject_findings(table(spark, sf, "orders").withColumnRenamed("o_custkey", "subject_id"), active).select("o_orderkey")


@query("""
WITH q AS (SELECT DISTINCT replace(c_name, 'Customer', 'Supplier') AS query FROM customer)
SELECT query, (SELECT max(s_name) FROM supplier WHERE s_name < query) AS before, (SELECT min(s_name) FROM supplier WHERE s_name >= query) AS after FROM q
""")
def q27_asof_neighbours(spark, sf):
    q = table(spark, sf, "customer").select(F.replace("c_name", F.lit("Customer"), F.lit("Supplier")).alias("query"))
    return labels.neighbours(q, table(spark, sf, "supplier").select(F.col("s_name").alias("name")))


_NAMES = "CASE c_custkey % 6 WHEN 0 THEN 'R' || substr(md5(c_name), 1, 20) WHEN 1 THEN 'R' || substr(md5(c_name), 1, 23) WHEN 2 THEN 'R' || substr(md5(c_name), 1, 19) || '_-' WHEN 3 THEN substr(md5(c_name), 1, 21) || '-' WHEN 4 THEN substr(md5(c_name), 1, 18) || 'Q' ELSE c_name END"


@query(f"""
WITH n AS (SELECT {_NAMES} AS x FROM customer)
SELECT CASE WHEN regexp_full_match(x, 'R[0-9A-Za-z]{{19,22}}') THEN 'canonical' WHEN regexp_full_match(x, 'R[0-9A-Fa-f]{{23}}') THEN 'legacy-hex' WHEN regexp_full_match(x, 'R[0-9A-Za-z_-]{{19,23}}') THEN 'legacy-r-base64url'
  WHEN regexp_full_match(x, '[0-9A-Za-z_-]{{22}}') THEN 'legacy-uuid' WHEN regexp_full_match(x, '[0-9A-Za-z]{{17,21}}[AQgw]') THEN 'legacy-16-bytes' ELSE 'nonconforming' END AS family, count(*) AS n FROM n GROUP BY 1
""")
def q28_family_census(spark, sf):
    names = table(spark, sf, "customer").select(F.expr(_NAMES).alias("x"))
    return names.groupBy(identity.family(F.col("x")).alias("family")).agg(F.count(F.lit(1)).alias("n"))


def _part_forms(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("subject"), F.lower("p_name").alias("form"), F.lower(F.substring("p_type", 1, 2)).alias("language"))


@query("SELECT lower(p_name) AS form, count(DISTINCT p_partkey) AS n_concepts FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1")
def q29_ambiguous_forms(spark, sf):
    return labels.ambiguous_forms(_part_forms(spark, sf))


@query("""
WITH f AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS subject, lower(p_name) AS form, lower(substr(p_type, 1, 2)) AS language FROM part)
SELECT subject, form, language, count(*) OVER (PARTITION BY form, language) - 1 AS n_other FROM f QUALIFY n_other > 0
""")
def q30_collision_check(spark, sf):
    return labels.collisions(_part_forms(spark, sf), _part_forms(spark, sf))


def _two_labels(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    key, lang = F.col("p_partkey").cast("string").alias("subject"), F.element_at(F.array(F.lit("en"), F.lit("de"), F.lit("fr")), (F.col("p_size") % 3 + 1).cast("int")).alias("language")
    alt = F.when(F.col("p_size") % 5 == 0, F.col("p_name")).otherwise(F.element_at(F.split("p_name", " "), -1))
    return p.select(key, F.col("p_name").alias("text"), F.lit("rdfs:label").alias("field"), lang).unionAll(p.select(key, alt, F.lit("skos:altLabel"), lang))


_TWO = """
l AS (SELECT CAST(p_partkey AS VARCHAR) AS subject, p_name AS text, 'rdfs:label' AS field, ['en', 'de', 'fr'][p_size % 3 + 1] AS language FROM part
      UNION ALL SELECT CAST(p_partkey AS VARCHAR), CASE WHEN p_size % 5 = 0 THEN p_name ELSE string_split(p_name, ' ')[-1] END, 'skos:altLabel', ['en', 'de', 'fr'][p_size % 3 + 1] FROM part)"""


@query(f"WITH {_TWO} SELECT subject, text, language, count(DISTINCT field) AS n_fields FROM l GROUP BY ALL HAVING count(DISTINCT field) > 1")
def q31_disjointness(spark, sf):
    return labels.disjointness(_two_labels(spark, sf))


CELLS = {("note", "added"): 1, ("text", "retagged"): 2, ("text", "replaced"): 3, ("text", "added"): 2, ("text", "removed"): 4}


@query(_DELTA + """SELECT subject, CAST(max(CASE WHEN predicate = 'note' THEN CASE WHEN change = 'added' THEN 1 ELSE 0 END ELSE CASE change WHEN 'removed' THEN 4 WHEN 'replaced' THEN 3 ELSE 2 END END) AS INTEGER) AS worst, count(*) AS n FROM d GROUP BY subject""")
def q32_change_cells(spark, sf):
    d = q13_delta_classify(spark, sf)
    return labels.change_cells(d.select("subject", F.when(F.col("predicate") == "note", "note").otherwise("text").alias("layer"), F.col("change").alias("direction")), CELLS)


@query(f"""
WITH {_VERSIONS}, a AS (SELECT DISTINCT subject, language, lexical FROM v0), b AS (SELECT DISTINCT subject, language, lexical FROM v1),
j AS (SELECT language, a.subject IS NOT NULL AS x, b.subject IS NOT NULL AS y FROM a FULL JOIN b USING (subject, language, lexical))
SELECT language, count(*) FILTER (x) AS n_before, count(*) FILTER (y AND NOT x) AS n_added, count(*) FILTER (y) AS n_after FROM j GROUP BY language
""")
def q33_language_coverage(spark, sf):
    return labels.language_coverage(*(v.select("subject", "language", "lexical") for v in versions(spark, sf)))


@query(f"WITH {_TWO} SELECT language, count(*) AS n_alt, count(*) FILTER ((subject, text) IN (SELECT (subject, text) FROM l WHERE field <> 'skos:altLabel')) AS n_same FROM l WHERE field = 'skos:altLabel' GROUP BY language")
def q34_duplicate_localisation(spark, sf):
    return labels.duplicate_localisation(_two_labels(spark, sf))


@query(f"WITH {_VERSIONS} SELECT subject, predicate, language, (subject, predicate, language) IN (SELECT (subject, predicate, language) FROM v0) AS occupied FROM v1")
def q35_slot_occupancy(spark, sf):
    old, new = versions(spark, sf)
    slot = ["subject", "predicate", "language"]
    return labels.slot_occupancy(new.distinct().select(*slot), old, slot).select(*slot, "occupied")


@query(f"WITH {_TWO} SELECT text AS query, subject, min(language) AS language FROM l GROUP BY ALL")
def q36_exact_label_lookup(spark, sf):
    rows = _two_labels(spark, sf)
    return labels.exact_lookup(rows.select(F.col("text").alias("query")), rows)


def _triple(s: str, s_kind: str, p: str, o: str, o_kind: str):
    return F.struct(F.col(s).alias("subject"), F.lit(s_kind).alias("subject_kind"), F.lit(p).alias("predicate"), F.col(o).alias("object"), F.lit(o_kind).alias("object_kind"))


@query("""
SELECT l_returnflag || l_linestatus AS property, count(*) AS n, count(DISTINCT l_partkey) AS n_classes FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_partkey, l_suppkey FROM lineitem) GROUP BY 1
""")
def q37_restriction_stats(spark, sf):
    li = table(spark, sf, "lineitem").select(F.concat(F.lit("_:"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"), "l_returnflag", "l_linestatus").alias("node"), F.col("l_partkey").cast("string").alias("part"), F.col("l_suppkey").cast("string").alias("supp"), F.concat("l_returnflag", "l_linestatus").alias("flag"))
    none = F.lit(None).cast("string")
    facts = F.explode(F.array(
        _triple("part", "iri", RDFS + "subClassOf", "node", "bnode"),
        _triple("node", "bnode", OWL + "onProperty", "flag", "iri"),
        _triple("node", "bnode", OWL + "someValuesFrom", "supp", "iri"),
    ))
    triples = li.select(facts.alias("t")).select("t.*").withColumn("language", none).withColumn("datatype", none)
    return graph.restriction_stats(graph.restrictions(triples))


CURIES = {"C": "urn:c:", "OGS": "urn:s:", "OGL": "urn:l:", "skos": "http://www.w3.org/2004/02/skos/core#", "semapv": "https://w3id.org/semapv/vocab/"}


@query(r"""
WITH r AS (SELECT p_partkey, '<urn:c:' || p_partkey || '>' AS s, ['exact', 'close', 'broad', 'narrow', 'related'][p_partkey % 5 + 1] AS pn, replace(p_name, ' ', '_') || ':noun:' || p_size AS sid, p_name,
   '_:axiom' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS x, ['0.5', '0.25', '1.0', '0.125'][p_partkey % 4 + 1] AS c FROM part),
t AS (SELECT *, '<http://www.w3.org/2004/02/skos/core#' || pn || 'Match>' AS p, '<urn:s:' || sid || '>' AS o, '<urn:l:' || replace(p_name, ' ', '_') || '>' AS l, '<urn:l:' || replace(p_name, ' ', '_') || '#form>' AS f,
  '<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>' AS a, 'http://www.w3.org/2002/07/owl#' AS w, 'http://www.w3.org/ns/lemon/ontolex#' AS e FROM r)
SELECT DISTINCT unnest([y FOR y IN [s || ' ' || p || ' ' || o || ' .', x || ' ' || a || ' <' || w || 'Axiom> .', x || ' <' || w || 'annotatedSource> ' || s || ' .', x || ' <' || w || 'annotatedProperty> ' || p || ' .', x || ' <' || w || 'annotatedTarget> ' || o || ' .',
  x || ' <https://w3id.org/sssom/confidence> "' || c || '"^^<http://www.w3.org/2001/XMLSchema#double> .', x || ' <https://w3id.org/sssom/mapping_justification> <https://w3id.org/semapv/vocab/LexicalMatching> .', x || ' <http://www.w3.org/2000/01/rdf-schema#comment> "label-phrase" .',
  o || ' ' || a || ' <' || e || 'LexicalSense> .', o || ' <http://www.w3.org/2004/02/skos/core#definition> "' || p_name || ' gloss"@en .', o || ' <' || e || 'isSenseOf> ' || l || ' .', l || ' ' || a || ' <' || e || 'LexicalEntry> .', l || ' <' || e || 'sense> ' || o || ' .',
  l || ' <' || e || 'canonicalForm> ' || f || ' .', f || ' <' || e || 'writtenRep> "' || p_name || '"@en .', CASE WHEN pn = 'exact' THEN o || ' <' || e || 'reference> ' || s || ' .' END] IF y IS NOT NULL]) AS line FROM t
""")
def q38_triples_export(spark, sf):
    part = table(spark, sf, "part")
    rows = _part_rows(part)
    senses = rows.select(F.substring("object_id", 5, 1 << 20).alias("sense_id"), F.replace("match_string", F.lit(" "), F.lit("_")).alias("lexeme_id"), F.col("match_string").alias("headword"), F.concat("match_string", F.lit(" gloss")).alias("gloss"))
    return mapping.export_lines(rows, senses, CURIES)


@query(f"WITH {_VERSIONS} SELECT subject, predicate, language, 'removed' AS side FROM (SELECT * FROM v0 EXCEPT SELECT * FROM v1) UNION ALL SELECT subject, predicate, language, 'added' FROM (SELECT * FROM v1 EXCEPT SELECT * FROM v0)")
def q39_set_delta_both_ways(spark, sf):
    return changes.both_ways(*versions(spark, sf)).select("subject", "predicate", "language", "side")


@query(f"""
WITH {_VERSIONS}, g AS (SELECT * FROM v0 EXCEPT SELECT * FROM v1), c AS (SELECT * FROM v1 EXCEPT SELECT * FROM v0), c2 AS (SELECT * FROM c WHERE predicate <> 'note')
SELECT 'unexpected_removed' AS problem, 0::BIGINT AS n UNION ALL SELECT 'unexpected_added', (SELECT count(*) FROM c WHERE predicate = 'note') UNION ALL SELECT 'missing_removed', 0 UNION ALL SELECT 'missing_added', 0
""")
def q40_fidelity(spark, sf):
    old, new = (changes.keyed(v) for v in versions(spark, sf))
    accepted = changes.delta(old, new).where("NOT (change = 'added' AND after.predicate = 'note')")
    return changes.fidelity(old, new, accepted)


@query(_DELTA + "SELECT change, subject, predicate FROM d ORDER BY change, subject, predicate LIMIT 50")
def q41_top50_delta_sample(spark, sf):
    return changes.sample_of_changes(q13_delta_classify(spark, sf), ["change", "subject", "predicate"])


@query("SELECT o_orderpriority AS name, arg_max(o_orderkey, (year(o_orderdate), month(o_orderdate), o_orderkey)) AS id FROM orders GROUP BY 1")
def q42_latest_version(spark, sf):
    return labels.latest(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("name"), F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("major"), F.month("o_orderdate").alias("minor")))


@query(f"""
WITH {_TWO}, f AS (SELECT subject, text, CASE WHEN length(text) % 2 = 0 AND field = 'rdfs:label' THEN 'skos:prefLabel' ELSE field END AS field, language FROM l)
SELECT subject, arg_min(text, (CASE field WHEN 'skos:prefLabel' THEN 0 WHEN 'rdfs:label' THEN 2 ELSE 4 END + CASE WHEN language = 'en' THEN 0 ELSE 1 END, text)) AS label FROM f GROUP BY subject
""")
def q43_label_priority(spark, sf):
    rows = _two_labels(spark, sf)
    return graph.label_choice(rows.withColumn("field", F.when((F.length("text") % 2 == 0) & (F.col("field") == "rdfs:label"), "skos:prefLabel").otherwise(F.col("field"))))


PROFILES = {"a": {"PROMO": 1.0, "SMALL": 0.8, "other": 0.3}, "b": {"STANDARD": 1.0, "PROMO": 1.0, "other": 0.3}, "c": {"LARGE": 0.9, "other": 0.3}}
_PRIOR = {p: "CASE p_type " + " ".join(f"WHEN '{r}' THEN {v}" for r, v in t.items() if r != "other") + f" ELSE {t['other']} END" for p, t in PROFILES.items()}


@query("SELECT p_partkey, arg_min(p, (-v, p)) AS profile, max(v)::DOUBLE AS prior FROM (" + " UNION ALL ".join(f"SELECT p_partkey, '{p}' AS p, ({s})::DOUBLE AS v FROM part" + (" WHERE p_size > 10" if p == "b" else "") for p, s in _PRIOR.items()) + ") GROUP BY p_partkey")
def q44_profile_argmin(spark, sf):
    profiles = F.when(F.col("p_size") > 10, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("a"), F.lit("c")))
    return table(spark, sf, "part").select("p_partkey", lexical.best_profile(profiles, F.col("p_type"), PROFILES).alias("profile"), lexical.prior(profiles, F.col("p_type"), PROFILES).alias("prior"))


@query("SELECT event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 50)")
def q45_receipt_cache_join(spark, sf):
    e = table(spark, sf, "events")
    return review.unseen_requests(e, e.where("event_type = 'purchase' AND value > 50"), "user_id").select("event_id")


@query("SELECT doc_id, source, lang, (row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) - 1) // 25 AS batch FROM documents")
def q46_batches_of_25(spark, sf):
    return review.batches(table(spark, sf, "documents").select("doc_id", "source", "lang"), "doc_id", 25, ["source", "lang"])


_WIDTH = "CASE lang WHEN 'en' THEN 900 WHEN 'de' THEN 3000 ELSE 20 END"


@query(f"""
WITH n AS (SELECT DISTINCT lang, lang || '/' || source AS node FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL), s AS (SELECT a.node, rpad(b.node, {_WIDTH.replace('lang', 'a.lang')}, '.') AS label FROM n a JOIN n b ON a.lang = b.lang AND a.node <> b.node),
t AS (SELECT node, list(label ORDER BY label) AS l FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY label) AS k FROM s) WHERE k <= 12 GROUP BY node), u AS (SELECT n.node, ['language ' || lang] AS a, coalesce(l, []) AS l FROM n LEFT JOIN t USING (node)),
w AS (SELECT *, strlen(CAST(to_json({{'ancestors': a, 'siblings': l}}) AS VARCHAR)) > 8000 AS z, l[1:3] AS f FROM u)
SELECT node, array_to_string(a, '|') AS ancestors, array_to_string(CASE WHEN z THEN f ELSE l END, '|') AS siblings, z AND strlen(CAST(to_json({{'ancestors': a, 'siblings': f}}) AS VARCHAR)) > 8000 AS oversize FROM w
""")
def q47_context_topk(spark, sf):
    """Sources within languages: short labels fit, long ones are cut to three, and the longest are flagged even then."""
    d = table(spark, sf, "documents").where("lang IS NOT NULL AND source IS NOT NULL").select("lang", F.concat_ws("/", "lang", "source").alias("node")).distinct()
    edges = d.select(F.col("node").alias("child"), F.col("lang").alias("parent"))
    near = graph.first_siblings(edges, d.select(F.col("node").alias("subject"), F.expr(f"rpad(node, {_WIDTH}, '.')").alias("label")))
    up = d.select("node", F.concat(F.lit("language "), "lang").alias("label"))
    out = graph.bounded_context(up, near)
    return out.select("node", F.array_join("ancestors", "|").alias("ancestors"), F.array_join("siblings", "|").alias("siblings"), "oversize")


@query("""SELECT name, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS name FROM pages) GROUP BY name""")
def q48_page_markup_scan(spark, sf):
    found = table(spark, sf, "pages").select(F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1))).alias("name"))
    return found.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query()
def q49_unicode_normalise(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2(text.normalize(F.col("text")), 256).alias("normal_hash"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def q50_tumbling_window_census(spark, sf):
    out = stream_census.windowed_counts(table(spark, sf, "events"), late=None)
    return out.withColumn("total", F.round("total", 4)).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity, CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def q51_rollup_grouping_sets(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.grouping_id().alias("level"))

