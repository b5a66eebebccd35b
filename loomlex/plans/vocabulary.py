"""Queries over a vocabulary as triples, derived from customers, nations, regions and suppliers, in two versions.

The triples are stated once, in SQL that Spark and DuckDB both read; the operators are held against SQL of their own.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, text
from ..operators import changes, graph, labels, lexical
from ..operators.tables import OWL, RDFS, SKOS, XSD, json_lines, stored
from .queries import _VERSIONS, versions
from .registry import query, table

U = "urn:v:"
_ALT, _HIDDEN, _PREF, _LABEL, _DEF = SKOS + "altLabel", SKOS + "hiddenLabel", SKOS + "prefLabel", RDFS + "label", SKOS + "definition"
_NULL = "CAST(NULL AS STRING)"
_COLUMNS = "subject, subject_kind, predicate, object, object_kind, language, datatype"


def derived(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """A query in which tables stand in braces."""
    return spark.sql(sql, **{n: table(spark, sf, n) for n in set(re.findall(r"\{(\w+)\}", sql))})


def plain(sql: str) -> str:
    """The same for DuckDB, which has the tables by name."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def triples_sql(version: int) -> str:
    new = version == 1
    node = "'_:q'" if new else "'_:r'"

    def part(subject: str, predicate: str, object_: str, source: str, kind: str = "literal", language: str = _NULL, datatype: str = _NULL, where: str = "", subject_kind: str = "iri") -> str:
        return f"SELECT {subject} AS subject, '{subject_kind}' AS subject_kind, '{predicate}' AS predicate, {object_} AS object, '{kind}' AS object_kind, {language} AS language, {datatype} AS datatype FROM {{{source}}}" + (f" WHERE {where}" if where else "")

    c, n, r, s = (f"'{U}{k}' || {col}" for k, col in (("C", "c_custkey"), ("N", "n_nationkey"), ("R", "r_regionkey"), ("S", "s_suppkey")))
    parts = [
        part(c, graph.TYPE, f"'{graph.CLASS}'", "customer", "iri", where="" if new else "c_custkey % 13 <> 0"), part(n, graph.TYPE, f"'{graph.CLASS}'", "nation", "iri"), part(r, graph.TYPE, f"'{graph.CLASS}'", "region", "iri"),
        part(s, graph.TYPE, f"'{OWL}NamedIndividual'", "supplier", "iri"),
        part(c, graph.SUBCLASS, f"'{U}N' || c_nationkey", "customer", "iri"), part(n, graph.SUBCLASS, f"'{U}R' || n_regionkey", "nation", "iri"), part(r, graph.SUBCLASS, f"'{OWL}Thing'", "region", "iri"),
        part(c, _LABEL, "c_name", "customer", language="CASE c_custkey % 3 WHEN 1 THEN 'en' WHEN 2 THEN 'de' END", datatype=f"CASE WHEN c_custkey % 6 = 0 THEN '{XSD}string' END"),
        part(n, _LABEL, "n_name", "nation", language="'EN-us'"), part(r, _LABEL, "r_name", "region"),
        part(c, _PREF, "c_name || ' and Co'", "customer", language="'en'", where="c_custkey % 4 = 0"),
        part(c, _ALT, "c_mktsegment", "customer", language="'en'", where="c_custkey % 5 <> 0" if new else ""),
        part(c, _ALT, "'rel:' || c_mktsegment", "customer", where="c_custkey % 5 = 1 AND " + ("FALSE" if new else "TRUE")),
        part(c, _HIDDEN, "lower(c_name)", "customer", where="c_custkey % 4 = 0 AND " + ("TRUE" if new else "c_custkey % 8 = 0")),
        part(c, _DEF, "c_name || ' buys ' || c_mktsegment" + (" || CASE WHEN c_custkey % 6 = 0 THEN ' daily' ELSE '' END" if new else ""), "customer", language="'en'"),
        part(c, _DEF, "'A customer in ' || c_mktsegment", "customer", language="'en'", where="c_custkey % 11 = 0 AND " + ("TRUE" if new else "FALSE")),
        part(c, graph.DEPRECATED, "CASE WHEN c_custkey % 2 = 0 THEN ' TRUE ' ELSE '1' END", "customer", where="c_acctbal < 0"), part(n, graph.DEPRECATED, "'true'", "nation", where="n_nationkey % 9 = 4"), part(c, graph.DEPRECATED, "'false'", "customer", where="c_custkey % 7 = 0"),
        part(c, graph.SUBCLASS, f"{node} || c_custkey", "customer", "bnode"), part(f"{node} || c_custkey", graph.TYPE, f"'{OWL}Restriction'", "customer", "iri", subject_kind="bnode"),
        part(f"{node} || c_custkey", OWL + "onProperty", f"'{U}buysFrom'", "customer", "iri", subject_kind="bnode"),
        part(f"{node} || c_custkey", OWL + "someValuesFrom", f"'{U}S' || (1 + c_custkey % 10" + (" + CASE WHEN c_custkey % 8 = 0 THEN 1 ELSE 0 END" if new else "") + ")", "customer", "iri", subject_kind="bnode"),
        f"SELECT a, 'iri', '{graph.SUBCLASS}', b, 'iri', {_NULL}, {_NULL} FROM (VALUES ('{U}X1', '{U}X2'), ('{U}X2', '{U}X1'), ('{U}X2', '{U}R0')) AS x(a, b)",
        f"SELECT a, 'iri', '{graph.TYPE}', '{graph.CLASS}', 'iri', {_NULL}, {_NULL} FROM (VALUES ('{U}X1'), ('{U}X2')) AS x(a)",
    ]
    return " UNION ALL ".join(parts)


def vocabulary(spark: SparkSession, sf: str, version: int = 0) -> DataFrame:
    """Stored, as a vocabulary that is loaded is: the operators read it several times."""
    return stored(derived(spark, sf, triples_sql(version)), "vocabulary")


_T = f"t AS (SELECT DISTINCT * FROM ({plain(triples_sql(0))}))"
_T1 = f"t1 AS (SELECT DISTINCT * FROM ({plain(triples_sql(1))}))"
_C = f"c AS (SELECT DISTINCT subject FROM t WHERE predicate = '{graph.TYPE}' AND object = '{graph.CLASS}' AND subject_kind = 'iri')"
_D = f"d AS (SELECT DISTINCT subject FROM t WHERE predicate = '{graph.DEPRECATED}' AND lower(trim(object)) IN ('true', '1'))"
_A = "a AS (SELECT subject FROM c WHERE subject NOT IN (SELECT subject FROM d))"
_E = f"e AS (SELECT DISTINCT subject AS child, object AS parent FROM t WHERE predicate = '{graph.SUBCLASS}' AND object_kind = 'iri' AND subject_kind = 'iri')"
_FIELD = f"CASE predicate WHEN '{_LABEL}' THEN 'rdfs:label' WHEN '{_PREF}' THEN 'skos:prefLabel' WHEN '{_ALT}' THEN 'skos:altLabel' ELSE 'skos:hiddenLabel' END"
_IS_LABEL = f"predicate IN ('{_LABEL}', '{_PREF}', '{_ALT}', '{_HIDDEN}')"
_ENGLISH = "lower(coalesce(language, '')) IN ('', 'en', 'en-us', 'en-gb') AND object <> ''"


@query(f"WITH {_T}, {_C}, {_D} SELECT subject, subject NOT IN (SELECT subject FROM d) AS active FROM c")
def q52_declared_classes(spark, sf):
    t = vocabulary(spark, sf)
    active = graph.active_classes(t).withColumn("active", F.lit(True))
    return graph.classes(t).join(active, "subject", "left").select("subject", F.coalesce("active", F.lit(False)).alias("active"))


@query(f"WITH {_T} SELECT count(*) AS triples, count(*) FILTER (predicate = '{graph.TYPE}' AND object = '{graph.CLASS}' AND subject_kind = 'iri') AS classes FROM t")
def q53_graph_summary(spark, sf):
    return graph.graph_summary(vocabulary(spark, sf))


@query(f"WITH {_T} SELECT subject, predicate, object_kind AS kind, object AS value, language, datatype FROM t WHERE {_IS_LABEL}")
def q54_label_terms(spark, sf):
    t = vocabulary(spark, sf).where(F.col("predicate").isin(_LABEL, _PREF, _ALT, _HIDDEN))
    return t.distinct().select("subject", "predicate", graph.term().alias("t")).select("subject", "predicate", "t.*")


@query(f"WITH {_T} SELECT subject, object AS text, {_FIELD} AS field, language FROM t WHERE {_IS_LABEL} AND {_ENGLISH}")
def q55_english_labels(spark, sf):
    return graph.labels(vocabulary(spark, sf).distinct(), english=True)


@query(f"WITH {_T} SELECT DISTINCT subject, predicate, object AS lexical, language, datatype FROM t WHERE subject_kind = 'iri' AND object_kind = 'literal'")
def q56_literal_annotations(spark, sf):
    return changes.annotations(vocabulary(spark, sf))


@query(f"WITH {_T}, {_C}, {_D}, {_A}, {_E} SELECT DISTINCT child AS subject, object AS text FROM e JOIN t ON t.subject = parent AND {_IS_LABEL} AND {_ENGLISH} WHERE parent IN (SELECT subject FROM a)")
def q57_parent_labels(spark, sf):
    t = vocabulary(spark, sf)
    return graph.parent_labels(graph.edges(t), graph.labels(t, english=True).select("subject", "text"), graph.active_classes(t))


@query(f"WITH {_T}, {_D}, {_E} SELECT node, relation, neighbour, neighbour IN (SELECT subject FROM d) AS deprecated FROM (SELECT child AS node, 'parent' AS relation, parent AS neighbour FROM e UNION ALL SELECT parent, 'child', child FROM e)")
def q58_neighbour_flags(spark, sf):
    t = vocabulary(spark, sf)
    return graph.parents_and_children(graph.edges(t), graph.deprecated(t)).select("node", "relation", "neighbour", "deprecated")


_BRANCHES = f"""WITH RECURSIVE {_T}, {_C}, {_D}, {_A}, {_E}, i AS (SELECT child, parent FROM e WHERE child IN (SELECT subject FROM a)), top AS (SELECT DISTINCT child FROM i WHERE parent = '{OWL}Thing'),
w(subject, up) AS (SELECT subject, subject FROM a UNION SELECT w.subject, i.parent FROM w JOIN i ON i.child = w.up AND i.parent IN (SELECT subject FROM a)),
b AS (SELECT subject, string_agg(DISTINCT up, '|' ORDER BY up) AS branches FROM w WHERE up IN (SELECT child FROM top) GROUP BY subject)"""


@query(_BRANCHES + " SELECT subject, coalesce(branches, '') AS branches FROM a LEFT JOIN b USING (subject)")
def q59_branches(spark, sf):
    t = vocabulary(spark, sf)
    return graph.branches(graph.edges(t), graph.active_classes(t)).select("subject", F.array_join("branches", "|").alias("branches"))


_LOCAL = {"R0": "place", "R1": "commerce", "R2": "finance"}


@query(_BRANCHES + f" SELECT subject, CASE branches WHEN '{U}R0' THEN 'place' WHEN '{U}R1' THEN 'commerce' WHEN '{U}R2' THEN 'finance' ELSE 'legal' END AS profiles FROM a LEFT JOIN b USING (subject)")
def q60_branch_profiles(spark, sf):
    t = vocabulary(spark, sf)
    found = graph.branches(graph.edges(t), graph.active_classes(t))
    return found.select("subject", F.array_join(lexical.profiles_of(F.col("branches"), U, _LOCAL), "|").alias("profiles"))


@query(f"""WITH {_T}, {_D}, {_E} SELECT 'label' AS part, predicate AS key, object AS value, coalesce(language, '') AS more FROM t WHERE subject = '{U}N4' AND {_IS_LABEL}
UNION ALL SELECT 'neighbour', 'parent', parent, CAST(parent IN (SELECT subject FROM d) AS VARCHAR) FROM e WHERE child = '{U}N4' UNION ALL SELECT 'neighbour', 'child', child, CAST(child IN (SELECT subject FROM d) AS VARCHAR) FROM e WHERE parent = '{U}N4'""")
def q61_inspect_class(spark, sf):
    found = graph.inspect(vocabulary(spark, sf).distinct(), U + "N4")
    own = found["labels"].select(F.lit("label").alias("part"), F.col("predicate").alias("key"), F.col("term.value").alias("value"), F.coalesce("term.language", F.lit("")).alias("more"))
    return own.unionAll(found["neighbours"].select(F.lit("neighbour"), "relation", "neighbour", F.col("deprecated").cast("string")))


@query(f"WITH {_T} SELECT predicate, count(*) AS n FROM t WHERE subject_kind <> 'bnode' AND object_kind <> 'bnode' GROUP BY predicate")
def q62_named_triples(spark, sf):
    return graph.named_only(vocabulary(spark, sf).distinct()).groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_T}, {_C} SELECT subject FROM c ORDER BY subject LIMIT 10")
def q63_class_sample(spark, sf):
    return graph.class_sample(vocabulary(spark, sf))


_NORM = f"SELECT subject, predicate, object, object_kind, language, CASE WHEN datatype = '{XSD}string' AND language IS NULL THEN NULL ELSE datatype END AS datatype FROM"
_MERGE = f"""WITH {_T}, {_T1}, o AS (SELECT DISTINCT * FROM ({_NORM} t1)), h AS (SELECT DISTINCT * FROM ({_NORM} t)),
oc AS (SELECT DISTINCT subject FROM o WHERE predicate = '{graph.TYPE}' AND object = '{graph.CLASS}'), hc AS (SELECT DISTINCT subject FROM h WHERE predicate = '{graph.TYPE}' AND object = '{graph.CLASS}'), k AS (SELECT subject FROM oc INTERSECT SELECT subject FROM hc),
ok AS (SELECT * FROM o WHERE subject IN (SELECT subject FROM k)), hk AS (SELECT * FROM h WHERE subject IN (SELECT subject FROM k)), came AS (SELECT * FROM ok EXCEPT SELECT * FROM hk), gone AS (SELECT * FROM hk EXCEPT SELECT * FROM ok),
own AS (SELECT subject, object FROM ok WHERE predicate IN ('{_LABEL}', '{_PREF}')), rs AS (SELECT s.subject, v.object AS value, s.v FROM (SELECT subject, object, 1 AS v FROM t1 WHERE predicate = '{graph.SUBCLASS}' AND object_kind = 'bnode' UNION ALL SELECT subject, object, 0 FROM t WHERE predicate = '{graph.SUBCLASS}' AND object_kind = 'bnode') s
  JOIN (SELECT subject, object, 1 AS v FROM t1 WHERE predicate = '{OWL}someValuesFrom' UNION ALL SELECT subject, object, 0 FROM t WHERE predicate = '{OWL}someValuesFrom') v ON v.subject = s.object AND v.v = s.v WHERE s.subject IN (SELECT subject FROM k)),
m AS (SELECT 'new_classes' AS kind, subject, '' AS detail FROM (SELECT subject FROM oc EXCEPT SELECT subject FROM hc)
  UNION ALL SELECT 'new_alt_labels', subject, object FROM came WHERE predicate = '{_ALT}' UNION ALL SELECT 'new_hidden_labels', subject, object FROM came WHERE predicate = '{_HIDDEN}'
  UNION ALL SELECT 'removed_labels', subject, object FROM gone WHERE predicate IN ('{_ALT}', '{_HIDDEN}') AND object_kind = 'literal' AND NOT starts_with(object, 'rel:') AND (subject, object) NOT IN (SELECT (subject, object) FROM own)
    AND (subject, predicate, object) NOT IN (SELECT (subject, predicate, object) FROM ok)
  UNION ALL SELECT 'definition_additions', subject, object FROM came WHERE predicate = '{_DEF}' AND subject NOT IN (SELECT subject FROM gone WHERE predicate = '{_DEF}')
  UNION ALL SELECT 'definition_updates', subject, object FROM came WHERE predicate = '{_DEF}' AND subject IN (SELECT subject FROM gone WHERE predicate = '{_DEF}')
    AND subject IN (SELECT subject FROM ok WHERE predicate = '{_DEF}' GROUP BY subject HAVING count(*) = 1) AND subject IN (SELECT subject FROM hk WHERE predicate = '{_DEF}' GROUP BY subject HAVING count(*) = 1)
  UNION ALL SELECT 'new_restrictions', subject, value FROM (SELECT subject, value FROM rs WHERE v = 1 EXCEPT SELECT subject, value FROM rs WHERE v = 0))"""


def _merge_parts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return changes.merge_diff(vocabulary(spark, sf, 1), vocabulary(spark, sf, 0), "rel:")


@query(_MERGE + " SELECT kind, subject, detail FROM m")
def q64_merge_diff(spark, sf):
    out = None
    for kind, df in _merge_parts(spark, sf).items():
        detail = F.col("object") if "object" in df.columns else F.col("value") if "value" in df.columns else F.col("plain") if "plain" in df.columns else F.lit("")
        one = df.select(F.lit(kind).alias("kind"), "subject", detail.alias("detail"))
        out = one if out is None else out.unionAll(one)
    return out


_KINDS = ("new_classes", "new_alt_labels", "new_hidden_labels", "removed_labels", "definition_additions", "definition_updates", "label_normalizations", "new_restrictions")


@query(_MERGE + f" SELECT k2.kind, count(m.subject) AS n FROM (SELECT unnest({list(_KINDS)!r}) AS kind) k2 LEFT JOIN m ON m.kind = k2.kind GROUP BY k2.kind")
def q65_merge_summary(spark, sf):
    return changes.merge_summary(_merge_parts(spark, sf))


@query(f"""WITH {_T}, {_T1}, x AS (SELECT subject, predicate, object, 0 AS v FROM t WHERE object_kind <> 'bnode' AND subject_kind <> 'bnode' UNION ALL SELECT subject, predicate, object, 1 FROM t1 WHERE object_kind <> 'bnode' AND subject_kind <> 'bnode'),
n AS (SELECT DISTINCT object AS value, 0 AS v FROM t WHERE predicate = '{OWL}someValuesFrom' UNION SELECT DISTINCT object, 1 FROM t1 WHERE predicate = '{OWL}someValuesFrom'),
r AS (SELECT s.subject, v.object AS value, 0 AS v FROM t s JOIN t v ON v.subject = s.object AND v.predicate = '{OWL}someValuesFrom' WHERE s.object_kind = 'bnode' UNION SELECT s.subject, v.object, 1 FROM t1 s JOIN t1 v ON v.subject = s.object AND v.predicate = '{OWL}someValuesFrom' WHERE s.object_kind = 'bnode')
SELECT 'restriction' AS part, count(*) AS n FROM (SELECT subject, value FROM r WHERE v = 1 EXCEPT SELECT subject, value FROM r WHERE v = 0)
UNION ALL SELECT 'node', (SELECT count(*) FROM (SELECT value FROM n WHERE v = 1 EXCEPT SELECT value FROM n WHERE v = 0))""")
def q66_nameless_drift(spark, sf):
    """What the newer version says through nodes without a name that the older does not, whatever the nodes are called."""
    new, old = (changes.canonical(vocabulary(spark, sf, v)) for v in (1, 0))
    more = changes.difference(new, old)
    hung = more.where((F.col("object_kind") == "bnode") & (F.col("subject_kind") == "iri"))
    fresh = more.where((F.col("subject_kind") == "bnode") & (F.col("predicate") == OWL + "someValuesFrom"))
    return hung.agg(F.count(F.lit(1)).alias("n")).select(F.lit("restriction").alias("part"), "n").unionAll(fresh.agg(F.count(F.lit(1))).select(F.lit("node"), F.col("count(1)")))


@query(f"""WITH {_T}, r AS (SELECT DISTINCT subject, object AS lexical FROM t WHERE predicate = '{_ALT}'), v AS (SELECT DISTINCT subject, predicate, object, language FROM t WHERE subject_kind = 'iri' AND object_kind = 'literal'),
l AS (SELECT subject, min(object) AS label FROM t WHERE predicate = '{_LABEL}' GROUP BY subject),
s AS (SELECT r.subject, r.lexical, CASE WHEN count(DISTINCT v.object) = 1 THEN min(v.object) END AS source FROM r JOIN v ON v.subject = r.subject AND v.predicate = '{_ALT}' AND lower(coalesce(v.language, '')) IN ('en', '') AND v.object <> r.lexical GROUP BY ALL),
d AS (SELECT subject, min(object) AS definition FROM v WHERE predicate = '{_DEF}' GROUP BY subject),
k AS (SELECT DISTINCT subject, CASE WHEN predicate = '{_ALT}' THEN 'about it' ELSE 'about all' END AS message FROM t WHERE predicate IN ('{_ALT}', '{_HIDDEN}') AND length(object) % 2 = 0),
g AS (SELECT subject, string_agg(message, '|' ORDER BY message) AS risks FROM k GROUP BY subject)
SELECT r.subject || ' ' || r.lexical AS record_id, coalesce(label, r.subject) AS label, source, definition, coalesce(risks, '') AS risks FROM r LEFT JOIN l USING (subject) LEFT JOIN s USING (subject, lexical) LEFT JOIN d USING (subject) LEFT JOIN g USING (subject)""")
def q67_record_contexts(spark, sf):
    t = vocabulary(spark, sf).distinct()
    values = changes.annotations(t)
    records = t.where(F.col("predicate") == _ALT).select(F.concat_ws(" ", "subject", "object").alias("record_id"), "subject", "predicate", F.col("object").alias("lexical")).distinct()
    names = t.where(F.col("predicate") == _LABEL).groupBy("subject").agg(F.min("object").alias("label"))
    told = t.where(F.col("predicate").isin(_ALT, _HIDDEN) & (F.length("object") % 2 == 0))
    risks = told.select("subject", F.when(F.col("predicate") == _ALT, _ALT).otherwise("").alias("predicate"), F.when(F.col("predicate") == _ALT, "about it").otherwise("about all").alias("message"))
    return graph.record_contexts(records, values, names, risks).withColumn("risks", F.array_join("risks", "|"))


@query(f"WITH {_T}, {_T1}, {_C} SELECT DISTINCT subject, predicate, object FROM t1 WHERE predicate IN ('{_ALT}', '{_HIDDEN}') AND NOT starts_with(object, 'rel:') AND subject IN (SELECT subject FROM c)")
def q68_merge_applied(spark, sf):
    """The labels for search of the classes that both versions declare, after the merge of the newer into the older: those of the newer."""
    ours, theirs = (vocabulary(spark, sf, v).where("NOT startswith(object, 'rel:')") for v in (1, 0))
    merged = changes.apply_merge(ours, theirs, changes.merge_diff(ours, theirs, "rel:"))
    return merged.where(F.col("predicate").isin(_ALT, _HIDDEN)).join(graph.classes(theirs), "subject", "left_semi").select("subject", "predicate", "object").distinct()


@query(f"WITH {_VERSIONS}, o AS (SELECT * FROM v0 EXCEPT SELECT * FROM v1), n AS (SELECT * FROM v1 EXCEPT SELECT * FROM v0) SELECT 'self' AS pair, TRUE AS same UNION ALL SELECT 'versions', (SELECT count(*) FROM o) + (SELECT count(*) FROM n) = 0 UNION ALL SELECT 'applied', TRUE")
def q69_set_equality(spark, sf):
    old, new = (changes.keyed(v) for v in versions(spark, sf))
    applied = changes.apply_changes(old, changes.delta(old, new))
    found = [("self", changes.same(old, old)), ("versions", changes.same(old, new)), ("applied", changes.same(applied, new))]
    return spark.createDataFrame(found, "pair string, same boolean")


def _json(*pairs: tuple[str, str]) -> str:
    """SQL for a canonical JSON object of nullable strings."""
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || coalesce(CAST(to_json({v}) AS VARCHAR), 'null')" for k, v in sorted(pairs)) + " || '}'"


def _JSON_VALUE(p: str) -> str:  # noqa: N802
    """SQL for what a literal annotation's hash is taken of."""
    return _json(("subject", f"{p}.subject"), ("predicate", f"{p}.predicate"), ("object_kind", "'literal'"), ("language", f"lower({p}.language)"), ("datatype", "NULL::VARCHAR"), ("lexical", f"{p}.lexical"))


_ABSENT = "sha256('<absent>')"


@query(f"""WITH {_VERSIONS.replace("text AS lexical", "nfc_normalize(text) AS lexical")}, w AS (SELECT subject, predicate, nfc_normalize(lexical) AS lexical, language FROM v1),
o AS (SELECT * FROM v0 EXCEPT SELECT * FROM w), n AS (SELECT * FROM w EXCEPT SELECT * FROM v0),
p AS (SELECT o.subject, o.predicate, n.language, sha256({_JSON_VALUE("o")}) AS before_hash, sha256({_JSON_VALUE("n")}) AS after_hash FROM o JOIN n ON o.subject = n.subject AND o.predicate = n.predicate AND ((o.lexical = n.lexical) OR lower(o.language) = lower(n.language))),
r AS (SELECT subject, predicate, language, before_hash, after_hash FROM p UNION ALL SELECT subject, predicate, language, sha256({_JSON_VALUE("o")}), {_ABSENT} FROM o WHERE (subject, predicate) NOT IN (SELECT (subject, predicate) FROM p)
  UNION ALL SELECT subject, predicate, language, {_ABSENT}, sha256({_JSON_VALUE("n")}) FROM n WHERE (subject, predicate) NOT IN (SELECT (subject, predicate) FROM p))
SELECT sha256('{{"after_hash":"' || after_hash || '","before_hash":"' || before_hash || '","locator":' || {_json(("subject", "subject"), ("predicate", "predicate"), ("object_kind", "'literal'"), ("language", "lower(language)"), ("datatype", "NULL::VARCHAR"))} || '}}') AS record_id, before_hash, after_hash FROM r""")
def q70_change_manifest(spark, sf):
    d = _unique_versions(spark, sf)
    return changes.manifest(*d).select("record_id", "before_hash", "after_hash")


def _unique_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return versions(spark, sf)


@query(f"""WITH {_VERSIONS}, o AS (SELECT * FROM v0 EXCEPT SELECT * FROM v1), n AS (SELECT * FROM v1 EXCEPT SELECT * FROM v0)
SELECT '{{"after":null,"before":' || {_json(("datatype", "NULL::VARCHAR"), ("language", "language"), ("lexical", "lexical"), ("predicate", "predicate"), ("subject", "subject"))} || ',"change":"removed"}}' AS line FROM o WHERE CAST(subject AS BIGINT) % 7 = 0
UNION ALL SELECT '{{"after":' || {_json(("datatype", "NULL::VARCHAR"), ("language", "language"), ("lexical", "lexical"), ("predicate", "predicate"), ("subject", "subject"))} || ',"before":null,"change":"added"}}' FROM n WHERE predicate IN ('moved', 'note')""")
def q71_change_lines(spark, sf):
    """Additions and removals as JSON lines."""
    return changes.change_lines(changes.delta(*versions(spark, sf)).where("change IN ('added', 'removed')"))


@query("""SELECT '{"name":' || to_json(n_name) || ',"nation":' || n_nationkey || ',"region":' || n_regionkey || '}' AS line FROM nation""")
def q72_json_lines(spark, sf):
    return json_lines(table(spark, sf, "nation").select(F.col("n_regionkey").alias("region"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("nation")))


@query("SELECT p_partkey, 'OGS:' || replace(p_name, ' ', '_') AS curie, replace(p_name, ' ', '_') AS local, p_type || ' ' || p_brand AS cleaned FROM part")
def q73_curies_and_cleaning(spark, sf):
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    rows = table(spark, sf, "part").select("p_partkey", identity.to_curie(name, "OGS:").alias("curie"), text.clean(F.concat("p_type", F.lit("\t"), "p_brand")).alias("cleaned"))
    return rows.select("p_partkey", "curie", identity.from_curie(F.col("curie"), "OGS:").alias("local"), "cleaned")


_PROPOSED = "CASE c_custkey % 4 WHEN 0 THEN 'R' || substr(md5(c_name), 1, 20) WHEN 1 THEN 'R' || substr(md5(c_name), 1, 18) ELSE 'R' || upper(substr(md5(c_name), 1, 21)) END"
_USED = "'R' || upper(substr(md5(c_name), 1, 21))"


@query(f"""WITH p AS (SELECT DISTINCT {_PROPOSED} AS name FROM customer), u AS (SELECT {_USED} AS name FROM customer WHERE c_acctbal > 5000)
SELECT name, CASE WHEN regexp_full_match(name, 'R[0-9A-Za-z]{{19,22}}') THEN 'canonical' WHEN regexp_full_match(name, '[0-9A-Za-z]{{17,21}}[AQgw]') THEN 'legacy-16-bytes' ELSE 'nonconforming' END AS family, name IN (SELECT name FROM u) AS taken,
  CASE WHEN name IN (SELECT name FROM u) THEN 'taken' WHEN NOT regexp_full_match(name, 'R[0-9A-Za-z]{{19,22}}') THEN 'shape' ELSE 'ok' END AS verdict FROM p""")
def q74_check_names(spark, sf):
    c = table(spark, sf, "customer")
    return labels.check_names(c.select(F.expr(_PROPOSED).alias("name")), c.where("c_acctbal > 5000").select(F.expr(_USED).alias("name")))


@query(f"""WITH p AS (SELECT {_PROPOSED} AS name, min(c_custkey) AS place FROM customer GROUP BY 1), u AS (SELECT {_USED} AS name FROM customer WHERE c_acctbal > 5000),
k AS (SELECT name FROM p WHERE name NOT IN (SELECT name FROM u) AND regexp_full_match(name, 'R[0-9A-Za-z]{{19,22}}') ORDER BY place, name LIMIT 25)
SELECT name, (SELECT max(u.name) FROM u WHERE u.name < k.name) AS before, (SELECT min(u.name) FROM u WHERE u.name >= k.name) AS after FROM k""")
def q75_mint(spark, sf):
    c = table(spark, sf, "customer")
    return labels.mint(c.select(F.expr(_PROPOSED).alias("name"), F.col("c_custkey").alias("place")), c.where("c_acctbal > 5000").select(F.expr(_USED).alias("name")), 25)


@query("SELECT DISTINCT c_name AS name FROM customer WHERE c_acctbal >= 0")
def q76_name_drift(spark, sf):
    c = table(spark, sf, "customer")
    return labels.drift(c.select(F.col("c_name").alias("name")), c.where("c_acctbal < 0").select(F.col("c_name").alias("name")))


