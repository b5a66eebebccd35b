"""Review of annotations: census findings, stratified samples, bounds, reconciliation, evaluation by slice, debt."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import identity, stats
from .tables import LABELS, RDF, RDFS, SKOS, null_safe, stored

TARGETS = (RDFS + "label", SKOS + "prefLabel", SKOS + "altLabel", SKOS + "hiddenLabel", SKOS + "definition", SKOS + "example", SKOS + "note")
SENTINELS = ("null", "none", "n/a")
#: The script that a base language is written in.
SCRIPTS = {"ar": "Arabic", "el": "Greek", "he": "Hebrew", "ru": "Cyrillic", "uk": "Cyrillic", "zh": "Han"}
LANGUAGE_TAG = r"^(?:[A-Za-z]{2,8}(?:-[A-Za-z]{4})?(?:-(?:[A-Za-z]{2}|[0-9]{3}))?(?:-(?:[A-Za-z0-9]{5,8}|[0-9][A-Za-z0-9]{3}))*(?:-[A-WYZa-wyz0-9](?:-[A-Za-z0-9]{2,8})+)*(?:-[Xx](?:-[A-Za-z0-9]{1,8})+)?|[Xx](?:-[A-Za-z0-9]{1,8})+)$"


@F.pandas_udf(T.BooleanType())
def _container(s: pd.Series) -> pd.Series:
    import ast

    def one(x: str | None) -> bool:
        if x is None or not (x[:1] in "[{(" and x[-1:] in "]})"):
            return False
        try:
            return isinstance(ast.literal_eval(x), (list, tuple, set, dict))
        except (SyntaxError, ValueError, MemoryError, RecursionError):
            return False

    return s.map(one)


def serialized_container(c: Column) -> Column:
    """Whether a text is a written-out list, tuple, set or dict; Python looks only at bracketed texts."""
    t = F.trim(c)
    return t.rlike(r"(?s)^[\[{(].*[\]})]$") & _container(F.when(t.rlike(r"(?s)^[\[{(].*[\]})]$"), t))


def script_risk(c: Column, language: Column) -> Column:
    """Letters, but none of the script that the language is written in."""
    base = F.lower(F.split_part(language, F.lit("-"), F.lit(1)))
    out = F.lit(False)
    for lang, script in SCRIPTS.items():
        out = F.when(base == lang, c.rlike(r"\p{L}") & ~c.rlike(rf"\p{{Is{script}}}")).otherwise(out)
    return F.coalesce(out, F.lit(False))


#: What findings say, as the key of a regression holds it. A brace stands for a value.
MESSAGES = {
    "missing_subject_iri": "Annotation subject must be an IRI.",
    "unsupported_object_kind": "Annotation value must be a literal.",
    "empty_annotation": "Annotation is empty or whitespace-only.",
    "sentinel_annotation": "Annotation contains a configured sentinel value.",
    "serialized_container": "Annotation contains a serialized container.",
    "invalid_language_tag": "Invalid BCP 47 language tag: {}",
    "language_datatype_conflict": "Language-tagged literal has an incompatible datatype.",
    "script_mismatch": "Text script is unusual for language {}.",
    "unusual_language_tag": "Regional language tag {} requires semantic review.",
    "duplicate_logical_identity": "Duplicate logical annotation identity.",
    "base_label_duplicate": "Alternate label duplicates a base label: {}",
    "cardinality_violation": "Cardinality {} exceeds maximum {}.",
    "shacl_violation": "A value of {} must be a literal with a character at least.",
}
RISKS = ("script_mismatch", "unusual_language_tag", "base_label_duplicate")


def _finding(code: str, *values: Column) -> Column:
    parts = MESSAGES[code].split("{}")
    said = F.concat(*(x for i, p in enumerate(parts) for x in ([F.lit(p)] + ([values[i].cast("string")] if i < len(values) else []))))
    return F.struct(F.lit(code).alias("code"), F.lit("review" if code in RISKS else "error").alias("severity"), said.alias("message"))


def census(values: DataFrame, supported: tuple[str, ...] = (), sentinels: tuple[str, ...] = SENTINELS, resources: tuple[str, ...] = ()) -> DataFrame:
    """(code, severity, subject, predicate, message) of annotations (subject, predicate, lexical, language, datatype, object_kind[, subject_kind]).

    resources: predicates whose values may be nodes. An empty language is none.
    """
    v, lang = F.col("lexical"), F.nullif(F.lower("language"), F.lit(""))
    literal = F.col("object_kind") == "literal"
    blank = F.trim(F.regexp_replace(v, r"(?U)\s", " ")) == ""
    sentinel = F.lower(F.trim(v)).isin(*sentinels)
    tagged = literal & lang.isNotNull()
    named = F.col("subject_kind") == "iri" if "subject_kind" in values.columns else F.lit(True)
    checks = (
        ("missing_subject_iri", ~named, ()),
        ("unsupported_object_kind", ~literal & ~F.col("predicate").isin(*resources), ()),
        ("empty_annotation", literal & blank, ()),
        ("sentinel_annotation", literal & ~blank & sentinel, ()),
        ("serialized_container", literal & ~blank & ~sentinel & serialized_container(v), ()),
        ("invalid_language_tag", tagged & ~lang.rlike(LANGUAGE_TAG), (lang,)),
        ("language_datatype_conflict", tagged & (F.col("datatype") != RDF + "langString"), ()),
        ("script_mismatch", tagged & script_risk(v, lang), (lang,)),
        ("unusual_language_tag", tagged & ~lang.isin(*supported) if supported else F.lit(False), (lang,)),
    )
    found = F.array_compact(F.array(*(F.when(bad, _finding(code, *told)) for code, bad, told in checks)))
    return values.select("subject", "predicate", F.explode(found).alias("f")).select("f.code", "f.severity", "subject", "predicate", "f.message")


def census_run(triples: DataFrame, supported: tuple[str, ...] = (), sentinels: tuple[str, ...] = SENTINELS, resources: tuple[str, ...] = (), bounds: dict[str, int] | None = None, shaped: tuple[str, ...] = (SKOS + "definition", SKOS + "example", SKOS + "prefLabel"), targets: tuple[str, ...] = TARGETS) -> DataFrame:
    """All findings of one run over a graph's annotations: census(), repeated identities, too many values, repeated base labels and shapes.

    Triples may hold repeats, as raw rows do. One scan of the annotations is stored for the five.
    """
    values = triples.where(F.col("predicate").isin(*targets)).select("subject", "subject_kind", "predicate", F.col("object").alias("lexical"), "language", "datatype", "object_kind")
    values = stored(values, "annotations")
    row = lambda f: ["f.code", "f.severity", "subject", "predicate", "f.message"]
    literal = values.where("object_kind = 'literal'")
    lower = literal.withColumn("language", F.nullif(F.lower("language"), F.lit("")))
    out = census(values, supported, sentinels, resources).unionByName(duplicate_identities(lower))
    if bounds:
        m = F.create_map(*(F.lit(x) for kv in bounds.items() for x in kv))
        many = cardinality(values, bounds).withColumn("f", _finding("cardinality_violation", F.col("n"), m[F.col("predicate")]))
        out = out.unionByName(many.select(*row("f")))
    named = {v: k for k, v in LABELS.items()}
    field = F.create_map(*(F.lit(x) for kv in named.items() for x in kv))
    labels = lower.where(F.col("predicate").isin(*named)).select("subject", F.col("lexical").alias("text"), field[F.col("predicate")].alias("field"), "language")
    twice = base_label_duplicates(labels).withColumn("predicate", F.lit(SKOS + "altLabel")).withColumn("f", _finding("base_label_duplicate", F.col("text")))
    shape = shapes(values, shaped).withColumn("f", _finding("shacl_violation", F.col("predicate")))
    return out.unionByName(twice.select(*row("f"))).unionByName(shape.select(*row("f")))


def census_status(findings: DataFrame) -> DataFrame:
    """One row: failed or complete, with the numbers of failures and of risks."""
    bad = F.count_if(F.col("severity") == "error")
    return findings.agg(F.when(bad > 0, "failed").otherwise("complete").alias("status"), bad.alias("failures"), F.count_if(F.col("severity") == "review").alias("risks"))


def duplicate_identities(values: DataFrame) -> DataFrame:
    keys = ["subject", "predicate", "language", "datatype", "lexical"]
    n = values.groupBy(*keys).count().where("count > 1").withColumn("f", _finding("duplicate_logical_identity"))
    return n.select("f.code", "f.severity", "subject", "predicate", "f.message")


def cardinality(values: DataFrame, bounds: dict[str, int]) -> DataFrame:
    """(subject, predicate, n) where a subject has more values of a predicate than its bound."""
    m = F.create_map(*(F.lit(x) for kv in bounds.items() for x in kv))
    n = values.where(F.col("predicate").isin(*bounds)).groupBy("subject", "predicate").agg(F.count(F.lit(1)).alias("n"))
    return n.where(F.col("n") > m[F.col("predicate")])


def base_label_duplicates(labels: DataFrame) -> DataFrame:
    """(subject, language, text): alternative labels that repeat a name, by folded text and base language. labels: (subject, text, field, language)."""
    base = F.lower(F.split_part(F.col("language"), F.lit("-"), F.lit(1)))
    rows = labels.where("language is not null").select("subject", base.alias("language"), F.lower("text").alias("text"), "field")
    n = rows.groupBy("subject", "language", "text").agg(F.max(F.col("field").isin("rdfs:label", "skos:prefLabel")).alias("name"), F.max(F.col("field") == "skos:altLabel").alias("alt"))
    return n.where("name AND alt").select("subject", "language", "text")


def shapes(values: DataFrame, predicates: tuple[str, ...]) -> DataFrame:
    """Values of the predicates that are no literals, or empty."""
    return values.where(F.col("predicate").isin(*predicates) & ((F.col("object_kind") != "literal") | (F.length("lexical") < 1)))


def stratum(*fields: str) -> Column:
    return F.concat_ws("|", *(F.coalesce(F.nullif(F.col(f), F.lit("")), F.lit("unknown")) for f in fields))


def stratum_counts(records: DataFrame, by: list[str]) -> DataFrame:
    return records.groupBy(*by).agg(F.count(F.lit(1)).alias("population"))


def hash_sample(records: DataFrame, id_col: str, seed: str, confidence: float, margin: float, census_at: int, strata: int, stratum_col: str = "stratum") -> DataFrame:
    """records with whether the sample of their stratum takes them, and their place in the hash order (null well beyond the sample).

    The order is by sha-256 of seed and id. Counts per leading digits of the hash tell how far a stratum's sample reaches
    at most; only rows up to there are sorted, so that no task sorts a whole stratum.
    """
    key = F.sha2(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")), 256)
    rows = records.withColumn("_key", key).withColumn("_digits", F.substring("_key", 1, 3))
    counts = rows.groupBy(stratum_col, "_digits").agg(F.count(F.lit(1)).alias("_n"))
    want = F.when(F.col("population") <= census_at, F.col("population")).otherwise(stats.sample_size(F.col("population"), stats.simultaneous(confidence, strata), margin))
    # At most 4096 rows per stratum here, and one below; the join takes whichever form its size allows. Null is a stratum.
    whole = counts.withColumn("population", F.sum("_n").over(W.partitionBy(stratum_col)))
    run = whole.withColumn("sample", want.cast("long")).withColumn("_to", F.sum("_n").over(W.partitionBy(stratum_col).orderBy("_digits")))
    reach = run.where("_to >= sample").groupBy(F.col(stratum_col).alias("_stratum")).agg(F.min("_digits").alias("_reach"), F.first("population").alias("population"), F.first("sample").alias("sample"))
    placed = rows.join(reach, F.col(stratum_col).eqNullSafe(F.col("_stratum"))).drop("_stratum")
    near = placed.where("_digits <= _reach").withColumn("place", F.row_number().over(W.partitionBy(stratum_col).orderBy("_key", id_col)).cast("long"))
    near = near.withColumn("selected", F.col("place") <= F.col("sample"))
    far = placed.where("_digits > _reach").withColumn("place", F.lit(None).cast("long")).withColumn("selected", F.lit(False))
    return near.unionByName(far).drop("_key", "_digits", "_reach")


def population_hash(records: DataFrame, id_col: str, by: list[str]) -> DataFrame:
    """(by, population_hash): of the set of ids of each group, whatever their order.

    A tree of two levels: ids are dealt by the leading digits of their hash, each deal is hashed in order, and the group's
    hash is that of the deals' hashes in order; so no row ever holds a large group's ids.
    """
    ids = records.select(*by, F.sha2(F.col(id_col).cast("string"), 256).alias("_h")).distinct()
    deals = ids.groupBy(*by, F.substring("_h", 1, 4).alias("_d")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("_h")), ","), 256).alias("_s"))
    whole = deals.groupBy(*by).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "_d", "_s"))), ","), 256).alias("population_hash"))
    return whole


def legacy_population(triples: DataFrame, changed: DataFrame | None = None) -> DataFrame:
    """(record_id, family, locale, subject, predicate, lexical, language, datatype): standing annotations that surveillance draws from.

    Definitions, examples, and labels in other languages than English; without those whose record_id is in changed.
    """
    rows = triples.where((F.col("subject_kind") == "iri") & (F.col("object_kind") == "literal")).select("subject", "predicate", F.col("object").alias("lexical"), "language", "datatype")
    locale = F.lower(F.coalesce(F.nullif("language", F.lit("")), F.lit("en")))
    family = F.when(F.col("predicate") == SKOS + "definition", "definition").when(F.col("predicate") == SKOS + "example", "example")
    family = F.when(F.col("predicate").isin(*LABELS.values()) & (locale != "en"), "translation").otherwise(family)
    rows = rows.withColumns({"family": family, "locale": locale}).where("family IS NOT NULL")
    rows = rows.withColumn("record_id", identity.surveillance_id(*(F.col(c) for c in ("subject", "predicate", "lexical", "language"))))
    if changed is not None:
        rows = rows.join(changed.select("record_id"), "record_id", "left_anti")
    return rows.select("record_id", "family", "locale", "subject", "predicate", "lexical", "language", "datatype")


def to_review(*ids: DataFrame) -> DataFrame:
    """(record_id): all that is selected or pending anywhere, once."""
    out = ids[0].select("record_id")
    for more in ids[1:]:
        out = out.unionByName(more.select("record_id"))
    return out.distinct()


def evaluate_sample(selected: DataFrame, results: DataFrame, confidence: float, strata: int, most: float) -> DataFrame:
    """Per stratum of the selected records (record_id, stratum): defects, severe ones, missing results, the Wilson bound, and whether a census is due.

    results: (record_id, verdict, severe). Missing results are no defects, yet they block.
    """
    j = selected.join(results, "record_id", "left")
    defect = F.coalesce(F.col("verdict") == "defect", F.lit(False))
    by = j.groupBy("stratum").agg(F.count(F.lit(1)).alias("sample"), F.count_if(defect).alias("defects"), F.count_if(defect & F.coalesce("severe", F.lit(False))).alias("severe"), F.count_if(F.col("verdict").isNull()).alias("missing"))
    upper = stats.wilson_upper(F.col("defects"), F.col("sample"), stats.simultaneous(confidence, strata))
    return by.withColumn("upper_bound", upper).withColumn("requires_census", (F.col("severe") > 0) | (F.col("upper_bound") > most))


def reconcile(left: DataFrame, right: DataFrame, minimum: float) -> DataFrame:
    """(record_id, state) of two reviewers' (record_id, verdict, confidence); state is incomplete where one of them is missing."""
    a = left.select("record_id", F.col("verdict").alias("va"), F.col("confidence").alias("ca"))
    b = right.select("record_id", F.col("verdict").alias("vb"), F.col("confidence").alias("cb"))
    both = lambda v: (F.col("va") == v) & (F.col("vb") == v)
    state = F.when(F.col("va").isNull() | F.col("vb").isNull(), "incomplete").when(both("pass") & (F.least("ca", "cb") >= minimum), "accepted").when(both("defect"), "defect_confirmed").otherwise("quarantined")
    return a.join(b, "record_id", "full_outer").select("record_id", state.alias("state"))


def reconciliation_status(states: DataFrame) -> DataFrame:
    bad = F.count_if(F.col("state") == "incomplete")
    odd = F.count_if(F.col("state") == "quarantined")
    return states.agg(F.when(bad > 0, "incomplete").when(odd > 0, "quarantined").otherwise("complete").alias("status"))


def slice_metrics(cases: DataFrame, predictions: DataFrame, minimum: int) -> DataFrame:
    """Per (family, locale) of cases (case_id, family, locale, expected): counts, accuracy, defect recall, false accepts, and whether there are enough."""
    j = cases.join(predictions.select("case_id", "predicted"), "case_id", "left")
    defect = F.col("expected") == "defect"
    n = j.groupBy("family", "locale").agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(F.col("predicted").isNull()).alias("n_missing"), F.count_if(F.coalesce(F.col("predicted") == F.col("expected"), F.lit(False))).alias("n_correct"),
        F.count_if(defect).alias("n_defects"), F.count_if(defect & F.coalesce(F.col("predicted") == "pass", F.lit(False))).alias("n_false_accepts"),
    )
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    d, f = F.col("n_defects"), F.col("n_false_accepts")
    return n.select("family", "locale", "n_scored", "n_missing", share(F.col("n_correct"), F.col("n_scored")).alias("accuracy"), share(d - f, d).alias("defect_recall"), share(f, d).alias("false_accept_rate"), (F.col("n_scored") >= minimum).alias("supported"))


#: Tiers of authority whose cases count.
SCORED = ("deterministic-gold", "source-grounded-silver")


def case_findings(cases: DataFrame) -> DataFrame:
    """(case_id, code) of evaluation cases that may not be used: repeated or missing ids, unknown tiers, verdicts of models, missing sources, scored challenges.

    cases: (case_id, authority, source_kind, source_ref, adjudication_hash, expected), strings.
    """
    given = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    tier = F.coalesce("authority", F.lit(""))
    checks = {
        "missing-id": ~given("case_id"),
        "authority": ~tier.isin(*SCORED, "unscored-challenge"),
        "model-consensus": F.coalesce("source_kind", F.lit("")) == "model-consensus",
        "provenance": (tier == SCORED[1]) & ~(given("source_ref") & given("adjudication_hash")),
        "scored-challenge": (tier == "unscored-challenge") & F.col("expected").isNotNull(),
    }
    found = cases.select("case_id", F.explode(F.array_compact(F.array(*(F.when(bad, F.lit(code)) for code, bad in checks.items())))).alias("code"))
    twice = cases.where(given("case_id")).groupBy("case_id").count().where("count > 1").select("case_id", F.lit("repeated-id").alias("code"))
    return found.unionByName(twice)


def evaluation(cases: DataFrame, predictions: DataFrame, minimum: int, required: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(overall, unsupported) of cases (case_id, family, locale, authority, expected): only scored tiers count.

    overall, one row: scored, challenges, missing, accuracy, defect_recall, false_accept_rate. unsupported: required
    slices (family, locale; those of the scored cases if not given) with fewer than `minimum` scored cases, and how many.
    """
    scored = F.col("authority").isin(*SCORED)
    j = cases.join(predictions.select("case_id", "predicted"), "case_id", "left")
    defect = scored & (F.col("expected") == "defect")
    right = scored & F.coalesce(F.col("predicted") == F.col("expected"), F.lit(False))
    n = j.agg(
        F.count_if(scored).alias("scored"), F.count_if(~scored).alias("challenges"), F.count_if(scored & F.col("predicted").isNull()).alias("missing"), F.count_if(right).alias("_right"),
        F.count_if(defect).alias("_defects"), F.count_if(defect & F.coalesce(F.col("predicted") == "pass", F.lit(False))).alias("_accepted"),
    )
    share = lambda a, b: F.when(F.col(b) > 0, a / F.col(b)).otherwise(0.0)
    overall = n.select(
        "scored", "challenges", "missing", share(F.col("_right"), "scored").alias("accuracy"), share(F.col("_defects") - F.col("_accepted"), "_defects").alias("defect_recall"), share(F.col("_accepted"), "_defects").alias("false_accept_rate")
    )
    sizes = cases.where(scored).groupBy("family", "locale").agg(F.count(F.lit(1)).alias("n"))
    want = (sizes if required is None else required).select("family", "locale").distinct()
    have = want.join(sizes, ["family", "locale"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return overall, have.where(F.col("n") < minimum)


#: The defects that an answer may name.
DEFECTS = ("negation", "modality", "party", "number", "jurisdiction", "concept_substitution", "untranslated", "register", "unsupported_claim", "circular", "prompt_injection", "other")


def response_findings(responses: DataFrame) -> DataFrame:
    """(record_id, code) of reviewers' answers that break the schema of an answer.

    responses: record_id, verdict, confidence, defect_types, evidence_spans (array of source, quote), preserved_propositions,
    rationale, proposed_replacement. A defect names its type and its evidence; a pass has evidence and what it preserves,
    and proposes nothing. Nulls break the rule of their column.
    """
    no = lambda bad: F.coalesce(bad, F.lit(True))
    few = lambda c: F.coalesce(F.size(c), F.lit(0)) < 1
    checks = {
        "record_id": no(~F.col("record_id").rlike("^[0-9a-f]{64}$")),
        "verdict": no(~F.col("verdict").isin("pass", "defect", "abstain")),
        "confidence": no(~F.col("confidence").between(0.0, 1.0)),
        "defect_types": no((F.size("defect_types") != F.size(F.array_distinct("defect_types"))) | F.exists("defect_types", lambda d: F.coalesce(~d.isin(*DEFECTS), F.lit(True)))),
        "evidence_spans": no(F.exists("evidence_spans", lambda e: F.coalesce(~e["source"].isin("annotation", "source", "context") | (F.length(e["quote"]) < 1), F.lit(True)))),
        "preserved_propositions": no(F.exists("preserved_propositions", lambda p: F.coalesce(F.length(p) < 1, F.lit(True)))),
        "rationale": no(F.length("rationale") < 1),
        "defect-needs": (F.col("verdict") == "defect") & (few("defect_types") | few("evidence_spans")),
        "pass-needs": (F.col("verdict") == "pass") & (few("evidence_spans") | few("preserved_propositions") | F.col("proposed_replacement").isNotNull()),
    }
    return responses.select("record_id", F.explode(F.array_compact(F.array(*(F.when(bad, F.lit(code)) for code, bad in checks.items())))).alias("code"))


def expand_controls(slices: DataFrame, controls: DataFrame) -> DataFrame:
    """A case per slice (family, locale) and control (id, expected). Controls are a handful of configured rows, which bounds the product."""
    n = controls.limit(1001).count()
    if n > 1000:
        raise ValueError("controls are configuration: at most 1000 rows")
    pairs = slices.select("family", "locale").distinct().join(F.broadcast(controls), F.lit(True))
    return pairs.select(F.concat_ws("-", F.lit("gold-slice"), "family", "locale", "id").alias("case_id"), "family", "locale", "expected")


def debt_matches(debt: DataFrame, values: DataFrame) -> DataFrame:
    """(debt_id, n): how many present values an entry's locator and hash match; one is right."""
    hashed = values.select("subject", "predicate", F.lower("language").alias("language"), "datatype", identity.value_hash(*(F.col(c) for c in ("subject", "predicate", "lexical", "language", "datatype"))).alias("current_hash"))
    keys = ["subject", "predicate", "language", "datatype", "current_hash"]
    r = hashed.select(*(F.col(k).alias(f"_{k}") for k in keys), F.lit(1).alias("_hit"))
    j = debt.join(r, [debt[k].eqNullSafe(r[f"_{k}"]) for k in keys], "left")
    return j.groupBy("debt_id").agg(F.count("_hit").alias("n"))


def debt_findings(debt: DataFrame) -> DataFrame:
    """(debt_id, code) of a ledger of confirmed debt: ids and locators are unique, entries are open and propose nothing."""
    locator = ["subject", "predicate", "language", "datatype", "current_hash"]
    twice = lambda keys: debt.groupBy(*keys).count().where("count > 1").select(*keys)
    out = twice(["debt_id"]).select("debt_id", F.lit("repeated-id").alias("code"))
    out = out.unionByName(null_safe(debt, twice(locator), locator, "left_semi").select("debt_id", F.lit("repeated-locator").alias("code")))
    if "replacement" in debt.columns:
        out = out.unionByName(debt.where("replacement IS NOT NULL").select("debt_id", F.lit("replacement").alias("code")))
    return out.unionByName(debt.where("state IS NULL OR state <> 'open'").select("debt_id", F.lit("not-open").alias("code")))


def debt_lineage(debt: DataFrame, ledger: DataFrame) -> DataFrame:
    """(debt_id, root_record_id, revisions): each entry's root, and how many corrections of the ledger (root_record_id, revision_id) stem from it."""
    root = identity.debt_root(*(F.col(c) for c in ("debt_id", "subject", "predicate", "language", "datatype", "current_hash")))
    rows = debt.select("debt_id", root.alias("root_record_id"))
    return rows.join(ledger.select("root_record_id", "revision_id").distinct(), "root_record_id", "left").groupBy("debt_id", "root_record_id").agg(F.count("revision_id").alias("revisions"))


def unresolved_debt(debt: DataFrame, values: DataFrame) -> DataFrame:
    return debt_matches(debt.where("state = 'open'"), values).where("n > 0").select("debt_id")


def closed_debt(debt: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    return unresolved_debt(debt, before).join(unresolved_debt(debt, after), "debt_id", "left_anti")


def unseen_requests(requests: DataFrame, receipts: DataFrame, key: str) -> DataFrame:
    """Requests without a receipt under their key."""
    return null_safe(requests, receipts, [key], "left_anti")


def receipts_to_add(held: DataFrame, new: DataFrame) -> DataFrame:
    """Receipts (request_id, body) that are not held yet, once each; another body under a request's id is an error."""
    rows = new.select("request_id", "body").distinct()
    clash = rows.groupBy("request_id").count().where("count > 1").select("request_id").unionByName(rows.join(held.select("request_id", F.col("body").alias("_held")), "request_id").where("body <> _held").select("request_id"))
    first = clash.first()
    if first is not None:
        raise ValueError(f"another receipt is held for {first['request_id']}")
    return rows.join(held.select("request_id"), "request_id", "left_anti")


def dispatch(requests: DataFrame, receipts: DataFrame, prices: dict[str, tuple[float, float]], most_output: int, ceilings: dict[str, float]) -> DataFrame:
    """(request_id, status, tokens, cost): which requests are answered by a receipt, which may be made, and which no ceiling leaves room for.

    requests: (request_id, place, route, size), size in bytes; receipts: (request_id, route). A receipt of another route
    is refused as such. Misses are admitted in order of place while the running sums of requests, tokens, tokens of
    answers (most_output each) and cost stay within the ceilings (requests, tokens, output_tokens, cost; one that is not
    given is none); from the first that does not, all are refused.
    """
    rows = priced(requests.join(receipts.select("request_id", F.col("route").alias("_served")), "request_id", "left"), prices, most_output)
    held = rows.where("_served IS NOT NULL").select("request_id", F.when(F.col("_served") == F.col("route"), "receipt").otherwise("route-mismatch").alias("status"), "tokens", "cost")
    misses = admitted(rows.where("_served IS NULL"), most_output, ceilings)
    return held.unionByName(misses.select("request_id", "status", "tokens", "cost"))


def priced(requests: DataFrame, prices: dict[str, tuple[float, float]], most_output: int) -> DataFrame:
    """requests (route, size) with tokens and cost: prices per million tokens in and out, answers at their longest."""
    per = F.create_map(*(F.lit(x) for k, (a, b) in prices.items() for x in (k, F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")))))
    rows = requests.withColumn("tokens", F.greatest(F.lit(1), F.ceil(F.col("size") / 4)).cast("long"))
    return rows.withColumn("cost", (F.col("tokens") * per[F.col("route")]["a"] + F.lit(most_output) * per[F.col("route")]["b"]) / 1e6)


def admitted(misses: DataFrame, most_output: int, ceilings: dict[str, float], before: dict[str, float] | None = None) -> DataFrame:
    """Priced misses with status, admitted or refused in order of place; before: the sums (requests, tokens, cost) of misses that came earlier."""
    before = before or {}
    summed = running_sums(misses.withColumn("_one", F.lit(1)), "place", {"_requests": "_one", "_tokens": "tokens", "_cost": "cost"})
    requests, tokens, cost = (F.col(f"_{k}") + F.lit(before.get(k, 0)) for k in ("requests", "tokens", "cost"))
    used = {"requests": requests, "tokens": tokens, "output_tokens": requests * most_output, "cost": cost - 1e-12}
    fits = F.lit(True)
    for name, most in ceilings.items():
        fits = fits & (used[name] <= most)
    return summed.withColumn("status", F.when(fits, "admitted").otherwise("refused")).select(*misses.columns, "status")


def running_sums(records: DataFrame, order: str, sums: dict[str, str]) -> DataFrame:
    """records with running sums (new name to column) in order, by ranges: a range starts from the sums of those before it."""
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(records.repartitionByRange(n, order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    whole = dealt.groupBy("_part").agg(*(F.sum(c).alias(f"_s_{k}") for k, c in sums.items()))
    offsets = whole.select(F.col("_part").alias("_p"), *(F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums))
    w = W.partitionBy("_part").orderBy(order)
    out = dealt.join(F.broadcast(offsets), F.col("_part") == F.col("_p"))
    return out.select(*records.columns, *((F.sum(c).over(w) + F.col(f"_o_{k}")).alias(k) for k, c in sums.items()))


def batches(records: DataFrame, order: str, size: int = 25, group: list[str] | None = None) -> DataFrame:
    """records with the number of their batch of `size`, in order, within each group.

    Rows are dealt by ranges of group and order; a range's offset is the sum of the ranges before it, so that a common
    group is numbered by many tasks.
    """
    group = group or []
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(records.repartitionByRange(n, *group, order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*(group or [F.lit(0)])).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    cond = [F.col("_part") == F.col("_p"), *(F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group))]
    place = F.row_number().over(W.partitionBy(*group, "_part").orderBy(order)) - 1 + F.col("_offset")
    return dealt.join(offsets, cond).withColumn("batch", F.floor(place / size).cast("long")).select(*records.columns, "batch")


def release_decision(gates: dict[str, bool]) -> tuple[str, list[str]]:
    """The decision, and the gates that hold it up."""
    held = sorted(k for k, ok in gates.items() if not ok)
    return ("blocked" if held else "approved"), held
