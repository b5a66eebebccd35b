"""Links from concepts to word senses: normalise, join, score, rank, threshold, keep the strongest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text
from .changes import one_sided
from .tables import stored

#: Fixed values of the method.
EXACT, LEAD, OTHER_PHRASE, PHRASE_FLOOR, WORD, WORD_FACTOR, GAP_PRIOR = 0.60, 0.05, 0.55, 0.40, 0.45, 0.8, 0.7
STRENGTH = {"skos:exactMatch": 4, "skos:closeMatch": 3, "skos:broadMatch": 2, "skos:narrowMatch": 2, "skos:relatedMatch": 1}
FIELDS = ("rdfs:label", "skos:prefLabel", "skos:altLabel")
PRIORS = {
    "legal": {"law_government": 1.0, "business": 0.7, "other": 0.3},
    "place": {"law_government": 1.0, "nature": 1.0, "people_society": 1.0, "history": 0.7, "other": 0.3},
    "commerce": {"business": 1.0, "science": 0.8, "technology": 0.8, "nature": 0.8, "health": 0.8, "arts": 0.8, "everyday_life": 0.8, "sports_recreation": 0.8, "education": 0.8, "law_government": 0.7, "other": 0.3},
    "finance": {"business": 1.0, "law_government": 0.8, "mathematics": 0.7, "other": 0.3},
    "language": {"language": 1.0, "humanities": 0.8, "people_society": 0.8, "other": 0.3},
    "technical": {"technology": 1.0, "language": 0.8, "business": 0.7, "law_government": 0.7, "other": 0.3},
    "service": {"business": 1.0, "law_government": 1.0, "technology": 0.8, "health": 0.8, "other": 0.3},
}
#: Local names of the branches that have a profile of their own; others are legal.
BRANCH_PROFILES = {
    "R9aSzp9cEiBCzObnP92jYFX": "place", "R8f4qGdjxuiQary8OBpq8W9": "commerce", "R767niCLQVC5zIcO5WDQMSl": "finance", "RhBgnef56iLBXYfPqWQE41": "finance", "RCIwc6WJi6IT7xePURxsi4T": "finance",
    "RDOvAHsvY8TKJ1O1orXPM9o": "language", "R79aItNTJQwHgR002wuX3iC": "technical", "R8EoZh39tWmXCkmP2Xzjl6E": "technical", "R8qItBwG2pRMFhUq1HQEMnb": "technical", "RDK1QEdQg1T8B5HQqMK2pZN": "service",
}
DEFAULT_PROFILE = "legal"


def profiles_of(branches: Column, prefix: str = "", table: dict[str, str] = BRANCH_PROFILES) -> Column:
    """The profiles of an array of branch IRIs, sorted; the default one where there is no branch."""
    m = F.create_map(*(F.lit(x) for k, v in table.items() for x in (prefix + k, v)))
    found = F.array_sort(F.array_distinct(F.transform(branches, lambda b: F.coalesce(F.try_element_at(m, b), F.lit(DEFAULT_PROFILE)))))
    return F.when(F.size(F.coalesce(branches, F.array().cast("array<string>"))) == 0, F.array(F.lit(DEFAULT_PROFILE))).otherwise(found)


def profile_prior(profile: Column, root: Column, priors: dict[str, dict[str, float]]) -> Column:
    m = F.create_map(*(F.lit(x) for p, t in priors.items() for r, v in t.items() for x in (f"{p}\x1f{r}", float(v))))
    at = lambda r: F.try_element_at(m, F.concat(profile, F.lit("\x1f"), r))
    return F.coalesce(at(root), at(F.lit("other")))


def prior(profiles: Column, root: Column, priors: dict[str, dict[str, float]] = PRIORS) -> Column:
    """The greatest prior over a concept's profiles."""
    return F.array_max(F.transform(profiles, lambda p: profile_prior(p, root, priors)))


def best_profile(profiles: Column, root: Column, priors: dict[str, dict[str, float]] = PRIORS) -> Column:
    """The profile with the greatest prior; of equals the first by name."""
    return F.array_min(F.transform(profiles, lambda p: F.struct((-profile_prior(p, root, priors)).alias("a"), p.alias("p"))))["p"]


def surface_forms(labels: DataFrame, ascii_only: bool = False) -> DataFrame:
    """(subject, form, field), distinct, from labels (subject, text, field)."""
    parts = labels.where("text is not null").select("subject", "field", F.explode(text.label_parts(F.col("text"))).alias("part"))
    folded = F.lower("part") if ascii_only else text.fold(F.col("part"))
    rows = parts.withColumn("folded", folded)
    return rows.select("subject", text.trim_marks(text.normalize(F.col("part"), F.col("folded"))).alias("form"), "field").where("form <> ''").distinct()


def first_label(labels: DataFrame) -> DataFrame:
    """(subject, label): by the fields' order, then by text."""
    order = F.array_position(F.array(*map(F.lit, FIELDS)), F.col("field"))
    return labels.groupBy("subject").agg(F.min(F.struct(order.alias("o"), F.col("text"))).alias("m")).select("subject", F.col("m.text").alias("label"))


def lookups(forms: DataFrame) -> DataFrame:
    """A form itself, and the distinct content words of forms of two to six words: (subject, form, field, kind, lookup, is_head)."""
    # The form stands first among its words, so that forms are made once and not for each kind.
    ws = forms.withColumn("ws", text.words(F.col("form")))
    content = F.when(F.size("ws").between(2, 6), F.array_except("ws", F.array(*map(F.lit, text.STOP_WORDS)))).otherwise(F.array().cast("array<string>"))
    each = ws.select("subject", "form", "field", text.head_word(F.col("ws")).alias("head"), F.posexplode(F.concat(F.array("form"), content)).alias("_at", "lookup"))
    word = F.col("_at") > 0
    return each.select("subject", "form", "field", word.cast("int").alias("kind"), "lookup", (word & F.coalesce(F.col("lookup") == F.col("head"), F.lit(False))).alias("is_head"))


def candidate_headwords(forms: DataFrame) -> DataFrame:
    """(headword): all that a sense could be looked up by."""
    return forms.select(F.explode(F.array_union(F.array("form"), text.words(F.col("form")))).alias("headword")).distinct()


def usable_senses(senses: DataFrame, headwords: DataFrame | None = None, ascii_only: bool = False) -> DataFrame:
    """Nouns from any source but the excluded one (null counts as another), with norm_headword and stems; only those that headwords names."""
    if "pos" in senses.columns:
        senses = senses.where("pos = 'noun'")
    if "source" in senses.columns:
        senses = senses.where(~F.col("source").eqNullSafe("wordnet-3.0"))
    low = (lambda c: F.lower(c)) if ascii_only else text.fold
    out = senses.withColumn("_folded", low(F.col("headword"))).withColumn("_gloss", low(F.coalesce("gloss", F.lit(""))))
    root = F.when(F.coalesce(F.col("domain_root"), F.lit("")) != "", F.col("domain_root")).otherwise(F.element_at(F.split(F.coalesce("domain", F.lit("")), r"\."), 1))
    out = out.select("sense_id", "headword", F.coalesce("domain", F.lit("")).alias("domain"), root.alias("root"), text.normalize(F.col("headword"), F.col("_folded")).alias("norm_headword"), text.content_stems(F.col("_gloss")).alias("gloss_stems"))
    if headwords is not None:
        out = out.join(headwords.select(F.col("headword").alias("norm_headword")), "norm_headword", "left_semi")
    return out


def ranked(looked: DataFrame, concepts: DataFrame, senses: DataFrame, priors: dict = PRIORS) -> DataFrame:
    """Per (subject, lookup) the senses by score, then id: rank, runner, the score that follows, and top, the first one's."""
    # Concepts come before senses, whose rows are many for each lookup, so that pairs are made where their subject is; one shuffle by subjects serves all of it.
    # What each profile makes of a sense's root is the sense's, so that a pair only picks the greatest.
    weighed = senses.withColumns({f"_prior{i}": profile_prior(F.lit(p), F.col("root"), priors) for i, p in enumerate(priors)})
    pairs = looked.select("subject", "lookup").repartition("subject").distinct().join(concepts.select("subject", "context", "profiles").hint("merge"), "subject").join(weighed, F.col("lookup") == F.col("norm_headword"))
    best = F.greatest(F.lit(None).cast("double"), F.lit(None).cast("double"), *(F.when(F.array_contains("profiles", p), F.col(f"_prior{i}")) for i, p in enumerate(priors)))
    overlap = F.when(F.size("gloss_stems") > 0, F.size(F.array_intersect("context", "gloss_stems")) / F.size("gloss_stems")).otherwise(F.lit(0.0))
    scored = pairs.select("subject", "lookup", "sense_id", "headword", "root", "profiles", (0.5 * best + 0.5 * overlap).alias("score"))
    w = W.partitionBy("subject", "lookup").orderBy(F.desc("score"), "sense_id")
    return scored.withColumn("rank", F.row_number().over(w)).withColumn("runner", F.coalesce(F.lead("score").over(w), F.lit(0.0))).withColumn("top", F.first("score").over(w))


def emissions(looked: DataFrame, ranks: DataFrame) -> DataFrame:
    """Every link that the rules emit, before the strongest per (subject, sense) is chosen."""
    phrase, first = F.col("kind") == 0, F.col("rank") == 1
    # No rule takes the others, so they are not joined.
    rows = looked.join(ranks.where(first | (F.col("score") >= OTHER_PHRASE)), ["subject", "lookup"])
    exact = first & (F.col("field") != "skos:altLabel") & (F.col("score") >= EXACT) & (F.col("score") >= F.col("runner") + LEAD)
    keep = F.when(phrase, (F.col("top") >= PHRASE_FLOOR) & (first | (F.col("score") >= OTHER_PHRASE))).otherwise(first & (F.col("score") >= WORD))
    predicate = F.when(phrase, F.when(exact, "skos:exactMatch").otherwise("skos:closeMatch")).otherwise(F.when(F.col("is_head"), "skos:broadMatch").otherwise("skos:relatedMatch"))
    rule = F.when(phrase, F.when(F.col("field") == "skos:altLabel", "altlabel-phrase").otherwise("label-phrase")).otherwise(F.when(F.col("is_head"), "head-word").otherwise("modifier-word"))
    return rows.where(keep).select(
        "subject", "sense_id", "headword", "root", "profiles", "form", "field", "kind", "lookup", "rank", "score", predicate.alias("predicate"), rule.alias("rule"),
        text.three_decimals(F.when(phrase, F.col("score")).otherwise(WORD_FACTOR * F.col("score"))).alias("confidence"),
    )


def strongest(links: DataFrame) -> DataFrame:
    """One link per (subject, sense): the strongest predicate, then confidence, then the first emitted."""
    m = F.create_map(*(F.lit(x) for kv in STRENGTH.items() for x in kv))
    # Emitted in order of form and field; phrases by rank, then words by text.
    w = W.partitionBy("subject", "sense_id").orderBy(F.desc(m[F.col("predicate")]), F.desc(F.col("confidence").cast("double")), "form", "field", "kind", F.when(F.col("kind") == 0, F.col("rank")), "lookup")
    return links.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def gaps(labels: DataFrame, concepts: DataFrame, senses: DataFrame, links: DataFrame, priors: dict = PRIORS, ascii_only: bool = False) -> DataFrame:
    """Whole labels of concepts without any link, whose senses all have low priors: (subject, match_string, headword_senses_domains)."""
    low = F.lower("text") if ascii_only else text.fold(F.col("text"))
    whole = labels.where(F.col("field").isin("rdfs:label", "skos:prefLabel")).withColumn("_folded", low)
    whole = whole.select("subject", text.normalize(F.col("text"), F.col("_folded")).alias("match_string")).where("match_string <> ''").distinct()
    whole = whole.join(links.select("subject").distinct(), "subject", "left_anti")
    found = whole.join(senses, F.col("match_string") == F.col("norm_headword")).join(concepts.select("subject", "profiles"), "subject")
    found = found.withColumn("prior", prior(F.col("profiles"), F.col("root"), priors))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sense_id", "domain"))), lambda s: F.concat(s["sense_id"], F.lit("="), s["domain"])), "; ")
    return found.groupBy("subject", "match_string").agg(listed.alias("headword_senses_domains"), F.max("prior").alias("_p")).where(F.col("_p") < GAP_PRIOR).drop("_p")


def concepts_of(labels: DataFrame, definitions: DataFrame, parent_labels: DataFrame, branches: DataFrame | None = None, prefix: str = "", profiles: Column | None = None, ascii_only: bool = False) -> DataFrame:
    """(subject, label, context, profiles): context is the stems of the label, definitions and parents' labels.

    definitions, parent_labels: (subject, text). branches: (subject, branches array).
    """
    said = first_label(labels).select("subject", F.col("label").alias("text")).unionByName(definitions.select("subject", "text")).unionByName(parent_labels.select("subject", "text"))
    low = F.lower("text") if ascii_only else text.fold(F.col("text"))
    stems = said.where("text is not null").withColumn("_f", low).groupBy("subject").agg(F.array_distinct(F.flatten(F.collect_list(text.content_stems(F.col("_f"))))).alias("context"))
    out = first_label(labels).join(stems, "subject", "left").withColumn("context", F.coalesce("context", F.array().cast("array<string>")))
    if profiles is not None:
        return out.withColumn("profiles", profiles)
    if branches is None:
        return out.withColumn("profiles", F.array(F.lit(DEFAULT_PROFILE)))
    return out.join(branches, "subject", "left").withColumn("profiles", profiles_of(F.col("branches"), prefix)).drop("branches")


def match(labels: DataFrame, concepts: DataFrame, senses: DataFrame, priors: dict = PRIORS, ascii_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """(links, gaps). senses: as usable_senses() gives them."""
    looked = lookups(surface_forms(labels, ascii_only))
    links = emissions(looked, ranked(looked, concepts, senses, priors))
    return strongest(links), gaps(labels, concepts, senses, links, priors, ascii_only)


@dataclass
class Linked:
    """A vocabulary's links with what they came from: labels, concepts, senses as match() takes them, and the lookups()."""

    labels: DataFrame
    concepts: DataFrame
    senses: DataFrame
    looked: DataFrame
    links: DataFrame


def linked(labels: DataFrame, concepts: DataFrame, senses: DataFrame, priors: dict = PRIORS, ascii_only: bool = False) -> Linked:
    """All links from scratch, stored as refresh() needs them."""
    labels, concepts, senses = stored(labels, "labels"), stored(concepts, "concepts"), stored(senses, "senses")
    looked = stored(lookups(surface_forms(labels, ascii_only)), "looked")
    return Linked(labels, concepts, senses, looked, stored(strongest(emissions(looked, ranked(looked, concepts, senses, priors))), "links"))


def refresh(held: Linked, labels: DataFrame, concepts: DataFrame, senses: DataFrame, priors: dict = PRIORS, ascii_only: bool = False) -> tuple[Linked, DataFrame]:
    """The links after a change of inputs, and the (subject) that were looked at anew.

    A concept's links depend on its own labels and context, and on the senses that its forms look up. So only concepts
    with changed labels or contexts, and those that look up the head of a changed sense, lose their links and are ranked
    again, against the senses that they look up; all other links stay as they are.
    """
    labels, concepts, senses = stored(labels, "labels"), stored(concepts, "concepts"), stored(senses, "senses")
    moved = _moved(held.labels, labels).select("subject").union(_moved(held.concepts, concepts).select("subject")).distinct()
    moved = stored(moved, "moved")
    fresh = lookups(surface_forms(_of(labels, moved), ascii_only))
    looked = stored(_of(held.looked, moved, "left_anti").unionByName(fresh), "looked")
    heads = _moved(held.senses, senses).select(F.col("norm_headword").alias("lookup")).distinct()
    touched = stored(moved.union(looked.join(heads, "lookup", "left_semi").select("subject")).distinct(), "touched")
    mine = stored(_of(looked, touched), "looked-again")
    wanted = mine.select(F.col("lookup").alias("norm_headword")).distinct()
    ranks = ranked(mine, _of(concepts, touched), senses.join(wanted, "norm_headword", "left_semi"), priors)
    links = _of(held.links, touched, "left_anti").unionByName(strongest(emissions(mine, ranks)))
    return Linked(labels, concepts, senses, looked, stored(links, "links")), touched


def _of(rows: DataFrame, subjects: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of some subjects, which may be most: they are met by a shuffle, whatever their files' size says, as a broadcast holds them all in each executor."""
    return rows.join(subjects.hint("merge"), "subject", how)


def _moved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that one of two tables has and the other has not, with arrays in any order; each table is read once, and neither is held whole by a task."""
    flat = lambda df: df.select(*(F.sort_array(F.col(f"`{n}`")).alias(n) if t.startswith("array") else F.col(f"`{n}`") for n, t in old.dtypes))
    return one_sided(flat(old), flat(new)).drop("side")


def mapping_rows(links: DataFrame, concepts: DataFrame, subject_prefix: str = "", subject_curie: str = "", object_curie: str = "OGS:", priors: dict = PRIORS) -> DataFrame:
    """The eleven string columns of a mapping set."""
    subject = F.when(F.lit(bool(subject_prefix)) & F.startswith("subject", F.lit(subject_prefix)), F.concat(F.lit(subject_curie), F.substring("subject", len(subject_prefix) + 1, 1 << 30))).otherwise(F.col("subject"))
    rows = links.join(concepts.select("subject", "label"), "subject")
    comment = F.concat("rule", F.lit("; score="), text.three_decimals(F.col("score")), F.lit("; profile="), best_profile(F.col("profiles"), F.col("root"), priors))
    return rows.select(
        subject.alias("subject_id"), F.col("label").alias("subject_label"), F.col("predicate").alias("predicate_id"), F.concat(F.lit(object_curie), "sense_id").alias("object_id"), F.col("headword").alias("object_label"),
        F.lit("semapv:LexicalMatching").alias("mapping_justification"), "confidence", F.col("field").alias("subject_match_field"), F.lit("rdfs:label").alias("object_match_field"), F.when(F.col("kind") == 0, F.col("form")).otherwise(F.col("lookup")).alias("match_string"), comment.alias("comment"),
    )
