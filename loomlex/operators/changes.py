"""Differences between two versions of a table of annotations or triples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import identity, text
from . import nameless
from .tables import OWL, RDFS, SKOS, XSD, dealt, json_lines, null_safe, stored

VALUE = ["subject", "predicate", "lexical", "language", "datatype"]
LOCATOR = ["subject", "predicate", "language", "datatype"]


def annotations(triples: DataFrame) -> DataFrame:
    """Literal values of named subjects, as VALUE columns."""
    rows = triples.where((F.col("subject_kind") == "iri") & (F.col("object_kind") == "literal"))
    return rows.select("subject", "predicate", F.col("object").alias("lexical"), "language", "datatype").distinct()


def difference(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct rows of left that right lacks; nulls are equal."""
    return null_safe(left.distinct(), right, keys or left.columns, "left_anti")


def both_ways(left: DataFrame, right: DataFrame) -> DataFrame:
    return difference(left, right).withColumn("side", F.lit("removed")).unionByName(difference(right, left).withColumn("side", F.lit("added")))


def one_sided(left: DataFrame, right: DataFrame) -> DataFrame:
    """both_ways() by one shuffle: each table is read once, whole rows are the keys."""
    seen = left.withColumn("_side", F.lit(0)).unionByName(right.withColumn("_side", F.lit(1))).groupBy(*(F.col(f"`{c}`") for c in left.columns))
    side = F.when(F.col("_a") == 0, "removed").otherwise("added")
    return seen.agg(F.min("_side").alias("_a"), F.max("_side").alias("_b")).where("_a = _b").withColumn("side", side).drop("_a", "_b")


def keyed(values: DataFrame) -> DataFrame:
    """values (VALUE) with the digest of each text for it, stored: enough wherever texts are only compared, and no text is shuffled."""
    return stored(values.select(*(F.sha2(c, 256).alias(c) if c == "lexical" else F.col(c) for c in VALUE)).distinct(), "keyed")


def same(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables have the same rows of strings, nulls equal; rows are compared by digests, and each table is read once."""
    cell = lambda c: F.when(F.col(f"`{c}`").isNull(), "-").otherwise(F.concat(F.octet_length(F.col(f"`{c}`")).cast("string"), F.lit(":"), F.col(f"`{c}`")))
    row = lambda df, side: df.select(F.unhex(F.sha2(F.concat(*(cell(c) for c in left.columns)), 256)).alias("row"), F.lit(side).alias("side"))
    seen = row(left, 0).unionAll(row(right, 1)).groupBy("row").agg(F.min("side").alias("a"), F.max("side").alias("b"))
    return seen.where("a = b").isEmpty()


def _paired(rows: DataFrame, keys: list[str], change: str) -> tuple[DataFrame, DataFrame]:
    """Rows of (VALUE, side) split into pairs, one of each side alone under the keys, and the rest. One shuffle serves both."""
    w = W.partitionBy(*keys)
    n = lambda side: F.count_if(F.col("side") == side).over(w)
    marked = rows.withColumn("_pair", (n("removed") == 1) & (n("added") == 1))
    value = F.struct(*VALUE)
    pairs = marked.where("_pair").groupBy(*keys).agg(F.max(F.when(F.col("side") == "removed", value)).alias("before"), F.max(F.when(F.col("side") == "added", value)).alias("after"))
    return pairs.select(F.lit(change).alias("change"), "before", "after"), marked.where("NOT _pair").drop("_pair")


def delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """(change, before, after) between two annotation tables (VALUE).

    A value whose language or datatype alone changed is retagged, one whose text alone changed is replaced, if the pair
    is unambiguous; what is left is removed or added.
    """
    sides = both_ways(old.select(*VALUE), new.select(*VALUE))
    low = sides.withColumn("_lang", F.lower("language"))
    retagged, rest = _paired(low, ["subject", "predicate", "lexical"], "retagged")
    replaced, rest = _paired(rest, ["subject", "predicate", "_lang", "datatype"], "replaced")
    value = F.struct(*VALUE)
    left = rest.select(F.col("side").alias("change"), F.when(F.col("side") == "removed", value).alias("before"), F.when(F.col("side") == "added", value).alias("after"))
    return retagged.unionByName(replaced).unionByName(left)


def hashed(changes: DataFrame) -> DataFrame:
    """delta() with before_hash, after_hash and record_id. Lexical values are hashed as they are; put them in NFC before."""
    h = lambda s: F.when(F.col(s).isNotNull(), identity.value_hash(*(F.col(f"{s}.{c}") for c in VALUE)))
    at = F.coalesce("after", "before")
    locator = identity.canonical_json(subject=at["subject"], predicate=at["predicate"], object_kind=F.lit("literal"), language=F.lower(at["language"]), datatype=at["datatype"])
    rows = changes.withColumn("before_hash", h("before")).withColumn("after_hash", h("after"))
    return rows.withColumn("record_id", identity.record_id(locator, F.col("before_hash"), F.col("after_hash"))).withColumn("before_hash", F.coalesce("before_hash", F.sha2(F.lit(identity.ABSENT), 256))).withColumn("after_hash", F.coalesce("after_hash", F.sha2(F.lit(identity.ABSENT), 256)))


def manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """The hashed changes between two annotation tables, in NFC, in order of their ids."""
    nfc = lambda df: df.select(*(text.nfc(F.col(c)).alias(c) if c == "lexical" else F.col(c) for c in VALUE))
    return hashed(delta(nfc(old), nfc(new))).orderBy("record_id")


def change_lines(changes: DataFrame) -> DataFrame:
    """(line): each change as a JSON object, keys sorted, nulls kept."""
    side = lambda s: F.when(F.col(s).isNotNull(), F.struct(*(F.col(f"{s}.{c}").alias(c) for c in sorted(VALUE)))).alias(s)
    return json_lines(changes.withColumns({"after": side("after"), "before": side("before")}))


def regressions(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Candidate findings that the baseline does not have."""
    keys = ["code", "severity", "subject", "predicate", "message"]
    return null_safe(candidate.select(*keys), baseline.select(*keys), keys, "left_anti")


def fidelity(base: DataFrame, output: DataFrame, changes: DataFrame) -> DataFrame:
    """(problem, n): what base-to-output changes beyond, or short of, the accepted changes (delta())."""
    cols = VALUE
    gone, came = difference(base.select(*cols), output.select(*cols)), difference(output.select(*cols), base.select(*cols))
    old = changes.where("before is not null").select("before.*").select(*cols)
    new = changes.where("after is not null").select("after.*").select(*cols)
    parts = {"unexpected_removed": difference(gone, old), "unexpected_added": difference(came, new), "missing_removed": difference(old, gone), "missing_added": difference(new, came)}
    out = None
    for name, df in parts.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("problem"), "n")
        out = one if out is None else out.unionAll(one)
    return out


def apply_changes(values: DataFrame, changes: DataFrame) -> DataFrame:
    """values (VALUE) after the changes: what was before goes, what is after comes."""
    gone = changes.where("before is not null").select("before.*").select(*VALUE)
    came = changes.where("after is not null").select("after.*").select(*VALUE)
    return difference(values.select(*VALUE), gone).unionByName(came).distinct()


def _plain(triples: DataFrame) -> DataFrame:
    """Strings with their datatype spelt out as plain ones."""
    same = (F.col("datatype") == XSD + "string") & F.col("language").isNull()
    return triples.withColumn("datatype", F.when(same, None).otherwise(F.col("datatype")))


def merge_diff(ours: DataFrame, theirs: DataFrame, relation_prefix: str = "") -> dict[str, DataFrame]:
    """What a merge of our triples into theirs has to do, per class that both have.

    Plain and xsd:string literals are equal. A label is removed only if its string is gone from the names and from the
    same predicate; values with the relation prefix are no labels. Definitions are added beside others, or replaced one for one.
    """
    from . import graph

    a, b = _plain(ours).distinct(), _plain(theirs).distinct()
    ours_c, theirs_c = graph.classes(a), graph.classes(b)
    common = ours_c.join(theirs_c, "subject", "left_semi")
    a, b = a.join(common, "subject", "left_semi"), b.join(common, "subject", "left_semi")
    keys = ["subject", "predicate", "object", "object_kind", "language", "datatype"]
    at = lambda df, *p: df.where(F.col("predicate").isin(*p)).select(*keys)
    alt, hidden, definition = SKOS + "altLabel", SKOS + "hiddenLabel", SKOS + "definition"
    kept = at(a, RDFS + "label", SKOS + "prefLabel", alt, hidden)
    removed = difference(at(b, alt, hidden), at(a, alt, hidden)).where(F.col("object_kind") == "literal")
    if relation_prefix:
        removed = removed.where(~F.startswith("object", F.lit(relation_prefix)))
    names = kept.where(F.col("predicate").isin(RDFS + "label", SKOS + "prefLabel")).select("subject", "object")
    removed = removed.join(names, ["subject", "object"], "left_anti").join(kept.select("subject", "predicate", "object"), ["subject", "predicate", "object"], "left_anti")
    new_defs, old_defs = difference(at(a, definition), at(b, definition)), difference(at(b, definition), at(a, definition))
    changed = old_defs.select("subject").distinct()
    single = at(a, definition).groupBy("subject").count().where("count = 1").join(at(b, definition).groupBy("subject").count().where("count = 1"), "subject", "left_semi").select("subject")
    return {
        "new_classes": difference(ours_c, theirs_c),
        "new_alt_labels": difference(at(a, alt), at(b, alt)),
        "new_hidden_labels": difference(at(a, hidden), at(b, hidden)),
        "removed_labels": removed,
        "definition_additions": new_defs.join(changed, "subject", "left_anti"),
        "definition_updates": new_defs.join(changed, "subject", "left_semi").join(single, "subject", "left_semi"),
        "label_normalizations": _prefixed(a, b, relation_prefix),
        "new_restrictions": difference(graph.restrictions(a.unionByName(_nameless(ours, a))), graph.restrictions(b.unionByName(_nameless(theirs, b)))),
    }


def _prefixed(ours: DataFrame, theirs: DataFrame, prefix: str) -> DataFrame:
    """(subject, plain, prefixed): prefixed labels of theirs whose plain text is a label, and which are a notation, in ours."""
    label, notation = RDFS + "label", SKOS + "notation"
    old = theirs.where((F.col("predicate") == label) & F.startswith("object", F.lit(prefix)) & F.lit(bool(prefix)))
    old = old.select("subject", F.substring("object", len(prefix) + 1, 1 << 30).alias("plain"), F.col("object").alias("prefixed")).distinct()
    untagged = ours.where(F.col("language").isNull() & F.col("datatype").isNull())
    has = lambda predicate, c: untagged.where(F.col("predicate") == predicate).select("subject", F.col("object").alias(c))
    return old.join(has(label, "plain"), ["subject", "plain"], "left_semi").join(has(notation, "prefixed"), ["subject", "prefixed"], "left_semi").select("subject", "plain", "prefixed")


def _nameless(whole: DataFrame, part: DataFrame) -> DataFrame:
    """Triples about nodes without a name, which restrictions are spelt with."""
    return whole.where(F.col("subject_kind") == "bnode").select(*part.columns)


def merge_summary(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in parts.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("kind"), "n")
        out = one if out is None else out.unionAll(one)
    return out


def _renamed(triples: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """triples with the hashes of nameless nodes in a column. Only such nodes meet the names: other values are shared by many rows, which would be one task's."""
    is_node = F.coalesce(F.col(f"{column}_kind") == "bnode", F.lit(False))
    key = names.select(F.col("node").alias(column), F.col("hash").alias("_hash"))
    met = triples.where(is_node).join(key, column, "left").withColumn(column, F.col("_hash"))
    return met.select(*triples.columns).unionByName(triples.where(~is_node))


def canonical(triples: DataFrame) -> DataFrame:
    """triples with hashes for names of nameless nodes, so that two graphs compare as tables."""
    h = nameless.names(triples)
    return dealt(_renamed(_renamed(triples, h, "subject"), h, "object")).distinct()


def sample_of_changes(rows: DataFrame, by: list[str], n: int = 50) -> DataFrame:
    return rows.orderBy(*by).limit(n)


#: What a merge brings in, by the part of merge_diff() that names it.
_ADDED = ("new_alt_labels", "new_hidden_labels", "definition_additions", "definition_updates")


def apply_merge(ours: DataFrame, theirs: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """theirs after the seven kinds of changes that merge_diff(ours, theirs) names.

    New classes come with all that ours says of them, restrictions with their nameless nodes; labels and definitions are
    added, removed labels and replaced definitions go, and prefixed labels become notations. All else in theirs stays,
    with strings as plain ones.
    """
    from . import graph

    cols = ["subject", "subject_kind", "predicate", "object", "object_kind", "language", "datatype"]
    keys = ["subject", "predicate", "object", "object_kind", "language", "datatype"]
    gone = parts["removed_labels"].select(*keys)
    replaced = parts["definition_updates"].select("subject").distinct()
    kept = null_safe(_plain(theirs).select(*cols), gone, keys, "left_anti")
    kept = kept.join(replaced.withColumn("predicate", F.lit(SKOS + "definition")), ["subject", "predicate"], "left_anti")
    turned = parts["label_normalizations"]
    kept = kept.join(turned.select("subject", F.lit(RDFS + "label").alias("predicate"), F.col("prefixed").alias("object")), ["subject", "predicate", "object"], "left_anti")
    none = F.lit(None).cast("string")
    literal = lambda predicate, c: turned.select("subject", F.lit("iri").alias("subject_kind"), F.lit(predicate).alias("predicate"), F.col(c).alias("object"), F.lit("literal").alias("object_kind"), none.alias("language"), none.alias("datatype"))
    out = kept.select(*cols).unionByName(literal(RDFS + "label", "plain")).unionByName(literal(SKOS + "notation", "prefixed"))
    for name in _ADDED:
        out = out.unionByName(parts[name].withColumn("subject_kind", F.lit("iri")).select(*cols))
    ours = _plain(ours)
    found = ours.join(parts["new_classes"], "subject", "left_semi").select(*cols)
    # The nodes that the new classes and the new restrictions hang on.
    want = parts["new_restrictions"].select("subject", F.col("property").alias("_p"), F.col("kind").alias("_k"), F.col("value").alias("_v"))
    node = graph.restriction_nodes(ours)
    fresh = node.join(want, [node["subject"] == want["subject"], F.col("property") == F.col("_p"), F.col("kind") == F.col("_k"), F.col("value") == F.col("_v")], "left_semi")
    held = ours.join(fresh.select("subject", F.col("node").alias("object")).withColumn("object_kind", F.lit("bnode")), ["subject", "object", "object_kind"], "left_semi").select(*cols)
    hung = found.unionByName(held).where(F.col("object_kind") == "bnode").select(F.col("object").alias("subject")).distinct()
    about = ours.where(F.col("subject_kind") == "bnode").join(hung, "subject", "left_semi").select(*cols)
    return out.unionByName(found).unionByName(held).unionByName(about).distinct()


THING = OWL + "Thing"
