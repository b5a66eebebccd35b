"""Whole runs over recorded tables: a batch of corrections from votes to publication, and a replay that says where a record is not borne out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import changes, hashtree, review
from ..operators.tables import json_lines, stored
from ..sources.publish import publish_lines
from . import release

_RECORD = ["record_id", *changes.VALUE]


def corrected_batch(
    values: DataFrame, records: DataFrame, votes: DataFrame, proposals: DataFrame, checks: DataFrame, rereviews: DataFrame, routes: DataFrame, qualifications: DataFrame, minimum: float, path: str, attempts: int = 2
) -> dict:
    """Corrections that converge, are borne out and bound to their qualifications, put into the values and published once; the artifact.

    values: changes.VALUE. records: (record_id, VALUE), what each record judged. votes, proposals, checks, rereviews: as
    release.correction_run() takes them. routes: (record_id, proposer_route, verifier_routes,
    verifier_qualification_hashes). The values go to path/values, the ledger to path/ledger, as JSON lines. ValueError, with
    nothing published, if a correction lacks its lineage or its binding, or does not match exactly one value; the same
    batch again changes nothing, another under the same path is refused.
    """
    states = stored(release.correction_run(votes, proposals, checks, rereviews, minimum, attempts), "correction-states")
    good = states.where("state = 'verified'").select("record_id", "replacement")
    named = good.join(records.select(*_RECORD), "record_id").join(routes, "record_id", "left")
    revision = F.sha2(F.concat_ws("\x1f", F.col("record_id").cast("string"), "replacement"), 256)
    ledger = stored(named.select(F.col("record_id").alias("root_record_id"), revision.alias("revision_id"), *changes.VALUE, "replacement", "proposer_route", "verifier_routes", "verifier_qualification_hashes"), "ledger")
    final = rereviews.join(states.where("state = 'verified'").select("record_id", "attempt"), ["record_id", "attempt"], "left_semi")
    for what, found in (("lineage", release.lineage_findings(ledger, good, final, minimum)), ("binding", release.binding_findings(ledger, qualifications))):
        first = found.orderBy("root_record_id", "code").first()
        if first is not None:
            raise ValueError(f"{what}: {first['root_record_id']} {first['code']}")
    after = release.apply_corrections(values, ledger)
    told = {name: publish_lines(json_lines(df).orderBy("line"), f"{path.rstrip('/')}/{name}", suffix=".jsonl") for name, df in (("values", after), ("ledger", ledger))}
    counts = {r["state"]: r["n"] for r in states.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per state
    return release.artifact({"states": counts, "values": told["values"]["content"], "ledger": told["ledger"]["content"], "lines": told["values"]["lines"]}, "complete")


def recomputed(inputs: Mapping[str, DataFrame], minimum: float, confidence: float, margin: float, census_at: int, most_defects: float, cases_per_slice: int, seed: str, thresholds: tuple[float, float, float]) -> dict[str, tuple[DataFrame, list[str]]]:
    """Each stage of a run from its inputs, with the keys of its rows: delta, census, sample, states, evaluated, slices, qualification, report.

    inputs: old, new (changes.VALUE), triples, records (record_id, stratum), left, right (record_id, verdict, confidence),
    cases, predictions.
    """
    spark = inputs["old"].sparkSession
    strata = inputs["records"].select("stratum").distinct().count()
    states = stored(review.reconcile(inputs["left"], inputs["right"], minimum), "states")
    sample = stored(review.hash_sample(inputs["records"], "record_id", seed, confidence, margin, census_at, strata).where("selected").select("record_id", "stratum"), "sample")
    verdict = states.where("state <> 'incomplete'").select("record_id", F.when(F.col("state") == "accepted", "pass").otherwise("defect").alias("verdict"), F.lit(False).alias("severe"))
    slices = stored(review.slice_metrics(inputs["cases"], inputs["predictions"], cases_per_slice), "slices")
    decided = release.qualification(slices, *thresholds)
    report = release.release_report({"qualified": decided["status"] == "qualified"}, {}, states, "", {})
    one = lambda x: spark.createDataFrame([(x["status"], release.digest(x["payload"]))], "status string, payload string")
    return {
        "delta": (changes.manifest(inputs["old"], inputs["new"]).select("record_id", "before_hash", "after_hash"), ["record_id"]),
        "census": (review.census_run(inputs["triples"]).select("code", "severity", "subject", "predicate").distinct(), ["code", "subject", "predicate"]),
        "sample": (sample, ["record_id"]), "states": (states, ["record_id"]), "evaluated": (review.evaluate_sample(sample, verdict, confidence, strata, most_defects), ["stratum"]),
        "slices": (slices, ["family", "locale"]), "qualification": (one(decided), ["status"]), "report": (one(report), ["status"]),
    }


def replayed(record: Mapping[str, DataFrame], anew: Mapping[str, tuple[DataFrame, list[str]]], decimals: int = 9) -> DataFrame:
    """(stage, key, problem): rows of a recorded run that computing it again does not bear out, found by hash trees.

    record: the recorded tables by stage. Only rows in key ranges whose digests differ are joined. Numbers count as equal
    to `decimals` places; key is the row's keys as JSON; a stage that is not recorded is missing as a whole.
    """
    out = None
    for stage, (now, keys) in anew.items():
        plain = lambda df: df.select(*(F.round(c, decimals).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))
        now = stored(plain(now), "replayed")
        held = plain(record[stage].select(*now.columns)) if stage in record else now.limit(0)
        a, b = hashtree.narrowed(held, now, keys)
        whole = [c for c in now.columns if c not in keys]
        a, b = (df if whole else df.withColumn("_there", F.lit(True)) for df in (a, b))
        found = release.differing(a, b, keys).select(F.lit(stage).alias("stage"), F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("key"), "problem")
        out = found if out is None else out.unionAll(found)
    return out
