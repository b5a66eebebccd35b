"""Runs around the operators: surveillance until nothing expands, corrections, qualification, reports, heartbeats, replay.

Reviewers' answers come from tables of recorded receipts. Tables stay distributed; what comes to the driver is counts per
stratum, gates and hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import changes, mapping, review
from ..operators.tables import LABELS, SKOS, null_safe, stored
from ..sources.files import canonical_bytes


def digest(value) -> str:
    return hashlib.sha256(canonical_bytes(value)).hexdigest()


def artifact(payload, status: str, parents: list[str] | None = None, **ids: str) -> dict:
    """A result that carries its own hash and those of what it came from."""
    body = {"payload": payload, "status": status, "parent_hashes": sorted(parents or []), **ids}
    return {"artifact_hash": digest(body), **body}


def check_artifact(a: Mapping) -> None:
    if digest({k: v for k, v in a.items() if k != "artifact_hash"}) != a["artifact_hash"]:
        raise ValueError("an artifact was changed after it was hashed")


def replay(report: Mapping, recomputed: Mapping) -> list[str]:
    """Keys of a report's payload that computing them again does not bear out."""
    check_artifact(report)
    held = report["payload"]
    return sorted(k for k in {*held, *recomputed} if held.get(k) != recomputed.get(k))


def differing(recorded: DataFrame, recomputed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, problem) of rows that are missing from, unexpected in, or other than what computing them again gives; nulls are equal."""
    rest = [c for c in recomputed.columns if c not in keys]
    side = lambda df, name: df.select(*keys, F.struct(*rest).alias(name), F.lit(True).alias(f"_{name}"))
    a, b = side(recorded, "held"), side(recomputed, "anew")
    j = a.join(b.select(*(F.col(k).alias(f"_k_{k}") for k in keys), "anew", "_anew"), [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "full_outer")
    problem = F.when(F.col("_held").isNull(), "missing").when(F.col("_anew").isNull(), "unexpected").when(~F.col("held").eqNullSafe(F.col("anew")), "different")
    return j.select(*(F.coalesce(k, f"_k_{k}").alias(k) for k in keys), problem.alias("problem")).where("problem IS NOT NULL")


def replay_run(bundle: Mapping[str, DataFrame], minimum: float, confidence: float, strata: int, most_defects: float, cases_per_slice: int, decimals: int = 9) -> DataFrame:
    """(stage, n): how many rows of each recorded result computing it again from the recorded inputs does not bear out.

    bundle: votes (record_id, reviewer, verdict, confidence; two reviewers), states, sample (record_id, stratum), evaluated,
    cases, predictions, slices. Numbers count as equal to `decimals` places.
    """
    votes = bundle["votes"]
    names = [r["reviewer"] for r in votes.select("reviewer").distinct().orderBy("reviewer").limit(3).collect()]  # two, by contract
    if len(names) != 2:
        raise ValueError("a run has two reviewers")
    left, right = (votes.where(F.col("reviewer") == x) for x in names)
    states = review.reconcile(left, right, minimum)
    verdict = states.where("state <> 'incomplete'").select("record_id", F.when(F.col("state") == "accepted", "pass").otherwise("defect").alias("verdict"), F.lit(False).alias("severe"))
    parts = {
        "states": (states, ["record_id"]),
        "evaluated": (review.evaluate_sample(bundle["sample"], verdict, confidence, strata, most_defects), ["stratum"]),
        "slices": (review.slice_metrics(bundle["cases"], bundle["predictions"], cases_per_slice), ["family", "locale"]),
    }
    out = None
    for name, (anew, keys) in parts.items():
        same = lambda df: df.select(*(F.round(c, decimals).alias(c) if t == "double" else c for c, t in df.dtypes))
        one = differing(same(bundle[name].select(*anew.columns)), same(anew), keys).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
        out = one if out is None else out.unionAll(one)
    return out


def token_estimate(c: Column) -> Column:
    """A quarter of the bytes, rounded up, and one at least."""
    return F.greatest(F.lit(1), F.ceil(F.octet_length(c) / 4))


#: Slices are configured pairs of family and locale; an artifact lists them by name.
SLICES = 10_000


def unstable(first: DataFrame, second: DataFrame, most: float = 0.0) -> DataFrame:
    """(family, locale, changed) of slices in which a second run answers more than a share of the cases otherwise than the first.

    first, second: (case_id, family, locale, predicted); a case that one run lacks counts as answered otherwise.
    """
    b = second.select("case_id", "family", "locale", F.col("predicted").alias("_again"))
    j = first.select("case_id", "family", "locale", "predicted").join(b, ["case_id", "family", "locale"], "full")
    other = (~F.col("predicted").eqNullSafe(F.col("_again")) | F.col("predicted").isNull()).cast("int")
    return j.groupBy("family", "locale").agg(F.avg(other).alias("changed")).where(F.col("changed") > most)


def qualification(slices: DataFrame, accuracy: float, recall: float, false_accepts: float, stable: bool = True, runs: tuple[DataFrame, DataFrame] | None = None, **ids: str) -> dict:
    """A reviewer's decision from review.slice_metrics(): every slice must be supported, complete and within the thresholds, and stable between two runs, where they are given."""
    stable = stable and (runs is None or unstable(*runs).isEmpty())
    good = F.col("supported") & (F.col("n_missing") == 0) & (F.col("accuracy") >= accuracy) & (F.col("defect_recall") >= recall) & (F.col("false_accept_rate") <= false_accepts)
    rows = slices.withColumn("_good", good)
    bad = rows.where("NOT _good").count()
    passing = rows.where("_good").select("family", "locale").orderBy("family", "locale").limit(SLICES + 1).collect()
    if len(passing) > SLICES:
        raise ValueError(f"slices are configuration: at most {SLICES}")
    body = {"qualified_slices": [[r["family"], r["locale"]] for r in passing], **ids}
    return artifact(body, "qualified" if not bad and passing and stable else "rejected")


def check_roles(roles: Mapping[str, str], apart: list[tuple[str, str]]) -> None:
    """roles: role to provider; each pair in `apart` must be served by different ones."""
    for a, b in apart:
        if roles.get(a) is None or roles.get(b) is None or roles[a] == roles[b]:
            raise ValueError(f"{a} and {b} must be served by different providers")


def role_findings(qualifications: DataFrame, needed: list[str], apart: list[tuple[str, str, str]], bound: Mapping[str, str], now: str) -> DataFrame:
    """(role, code): roles that are missing, not qualified, expired, bound to other hashes, or served by what must be apart from them.

    qualifications: (role, status, valid_until, and the columns that `apart` and `bound` name), a row per role. apart:
    (role, other role, column that must differ). bound: column to the value that it must have. now: ISO time.
    """
    spark = qualifications.sparkSession
    want = spark.createDataFrame([(r,) for r in needed], "role string")
    j = want.join(qualifications, "role", "left")
    checks = {
        "missing": F.col("status").isNull(),
        "not-qualified": F.col("status") != "qualified",
        "expired": F.col("valid_until").try_cast("timestamp") <= F.lit(now).cast("timestamp"),
        **{f"binding:{c}": F.col("status").isNotNull() & ~F.col(c).eqNullSafe(F.lit(v)) for c, v in bound.items()},
    }
    out = j.select("role", F.explode(F.array_compact(F.array(*(F.when(bad, F.lit(code)) for code, bad in checks.items())))).alias("code"))
    for a, b, column in apart:
        x = qualifications.where(F.col("role") == a).select("role", F.col(column).alias("_x"))
        y = qualifications.where(F.col("role") == b).select(F.col(column).alias("_y"))
        out = out.unionByName(x.join(F.broadcast(y), F.col("_x") == F.col("_y")).select("role", F.lit(f"same-{column}:{b}").alias("code")))
    return out


def binding_findings(ledger: DataFrame, qualifications: DataFrame, proposer: str = "correction-proposer", verifiers: tuple[str, ...] = ("correction-verifier-1", "correction-verifier-2")) -> DataFrame:
    """(root_record_id, code) of corrections that name other routes or qualifications than those of their roles.

    ledger: (root_record_id, proposer_route, verifier_routes and verifier_qualification_hashes, arrays in the roles'
    order). qualifications: (role, route_id, qualification_hash, status), joined by the hash that a correction names:
    unknown is one that no qualification has, role one of another role, status one that is not qualified, and route a
    route that is not the qualification's own.
    """
    named = ledger.select("root_record_id", F.posexplode(F.arrays_zip(F.col("verifier_routes").alias("route"), F.col("verifier_qualification_hashes").alias("hash"))).alias("_i", "_v"))
    role = F.element_at(F.array(*map(F.lit, verifiers)), F.least(F.col("_i") + 1, F.lit(len(verifiers))))
    held = qualifications.select(F.col("qualification_hash").alias("_hash"), F.col("role").alias("_role"), F.col("route_id").alias("_route"), F.col("status").alias("_status"))
    j = named.select("root_record_id", "_i", role.alias("_want"), F.col("_v.route").alias("_named"), F.col("_v.hash").alias("_hash")).join(held, "_hash", "left")
    code = F.when(F.col("_role").isNull(), "unknown").when(F.col("_role") != F.col("_want"), "role").when(F.col("_status") != "qualified", "status").when(~F.col("_named").eqNullSafe(F.col("_route")), "route")
    out = j.select("root_record_id", F.concat(code, F.lit(":"), "_want").alias("code")).where("code IS NOT NULL")
    count = ledger.where((F.coalesce(F.size("verifier_routes"), F.lit(-1)) != len(verifiers)) | (F.coalesce(F.size("verifier_qualification_hashes"), F.lit(-1)) != len(verifiers))).select("root_record_id", F.lit("verifiers").alias("code"))
    routes = qualifications.where(F.col("role") == proposer).select(F.col("route_id").alias("proposer_route"))
    other = ledger.join(routes, "proposer_route", "left_anti").select("root_record_id", F.lit(f"route:{proposer}").alias("code"))
    return out.unionByName(count).unionByName(other).distinct()


def sample_against(evaluated: DataFrame, ceiling: int) -> DataFrame:
    """(sampled, ceiling, within): the total of all strata's samples against what may be reviewed."""
    total = F.coalesce(F.sum("sample"), F.lit(0)).cast("long")
    return evaluated.agg(total.alias("sampled")).select("sampled", F.lit(ceiling).cast("long").alias("ceiling"), (F.col("sampled") <= ceiling).alias("within"))


def ungrounded(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """record_id of responses (record_id, quotes array<string>) with a quote that the request's JSON (record_id, json) does not hold, or without a request."""
    j = responses.join(requests.select("record_id", "json"), "record_id", "left")
    return j.where(F.col("json").isNull() | F.exists("quotes", lambda q: ~F.contains(F.col("json"), q))).select("record_id")


def families(changed: DataFrame) -> DataFrame:
    """Changed values (subject, predicate, language) with the family that reviews them; null where none does."""
    plain = F.lower(F.coalesce("language", F.lit("en"))) == "en"
    f = F.when(F.col("predicate") == SKOS + "definition", "definition").when(F.col("predicate") == SKOS + "example", "example")
    return changed.withColumn("family", F.when(F.col("predicate").isin(*LABELS.values()) & ~plain, "translation").otherwise(f))


def routing_findings(records: DataFrame, contexts: DataFrame) -> DataFrame:
    """(record_id, code) of changed records (record_id, family) that no reviewer can be given: without a family, a translation without its one source, an example without a definition.

    contexts: (record_id, source, definition), as graph.record_contexts() gives it.
    """
    j = records.select("record_id", "family").join(contexts.select("record_id", "source", "definition"), "record_id", "left")
    code = F.when(F.col("family").isNull(), "family").when((F.col("family") == "translation") & F.col("source").isNull(), "source").when((F.col("family") == "example") & F.col("definition").isNull(), "definition")
    return j.select("record_id", code.alias("code")).where("code IS NOT NULL")


def surveillance(records: DataFrame, left: DataFrame, right: DataFrame, seed: str, confidence: float, margin: float, census_at: int, most_defects: float, minimum: float, ceiling: int) -> tuple[dict, DataFrame]:
    """(outcome, evaluation per stratum) of records (record_id, stratum[, severe]) judged by two reviewers.

    Strata whose bound or a severe defect asks for it are taken whole, until none is. More records than the ceiling are refused.
    """
    strata = records.select("stratum").distinct().count()
    placed = stored(review.hash_sample(records, "record_id", seed, confidence, margin, census_at, strata), "placed")
    states = review.reconcile(left, right, minimum)
    verdict = states.where("state <> 'incomplete'").select("record_id", F.when(F.col("state") == "accepted", "pass").otherwise("defect").alias("verdict"))
    severe = records.select("record_id", "severe") if "severe" in records.columns else records.select("record_id", F.lit(False).alias("severe"))
    results = stored(verdict.join(severe, "record_id", "left"), "results")
    whole: set = set()
    while True:
        chosen = placed.where(F.col("selected") | F.col("stratum").isin(*whole)) if whole else placed.where("selected")
        if chosen.count() > ceiling:
            raise ValueError("the sample exceeds the review ceiling")
        seen = stored(review.evaluate_sample(chosen.select("record_id", "stratum"), results, confidence, strata, most_defects).join(placed.groupBy("stratum").agg(F.max("population").alias("population")), "stratum"), "evaluated")
        grow = {r["stratum"] for r in seen.where("requires_census AND sample < population").select("stratum").collect()}  # a name per stratum
        if not grow:
            blocked = not seen.where("missing > 0").isEmpty()
            return {"decision": "blocked" if blocked else "pass", "census": sorted(whole)}, seen
        whole |= grow


def corrections(proposals: DataFrame, votes: DataFrame, minimum: float, attempts: int = 2) -> DataFrame:
    """(record_id, state, attempt, replacement): the first of the attempts that two verifiers pass; a repeated replacement is a cycle.

    proposals: (record_id, attempt, replacement); votes: (record_id, attempt, verifier, verdict, confidence), and
    proposed_replacement, where verifiers may propose: one that does has not passed the attempt.
    """
    good = (F.col("verdict") == "pass") & (F.col("confidence") >= minimum)
    if "proposed_replacement" in votes.columns:
        good = good & F.col("proposed_replacement").isNull()
    passed = votes.groupBy("record_id", "attempt").agg((F.count_distinct("verifier") == 2).alias("two"), F.min(good).alias("all_pass"))
    rows = proposals.where(F.col("attempt") <= attempts).join(passed, ["record_id", "attempt"], "left")
    usable = F.trim(F.coalesce("replacement", F.lit(""))) != ""
    rows = rows.withColumn("ok", usable & F.coalesce(F.col("two") & F.col("all_pass"), F.lit(False)))
    seen = F.row_number().over(W.partitionBy("record_id", "replacement").orderBy("attempt")) > 1
    rows = rows.withColumn("cycle", usable & seen)
    first = rows.groupBy("record_id").agg(F.min(F.when(F.col("ok"), F.col("attempt"))).alias("good"), F.min(F.when(F.col("cycle"), F.col("attempt"))).alias("loop"))
    verified = F.col("good").isNotNull() & (F.col("loop").isNull() | (F.col("good") < F.col("loop")))
    text = rows.where("ok").select("record_id", F.col("attempt").alias("good"), "replacement")
    out = first.withColumn("state", F.when(verified, "verified").otherwise("quarantined")).join(text, ["record_id", "good"], "left")
    keep = F.col("state") == "verified"
    return out.select("record_id", "state", F.when(keep, F.col("good")).alias("attempt"), F.when(keep, F.col("replacement")).alias("replacement"))


def confirmed(votes: DataFrame) -> DataFrame:
    """(record_id): records that exactly two votes, and none but those, call a defect."""
    n = votes.groupBy("record_id").agg(F.count_if(F.col("verdict") == "defect").alias("defects"), F.count(F.lit(1)).alias("n"))
    return n.where("defects = 2 AND n = 2").select("record_id")


def correction_run(votes: DataFrame, proposals: DataFrame, checks: DataFrame, rereviews: DataFrame, minimum: float, attempts: int = 2) -> DataFrame:
    """(record_id, state, attempt, replacement) of every confirmed record: verified, or quarantined.

    votes: (record_id, verdict) of the first review. proposals, checks: as corrections() takes them. rereviews:
    (record_id, attempt, reviewer, verdict, confidence) of what the verifiers passed: an attempt that two final reviewers
    do not both pass is no longer one, and the next attempt has its turn.
    """
    due = confirmed(votes)
    final = rereviews.groupBy("record_id", "attempt").agg((F.count_distinct("reviewer") == 2).alias("two"), F.min((F.col("verdict") == "pass") & (F.col("confidence") >= minimum)).alias("all_pass"))
    fallen = final.where("NOT (two AND all_pass)").select("record_id", "attempt")
    # A check of its own kind that fails takes the attempt out, yet leaves its text for the search of cycles.
    veto = fallen.select("record_id", "attempt", F.lit("final").alias("verifier"), F.lit("defect").alias("verdict"), F.lit(1.0).alias("confidence"))
    told = checks.select("record_id", "attempt", "verifier", "verdict", "confidence", *(c for c in checks.columns if c == "proposed_replacement")).unionByName(veto, allowMissingColumns=True)
    out = corrections(proposals.join(due, "record_id", "left_semi"), told, minimum, attempts)
    return due.join(out, "record_id", "left").withColumn("state", F.coalesce("state", F.lit("quarantined")))


def lineage_findings(ledger: DataFrame, verified: DataFrame, rereviews: DataFrame, minimum: float) -> DataFrame:
    """(root_record_id, code): what a ledger of corrections (root_record_id, revision_id, replacement) lacks to be borne out.

    Roots and revisions are unique, roots are those that converged (record_id, replacement), and two final reviewers pass each.
    """
    twice = lambda c: ledger.join(ledger.groupBy(c).count().where("count > 1").select(c), c, "left_semi").select("root_record_id").distinct()
    code = lambda df, name: df.select("root_record_id", F.lit(name).alias("code"))
    v = verified.select(F.col("record_id").alias("root_record_id"), F.col("replacement").alias("_text"))
    j = ledger.select("root_record_id", "replacement").join(v, "root_record_id", "full_outer")
    passed = rereviews.groupBy(F.col("record_id").alias("root_record_id")).agg((F.count_distinct("reviewer") == 2).alias("two"), F.min((F.col("verdict") == "pass") & (F.col("confidence") >= minimum)).alias("all_pass"))
    weak = ledger.select("root_record_id").distinct().join(passed.where("two AND all_pass"), "root_record_id", "left_anti")
    parts = {
        "repeated-root": twice("root_record_id"), "repeated-revision": twice("revision_id"), "not-converged": j.where("_text IS NULL"), "not-in-ledger": j.where("replacement IS NULL"),
        "other-text": j.where("replacement <> _text").distinct(), "final-review": weak,
    }
    out = None
    for name, df in parts.items():
        out = code(df, name) if out is None else out.unionAll(code(df, name))
    return out


def attest(report: Mapping, expires_at: str, **identity: str) -> dict:
    """What a passing report is handed on with: whose it is, what it looked at, and until when it holds."""
    check_artifact(report)
    if report["payload"].get("decision") != "approved":
        raise ValueError("only a passing report can be attested")
    body = {"report_hash": report["artifact_hash"], "stage_hashes": report["payload"]["stage_hashes"], "candidate_hash": report["candidate_hash"], "expires_at": expires_at, **identity}
    return {"predicate_hash": digest(body), **body}


def check_attestation(predicate: Mapping, report: Mapping, candidate_hash: str, now: str, **identity: str) -> None:
    """ValueError unless the predicate is unchanged, still holds, and names this identity, candidate and report."""
    body = {k: v for k, v in predicate.items() if k != "predicate_hash"}
    if digest(body) != predicate.get("predicate_hash"):
        raise ValueError("the attestation was changed after it was hashed")
    for k, v in identity.items():
        if predicate.get(k) != v:
            raise ValueError(f"the attestation is of another {k}")
    if datetime.fromisoformat(now) >= datetime.fromisoformat(predicate["expires_at"]):
        raise ValueError("the attestation has expired")
    check_artifact(report)
    if predicate["candidate_hash"] != candidate_hash or predicate["report_hash"] != report["artifact_hash"]:
        raise ValueError("the attestation is of another candidate or report")


def migration_receipt(debt: DataFrame, ledger: DataFrame, report: Mapping, final_hash: str) -> dict:
    """The receipt that closes confirmed debt: only on a passing report, and only if every entry has a correction that stems from it.

    Ids are hashed as sets, so that no list of them passes the driver.
    """
    if report["payload"].get("decision") != "approved":
        raise ValueError("debt closes on a passing report alone")
    rows = review.debt_lineage(debt, ledger)
    lacking = rows.where("revisions = 0").orderBy("debt_id").first()
    if lacking is not None:
        raise ValueError(f"no correction stems from {lacking['debt_id']}")
    one = lambda df, c: (review.population_hash(df.select(c), c, []).first() or {"population_hash": None})["population_hash"]
    body = {"closed": rows.count(), "debt_hash": one(debt, "debt_id"), "revisions_hash": one(ledger, "revision_id"), "report_hash": report["artifact_hash"], "final_hash": final_hash}
    return {"receipt_hash": digest(body), **body}


def apply_corrections(values: DataFrame, chosen: DataFrame) -> DataFrame:
    """values (changes.VALUE) with each correction (VALUE, replacement) in place of exactly the value that it names; others fail the job."""
    named = chosen.select(*changes.VALUE)
    missing = null_safe(named, values, changes.VALUE, "left_anti")
    if not missing.isEmpty() or named.count() != named.distinct().count():
        raise ValueError("a correction must match exactly one annotation")
    kept = null_safe(values.select(*changes.VALUE), named, changes.VALUE, "left_anti")
    return kept.unionByName(chosen.withColumn("lexical", F.col("replacement")).select(*changes.VALUE)).distinct()


def lineage(expected: DataFrame, found: DataFrame, key: str) -> dict[str, int]:
    """How many keys are missing from, or unexpected in, what was found."""
    a, b = expected.select(key).distinct(), found.select(key).distinct()
    return {"missing": null_safe(a, b, [key], "left_anti").count(), "unexpected": null_safe(b, a, [key], "left_anti").count()}


def release_report(gates: Mapping[str, bool], stages: Mapping[str, str], states: DataFrame, candidate_hash: str, stage_candidates: Mapping[str, str]) -> dict:
    """The decision: every gate holds, every state is accepted, and all stages looked at the same candidate."""
    stale = any(h != candidate_hash for h in stage_candidates.values())
    counts = {r["state"]: r["n"] for r in states.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per state
    accepted = set(counts) <= {"accepted"}
    decision, held = review.release_decision({**gates, "states_accepted": accepted, "fresh": not stale})
    payload = {"decision": decision, "held_by": held, "states": counts, "stage_hashes": dict(stages)}
    return artifact(payload, "stale" if stale else "complete", list(stages.values()), candidate_hash=candidate_hash)


def newest_series(names: DataFrame, shape: str) -> DataFrame:
    """(id, major, minor) with the greatest version among names (id) of the shape, whose two groups are numbers."""
    part = lambda i: F.regexp_extract("id", shape, i).try_cast("int")
    rows = names.select("id", part(1).alias("major"), part(2).alias("minor")).where("major IS NOT NULL AND minor IS NOT NULL")
    return rows.orderBy(F.desc("major"), F.desc("minor")).limit(1)


def next_minor(version: str) -> str:
    major, minor, _ = (int(x) for x in version.split("."))
    return f"{major}.{minor + 1}.0"


def heartbeat(before: DataFrame, after: DataFrame, score_before: Mapping, score_after: Mapping, version: str, major_change: bool = False, drift: bool = False) -> dict:
    """A rebuild's receipt: automatic, or held for a person where precision or rows fell, or the source changed its shape."""
    key = ["subject_id", "predicate_id", "object_id"]
    n = [df.count() for df in (before, after)]
    reasons = ["the major series changed"] * major_change + ["the source's columns changed"] * drift
    p, q = score_before.get("precision"), score_after.get("precision")
    number = lambda x: isinstance(x, (int, float)) and not isinstance(x, bool) and math.isfinite(x)
    if number(p) and number(q) and p - q > 0.02 + 1e-12:
        reasons.append("precision fell by more than 0.02")
    if n[1] < n[0] * 0.9:
        reasons.append("rows fell by more than a tenth")

    def part(df: DataFrame) -> dict:
        return {"count": df.count(), "sample": [" ".join(r) for r in changes.sample_of_changes(df, key, 50).collect()]}

    by = lambda df: {r["predicate_id"]: r["n"] for r in mapping.count_by_predicate(df).collect()}
    a, b = before.select(*key), after.select(*key)
    return {
        "decision": "review" if reasons else "auto", "reasons": reasons, "set_version": {"before": version, "after": next_minor(version)}, "rows": {"before": n[0], "after": n[1]},
        "rows_by_predicate": {"before": by(before), "after": by(after)}, "score": {"before": dict(score_before), "after": dict(score_after)},
        "added": part(changes.difference(b, a)), "removed": part(changes.difference(a, b)),
    }
