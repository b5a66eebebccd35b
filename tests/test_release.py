import pytest

from loomlex.plans import release


def test_artifacts_and_replay():
    a = release.artifact({"n": 1}, "complete", ["b", "a"], run_id="r")
    release.check_artifact(a)
    assert release.replay(a, {"n": 1}) == [] and release.replay(a, {"n": 2, "m": 0}) == ["m", "n"]
    with pytest.raises(ValueError):
        release.check_artifact({**a, "status": "stale"})


def test_roles():
    release.check_roles({"a": "p", "b": "q"}, [("a", "b")])
    with pytest.raises(ValueError):
        release.check_roles({"a": "p", "b": "p"}, [("a", "b")])


def test_surveillance_expands(spark):
    records = spark.createDataFrame([(f"{s}{i}", s) for s in "ab" for i in range(200)], "record_id string, stratum string")
    votes = lambda bad: spark.createDataFrame([(f"{s}{i}", "defect" if s in bad and i % 2 else "pass", 0.9) for s in "ab" for i in range(200)], "record_id string, verdict string, confidence double")
    out, seen = release.surveillance(records, votes("a"), votes("a"), "s", 0.95, 0.1, 10, 0.1, 0.5, 400)
    assert out == {"decision": "pass", "census": ["a"]}
    got = {r["stratum"]: (r["sample"], r["defects"]) for r in seen.collect()}
    assert got["a"] == (200, 100) and 50 < got["b"][0] < 200 and got["b"][1] == 0
    with pytest.raises(ValueError):
        release.surveillance(records, votes("a"), votes("a"), "s", 0.95, 0.1, 10, 0.1, 0.5, 250)
    short = votes("")
    assert release.surveillance(records, short.limit(0), short, "s", 0.95, 0.1, 10, 0.9, 0.5, 400)[0]["decision"] == "blocked"


def test_corrections(spark):
    p = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "x"), (2, 2, "x"), (3, 1, " ")], "record_id int, attempt int, replacement string")
    v = spark.createDataFrame([(r, a, k, "pass" if (r, a) == (1, 2) else "defect", 0.9) for r in (1, 2) for a in (1, 2) for k in "ab"], "record_id int, attempt int, verifier string, verdict string, confidence double")
    assert sorted(map(tuple, release.corrections(p, v, 0.8).collect())) == [(1, "verified", 2, "y"), (2, "quarantined", None, None), (3, "quarantined", None, None)]


def test_apply_and_lineage(spark):
    cols = "subject string, predicate string, lexical string, language string, datatype string"
    values = spark.createDataFrame([("s", "p", "bad", None, None), ("s", "p", "ok", "en", None)], cols)
    fix = values.where("lexical = 'bad'").selectExpr("*", "'good' AS replacement")
    assert sorted(r["lexical"] for r in release.apply_corrections(values, fix).collect()) == ["good", "ok"]
    with pytest.raises(ValueError):
        release.apply_corrections(values.where("lexical = 'ok'"), fix)
    assert release.lineage(values, values.limit(1), "lexical") == {"missing": 1, "unexpected": 0}


def test_report_and_grounding(spark):
    states = spark.createDataFrame([("1", "accepted")], "record_id string, state string")
    ok = release.release_report({"census": True}, {"census": "h"}, states, "c", {"census": "c"})
    assert ok["payload"]["decision"] == "approved"
    assert release.release_report({"census": True}, {}, states, "c", {"census": "d"})["status"] == "stale"
    req = spark.createDataFrame([("1", '{"a":"text"}')], "record_id string, json string")
    res = spark.createDataFrame([("1", ["text"]), ("1", ["other"]), ("2", [])], "record_id string, quotes array<string>")
    assert sorted(r[0] for r in release.ungrounded(req, res).collect()) == ["1", "2"]


def test_heartbeat(spark):
    cols = "subject_id string, predicate_id string, object_id string"
    a = spark.createDataFrame([("s", "p", str(i)) for i in range(20)], cols)
    r = release.heartbeat(a, a.where("object_id <> '3'"), {"precision": 0.9}, {"precision": 0.89}, "0.2.0")
    assert (r["decision"], r["removed"], r["set_version"]["after"]) == ("auto", {"count": 1, "sample": ["s p 3"]}, "0.3.0")
    assert release.heartbeat(a, a.limit(5), {"precision": 0.9}, {"precision": 0.8}, "0.2.0", True)["reasons"].__len__() == 3
    names = spark.createDataFrame([("v2.4-x",), ("v2.10-x",), ("other",)], "id string")
    assert release.newest_series(names, r"^v(\d+)\.(\d+)-x$").first()["id"] == "v2.10-x"


def test_families_and_qualification(spark):
    sk = "http://www.w3.org/2004/02/skos/core#"
    rows = spark.createDataFrame([("s", sk + "altLabel", "fr"), ("s", sk + "altLabel", None), ("s", sk + "example", "en")], "subject string, predicate string, language string")
    assert [r["family"] for r in release.families(rows).collect()] == ["translation", None, "example"]
    m = spark.createDataFrame([("f", "en", 5, 0, 1.0, 1.0, 0.0, True)], "family string, locale string, n_scored int, n_missing int, accuracy double, defect_recall double, false_accept_rate double, supported boolean")
    assert release.qualification(m, 0.9, 0.9, 0.1)["status"] == "qualified" and release.qualification(m, 0.9, 0.9, 0.1, False)["status"] == "rejected"


def test_a_verifier_that_proposes_has_not_passed(spark):
    proposals = spark.createDataFrame([("r", 1, "a"), ("r", 2, "b")], "record_id string, attempt int, replacement string")
    votes = spark.createDataFrame([("r", n, v, "pass", 0.9, "other" if (n, v) == (1, "y") else None) for n in (1, 2) for v in "xy"], "record_id string, attempt int, verifier string, verdict string, confidence double, proposed_replacement string")
    assert [tuple(r) for r in release.corrections(proposals, votes, 0.8).collect()] == [("r", "verified", 2, "b")]
    assert [tuple(r) for r in release.corrections(proposals, votes.drop("proposed_replacement"), 0.8).collect()] == [("r", "verified", 1, "a")]


def test_bindings_of_corrections(spark):
    q = spark.createDataFrame([("correction-proposer", "p", "h0", "qualified"), ("correction-verifier-1", "v", "h1", "qualified"), ("correction-verifier-2", "w", "h2", "rejected"), ("correction-verifier-2", "w", "h3", "qualified")], "role string, route_id string, qualification_hash string, status string")
    ledger = spark.createDataFrame(
        [("ok", "p", ["v", "w"], ["h1", "h3"]), ("swapped", "p", ["w", "v"], ["h3", "h1"]), ("old", "p", ["v", "w"], ["h1", "h2"]), ("none", "x", ["v", "u"], ["h9", "h3"]), ("one", "p", ["v"], ["h1"]), ("null", "p", None, None)],
        "root_record_id string, proposer_route string, verifier_routes array<string>, verifier_qualification_hashes array<string>",
    )
    assert sorted(map(tuple, release.binding_findings(ledger, q).collect())) == [
        ("none", "route:correction-proposer"), ("none", "route:correction-verifier-2"), ("none", "unknown:correction-verifier-1"), ("null", "verifiers"), ("old", "status:correction-verifier-2"), ("one", "verifiers"), ("swapped", "role:correction-verifier-1"), ("swapped", "role:correction-verifier-2"),
    ]


def test_runs_that_differ_are_unstable(spark):
    schema = "case_id int, family string, locale string, predicted string"
    first = spark.createDataFrame([(i, "f", "en" if i < 5 else "de", "pass") for i in range(10)], schema)
    second = spark.createDataFrame([(i, "f", "en" if i < 5 else "de", "defect" if i == 7 else "pass") for i in range(9)], schema)
    assert [tuple(r) for r in release.unstable(first, second).collect()] == [("f", "de", 0.4)]
    assert release.unstable(first, first).count() == 0 and release.unstable(first, second, 0.5).count() == 0


def test_totals_against_the_ceiling(spark):
    seen = spark.createDataFrame([("a", 5), ("b", 7)], "stratum string, sample long")
    assert [tuple(r) for r in release.sample_against(seen, 11).collect()] == [(12, 11, False)]
    assert [tuple(r) for r in release.sample_against(seen.limit(0), 0).collect()] == [(0, 0, True)]


def test_answers_have_a_ceiling_too(spark):
    from loomlex.operators import review

    requests = spark.createDataFrame([(i, i, "x", 40) for i in range(6)], "request_id int, place int, route string, size long")
    none = spark.createDataFrame([], "request_id int, route string")
    admitted = lambda **c: review.dispatch(requests, none, {"x": (1.0, 1.0)}, 100, c).where("status = 'admitted'").count()
    assert admitted(output_tokens=350) == 3 and admitted(requests=5, output_tokens=1000) == 5 and admitted(tokens=25) == 2
