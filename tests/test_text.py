import pytest
from pyspark.sql import functions as F

from loomlex.functions import identity, stats, text


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("raw", "want"),
    [(" ＬＩＣＥＮＳＥ_test/A-B (One) (Two) ", "license test a b (one)"), ("", ""), (None, None), ("Straße", "strasse"), ("a  (b)", "a"), ("(b)", ""), ("x–y", "x–y"), ("ﬁne\tart", "fine art")],
)
def test_normalize(spark, raw, want):
    assert one(spark, raw, text.normalize) == want
    if raw is not None:
        assert text.normalize_text(raw) == want


@pytest.mark.parametrize(("w", "want"), [("parties", "party"), ("ties", "tie"), ("boxes", "box"), ("is", "is"), ("running", "runn"), ("payment", "pay"), ("ment", "ment"), ("quickly", "quick"), ("ed", "ed")])
def test_stem(spark, w, want):
    assert one(spark, w, text.stem) == want


def test_content_stems_drop_stop_words_first(spark):
    assert set(one(spark, "the courts of being paid café", text.content_stems)) == {"court", "paid", "café"}


@pytest.mark.parametrize(("form", "want"), [("breach of contract", "breach"), ("of counsel", "counsel"), ("law", "law"), ("duty to act in court", "duty"), ("", None)])
def test_head_word(spark, form, want):
    assert one(spark, form, lambda c: text.head_word(text.words(c))) == want


def test_three_decimals_round_the_binary_value(spark):
    rows = spark.createDataFrame([(0.5625,), (0.4065,), (None,)], "x double").select(text.three_decimals("x")).collect()
    assert [r[0] for r in rows] == ["0.562", "0.406", None]


def test_canonical_json_and_hashes(spark):
    import hashlib
    import json

    row = ("s", "p", 'a "q"\n\\', None)
    got = spark.createDataFrame([row], "s string, p string, l string, g string").select(identity.canonical_json(subject=F.col("s"), predicate=F.col("p"), lexical=F.col("l"), language=F.col("g"))).first()[0]
    want = json.dumps({"subject": "s", "predicate": "p", "lexical": row[2], "language": None}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert got == want
    assert spark.range(1).select(identity.content_hash(F.lit(want))).first()[0] == hashlib.sha256(want.encode()).hexdigest()


def test_families(spark):
    names = ["R" + "a" * 20, "R" + "0" * 23, "R" + "a_" * 10, "a" * 21 + "-", "a" * 18 + "Q", "x", "R" + "a" * 20 + "\n"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "x string").select(identity.family(F.col("x"))).collect()]
    assert got == ["canonical", "legacy-hex", "legacy-r-base64url", "legacy-uuid", "legacy-16-bytes", "nonconforming", "nonconforming"]


def test_statistics(spark):
    r = spark.range(1).select(stats.sample_size(F.lit(1000), 0.95, 0.05), stats.sample_size(F.lit(1), 0.95, 0.05), stats.wilson_upper(F.lit(0), F.lit(0), 0.95), F.round(stats.wilson_upper(F.lit(5), F.lit(100), 0.95), 4)).first()
    assert (r[0], r[1], r[2]) == (278, 1, 1.0) and 0.09 < r[3] < 0.11
