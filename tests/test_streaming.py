from loomlex.streaming import census


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = []
    census.run_available(census.windowed_counts(stream, late="3650 days"), lambda b, n: got.append((n, [tuple(r) for r in b.collect()])), str(tmp_path / "ck"), "complete")
    want = sorted((r[0], r[1], r[2]) for r in census.windowed_counts(events, late=None).collect())
    assert sorted((r[0], r[1], r[2]) for r in got[-1][1]) == want


def test_sessions(spark):
    e = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:10:00"), (1, "2024-01-01 02:00:00")], "user_id int, t string").selectExpr("user_id", "cast(t as timestamp) ts")
    assert sorted(r["n"] for r in census.sessions(e, late=None).collect()) == [1, 2]
