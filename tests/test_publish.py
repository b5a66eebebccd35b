"""Publications: one result whatever fails, the same bytes whatever the dealing, refusal of others."""

import os

import pytest
from pyspark.sql import functions as F

from loomlex.sources import publish


def document(path):
    return "".join((path / n).read_text() for n in publish.read_manifest(str(path))["parts"])


def test_parts_in_order_make_the_document(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("n"), F.concat(F.lit("a\tb "), "id").alias("t"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("e"))
    want = "# k: v\n# m:\n#   a: b\nn\tt\te\n" + "".join(f"{n}\ta b {n}\t{'x' if n % 3 else ''}\n" for n in sorted(range(1000), key=str))
    told = publish.publish_tsv(df.repartition(7), str(tmp_path / "p"), ["n", "t", "e"], ["n"], {"k": "v", "m": {"a": "b"}})
    assert told["lines"] == 1000 and document(tmp_path / "p") == want
    again = publish.publish_tsv(df.repartition(3), str(tmp_path / "p"), ["n", "t", "e"], ["n"], {"k": "v", "m": {"a": "b"}})
    assert again == told
    before = sorted(os.listdir(tmp_path / "p"))
    for other, head in ((df.limit(999), {"k": "v", "m": {"a": "b"}}), (df, {"k": "w"})):
        with pytest.raises(FileExistsError):
            publish.publish_tsv(other, str(tmp_path / "p"), ["n", "t", "e"], ["n"], head)
    assert sorted(os.listdir(tmp_path / "p")) == before and document(tmp_path / "p") == want
    publish.join_parts(spark, str(tmp_path / "p"), str(tmp_path / "one.tsv"))
    publish.join_parts(spark, str(tmp_path / "p"), str(tmp_path / "one.tsv"))
    assert (tmp_path / "one.tsv").read_text() == want
    (tmp_path / "one.tsv").write_text("else")
    with pytest.raises(FileExistsError):
        publish.join_parts(spark, str(tmp_path / "p"), str(tmp_path / "one.tsv"))
    assert sorted(os.listdir(tmp_path)) == ["one.tsv", "p"]


def test_failures_leave_nothing(spark, tmp_path):
    bad = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id").cast("string")).alias("line"))
    with pytest.raises(Exception, match="no"):
        publish.publish_lines(bad, str(tmp_path / "q"))
    assert publish.read_manifest(str(tmp_path / "q")) is None and not [n for _, _, names in os.walk(tmp_path / "q") for n in names if n.startswith("part-")]
    with pytest.raises(FileNotFoundError):
        publish.join_parts(spark, str(tmp_path / "q"), str(tmp_path / "x"))
    publish.publish_lines(spark.range(3).select(F.col("id").cast("string")), str(tmp_path / "q"))
    assert document(tmp_path / "q") == "0\n1\n2\n"


def test_a_task_that_runs_again_leaves_one_part(tmp_path, monkeypatch):
    """Two attempts of one partition write; the commit gets the message of the second, and only its lines stay."""
    import pyarrow as pa

    class Context:
        attempt = 0

        def partitionId(self):  # noqa: N802
            return 0

        def taskAttemptId(self):  # noqa: N802
            Context.attempt += 1
            return Context.attempt

    monkeypatch.setattr(publish.TaskContext, "get", classmethod(lambda cls: Context()))
    writer = publish.LinesWriter({"path": str(tmp_path / "r"), "header": "h\n", "footer": "f\n"})
    batch = pa.RecordBatch.from_pydict({"line": ["a", None]})
    writer.write(iter([batch]))
    writer.commit([writer.write(iter([batch])), None])
    assert document(tmp_path / "r") == "h\na\n\nf\n" and len(os.listdir(tmp_path / "r")) == 4
    writer.abort([])


def test_empty_tables(spark, tmp_path):
    told = publish.publish_tsv(spark.range(0), str(tmp_path / "e"), ["id"], ["id"])
    assert told["lines"] == 0 and document(tmp_path / "e") == "id\n"


def test_a_batch_of_long_lines_is_not_copied(tmp_path, monkeypatch):
    """A writer holds a line at a time beside its batch."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    from loomlex.sources import publish

    monkeypatch.setattr(publish.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0, taskAttemptId=lambda: 0))
    batch = pa.RecordBatch.from_pydict({"line": ["x" * 10_000] * 2000})
    tracemalloc.start()
    part = publish.LinesWriter({"path": f"file://{tmp_path}/out"}).write(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print("peak", peak)
    assert part.lines == 2000 and peak < 10_000_000
