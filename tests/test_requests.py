"""Requests as a keyed stream against plain Python and against the batch plan, in any order of arrival and after restarts."""

import datetime as dt
import random

import pytest

from loomlex.operators import review
from loomlex.streaming.requests import ROWS, STATUSES, Dispatcher

PRICES = {"a": (1.0, 2.0), "b": (0.5, 1.0)}
START = dt.datetime(2024, 1, 1)
minute = lambda n: START + dt.timedelta(minutes=n)


def made(seed: int) -> list[tuple]:
    """Requests a minute or less apart, and up to three receipts for some, before or after them, in time or not."""
    r = random.Random(seed)
    rows = []
    for i in range(80):
        at = r.randrange(60)
        rows.append((minute(at), "request", f"r{i}", r.choice("ab"), r.choice([None, r.randrange(400)])))
        rows += [(minute(at + r.randint(-15, 15)), "receipt", f"r{i}", r.choice("ab"), None) for _ in range(r.choice([0, 0, 1, 3]))]
    rows += [x for x in rows if x[1] == "request"][:9] + [(minute(70), "request", "r1", "a", 3)]  # repeated rows, and an id asked for again
    return rows + [(minute(5), "receipt", "nobody", "a", None), (minute(7), "request", None, "a", 8), (minute(9), "request", None, "b", 8)]


def expected(rows, wait: int, most: int) -> set:
    receipts = [x for x in rows if x[1] == "receipt"]
    out, misses = set(), []
    for at, _, name, route, _ in {x for x in rows if x[1] == "request"}:
        near = {x[3] for x in receipts if x[2] == name and abs((x[0] - at).total_seconds()) <= wait * 60}
        if near and name is not None:
            out.add((name, at, "receipt" if route in near else "route-mismatch"))
        else:
            misses.append((at, name))
    return out | {(name, at, "admitted" if i < most else "refused") for i, (at, name) in enumerate(sorted(misses, key=lambda x: (x[0], x[1] or "")))}


def statuses(df) -> list:
    return [(x["request_id"], x["at"], x["status"]) for x in df.collect()]


def write(spark, rows, path) -> None:
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("seed", range(2))
def test_statuses_do_not_depend_on_arrival(spark, tmp_path, seed):
    """Rows arrive up to 20 minutes late; the stream is stopped and started again between files."""
    r = random.Random(seed + 10)
    rows = sorted(made(seed), key=lambda x: (x[0] - START).total_seconds() + r.uniform(0, 1100))
    path = f"file://{tmp_path}/in"
    new = lambda: Dispatcher(spark, f"file://{tmp_path}/out", PRICES, 10, {"requests": 25})
    stream = lambda: spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(path)
    step = len(rows) // 3 + 1
    seen = []
    for k in range(0, len(rows), step):
        write(spark, rows[k : k + step], path)
        new().run(stream(), str(tmp_path / "check"), "10 minutes", "20 minutes")
        seen.append(set(statuses(new().statuses())))
    write(spark, [(minute(200), "seal", None, None, None)], path)
    new().run(stream(), str(tmp_path / "check"), "10 minutes", "20 minutes")
    got = statuses(new().statuses())
    want = expected(rows, 10, 25)
    assert len(got) == len(want) and set(got) == want and {"admitted", "refused", "receipt", "route-mismatch"} == {x[2] for x in got}
    assert seen[0] < seen[1] < seen[2] < want  # settled as time moves on, and never taken back
    new().run(stream(), str(tmp_path / "check"), "10 minutes", "20 minutes")  # nothing new
    assert statuses(new().statuses()) == got


def test_admission_equals_the_batch_plan_and_happens_once(spark, tmp_path):
    """Every ceiling binds somewhere; batches that are handed over again, or ran half, change nothing."""
    r = random.Random(3)
    asked = [(f"r{i:03d}", minute(i), r.choice("ab"), r.randrange(4000)) for i in range(60)]
    names = "request_id string, at timestamp, route string, size long"
    requests = spark.createDataFrame(asked, names)
    receipts = requests.limit(0).select("request_id", "route")
    for n, ceilings in enumerate(({"requests": 20}, {"tokens": 9000}, {"output_tokens": 300}, {"cost": 0.01}, {})):
        run = Dispatcher(spark, f"file://{tmp_path}/{n}", PRICES, 10, ceilings)
        parts = [spark.createDataFrame([(*x, "missing", "request") for x in asked[k : k + 25]], names + ", status string, kind string") for k in (0, 25, 50)]
        run.take(parts[0], 0)
        (tmp_path / str(n) / "00000001-half").mkdir()  # a batch without its pointer
        run.take(parts[1], 1)
        run.take(parts[1], 1)
        run.take(parts[0], 0)
        run.take(parts[2], 2)
        whole = review.dispatch(requests.withColumnRenamed("at", "place"), receipts, PRICES, 10, ceilings)
        rows = lambda df: sorted((x["request_id"], x["status"], x["tokens"], round(x["cost"], 9)) for x in df.collect())
        assert rows(run.statuses()) == rows(whole)


def test_nothing_asked(spark, tmp_path):
    run = Dispatcher(spark, f"file://{tmp_path}/out", PRICES, 10, {})
    assert run.statuses().collect() == []
    run.take(spark.createDataFrame([], "request_id string, at timestamp, route string, size long, status string, kind string"), 0)
    assert run.statuses().collect() == [] and run.statuses().schema.simpleString() == spark.createDataFrame([], STATUSES).schema.simpleString()


def test_late_rows_are_counted_and_what_is_open_is_in_tables(spark, tmp_path):
    """What a batch leaves open is read by the next from tables that the pointer names; a row behind time is left out and counted."""
    from loomlex.streaming import pointers

    path = f"file://{tmp_path}/in"
    new = lambda: Dispatcher(spark, f"file://{tmp_path}/out", PRICES, 10, {})
    for rows in ([(minute(0), "request", "r", "a", 4), (minute(12), "receipt", "s", "b", None)], [(minute(8), "receipt", "r", "a", None), (minute(20), "request", "s", "a", 4)], [(minute(3), "request", "old", "a", 4), (minute(60), "seal", None, None, None)]):
        write(spark, rows, path)
        new().run(spark.readStream.schema(ROWS).parquet(path), str(tmp_path / "check"), "10 minutes", "10 minutes")
    assert set(statuses(new().statuses())) == {("r", minute(0), "receipt"), ("s", minute(20), "route-mismatch")}
    last = pointers.held(f"file://{tmp_path}/out", 1)[0]["open"]
    assert last["late"] == 1 and spark.read.parquet(f"file://{tmp_path}/out/{last['requests']}").count() == 0
