"""Requests and their receipts as one keyed stream: each request waits for a receipt, and what none answers is admitted once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import review
from ..operators.tables import stored
from . import pointers
from .census import run_available

#: What the stream holds: kind is "request", "receipt", or "seal", a row without an id that only moves time on.
ROWS = "at timestamp, kind string, request_id string, route string, size long"
STATUSES = "request_id string, at timestamp, route string, status string, tokens long, cost double"


_ASKED = ["at", "request_id", "route", "size"]
#: Requests that are not settled yet with what is known of their receipts, and receipts that requests may still come for.
OPEN = "at timestamp, request_id string, route string, size long, told boolean, same boolean"
RECEIPTS = "at timestamp, request_id string, route string"


def answered(requests: DataFrame, receipts: DataFrame, wait: str) -> DataFrame:
    """OPEN rows of requests, each once, with what these receipts add to what is known: told by one within `wait` before or after, the same by one of the request's route."""
    # Requests without an id have no receipt; they are dealt by what they hold.
    spread = F.when(F.col("request_id").isNull(), F.xxhash64("at", "route", "size")).otherwise(F.lit(0))
    told = receipts.where("request_id IS NOT NULL").select(F.col("at").alias("told_at"), F.col("request_id").alias("told_id"), F.col("route").alias("told_route"), F.lit(0).cast("long").alias("_told")).distinct()
    near = F.expr(f"request_id = told_id AND _spread = _told AND told_at >= at - INTERVAL {wait} AND told_at <= at + INTERVAL {wait}")
    both = requests.withColumn("_spread", spread).join(told, near, "left_outer")
    found = F.col("told_at").isNotNull()
    return both.groupBy(*_ASKED).agg(F.max(F.col("told") | found).alias("told"), F.max(F.col("same") | (found & F.col("told_route").eqNullSafe(F.col("route")))).alias("same"))


class Dispatcher:
    """Admits, batch by batch, the requests that no receipt answers, within ceilings that hold for the whole stream.

    Order is that of time, then id (none first), so that the statuses are those of `review.dispatch` over all requests at once, however
    the rows arrived. A batch's statuses are written before the pointer that names them and the sums so far, in a folder
    that all executors see: a batch that ran half is run again from the sums before it, one handed over again is passed by.

    When time has passed a request by `wait`, it is settled: "receipt" if a receipt of its route lies within `wait` of it,
    before or after, "route-mismatch" if only receipts of other routes do, else "missing". What is open stands in tables
    that the pointer names too: a batch joins its rows with them, writes them anew, and drops what time has passed, so that
    much at once is one join that spills, not state in memory. Rows come in any order, up to `late` behind the newest of the
    batches before; what is later is left out and counted in the pointer ("late"), so `late` has to cover it. Equal requests
    are one, others that share an id stand each for themselves, and one without an id is missing. Receipts that no request
    asks for are forgotten. The last requests stay open until rows, or a seal wait + late after them, move time on. A null
    `at` is an error.
    """

    def __init__(self, spark: SparkSession, at: str, prices: dict[str, tuple[float, float]], most_output: int, ceilings: dict[str, float]):
        self.spark, self.at, self.prices, self.most_output, self.ceilings = spark, at.rstrip("/"), prices, most_output, ceilings

    def _last(self, number: int) -> tuple[dict | None, bool]:
        """The pointer of the last whole batch, and whether it stands for batch `number` too."""
        last = next(iter(pointers.held(self.at, 1)), None)
        return last, last is not None and number <= last["batch"]

    def settle(self, batch: DataFrame, number: int, wait: str, late: str) -> None:
        """ROWS of a micro-batch: takes the requests that time has passed, and keeps the others."""
        last, known = self._last(number)
        if known:
            return
        kept = last.get("open") if last else None
        table = lambda name, schema: self.spark.read.schema(schema).parquet(f"{self.at}/{kept[name]}") if kept else self.spark.createDataFrame([], schema)
        rows = stored(batch.withColumn("at", F.coalesce("at", F.raise_error(F.lit("a row without its time")).cast("timestamp"))), "rows")
        before = kept["time"] if kept else None
        in_time = F.lit(True) if before is None else F.col("at") >= F.timestamp_micros(F.lit(before))
        seen = rows.agg(F.unix_micros(F.max("at") - F.expr(f"INTERVAL {late}")).alias("time"), F.count_if(~in_time).alias("late")).first()
        time = max((t for t in (before, seen["time"]) if t is not None), default=None)
        if time is None:
            return
        passed = F.timestamp_micros(F.lit(time)) - F.expr(f"INTERVAL {wait}")
        rows = rows.where(in_time)
        receipts = table("receipts", RECEIPTS).unionByName(rows.where("kind = 'receipt'").select("at", "request_id", "route"))
        none = F.lit(False)
        requests = table("requests", OPEN).unionByName(rows.where("kind = 'request'").select(*_ASKED, none.alias("told"), none.alias("same")))
        whole = stored(answered(requests, receipts, wait), "answered")
        name = f"{number:08d}-{uuid.uuid4().hex}"
        whole.where(F.col("at") >= passed).write.parquet(f"{self.at}/{name}-requests")
        receipts.where((F.col("at") >= passed) & F.col("request_id").isNotNull()).distinct().write.parquet(f"{self.at}/{name}-receipts")
        status = F.when(F.col("same"), "receipt").when(F.col("told"), "route-mismatch").otherwise("missing")
        done = whole.where(F.col("at") < passed).select(*_ASKED, F.lit("request").alias("kind"), status.alias("status"))
        held = {"time": time, "late": seen["late"] + (kept["late"] if kept else 0), "requests": f"{name}-requests", "receipts": f"{name}-receipts"}
        self.take(done, number, held)

    def take(self, batch: DataFrame, number: int, kept: dict | None = None) -> None:
        """Settled requests (at, kind, request_id, route, size, status); kept: what the pointer says of those that are not."""
        last, known = self._last(number)
        if known:
            return
        before = last["sums"] if last else {"requests": 0, "tokens": 0, "cost": 0.0}
        rows = stored(review.priced(batch.where("kind = 'request'"), self.prices, self.most_output).withColumn("place", F.struct("at", "request_id", "route", "size")), "settled")
        names = [f.split()[0] for f in STATUSES.split(", ")]
        misses = review.admitted(rows.where("status = 'missing'").drop("status"), self.most_output, self.ceilings, before)
        table = f"{number:08d}-{uuid.uuid4().hex}"
        rows.where("status <> 'missing'").select(*names).unionByName(misses.select(*names)).write.parquet(f"{self.at}/{table}")
        new = self.spark.read.schema(STATUSES).parquet(f"{self.at}/{table}").where("status IN ('admitted', 'refused')")
        added = new.agg(F.count(F.lit(1)).alias("requests"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost")).first()
        pointers.put(self.at, number, {"batch": number, "tables": table, "sums": {k: before[k] + added[k] for k in before}, "open": kept})

    def run(self, rows: DataFrame, checkpoint: str, wait: str, late: str) -> None:
        """Takes what the stream of ROWS holds now."""
        run_available(rows, lambda batch, number: self.settle(batch, number, wait, late), checkpoint)

    def statuses(self) -> DataFrame:
        """STATUSES of all requests that are settled."""
        found = [f"{self.at}/{p['tables']}" for p in pointers.held(self.at)]
        return self.spark.read.schema(STATUSES).parquet(*found) if found else self.spark.createDataFrame([], STATUSES)
