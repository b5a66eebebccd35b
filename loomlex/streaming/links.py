"""Links that follow a stream of changed labels: each micro-batch ranks only the concepts that it concerns."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import lexical
from ..operators.changes import difference
from . import pointers
from .census import run_available

#: A change of a label: seq orders changes, op is "add" or "remove".
CHANGE = "seq long, op string, subject string, text string, field string"
_TABLES = ("labels", "concepts", "senses", "looked", "links")
_LABEL = ["subject", "text", "field"]


class Follower:
    """Keeps a vocabulary's links up to date in a folder that all executors see.

    Each batch's tables are written before the pointer that names them, so that a batch is taken once: one that ran half
    is run again from the tables before it, and one that the stream hands over again is passed by.
    """

    def __init__(self, spark: SparkSession, at: str, make: Callable[[DataFrame], DataFrame], priors: dict = lexical.PRIORS, ascii_only: bool = False):
        self.spark, self.at, self.make, self.priors, self.ascii_only = spark, at.rstrip("/"), make, priors, ascii_only

    def _keep(self, now: lexical.Linked, number: int, touched: int) -> None:
        name = f"{number:08d}-{uuid.uuid4().hex}"
        for t in _TABLES:
            getattr(now, t).write.parquet(f"{self.at}/{name}/{t}")
        pointers.put(self.at, number, {"batch": number, "tables": name, "touched": touched})

    def pointer(self) -> dict | None:
        """The last batch that is whole: its number (0 for the start), tables, and how many concepts it looked at."""
        return next(iter(pointers.held(self.at, 1)), None)

    def state(self) -> lexical.Linked:
        name = self.pointer()["tables"]
        return lexical.Linked(*(self.spark.read.parquet(f"{self.at}/{name}/{t}") for t in _TABLES))

    def start(self, labels: DataFrame, senses: DataFrame) -> None:
        """Links from scratch, unless the folder holds some."""
        if self.pointer() is None:
            self._keep(lexical.linked(labels, self.make(labels), senses, self.priors, self.ascii_only), 0, labels.select("subject").distinct().count())

    def take(self, batch: DataFrame, number: int) -> None:
        """A batch of CHANGE rows; of several changes of one label the last counts."""
        if number + 1 <= self.pointer()["batch"]:
            return
        held = self.state()
        last = batch.withColumn("_n", F.row_number().over(W.partitionBy(*_LABEL).orderBy(F.desc("seq"), "op"))).where("_n = 1")
        labels = difference(held.labels, last.select(*_LABEL), _LABEL).unionByName(last.where("op = 'add'").select(*held.labels.columns))
        now, touched = lexical.refresh(held, labels, self.make(labels), held.senses, self.priors, self.ascii_only)
        self._keep(now, number + 1, touched.count())

    def run(self, changes: DataFrame, checkpoint: str) -> None:
        """Takes what the stream of CHANGE rows holds now."""
        run_available(changes, self.take, checkpoint)
