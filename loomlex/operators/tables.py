"""What operators share: schemas, null-safe joins, tables that cut lineage, and broadcasts behind a check of size."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRIPLES = "subject string, subject_kind string, predicate string, object string, object_kind string, language string, datatype string"
RDF, RDFS, OWL = "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/2000/01/rdf-schema#", "http://www.w3.org/2002/07/owl#"
SKOS, XSD = "http://www.w3.org/2004/02/skos/core#", "http://www.w3.org/2001/XMLSchema#"
LABELS = {"rdfs:label": RDFS + "label", "skos:prefLabel": SKOS + "prefLabel", "skos:altLabel": SKOS + "altLabel", "skos:hiddenLabel": SKOS + "hiddenLabel"}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a local folder only where it is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.loomlex.shared.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        at = "file://" + tempfile.mkdtemp(prefix="loomlex-shared-")
        spark.conf.set("spark.loomlex.shared.dir", at)
    return at if "://" in at else f"file://{os.path.abspath(at.removeprefix('file:'))}"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files on the executors' disks, where they else lie until the driver's next collection of garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def stored(df: DataFrame, what: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends here, and a lost executor costs nothing that is done."""
    at = f"{shared_dir(df.sparkSession).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    with swept(df.sparkSession):
        df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A semi or anti join in which nulls are equal."""
    r = right.select(*(F.col(k).alias(f"_r_{k}") for k in keys))
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, how)


def dealt(df: DataFrame) -> DataFrame:
    """df by a hash of whole rows, ahead of distinct(): else each task of the scan first gathers all its rows in memory."""
    return df.repartition(*df.columns)


def json_lines(df: DataFrame) -> DataFrame:
    """(line): each row as JSON with its keys sorted and nulls kept."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("line"))
