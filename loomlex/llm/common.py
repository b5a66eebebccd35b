"""Helpers that the training-data operators share: planning sizes, shared folders and Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of the vectorised kernels holds, so that their arrays stay within a few tens of MB.
STEP_BYTES = 1 << 20
#: Spark's estimate for data whose size it can't tell is near the largest long; no table is so large.
UNKNOWN = 1 << 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def input_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of df's size: file sizes for a scan, without running anything."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def parts_for(df: DataFrame, target: int) -> int:
    """A partition count that follows the input's size, and never falls below the session's, which also stands where the size is not known."""
    spark = df.sparkSession
    floor, size = int(spark.conf.get("spark.sql.shuffle.partitions")), input_bytes(df)
    return max(floor, -(-size // target)) if size < UNKNOWN else floor


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see. A local one is set only where the session names none (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        at = spark.conf.get("spark.loomlex.shared.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        at = "file://" + tempfile.mkdtemp(prefix="loomlex-shared-")
        spark.conf.set("spark.loomlex.shared.dir", at)
    return at if "://" in at else f"file://{os.path.abspath(at.removeprefix('file:'))}"


def new_dir(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """df as a table in the shared folder, which cuts its lineage and outlives a lost executor."""
    spark = df.sparkSession
    at = new_dir(spark, what)
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def release(spark: SparkSession) -> None:
    """Lets Spark drop shuffle files that no plan refers to any more, before the next large step writes its own."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def filesystem(uri: str):
    """pyarrow's file system for a URI, and the path within it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as UTF-8, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()).to_pylist()]


def steps(sizes: Iterable[int], most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Cuts consecutive items into runs of about `most` bytes; a longer item is a run of its own."""
    start = total = i = 0
    for i, n in enumerate(sizes, 1):
        total += n
        if total >= most:
            yield start, i
            start, total = i, 0
    if start < i:
        yield start, i


def map_batches(df: DataFrame, kernel: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """kernel over each Arrow batch of df."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield kernel(batch)

    return df.mapInArrow(run, schema)


def text_of(df: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Only the named columns and the text, as a string."""
    return df.select(*keep, F.col(text).cast("string").alias("text"))
