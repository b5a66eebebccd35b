"""Incremental censuses over event streams: an extension, in Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, ts: str = "ts", by: str = "event_type", width: str = "1 hour", late: str | None = "2 hours") -> DataFrame:
    """(window_start, by, n, total) per tumbling window; the same plan for batches (late=None) and streams."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    rows = rows.withWatermark(ts, late) if late else rows
    out = rows.groupBy(F.window(ts, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), by, "n", "total")


def sessions(events: DataFrame, user: str = "user_id", ts: str = "ts", gap: str = "30 minutes", late: str | None = "2 hours") -> DataFrame:
    """(user, start, end, n) of runs of events without a longer gap."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    rows = rows.withWatermark(ts, late) if late else rows
    out = rows.groupBy(F.session_window(ts, gap).alias("w"), user).agg(F.count(F.lit(1)).alias("n"))
    return out.select(user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def deduplicated(events: DataFrame, key: str = "event_id", ts: str = "ts", late: str = "2 hours") -> DataFrame:
    """The first event of each key within the watermark."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, sink, checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over what is there now; sink(batch, number) gets each micro-batch, exactly once by its number."""
    q = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
