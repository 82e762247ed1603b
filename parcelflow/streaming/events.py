"""Streaming counterparts: windows with watermarks, deduplication, and incremental upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def tumbling(events: DataFrame, length: str = "1 day", late: str = "2 days") -> DataFrame:
    w = F.window("ts", length)
    out = events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, length: str = "1 day", slide: str = "6 hours", late: str = "2 days") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.window("ts", length, slide), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "2 hours", late: str = "2 days") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def unique(events: DataFrame, late: str = "21 days", key: str = "event_id") -> DataFrame:
    """The first event of each key; keys are remembered for as long as data may be late."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def upsert_each_batch(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str):
    """Start a query that merges each micro-batch and stops when all there is has been read."""
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
