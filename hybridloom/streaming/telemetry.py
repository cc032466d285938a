"""Event-time windows over ingest telemetry, the same plan for batch and streaming input."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def timed(events: DataFrame, delay: str | None = None) -> DataFrame:
    """Cast the naive timestamp, since watermarks need an instant."""
    out = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return out.withWatermark("ts", delay) if delay else out


def windowed(events: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """Count and sum per event type in tumbling or sliding windows."""
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    return (events.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
            .select(F.col("w.start").alias("window_start"), "event_type", "n", "total"))


def sessions(events: DataFrame, gap: str, key: str = "user_id") -> DataFrame:
    """Sessions of a key that end after ``gap`` of silence; merged in each task first, so a busy key isn't sorted whole in one."""
    events.sparkSession.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    return (events.groupBy(F.session_window("ts", gap).alias("w"), key).agg(F.count("*").alias("n"))
            .select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n"))


def gaps(events: DataFrame, key: str, time: str, tie: str, part_seconds: int = 600) -> DataFrame:
    """Seconds since the previous event of the key, without sorting a whole busy key in one task.

    Events are ranked inside (key, part of ``part_seconds``); the first of a part continues from the last event of the key's
    previous part, found in a summary of one row per key and part that is combined before the shuffle.
    """
    stamp = F.unix_micros(F.col(time).cast("timestamp"))
    rows = events.withColumn("_us", stamp).withColumn("_part", F.floor(F.col("_us") / (part_seconds * 1_000_000)))
    parts = rows.groupBy(key, "_part").agg(F.max("_us").alias("_last"))
    before = parts.withColumn("_before", F.lag("_last").over(Window.partitionBy(key).orderBy("_part"))).select(key, "_part", "_before")
    inside = F.lag("_us").over(Window.partitionBy(key, "_part").orderBy("_us", tie))
    joined = rows.withColumn("_previous", inside).join(before, [key, "_part"])
    return joined.withColumn("gap", (F.col("_us") - F.coalesce("_previous", "_before")) / 1e6).drop("_us", "_part", "_previous", "_before")


def deduplicated(events: DataFrame, keys: list[str]) -> DataFrame:
    return events.dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)
