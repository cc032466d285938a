"""Windows over the events table and incremental ingest of documents.

Windows are an extension: the batch form is checked against SQL, the streaming form runs the same
plan over a file stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.session import work_folder
from hybridloom.streaming import incremental, telemetry
from hybridloom.workload import tables as tb
from hybridloom.workload.registry import query

_TUMBLING = """SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"""


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.timed(tb.table(spark, sf, "events"))


def _table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of part files: by a pattern, because a plain path has to be a folder."""
    return incremental.file_stream(spark, f"{sf}/{name}[.]parquet", tb.table(spark, sf, name).schema)


def _stamp(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def _shown(df: DataFrame) -> DataFrame:
    return df.select(_stamp("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("events_tumbling", _TUMBLING)
def events_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(telemetry.windowed(_events(spark, sf), "1 hour"))


@query("events_sliding", """SELECT strftime(time_bucket(INTERVAL 10 MINUTE, ts) - to_minutes(10 * k), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total
FROM events, (SELECT unnest(range(0, 3)) AS k) GROUP BY 1, 2""")
def events_sliding(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(telemetry.windowed(_events(spark, sf), "30 minutes", "10 minutes"))


@query("events_session", """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, strftime(max(ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS n FROM s GROUP BY user_id, no""")
def events_session(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.sessions(_events(spark, sf), "1 hour").select("user_id", _stamp("session_start"), _stamp("session_end"), "n")


@query("dedupe_events", "SELECT DISTINCT user_id, event_type FROM events")
def dedupe_events(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.deduplicated(_events(spark, sf), ["user_id", "event_type"]).select("user_id", "event_type")


@query("events_stream", _TUMBLING)
def events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The tumbling windows computed by a stream over the events file, kept in complete snapshots."""
    folder = work_folder(spark, "events")
    stream = _table_stream(spark, sf, "events")
    incremental.run_available(telemetry.windowed(telemetry.timed(stream, "1 hour"), "1 hour"), f"{folder}/state",
                              incremental.snapshot(f"{folder}/out"), "complete")
    latest = spark.read.parquet(f"{folder}/out")
    last = latest.agg(F.max("snapshot")).first()[0]
    return _shown(latest.filter(F.col("snapshot") == last))


@query("incremental_ingest", "SELECT doc_id AS id, source AS source_file, n_chars FROM documents")
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Documents appended by a file stream, and again by a second run that must add nothing."""
    folder = work_folder(spark, "ingest")
    for run in ("first", "second"):
        stream = _table_stream(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("source_file"), "n_chars")
        target = f"{folder}/points"
        handler = incremental.append_once(target, ["id"])
        # The second run has a fresh checkpoint and numbers its batches from 0 again.
        incremental.run_available(stream, f"{folder}/state-{run}", handler)
    stored = incremental.read_once(spark, f"{folder}/points")
    # A table without rows stores nothing.
    return (stream.sparkSession.createDataFrame([], stream.schema) if stored is None else stored).select("id", "source_file", "n_chars")
