"""Session helpers: builder defaults, lineage cuts and checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A side of at most this many rows may be broadcast; larger sides shuffle.
BROADCAST_ROW_LIMIT = 200_000
# ... and of at most this many bytes.
BROADCAST_BYTE_LIMIT = 64 << 20
# A table of at most this many bytes may be spread over the cores by a shuffle.
SPREAD_BYTES = 1 << 30
# Arrow batches of text end at this many bytes; by rows alone, 10,000 texts may be held several times over by every worker.
BATCH_BYTES = 8 << 20


def build_session(app: str = "hybridloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Sessions of a busy key are merged inside each input task before the shuffle.
        "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def own_folder(spark: SparkSession) -> str:
    """A temporary folder where driver and tasks share one machine; elsewhere the cluster has to name a shared one."""
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="hybridloom-")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables, inside the shared folder the cluster names."""
    base = spark.conf.get("spark.checkpoint.dir", None) or own_folder(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the folder the cluster names; a temporary one only where none is set."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or own_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def row_bytes(df: DataFrame) -> Column:
    """Size of a row: its strings as they are, nested values as JSON, eight bytes for the rest."""
    sizes = {"string": F.octet_length, "binary": F.octet_length}
    each = [F.coalesce(sizes[kind](F.col(f"`{c}`")), F.lit(0)) if kind in sizes
            else F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0)) if kind.startswith(("array", "struct", "map")) else F.lit(8)
            for c, kind in df.dtypes]
    return reduce(lambda a, b: a + b, each, F.lit(0)).cast("long")


def fits(df: DataFrame, rows: int = BROADCAST_ROW_LIMIT, size: int = BROADCAST_BYTE_LIMIT) -> bool:
    """True when ``df`` has at most ``rows`` rows and ``size`` bytes; reads no more than ``rows + 1`` of them."""
    found = df.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
    return found["n"] <= rows and found["b"] <= size


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast hint when the size check passes, otherwise leave the join to the shuffle."""
    return F.broadcast(df) if fits(df, rows) else df


def broadcast_within(df: DataFrame, bound: int, rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast hint for a frame whose row bound is known by construction (queries x k)."""
    return F.broadcast(df) if bound <= rows else df


def small_batches(spark: SparkSession) -> None:
    """Lower the bytes of an Arrow batch to BATCH_BYTES, unless the session asks for less."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = re.fullmatch(r"(-?\d+)b?", spark.conf.get(key, str(BATCH_BYTES)))
    if not held or not 0 < int(held[1]) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def spread(df: DataFrame) -> DataFrame:
    """Give a small table one partition per core before text work.

    A small file has a single row group and would be read by one task. Tables beyond SPREAD_BYTES
    are never shuffled for this: their splits are already the parallelism. Python functions over it get small batches.
    """
    small_batches(df.sparkSession)
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SPREAD_BYTES else df
