"""Helpers shared by the operators: tables, word rules, shared folders, checked sizes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hybridloom.session import own_folder

# Words of the contracts: runs of anything but blanks and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
# A frame of at most this many bytes (rows times a documented row width) may be broadcast.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; null texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest(*parts: Column) -> Column:
    """60 bits of an md5 over the parts, the same in every engine that has md5; nulls are told from empty strings."""
    shown = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *shown)), 1, 15), 16, 10).cast("long")


def sql_digest(*parts: str) -> str:
    """DuckDB form of :func:`digest`."""
    shown = " || '|' || ".join(f"coalesce('=' || ({p})::VARCHAR, '-')" for p in parts)
    return f"('0x' || substr(md5({shown}), 1, 15))::BIGINT"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body and its lambdas use it."""
    return F.transform(F.array(value), body)[0]


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use, in any case."""
    used = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in used:
        name = f"_{name}"
    return name


def by_bytes(batches: Iterator[pa.RecordBatch], place: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the values of column ``place`` hold about ``limit`` bytes each; a longer value comes alone."""
    for batch in batches:
        column = batch.column(place)
        width = 1 if pa.types.is_string(column.type) or pa.types.is_binary(column.type) else 4
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset + 1:column.offset + len(column) + 1] if len(column) else np.zeros(0, np.int32)
        first = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, first + limit // width, "right")))
            yield batch.slice(start, stop - start)
            first = ends[stop - 1]
            start = stop


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; an own one only where that is unset, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or own_folder(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a shared folder and read it back: lineage ends there and a lost executor costs nothing."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint when rows x row_bytes fits ``limit``; larger frames are left to the shuffle."""
    bound = limit // row_bytes
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def running(df: DataFrame, group: list[str], spread: Column, order: list[Column], measures: dict[str, Column], lanes: int = 256) -> DataFrame:
    """For each row and measure, the measure's total over the rows of its ``group`` that come before it in ``(spread, order)`` order.

    ``spread`` is a 60-bit hash of the row. Its leading bits cut a group into ``lanes`` parts that are sorted apart; a part
    starts from the totals of the parts before it. A group with a third of all rows is spread over all its parts, and what is
    summed up front is one row for each part and task.
    """
    lane, mark = free_name(df, "lane"), free_name(df, "spread")
    marked = df.withColumn(mark, spread)
    marked = marked.withColumn(lane, F.shiftright(F.col(mark), 60 - (lanes - 1).bit_length()))
    sums = marked.groupBy(*group, lane).agg(*[F.sum(m).alias(f"__s_{n}") for n, m in measures.items()])
    before = Window.partitionBy(*group).orderBy(lane).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col(lane).alias("__l"),
                         *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__b_{n}") for n in measures])
    local = Window.partitionBy(*group, lane).orderBy(mark, *order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = marked.withColumns({f"__r_{n}": F.coalesce(F.sum(m).over(local), F.lit(0)) for n, m in measures.items()})
    same = F.col(lane) == F.col("__l")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"__g{i}"))
    joined = numbered.join(broadcast_if_small(starts, 64), same)
    return joined.select(*df.columns, *[(F.col(f"__r_{n}") + F.col(f"__b_{n}")).cast("long").alias(n) for n in measures])


def running_slots(df: DataFrame, group: list[str], spread: Column, order: list[Column], out: str, lanes: int = 256) -> DataFrame:
    """Gapless numbers from 0 inside each ``group``."""
    return running(df, group, spread, order, {out: F.lit(1)}, lanes)
