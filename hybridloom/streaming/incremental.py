"""Incremental ingest: new files are picked up once, chunks are appended once per id."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridloom.session import checked_broadcast
from hybridloom.sources.commits import CommitLog

# Folders of a segment by hash of the key; segments of a level that are merged to one of the next; bits of a filter for each key.
BUCKETS, MERGED, BITS_PER_KEY, PAGE_BITS = 64, 8, 12, 32768


def file_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet", glob: str | None = None, **options: str) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(folder)


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what is there and stop. The checkpoint makes a restarted run continue where it was."""
    done = (stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
    done.awaitTermination()


@dataclass
class Segments:
    """What a target holds after a commit: its segments, and the last batch of every stream."""
    version: int = 0
    segments: list[dict] = field(default_factory=list)
    done: dict[str, int] = field(default_factory=dict)

    def after(self, number: int, entry: dict) -> "Segments":
        gone = set(entry.get("drop", []))
        kept = [s for s in self.segments if s["folder"] not in gone] + entry.get("add", [])
        return Segments(number, kept, {**self.done, **entry.get("done", {})})


class OnceTable:
    """A table of rows that are stored once by key, however often and by however many streams they arrive.

    A batch becomes a segment: its rows in folders by hash of the key, and a Bloom filter for each folder. A later batch opens only folders
    whose filter leaves room for one of its keys, which for new keys are next to none, so what it reads does not grow with the history; filters are a
    few bits a key. Segments of like size are merged, so their number grows with the logarithm of the history. Commits are numbered: a batch that is
    run again after a failure finds itself committed, and one that meets another stream's commit checks those rows and tries again.
    """

    def __init__(self, spark: SparkSession, target: str, keys: list[str]):
        self.spark, self.target, self.keys = spark, target.rstrip("/"), keys
        self.log = CommitLog(spark, f"{self.target}/_log")
        self.opened = 0  # folders that the last batch opened

    def state(self) -> Segments:
        summary, entries = self.log.entries()
        return reduce(lambda s, e: s.after(s.version + 1, e), entries, Segments(**summary) if summary else Segments())

    def read(self) -> DataFrame | None:
        """All rows; None before the first batch."""
        return self._rows(self.state().segments)

    def _rows(self, segments: list[dict]) -> DataFrame | None:
        parts = [self.spark.read.parquet(f"{self.target}/{s['folder']}/rows").drop("_bucket") for s in segments if s["rows"]]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("int")

    def _places(self, pages: Column | int) -> Column:
        """Positions of a key in a filter of so many pages, by two hashes."""
        return F.array(*[F.pmod(F.xxhash64(F.lit(seed), *self.keys), F.lit(PAGE_BITS) * pages) for seed in (1, 2)])

    def _segment(self, rows: DataFrame, level: int) -> dict:
        """Write rows as a segment with its filter. The filter has a page of 4 KB for some 2 700 keys of a folder."""
        folder = f"segment-{uuid.uuid4().hex}"
        rows.withColumn("_bucket", self._bucket()).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.target}/{folder}/rows")
        try:
            stored = self.spark.read.parquet(f"{self.target}/{folder}/rows")
        except Exception as problem:  # no row, so no file with a schema
            if "UNABLE_TO_INFER_SCHEMA" not in str(problem):
                raise
            return {"folder": folder, "level": level, "rows": 0, "pages": 1}
        sizes = stored.groupBy("_bucket").count().agg(F.max("count").alias("most"), F.sum("count").alias("rows")).first()
        pages = max(1, -(-(sizes["most"] or 0) * BITS_PER_KEY // PAGE_BITS))
        places = stored.select("_bucket", F.explode(self._places(pages)).alias("at"))
        filters = places.groupBy("_bucket", F.floor(F.col("at") / PAGE_BITS).alias("page")).agg(F.bitmap_construct_agg(F.col("at") % PAGE_BITS).alias("bits"))
        filters.coalesce(1).write.parquet(f"{self.target}/{folder}/filter")
        return {"folder": folder, "level": level, "rows": sizes["rows"] or 0, "pages": pages}

    def _candidates(self, fresh: DataFrame, segments: list[dict]) -> list[str]:
        """Folders of the segments that may hold a key of ``fresh``; at most BUCKETS for each segment."""
        if not segments:
            return []
        by_folder = [self.spark.read.parquet(f"{self.target}/{s['folder']}/filter").withColumn("segment", F.lit(i)) for i, s in enumerate(segments)]
        filters = reduce(DataFrame.unionByName, by_folder)
        wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("segment"), self._places(s["pages"]).alias("at")) for i, s in enumerate(segments)]))
        asked = fresh.select(self._bucket().alias("_bucket"), wanted.alias("w")).select("_bucket", "w.segment", "w.at")
        first, second = F.col("at")[0], F.col("at")[1]
        met = asked.join(checked_broadcast(filters.select("segment", "_bucket", F.col("page").alias("p1"), F.col("bits").alias("b1"))), ["segment", "_bucket"]).where(F.col("p1") == F.floor(first / PAGE_BITS))
        met = met.where(_bit("b1", first % PAGE_BITS)).drop("p1", "b1")
        met = met.join(checked_broadcast(filters.select("segment", "_bucket", F.col("page").alias("p2"), F.col("bits").alias("b2"))), ["segment", "_bucket"]).where(F.col("p2") == F.floor(second / PAGE_BITS))
        found = met.where(_bit("b2", second % PAGE_BITS)).select("segment", "_bucket").distinct().collect()
        return [f"{self.target}/{segments[r['segment']]['folder']}/rows/_bucket={r['_bucket']}" for r in found]

    def _unseen(self, fresh: DataFrame, segments: list[dict]) -> DataFrame:
        """Rows whose key none of the segments holds."""
        folders = self._candidates(fresh, [s for s in segments if s["rows"]])
        self.opened += len(folders)
        if not folders:
            return fresh
        stored = self.spark.read.parquet(*folders).select(*[F.col(k).alias(f"_stored{i}") for i, k in enumerate(self.keys)])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_stored{i}")) for i, k in enumerate(self.keys)])
        return fresh.join(stored, same, "left_anti")

    def append(self, batch: DataFrame, stream: str, number: int) -> bool:
        """Add the rows whose key is new; null is a key like others. False if this batch of this stream is stored already."""
        once = batch.dropDuplicates(self.keys).persist()
        try:
            return self._append(once, stream, number)
        finally:
            once.unpersist()

    def _append(self, own: DataFrame, stream: str, number: int) -> bool:
        self.opened, segment, seen = 0, None, set()
        while True:
            state = self.state()
            if state.done.get(stream, -1) >= number:
                return False
            others = [s for s in state.segments if s["folder"] not in seen]
            if segment is None or others:
                if segment is not None:
                    own = self._rows([segment]) if segment["rows"] else own.limit(0)
                segment = self._segment(self._unseen(own, others), 0)
            seen = {s["folder"] for s in state.segments}
            entry = {"add": [segment] if segment["rows"] else [], "done": {stream: number}}
            if self.log.put(state.version + 1, entry):
                self._summarise(state.after(state.version + 1, entry))
                self._merge()
                return True

    def _summarise(self, state: Segments) -> None:
        self.log.summarise(state.version, {"version": state.version, "segments": state.segments, "done": state.done})

    def _merge(self) -> None:
        """Merge segments of a level when there are MERGED of them. A merge that another writer forestalls is left to the next batch."""
        state = self.state()
        for level in sorted({s["level"] for s in state.segments}):
            same = [s for s in state.segments if s["level"] == level]
            if len(same) >= MERGED:
                entry = {"add": [self._segment(self._rows(same), level + 1)], "drop": [s["folder"] for s in same]}
                if self.log.put(state.version + 1, entry):
                    self._summarise(state.after(state.version + 1, entry))
                return


def _bit(bits: str, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1


def append_once(target: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """Batch handler: store the rows whose key is new in an :class:`OnceTable`. A stream is told by the id kept in its checkpoint."""
    def handle(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        OnceTable(batch.sparkSession, target, keys).append(batch, stream, number)

    return handle


def read_once(spark: SparkSession, target: str) -> DataFrame | None:
    """Rows of a target of :func:`append_once`."""
    return OnceTable(spark, target, []).read()


def snapshot(target: str) -> Callable[[DataFrame, int], None]:
    """Batch handler for complete output: the last snapshot is the result."""
    def handle(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/snapshot={number}")

    return handle
