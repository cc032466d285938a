"""Approximate nearest neighbours: an inverted multi-index over two vector halves, searched by largest inner product."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hybridloom.llm.common import table, written

K, QUERY_STEP = 20, 20
FIT_ROWS, FIT_ROUNDS, LEAST_CENTROIDS, MOST_CENTROIDS, ROWS_PER_CELL = 20_000, 12, 24, 256, 32
SHARE, LEAST_ENTRIES = 0.65, 400
_BLOCK, _QUERY_BLOCK = 4096, 8192


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vec) of the vectors that take part: an id, no null or non-finite component, not zero, of the commonest length (the
    shorter on a tie). Rows that agree in both count once."""
    vec = F.col(vector).cast("array<double>")
    sound = df.select(F.col(vec_id).alias("vec_id"), vec.alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.exists("vec", lambda x: x != 0)
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    lengths = sound.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return sound.where(F.size("vec") == (lengths[0]["d"] if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centroids.T - 0.5 * (centroids * centroids).sum(axis=1), axis=1)


def _centroids(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's rounds from evenly chosen distinct vectors; fewer distinct vectors give fewer centroids."""
    distinct = np.unique(x, axis=0)
    centres = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)].copy()
    for _ in range(FIT_ROUNDS):
        near = _nearest(x, centres)
        for j in np.unique(near):
            centres[j] = x[near == j].mean(axis=0)
    return centres


@dataclass(frozen=True)
class MultiIndex:
    """Centroids of both halves and, by cell, its entries, first block and number of blocks."""

    first: np.ndarray
    second: np.ndarray
    sizes: np.ndarray
    blocks: np.ndarray
    splits: np.ndarray

    def cell(self, x: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        return _nearest(x[:, :half], self.first) * len(self.second) + _nearest(x[:, half:], self.second)

    def probe(self, query: np.ndarray, entries: float) -> list[int]:
        """Non-empty cells in the order of the summed distances (negative inner products) of their centroid pairs, until they
        hold ``entries``. A pair enters the heap once both pairs before it have left."""
        half = self.first.shape[1]
        by_first, by_second = self.first @ query[:half], self.second @ query[half:]
        one, two = np.argsort(-by_first, kind="stable"), np.argsort(-by_second, kind="stable")
        a, b, one, two = (-by_first[one]).tolist(), (-by_second[two]).tolist(), one.tolist(), two.tolist()
        n, m, sizes = len(a), len(b), self.sizes
        left = [0] * n  # pairs of row i that have left the heap: always a prefix
        heap, cells, held = [(a[0] + b[0], 0, 0)], [], 0
        while heap and held < entries:
            _, i, j = heapq.heappop(heap)
            left[i] = j + 1
            cell = one[i] * m + two[j]
            if sizes[cell]:
                cells.append(cell)
                held += sizes[cell]
            if j + 1 < m and (i == 0 or left[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if i + 1 < n and left[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        return cells


def build_index(vectors: DataFrame, fit_rows: int = FIT_ROWS, block: int = _BLOCK) -> tuple[MultiIndex | None, DataFrame]:
    """The index and its entries (vec_id, cell, block, vec as bytes); all ``vectors`` are indexed.

    The centroids are fitted to the ``fit_rows`` vectors whose ids hash lowest (the documented bound of the fit); their number
    grows with the square root of the rows up to MOST_CENTROIDS per half. Of the rows the driver sees the sizes of the cells,
    at most MOST_CENTROIDS squared. Cells are packed into blocks of about ``block`` entries; a larger cell, as a very common
    vector makes it, is cut into several by a hash of the id.
    """
    n = vectors.count()
    schema = "vec_id long, cell int, block int, vec binary"
    if not n:
        return None, vectors.sparkSession.createDataFrame([], schema)
    place = F.xxhash64("vec_id")
    sample = np.array([r["vec"] for r in vectors.orderBy(place, "vec_id").limit(fit_rows).select("vec").collect()])
    half = max(1, sample.shape[1] // 2)
    k = int(min(MOST_CENTROIDS, max(LEAST_CENTROIDS, round(math.sqrt(n / ROWS_PER_CELL)))))
    first = _centroids(sample[:, :half], k)
    second = _centroids(sample[:, half:], k) if sample.shape[1] > half else np.zeros((1, 0))
    empty = np.zeros(0, np.int64)
    bare = MultiIndex(first, second, empty, empty, empty)

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(1).flatten(), np.float64).reshape(batch.num_rows, -1)
                yield pa.record_batch([batch.column(0), pa.array(bare.cell(x), pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())], names=["vec_id", "cell", "vec"])

    entries = written(vectors.select(F.col("vec_id").cast("long"), "vec").mapInArrow(celled, "vec_id long, cell int, vec binary"), "cells")
    sizes = np.zeros(len(first) * len(second), np.int64)
    for row in entries.groupBy("cell").count().collect():
        sizes[row["cell"]] = row["count"]
    splits, blocks, at, room = np.maximum(1, -(-sizes // block)), np.zeros(len(sizes), np.int64), 0, block
    for cell in np.flatnonzero(sizes):
        if sizes[cell] > room:
            at, room = at + 1, block
        blocks[cell] = at
        if splits[cell] > 1:
            at, room = at + int(splits[cell]), block
        else:
            room -= int(sizes[cell])
    index = MultiIndex(first, second, sizes, blocks, splits)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.asarray(batch.column(1))
            number = (np.asarray(batch.column(2)).astype(np.uint64) % index.splits[cell].astype(np.uint64)).astype(np.int64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(index.blocks[cell] + number, pa.int32()), batch.column(3)], names=["vec_id", "cell", "block", "vec"])

    return index, entries.select("vec_id", "cell", F.xxhash64("vec_id"), "vec").mapInArrow(placed, schema)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, share: float = SHARE, query_block: int = _QUERY_BLOCK) -> DataFrame:
    """The ``k`` entries of largest inner product for each of ``queries`` (a subset of ``vectors`` rows): query_id, rank, vec_id, score.

    Cells are visited, nearest centroid pairs first, until they hold ``share`` of all entries (LEAST_ENTRIES at least, so small
    tables are searched whole). The share is what vectors without structure need for a recall above 0.9; cells of such vectors tell
    little. Blocks of entries meet blocks of ``query_block`` queries; every entry of a visited cell is ranked by its exact double
    product with the original vector, so equal vectors tie exactly, and ties go to the smaller vec_id. A query's own id is no candidate.
    """
    index, entries = build_index(vectors)
    schema = "query_id long, vec_id long, score double"
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    wanted = max(share * int(index.sizes.sum()), LEAST_ENTRIES)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "part", "query_id", "vec", "cells"]
        for batch in batches:
            rows: list[tuple] = []
            for query_id, part, vec in zip(*(batch.column(i).to_pylist() for i in range(3))):
                cells = np.array(index.probe(np.array(vec), wanted), np.int64)
                many = np.repeat(cells, index.splits[cells])
                at = index.blocks[many] + np.concatenate([np.arange(s) for s in index.splits[cells]] or [np.zeros(0, np.int64)])
                order = np.argsort(at, kind="stable")
                at, many = at[order], many[order]
                cuts = np.flatnonzero(np.diff(at)) + 1
                rows += [(int(b[0]), part, query_id, np.array(vec).tobytes(), c.astype(np.int32).tobytes()) for b, c in zip(np.split(at, cuts), np.split(many, cuts)) if len(b)]
                if len(rows) >= 5000:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), probe_type)], names=names)
                    rows = []
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), probe_type)], names=names)

    probe_type = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("query_id", pa.int64()), ("vec", pa.binary()), ("cells", pa.binary())])

    def ranked(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            ids, cell, x = np.asarray(left.column("vec_id")), np.asarray(left.column("cell")), _matrix(left.column("vec"))
            for at in range(0, right.num_rows, 512):
                part = right.slice(at, 512)
                q = _matrix(part.column("vec"))
                rough = q @ x.T
                for row, (query_id, cells) in enumerate(zip(part.column("query_id").to_pylist(), part.column("cells").to_pylist())):
                    able = np.flatnonzero(np.isin(cell, np.frombuffer(cells, np.int32)) & (ids != query_id))
                    if len(able) > k:
                        scores = rough[row, able]
                        able = able[scores >= np.partition(scores, len(able) - k)[len(able) - k] - 1e-9 * (1 + np.abs(scores).max())]
                    exact = (x[able] * q[row]).sum(axis=1)
                    best = np.lexsort((ids[able], -exact))[:k]
                    out.append((np.full(len(best), query_id), ids[able][best], exact[best]))
        made = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 3
        return pa.table({"query_id": pa.array(made[0].astype(np.int64)), "vec_id": pa.array(made[1].astype(np.int64)), "score": pa.array(made[2], pa.float64())})

    parts = max(1, -(-queries.count() // query_block))
    asked = queries.select(F.col("vec_id").cast("long"), F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"), "vec")
    probed = asked.mapInArrow(probes, "block int, part int, query_id long, vec binary, cells binary")
    copied = entries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    found = copied.groupBy("block", "part").cogroup(probed.groupBy("block", "part")).applyInArrow(ranked, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    vectors = usable(table(spark, sf_dir, "embeddings")).dropDuplicates(["vec_id", "vec"])
    return nearest(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))
