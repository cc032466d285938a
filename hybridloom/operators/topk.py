"""Exact top-k scoring of many queries against an unbounded point table.

Every task scores its Arrow batches against the whole query block with one matrix product and
keeps ``k`` rows per query, so the shuffle carries ``tasks x queries x k`` rows whatever the
number of points. Query sets beyond the size bound are scored block by block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

QUERY_BLOCK_BYTES = 32 * 1024 * 1024
QUERY_ROWS = 4096
SCORE_BLOCK_CELLS = 4_000_000


def topk_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int,
                   rank: str = "rn", lanes: int = 32) -> DataFrame:
    """``row_number() <= k`` per key in two steps, so that no task sorts a whole hot group.

    Rows are ranked inside (key, lane) first, where a lane is a set of input partitions; only
    ``lanes x k`` rows of a key reach its final ranking.
    """
    lane = "_lane"
    df = df.withColumn(lane, F.spark_partition_id() % lanes)
    local = Window.partitionBy(*keys, lane).orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(rank, F.row_number().over(local)).filter(F.col(rank) <= k)
    return kept.drop(lane, rank).withColumn(rank, F.row_number().over(final)).filter(F.col(rank) <= k)


class _Best:
    """The best k (score, id) pairs of every query seen by one task."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.held: list[tuple[np.ndarray, list]] = [(np.empty(0), []) for _ in range(queries)]

    def offer(self, scores: np.ndarray, ids: list, eligible: np.ndarray | None = None) -> None:
        """``scores`` is queries x rows; rows that are not eligible never enter."""
        k = self.k
        for q, row in enumerate(scores):
            at = np.arange(len(row)) if eligible is None else np.flatnonzero(eligible[q])
            old_scores, old_ids = self.held[q]
            if len(old_scores) == k:
                at = at[row[at] >= old_scores[-1]]
            if not len(at):
                continue
            if len(at) > k:
                cut = np.partition(row[at], len(at) - k)[len(at) - k]
                at = at[row[at] >= cut]
            pairs = list(zip(old_scores.tolist(), old_ids)) + [(float(row[i]), ids[i]) for i in at]
            pairs.sort(key=lambda p: (-p[0], p[1]))
            pairs = pairs[:k]
            self.held[q] = (np.array([p[0] for p in pairs]), [p[1] for p in pairs])

    def batch(self, query_ids: list, schema: pa.Schema, more: tuple = ()) -> pa.RecordBatch:
        qs, ids, scores = [], [], []
        for qid, (held_scores, held_ids) in zip(query_ids, self.held):
            qs.extend([qid] * len(held_ids))
            ids.extend(held_ids)
            scores.extend(held_scores.tolist())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, type=f.type) for v, f in zip((qs, ids, scores, *([m] * len(qs) for m in more)), schema)], schema=schema)


def _output(points: DataFrame, queries: DataFrame, id_col: str, query_col: str) -> T.StructType:
    return T.StructType([
        T.StructField(query_col, queries.schema[query_col].dataType),
        T.StructField(id_col, points.schema[id_col].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def _blocks(queries: DataFrame, query_col: str, size: Callable[[list], int], per_block: Callable[[list], int],
            limit: int) -> Iterator[list]:
    """Collect the query side in blocks of bounded size.

    The first QUERY_ROWS rows tell whether one block is enough; a larger set is cut by a hash of
    the query id into blocks of about ``per_block`` rows.
    """
    rows = queries.limit(QUERY_ROWS + 1).collect()
    if len(rows) <= QUERY_ROWS and size(rows) <= limit:
        yield rows
        return
    blocks = math.ceil(queries.count() / max(1, per_block(rows)))
    for block in range(blocks):
        yield queries.filter(F.pmod(F.xxhash64(query_col), F.lit(blocks)) == block).collect()


def _matrix(lists, width: int) -> np.ndarray:
    values = lists.flatten()
    return np.asarray(values.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(lists), width)


def _unit(dots: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """dots / (|left| |right|), zero where a side is the zero vector."""
    length = np.sqrt((left * left).sum(axis=1))[:, None] * np.sqrt((right * right).sum(axis=1))[None, :]
    return np.divide(dots, length, out=np.zeros_like(dots), where=length > 0)


def _rank(scored: DataFrame, query_col: str, id_col: str, k: int, rank: str, more: list[str] | tuple = ()) -> DataFrame:
    return topk_per_group(scored, [query_col, *more], [F.desc("score"), F.asc(id_col)], k, rank)


def dense_topk(points: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vector: str = "dense",
               query_col: str = "query_id", query_vector: str = "dense", rank: str = "rn",
               decimals: int | None = None, block_bytes: int = QUERY_BLOCK_BYTES, group: str | None = None) -> DataFrame:
    """Cosine top-k of every query. Ties go to the smaller id.

    ``decimals`` rounds the score before ranking, for vectors whose dot product is not exact. With ``group``, a column of the points such as their
    collection, every query has a top-k in each group, null being one, and all are found in the same pass: a task keeps k rows for each query
    and group it meets.
    """
    schema = _output(points, queries, id_col, query_col)
    if group:
        schema = T.StructType([*schema.fields, points.schema[group]])
    arrow = _arrow_schema(schema)
    source = points.select(id_col, vector, *[group][:group is not None])
    parts = []
    row_bytes = lambda rows: 8 * max((len(r[1]) for r in rows), default=1)
    for rows in _blocks(queries.select(query_col, query_vector), query_col, lambda rows: len(rows) * row_bytes(rows),
                        lambda rows: block_bytes // row_bytes(rows), block_bytes):
        if not rows:
            continue
        query_ids, width = [r[0] for r in rows], len(rows[0][1])
        matrix = np.array([r[1] for r in rows], dtype=np.float64).reshape(len(rows), width)
        shared = points.sparkSession.sparkContext.broadcast((query_ids, matrix))

        def score(batches: Iterator[pa.RecordBatch], shared=shared, width=width) -> Iterator[pa.RecordBatch]:
            ids, lookup = shared.value
            best: dict = {}
            for batch in batches:
                # Missing vectors are dropped here: a filter would make the plan encode twice.
                batch = batch.filter(pc.is_valid(batch.column(1)))
                step = max(1, SCORE_BLOCK_CELLS // max(len(ids), 1))
                for start in range(0, batch.num_rows, step):
                    piece = batch.slice(start, step)
                    found = _matrix(piece.column(1), width)
                    scores = _unit(lookup @ found.T, lookup, found)
                    if decimals is not None:
                        scores = np.round(scores, decimals)
                    keys = piece.column(0).to_pylist()
                    if group is None:
                        best.setdefault(None, _Best(len(ids), k)).offer(scores, keys)
                        continue
                    places: dict = {}
                    for at, value in enumerate(piece.column(2).to_pylist()):
                        places.setdefault(value, []).append(at)
                    for value, at in places.items():
                        best.setdefault(value, _Best(len(ids), k)).offer(scores[:, at], [keys[i] for i in at])
            for value, held in best.items():
                yield held.batch(ids, arrow, () if group is None else (value,))

        parts.append(source.mapInArrow(score, schema))
    return _rank(_union(parts, points.sparkSession, schema), query_col, id_col, k, rank, [group] if group else [])


def signal_topk(texts: DataFrame, queries: DataFrame, k: int, idf: DataFrame, id_col: str = "id", terms: str = "terms", query_col: str = "query_id",
                rank: str = "rn", decimals: int = 9, block_bytes: int = QUERY_BLOCK_BYTES) -> DataFrame:
    """(signal, query, id, score, rn): the dense and the sparse top-k of the default encoders for texts given as lists of terms, in one pass.

    ``queries`` has both vectors; ``idf`` (term, idf) is the statistic of the collection, limited to the queries' terms. Terms become vectors where they are
    scored, so a text is read and cut into terms once and no vector leaves its task. The rows are those of :func:`dense_topk` and
    :func:`sparse_topk` over the encoded texts.
    """
    from hybridloom.functions.encoders import hash_terms

    plain = _output(texts, queries, id_col, query_col)
    schema = T.StructType([T.StructField("signal", T.StringType()), *plain.fields])
    arrow = _arrow_schema(plain)
    source = texts.select(id_col, terms)
    asked = queries.select(query_col, "dense", F.col("sparse.indices").alias("indices"), F.col("sparse.values").alias("values"))
    vocabulary_of = lambda rows: sorted({t for r in rows for t in (r[2] or [])})
    width_of = lambda rows: len(vocabulary_of(rows)) + max((len(r[1]) for r in rows), default=1)
    mean_terms = lambda rows: max(1.0, sum(len(r[2] or []) for r in rows) / max(len(rows), 1))
    parts = []
    for rows in _blocks(asked, query_col, lambda rows: 8 * len(rows) * width_of(rows), lambda rows: int(math.sqrt(block_bytes / 8 / mean_terms(rows))), block_bytes):
        if not rows:
            continue
        vocabulary = vocabulary_of(rows)
        column = {t: i for i, t in enumerate(vocabulary)}
        block_terms = F.broadcast(texts.sparkSession.createDataFrame([(t,) for t in vocabulary], "term string"))
        weight = {r[0]: r[1] for r in idf.join(block_terms, "term", "left_semi").select("term", "idf").collect()} if vocabulary else {}
        lookup = np.zeros((len(rows), max(len(vocabulary), 1)))
        for at, row in enumerate(rows):
            for term, value in zip(row[2] or [], row[3] or []):
                lookup[at, column[term]] = value * weight.get(term, 0.0)
        matrix = np.array([r[1] for r in rows], dtype=np.float64).reshape(len(rows), -1)
        shared = texts.sparkSession.sparkContext.broadcast(([r[0] for r in rows], matrix, vocabulary, lookup))

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, matrix, words, lookup = shared.value
            known, touched = pa.array(words, type=pa.string()), (lookup != 0).astype(np.float64)
            dense, sparse = _Best(len(ids), k), _Best(len(ids), k)
            step = max(1, SCORE_BLOCK_CELLS // max(len(words), len(ids), matrix.shape[1]))
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    piece = batch.slice(start, step)
                    lists, keys = piece.column(1), piece.column(0).to_pylist()
                    valid = np.asarray(pc.is_valid(lists))
                    found = hash_terms(lists, matrix.shape[1])
                    dense.offer(_unit(matrix @ found.T, matrix, found), keys, None if valid.all() else np.broadcast_to(valid, (len(ids), len(keys))))
                    if not words:
                        continue
                    at = pc.index_in(lists.flatten(), value_set=known)
                    held = np.asarray(pc.is_valid(at))
                    row = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))[held]
                    cells = row * len(words) + np.asarray(at.filter(pc.is_valid(at)), dtype=np.int64)
                    counts = np.log1p(np.bincount(cells, minlength=len(lists) * len(words)).reshape(len(lists), len(words)).astype(float))
                    sparse.offer(np.round(lookup @ counts.T, decimals), keys, (touched @ (counts > 0).astype(np.float64).T) > 0)
            for signal, held in (("dense", dense), ("sparse", sparse)):
                made = held.batch(ids, arrow)
                yield pa.RecordBatch.from_arrays([pa.array([signal] * made.num_rows), *made.columns], names=["signal", *arrow.names])

        parts.append(source.mapInArrow(score, schema))
    return _rank(_union(parts, texts.sparkSession, schema), query_col, id_col, k, rank, ["signal"])


def sparse_topk(points: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vector: str = "sparse",
                query_col: str = "query_id", query_vector: str = "sparse", rank: str = "rn",
                idf: DataFrame | None = None, decimals: int = 9,
                block_bytes: int = QUERY_BLOCK_BYTES) -> DataFrame:
    """Sparse dot product with the inverse-document-frequency modifier, top-k of every query.

    Only points sharing a term with the query are hits. ``idf`` is the statistic of the whole
    collection (term, idf); by default it is derived from ``points``.
    """
    schema = _output(points, queries, id_col, query_col)
    arrow = _arrow_schema(schema)
    source = points.select(id_col, F.col(f"{vector}.indices").alias("indices"), F.col(f"{vector}.values").alias("values"))
    query_rows = queries.select(query_col, F.col(f"{query_vector}.indices").alias("indices"),
                                F.col(f"{query_vector}.values").alias("values"))
    total = points.count() if idf is None else None
    parts = []
    # A block holds a queries x terms matrix, so its size grows with the square of its queries.
    vocabulary_of = lambda rows: sorted({t for r in rows for t in (r[1] or [])})
    mean_terms = lambda rows: max(1.0, sum(len(r[1] or []) for r in rows) / max(len(rows), 1))
    for rows in _blocks(query_rows, query_col, lambda rows: 8 * len(rows) * len(vocabulary_of(rows)),
                        lambda rows: int(math.sqrt(block_bytes / 8 / mean_terms(rows))), block_bytes):
        vocabulary = vocabulary_of(rows)
        if not vocabulary:
            continue
        column = {t: i for i, t in enumerate(vocabulary)}
        # The vocabulary of a block is bounded by the block size, so it may be broadcast.
        block_terms = F.broadcast(points.sparkSession.createDataFrame([(t,) for t in vocabulary], "term string"))
        known = (inverse_document_frequency(points, vector, block_terms, total) if idf is None
                 else idf.join(block_terms, "term", "left_semi"))
        weight = {r[0]: r[1] for r in known.select("term", "idf").collect()}
        matrix = np.zeros((len(rows), len(vocabulary)))
        for at, row in enumerate(rows):
            for term, value in zip(row[1] or [], row[2] or []):
                matrix[at, column[term]] = value * weight.get(term, 0.0)
        shared = points.sparkSession.sparkContext.broadcast(([r[0] for r in rows], vocabulary, matrix))

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, words, lookup = shared.value
            known = pa.array(words, type=pa.string())
            touched = (lookup != 0).astype(np.float64)
            best = _Best(len(ids), k)
            step = max(1, SCORE_BLOCK_CELLS // max(len(words), len(ids)))
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    piece = batch.slice(start, step)
                    lists = piece.column(1)
                    at = pc.index_in(lists.flatten(), value_set=known)
                    keep = np.asarray(pc.is_valid(at))
                    where = np.asarray(at.filter(pc.is_valid(at)), dtype=np.int64)
                    row = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))[keep]
                    value = np.asarray(piece.column(2).flatten(), dtype=np.float64)[keep]
                    found = np.zeros((len(lists), len(words)))
                    found[row, where] = value
                    scores = np.round(lookup @ found.T, decimals)
                    shares = (touched @ (found != 0).astype(np.float64).T) > 0
                    best.offer(scores, piece.column(0).to_pylist(), shares)
            yield best.batch(ids, arrow)

        parts.append(source.mapInArrow(score, schema))
    return _rank(_union(parts, points.sparkSession, schema), query_col, id_col, k, rank)


def inverse_document_frequency(points: DataFrame, vector: str = "sparse", wanted: DataFrame | None = None,
                               total: int | None = None) -> DataFrame:
    """term, df, idf = ln(1 + (N - df + 0.5) / (df + 0.5)) over the whole collection.

    The count is combined on the map side, so a term found in every point costs one row per task.
    ``wanted`` limits the terms; a caller that knows it to be small passes it with a broadcast hint.
    """
    total = points.count() if total is None else total
    # The outer form: the plain one makes the planner test the array first, encoding every text twice.
    found = points.select(F.explode_outer(f"{vector}.indices").alias("term")).filter("term IS NOT NULL")
    if wanted is not None:
        found = found.join(wanted, "term", "left_semi")
    df = F.col("df")
    return (found.groupBy("term").agg(F.count("*").alias("df"))
            .withColumn("idf", F.log(1 + (F.lit(total) - df + 0.5) / (df + 0.5))))


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _union(parts: list[DataFrame], spark: SparkSession, schema: T.StructType) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def long_vectors(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """Long form (id, pos, value) of an array vector."""
    return df.select(id_col, F.posexplode_outer(vector).alias("pos", "value")).filter("pos IS NOT NULL")


def long_sparse(df: DataFrame, id_col: str = "id", vector: str = "sparse") -> DataFrame:
    """Long form (id, term, weight) of a sparse vector."""
    pairs = F.explode(F.arrays_zip(F.col(f"{vector}.indices"), F.col(f"{vector}.values"))).alias("p")
    return df.select(id_col, pairs).select(id_col, F.col("p.indices").alias("term"), F.col("p.values").alias("weight"))
