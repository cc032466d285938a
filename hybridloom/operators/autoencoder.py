"""Sparse-autoencoder analytics: pooling, means, norms, top-K encoding, convergence."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from hybridloom.config import SAE_TOP_FEATURES, SPARSE_WINDOW_WORDS
from hybridloom.functions import encoders, text as tx
from hybridloom.operators.topk import SCORE_BLOCK_CELLS, _arrow_schema, _matrix, long_vectors, topk_per_group
from hybridloom.session import cut_lineage

ENCODER_BYTES = 512 * 1024 * 1024


def maxpool_sparse(windows: DataFrame, id_col: str = "id", vector: str = "sparse") -> DataFrame:
    """Maximum weight per (point, term) over all windows of a point."""
    pairs = F.explode(F.arrays_zip(F.col(f"{vector}.indices"), F.col(f"{vector}.values"))).alias("p")
    return (windows.select(id_col, pairs).groupBy(id_col, F.col("p.indices").alias("term"))
            .agg(F.max("p.values").alias("weight")))


def pool_logits(tokens: DataFrame, id_col: str = "id", logits: str = "logits") -> DataFrame:
    """(id, term, weight): the largest log1p(relu(logit)) of every dimension over the tokens of an id, zeros left out.

    One row per token goes in; the maximum is combined before the shuffle, so a long text costs a row per dimension and task.
    """
    each = tokens.select(id_col, F.posexplode(logits).alias("term", "logit")).filter("logit > 0")
    return each.groupBy(id_col, "term").agg(F.max(F.log1p(F.col("logit").cast("double"))).alias("weight"))


def maxpool_windows(df: DataFrame, id_col: str, text: str, size: int = SPARSE_WINDOW_WORDS,
                    encoder=encoders.sparse_terms) -> DataFrame:
    """Window a text, encode every window, pool per term."""
    windows = df.select(id_col, F.explode(tx.word_windows(F.col(text), size)).alias("window"))
    return maxpool_sparse(windows.select(id_col, encoder(F.col("window")).alias("sparse")), id_col)


def mean_by_position(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return long.groupBy(*(keys or []), "pos").agg(F.avg(F.col("value").cast("double")).alias("mean"))


def mean_vectors(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Mean vector per key: combined on the map side, then one row of fixed width per key."""
    long = df.select(*keys, F.posexplode_outer(vector).alias("pos", "value")).filter("pos IS NOT NULL")
    means = mean_by_position(long, keys)
    ordered = F.array_sort(F.collect_list(F.struct("pos", "mean")))
    return means.groupBy(*keys).agg(F.transform(ordered, lambda p: p["mean"]).alias("mean"))


def mean_sparse(points: DataFrame, vector: str = "sparse") -> DataFrame:
    """Mean weight of every term over all points, absent terms counting as zero."""
    total = points.count()
    pairs = F.explode(F.arrays_zip(F.col(f"{vector}.indices"), F.col(f"{vector}.values"))).alias("p")
    return (points.select(pairs).groupBy(F.col("p.indices").alias("term"))
            .agg((F.sum("p.values") / F.lit(total)).alias("mean")))


def nonzero_stats(counts: DataFrame, column: str = "nnz") -> DataFrame:
    """Mean, median, p10, p90 (linear interpolation), minimum and maximum.

    The exact percentile keeps one counter per distinct value, and a count of non-zeros has few.
    """
    return counts.agg(
        F.count("*").alias("n"), F.avg(column).alias("mean"),
        F.percentile(column, 0.5).alias("median"), F.percentile(column, 0.1).alias("p10"),
        F.percentile(column, 0.9).alias("p90"), F.min(column).alias("min"), F.max(column).alias("max"))


def row_norms(df: DataFrame, key: str, vector: str) -> DataFrame:
    """L2 norm of every weight row."""
    square = F.aggregate(F.col(vector), F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    return df.select(key, F.sqrt(square).alias("norm"))


def encoder_bytes(weights: DataFrame) -> int:
    return weights.select(F.coalesce(F.sum(F.size("row")), F.lit(0))).first()[0] * 8


def load_encoder(weights: DataFrame, bias: DataFrame, encoder_bias: dict | None = None) -> dict:
    """Bring the weight rows (feature, row) to the driver after a size check.

    An encoder is a model file: its width is fixed by the model, not by the corpus. :func:`encode` goes through larger ones block by block.
    """
    size = encoder_bytes(weights)
    if size > ENCODER_BYTES:
        raise ValueError(f"encoder of {size} bytes exceeds the {ENCODER_BYTES} byte bound; use encode")
    rows = weights.orderBy("feature").collect()
    matrix = np.array([r["row"] for r in rows], dtype=np.float64).reshape(len(rows), len(rows[0]["row"]) if rows else 0)
    return {
        "features": [r["feature"] for r in rows], "weights": matrix,
        "decoder_bias": np.array(bias.first()[0], dtype=np.float64),
        "encoder_bias": np.array([(encoder_bias or {}).get(r["feature"], 0.0) for r in rows]),
        "norms": np.sqrt((matrix * matrix).sum(axis=1)),
    }


def encode_topk(points: DataFrame, encoder: dict | Broadcast, k: int = SAE_TOP_FEATURES, id_col: str = "id",
                vector: str = "dense", decimals: int | None = None) -> DataFrame:
    """((x - b_dec) W + b_enc) * norms, the K largest per row, negative ones cut to zero and dropped."""
    schema = T.StructType([points.schema[id_col], T.StructField("feature", T.LongType()),
                           T.StructField("activation", T.DoubleType())])
    arrow = _arrow_schema(schema)
    shared = encoder if isinstance(encoder, Broadcast) else points.sparkSession.sparkContext.broadcast(encoder)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        features = np.asarray(model["features"], dtype=np.int64)
        step = max(1, SCORE_BLOCK_CELLS // max(len(features), 1))
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(1)))
            for start in range(0, batch.num_rows, step):
                piece = batch.slice(start, step)
                x = _matrix(piece.column(1), model["weights"].shape[1])
                act = ((x - model["decoder_bias"]) @ model["weights"].T + model["encoder_bias"]) * model["norms"]
                if decimals is not None:
                    act = np.round(act, decimals)
                order = np.argsort(-act, axis=1, kind="stable")[:, :k]
                best = np.take_along_axis(act, order, axis=1)
                row, col = np.nonzero(best > 0)
                ids = piece.column(0).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(features[order[row, col]]), pa.array(best[row, col])], schema=arrow)

    return points.select(id_col, vector).mapInArrow(encode, schema)


def encode(points: DataFrame, weights: DataFrame, bias: DataFrame, encoder_bias: dict | None = None, k: int = SAE_TOP_FEATURES, id_col: str = "id",
           vector: str = "dense", decimals: int | None = None, block_bytes: int = ENCODER_BYTES // 2) -> DataFrame:
    """:func:`encode_topk` for weights (feature, row) of any size.

    Weights beyond ``block_bytes`` are cut into blocks of features. Each block is multiplied with all points and leaves its K best per point; a point's
    K best of all blocks are among these, ties to the smaller feature. What a block leaves is written and its broadcast let go before the next, so driver
    and tasks hold one block, and the points are encoded or read from a written copy once a block.
    """
    blocks = -(-encoder_bytes(weights) // block_bytes)
    if blocks <= 1:
        return encode_topk(points, load_encoder(weights, bias, encoder_bias), k, id_col, vector, decimals)
    context = points.sparkSession.sparkContext
    points, parts = cut_lineage(points.select(id_col, vector)), []
    for block in range(blocks):
        model = load_encoder(weights.filter(F.pmod(F.xxhash64("feature"), F.lit(blocks)) == block), bias, encoder_bias)
        if model["features"]:
            shared = context.broadcast(model)
            parts.append(cut_lineage(encode_topk(points, shared, k, id_col, vector, decimals)))
            shared.destroy()
    best = topk_per_group(reduce(DataFrame.unionByName, parts), [id_col], [F.desc("activation"), F.asc("feature")], k)
    return best.select(id_col, "feature", "activation")


def sparse_vectors(coded: DataFrame, points: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, sparse) of coded features (id, feature, activation), in feature order; points without an active feature get an empty vector."""
    pairs = coded.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("feature", "activation"))).alias("p"))
    joined = points.select(id_col).join(pairs, id_col, "left")
    none = F.array().cast("array<struct<feature:bigint,activation:double>>")
    held = F.coalesce("p", none)
    return joined.select(id_col, F.struct(F.transform(held, lambda p: p["feature"].cast("string")).alias("indices"), F.transform(held, lambda p: p["activation"]).alias("values")).alias("sparse"))


def store_features(store, name: str, points: DataFrame, coded: DataFrame, id_col: str = "id") -> str:
    """Keep coded features as a sparse-only collection whose points lead back to the dense chunks they code."""
    folder = store.create(name, components=("payload", "sparse"))
    store.append(folder, points.select(F.col(id_col).alias("id"), F.array(F.col(id_col).cast("string")).alias("dense_chunk_ids")))
    store.append(folder, sparse_vectors(coded, points, id_col).withColumnRenamed(id_col, "id"), "sparse")
    return folder


def encode_long(points: DataFrame, weights: DataFrame, decoder_bias: DataFrame, norms: DataFrame,
                k: int = SAE_TOP_FEATURES, id_col: str = "id", vector: str = "dense") -> DataFrame:
    """The same encoding for weights in long form (pos, feature, w) of any size: a shuffled join and a sum."""
    x = long_vectors(points, id_col, vector).join(decoder_bias.select("pos", "mean"), "pos")
    act = (x.withColumn("v", F.col("value") - F.col("mean")).join(weights, "pos")
           .groupBy(id_col, "feature").agg(F.sum(F.col("v") * F.col("w")).alias("a"))
           .join(norms, "feature").withColumn("activation", F.col("a") * F.col("norm")))
    best = topk_per_group(act, [id_col], [F.desc("activation"), F.asc("feature")], k)
    return best.filter("activation > 0").select(id_col, "feature", "activation")


def explained_variance(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """1 - mean |rebuilt - x|^2 / mean |x - mean|^2 with the key's mean as the rebuilt vector.

    Written with the sums of squares per (key, position), so no row meets a second row.
    """
    long = df.select(*keys, F.posexplode(vector).alias("pos", "value"))
    v = F.col("value").cast("double")
    cells = long.groupBy(*keys, "pos").agg(F.count("*").alias("n"), F.sum(v).alias("s"), F.sum(v * v).alias("q"))
    per_pos = cells.groupBy("pos").agg(
        F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("residual"),
        (F.sum("q") - F.sum("s") * F.sum("s") / F.sum("n")).alias("total"))
    return per_pos.agg(F.round(1 - F.sum("residual") / F.sum("total"), 6).alias("explained_variance"))


def epoch_summary(rows: DataFrame, epoch: str = "epoch", step: str = "step", metrics: list[str] | None = None) -> DataFrame:
    """Mean, last, best value and the step of the best of every metric per epoch."""
    metrics = metrics or ["loss"]
    parts = [F.count("*").alias("steps")]
    for m in metrics:
        parts += [F.avg(m).alias(f"{m}_mean"), F.max_by(m, step).alias(f"{m}_last"),
                  F.min(m).alias(f"{m}_best"), F.min_by(step, F.struct(F.col(m), F.col(step))).alias(f"{m}_best_step")]
    return rows.groupBy(epoch).agg(*parts)


def last_of_list(metric):
    """Latest element of a list-valued metric."""
    return F.element_at(metric, -1)


def seeded_batches(df: DataFrame, id_col: str, seed: int, size: int, drop_last: bool) -> DataFrame:
    """A seeded permutation cut into batches of ``size``.

    A row's place is the number of rows before it in hash order. Counting per hash bucket first
    and ranking inside a bucket keeps the global order without a single-task sort.
    """
    from pyspark.sql import Window

    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    keyed = df.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, 3))
    per_bucket = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))  # at most 4096 rows
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_bucket").orderBy("_key")
    placed = (keyed.join(F.broadcast(starts), "_bucket")
              .withColumn("place", F.col("_start") + F.row_number().over(inside) - 1)
              .withColumn("batch", F.floor(F.col("place") / size).cast("long")))
    if drop_last:
        total = df.count()
        placed = placed.filter(F.col("batch") < total // size)
    return placed.drop("_key", "_bucket", "_start")
