"""Toxicity: a linear classifier on character n-grams whose features are naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from hybridloom.llm.common import broadcast_if_small, table

GRAMS, BITS, SMOOTHING, LEAST_Z, LEAST_RATIO = (5, 6, 7), 18, 2.0, 3.5, 0.5
FIT_ROWS, STEPS, RATE, DECAY, SCALE = 8000, 200, 0.05, 0.03, 0.05
THRESHOLD = 0.7
_DIMS, _SLICE, _PIECE = 1 << BITS, 4096, 1 << 20


def grams(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Distinct hash buckets of the 5- to 7-byte strings of the lower-cased whole text; ``seen`` is a cleared scratch mask and is
    left cleared. Long texts are hashed piece by piece, pieces overlap by what a string needs."""
    data = np.frombuffer(b" " + (text or "").lower().encode("utf-8", "replace") + b" ", np.uint8)
    for begin in range(0, len(data), _PIECE):
        piece = data[begin:begin + _PIECE + max(GRAMS) - 1].astype(np.uint64)
        for n in GRAMS:
            count = len(piece) - n + 1
            if count <= 0:
                continue
            mixed = np.zeros(count, np.uint64)
            for k in range(n):
                mixed *= np.uint64(1099511628211)
                mixed += piece[k:k + count]
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            seen[(mixed >> np.uint64(64 - BITS)).astype(np.int64)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found.astype(np.int32)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each bucket, by label; the whole partition gives one row for each slice of buckets."""
    sums, rows, seen = np.zeros((2, _DIMS), np.int64), np.zeros(2, np.int64), np.zeros(_DIMS, bool)
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            sums[toxic, grams(text.as_py(), seen)] += 1
            rows[toxic] += 1
    if rows.sum():
        starts = range(0, _DIMS, _SLICE)
        yield pa.record_batch([pa.array(range(len(starts)), pa.int32()), *[pa.array([sums[y, s:s + _SLICE].tobytes() for s in starts], pa.binary()) for y in (0, 1)],
                               *[pa.array([int(rows[y])] * len(starts), pa.int64()) for y in (0, 1)]], names=["slice", "clean", "toxic", "n_clean", "n_toxic"])


def _added(part: pa.Table) -> pa.Table:
    add = lambda name: sum(np.frombuffer(b.as_py(), np.int64) for b in part.column(name)).tobytes()
    total = lambda name: sum(part.column(name).to_pylist())
    return pa.table({"slice": pa.array(part.column("slice").to_pylist()[:1], pa.int32()), "clean": pa.array([add("clean")], pa.binary()),
                     "toxic": pa.array([add("toxic")], pa.binary()), "n_clean": pa.array([total("n_clean")], pa.int64()), "n_toxic": pa.array([total("n_toxic")], pa.int64())})


_COUNT_SCHEMA = "slice int, clean binary, toxic binary, n_clean long, n_toxic long"


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by bucket (log-count ratio and fitted factor in one), bias, and the slope and shift that turn margins into probabilities."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, buckets: np.ndarray) -> float:
        margin = self.slope * (float(self.weights[buckets].sum(dtype=np.float64)) + self.bias) + self.shift
        return float(1 / (1 + np.exp(-np.clip(margin, -60, 60))))


def _useful(clean: np.ndarray, toxic: np.ndarray, n: tuple[int, int]) -> np.ndarray:
    """Buckets whose shares of toxic and clean rows differ by at least LEAST_Z standard errors and by a ratio worth a feature."""
    p = (clean + toxic) / sum(n)
    spread = np.sqrt(p * (1 - p) * (1 / n[0] + 1 / n[1]))
    ratio = np.abs(np.log((toxic + SMOOTHING) / (n[1] + 2 * SMOOTHING)) - np.log((clean + SMOOTHING) / (n[0] + 2 * SMOOTHING)))
    return (np.abs(toxic / n[1] - clean / n[0]) >= LEAST_Z * np.maximum(spread, 1e-9)) & (ratio >= LEAST_RATIO)


def _fit(rows: list[np.ndarray], labels: np.ndarray, check: np.ndarray, ratios: np.ndarray, clean: np.ndarray, toxic: np.ndarray, n: tuple[int, int]) -> tuple:
    """Factor of every bucket, bias, slope and shift.

    A row's own count is taken out of its ratios, or strings that occur in it alone would give its label away. Rows marked in
    ``check`` don't fit the factors; slope and shift are fitted to their margins.
    """
    lengths = np.array([len(r) for r in rows])
    idx = np.concatenate(rows).astype(np.int32) if lengths.sum() else np.zeros(0, np.int32)
    at = np.repeat(np.arange(len(rows), dtype=np.int32), lengths)
    y = labels.astype(np.float64)
    own = y[at].astype(np.float32)
    a = SMOOTHING
    value = (np.log((toxic[idx] - own + a) / (n[1] - own + 2 * a)) - np.log((clean[idx] - (1 - own) + a) / (n[0] - (1 - own) + 2 * a))).astype(np.float32) * np.float32(SCALE)
    w, m, v = np.zeros(_DIMS), np.zeros(_DIMS), np.zeros(_DIMS)
    bias = bias_m = bias_v = 0.0
    fitting = np.where(check, 0.0, 1.0 / max(1, int((~check).sum())))
    margins = lambda: np.bincount(at, weights=value * w[idx], minlength=len(rows)) + bias
    for step in range(1, STEPS + 1):
        off = (1 / (1 + np.exp(-np.clip(margins(), -60, 60))) - y) * fitting
        grad, bias_grad = np.bincount(idx, weights=value * off[at], minlength=_DIMS) + DECAY / len(rows) * w, off.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        bias_m, bias_v = 0.9 * bias_m + 0.1 * bias_grad, 0.99 * bias_v + 0.01 * bias_grad ** 2
        rate = RATE * (1.0 if step <= 0.75 * STEPS else 0.3)
        w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        bias -= rate * (bias_m / (1 - 0.9 ** step)) / (np.sqrt(bias_v / (1 - 0.99 ** step)) + 1e-8)
    z, target, slope, shift = margins()[check], y[check], 1.0, 0.0
    if 0 < target.sum() < len(target):
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(slope * z + shift, -60, 60)))
            q = p * (1 - p) + 1e-6
            hessian = np.array([[(q * z * z).sum() + 0.01, (q * z).sum()], [(q * z).sum(), q.sum() + 0.01]])
            change = np.linalg.solve(hessian, [((p - target) * z).sum() + 0.01 * (slope - 1), (p - target).sum() + 0.01 * shift])
            slope, shift = slope - np.clip(change[0], -1, 1), shift - np.clip(change[1], -2, 2)
    return w, bias, max(slope, 0.05), shift


def train_toxicity(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Fit to ``labelled`` (doc_id, text, toxic 0/1).

    The counts behind the ratios are taken over all rows, in the tasks that read them, and summed by slices of buckets. The
    classifier on top is fitted, in one task, to the ``fit_rows`` rows whose ids hash lowest (the documented bound of the fit). Without
    rows of both labels every text gets the share of toxic rows (one half without any). What reaches the driver has the size
    of the bucket table, whatever the input.
    """
    counted = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(_counts, _COUNT_SCHEMA).groupBy("slice").applyInArrow(_added, _COUNT_SCHEMA)
    slices = sorted(counted.collect(), key=lambda r: r["slice"])
    n = (slices[0]["n_clean"], slices[0]["n_toxic"]) if slices else (0, 0)
    if min(n) == 0:
        share = (n[1] + 1) / (sum(n) + 2)
        return ToxicityModel(np.zeros(_DIMS, np.float32), float(np.log(share / (1 - share))), 1.0, 0.0)
    clean, toxic = (np.concatenate([np.frombuffer(r[c], np.int64) for r in slices]).astype(np.float32) for c in ("clean", "toxic"))
    a = SMOOTHING
    ratios = np.log((toxic + a) / (n[1] + 2 * a)) - np.log((clean + a) / (n[0] + 2 * a))
    useful = _useful(clean, toxic, n)
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = labelled.select(order.alias("place"), "doc_id").orderBy("place", "doc_id").limit(fit_rows).select(F.col("doc_id").alias("chosen")).distinct()
    sample = labelled.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen")).select("text", F.col("toxic").cast("int").alias("toxic"), F.pmod(order, F.lit(4)).cast("int").alias("part"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(_DIMS, bool)
        for batch in batches:
            found = (grams(t.as_py(), seen) for t in batch.column(0))
            made = [x[useful[x]].tobytes() for x in found]
            yield pa.record_batch([pa.array(made, pa.binary()), batch.column(1), batch.column(2)], names=["x", "toxic", "part"])

    def fitted(part: pa.Table) -> pa.Table:
        rows = [np.frombuffer(b.as_py(), np.int32) for b in part.column("x")]
        w, bias, slope, shift = _fit(rows, np.array(part.column("toxic").to_pylist()), np.array(part.column("part").to_pylist()) == 0, ratios, clean, toxic, n)
        return pa.table({"w": pa.array([w.astype(np.float32).tobytes()], pa.binary()), **{k: pa.array([float(v)]) for k, v in (("bias", bias), ("slope", slope), ("shift", shift))}})

    model = sample.mapInArrow(featured, "x binary, toxic int, part int").withColumn("fit", F.lit(0)).groupBy("fit").applyInArrow(fitted, "w binary, bias double, slope double, shift double").first()
    weights = np.where(useful, ratios * np.frombuffer(model["w"], np.float32) * SCALE, 0).astype(np.float32)
    return ToxicityModel(weights, model["bias"], model["slope"], model["shift"])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the probability of toxic, from the whole text alone. Null and empty texts get the score of no strings;
    a column of that name is replaced. Rows are scored where they are read: no shuffle."""
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    place = kept.index(text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(_DIMS, bool)
        for batch in batches:
            scores = [model.score(grams(t.as_py(), seen)) for t in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*kept, out])

    plain = docs.select(*kept)
    return plain.mapInArrow(scored, StructType([*plain.schema.fields, StructField(out, DoubleType())]))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; rows without an id are not among them, and have no label."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def labelled_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and toxic of the labelled rows that may be learnt from. Several labels of a document count as the highest."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    return docs.select("doc_id", "text").join(broadcast_if_small(known, 32), "doc_id")


def op4_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(labelled_documents(docs, table(spark, sf_dir, "labels")))
    scored = score_toxicity(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
