"""Combining ranked signals: reciprocal ranks, normalisation, boosts and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from hybridloom.config import BOOST_WEIGHTS, RRF_K, ZSCORE_EPSILON
from hybridloom.operators import topk


def reciprocal_rank(rank: Column, weight: Column | float = 1.0, k: int = RRF_K) -> Column:
    """Contribution of a 1-based rank."""
    return (weight if isinstance(weight, Column) else F.lit(float(weight))) / (F.lit(k) + rank)


def rrf_fuse(signals: dict[str, tuple[DataFrame, float]], limit: int, query_col: str = "query_id",
             id_col: str = "id", k: int = RRF_K) -> DataFrame:
    """Weighted reciprocal rank fusion of ranked lists (query, id, rn).

    A signal of weight zero leaves the plan: its hits must not enter with score zero.
    """
    parts = [df.select(query_col, id_col, reciprocal_rank(F.col("rn"), w, k).alias("part"))
             for df, w in signals.values() if w > 0]
    if not parts:
        any_df = next(iter(signals.values()))[0]
        parts = [any_df.select(query_col, id_col, F.lit(0.0).alias("part")).limit(0)]
    fused = (reduce(DataFrame.unionByName, parts)
             .groupBy(query_col, id_col).agg(F.sum("part").alias("score")))
    order = Window.partitionBy(query_col).orderBy(F.desc(F.round("score", 12)), F.asc(id_col))
    return fused.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= limit)


def rank_lists(dense: DataFrame, sparse: DataFrame, query_col: str = "query_id", id_col: str = "id") -> DataFrame:
    """Both rank lists side by side; a missing rank is NULL."""
    left = dense.select(query_col, id_col, F.col("rn").alias("dense_rank"))
    right = sparse.select(query_col, id_col, F.col("rn").alias("sparse_rank"))
    return left.join(right, [query_col, id_col], "full_outer")


def replay_weights(lists: DataFrame, weights: list[float], limit: int, query_col: str = "query_id",
                   id_col: str = "id", k: int = RRF_K) -> DataFrame:
    """Fused ranking of cached rank lists at every sparse weight, in one job.

    The weights are an array on the row, exploded in place: no join, and every
    (query, weight) ranking holds only the rows of one query's candidate list.
    """
    grid = F.explode(F.array(*[F.lit(float(w)) for w in weights])).alias("weight")
    score = (F.coalesce(reciprocal_rank(F.col("dense_rank"), 1.0, k), F.lit(0.0))
             + F.coalesce(reciprocal_rank(F.col("sparse_rank"), F.col("weight"), k), F.lit(0.0)))
    scored = lists.select("*", grid).withColumn("score", score)
    order = Window.partitionBy(query_col, "weight").orderBy(F.desc(F.round("score", 12)), F.asc(id_col))
    return scored.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= limit)


def zscore(df: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    """(score - mean) / (population std + 1e-8) within ``keys``; a bounded result list per key."""
    w = Window.partitionBy(*keys)
    return df.withColumn(score, (F.col(score) - F.avg(score).over(w))
                         / (F.stddev_pop(score).over(w) + F.lit(ZSCORE_EPSILON)))


def minmax(df: DataFrame, keys: list[str], score: str, out: str) -> DataFrame:
    """(score - min) / (max - min) within ``keys``; 1.0 where all scores are equal."""
    w = Window.partitionBy(*keys)
    low, high = F.min(score).over(w), F.max(score).over(w)
    return df.withColumn(out, F.when(high == low, F.lit(1.0)).otherwise((F.col(score) - low) / (high - low)))


def metadata_boost(query: Column, fields: dict[str, Column]) -> Column:
    """Sum of the weights of the fields whose non-empty value occurs in the query."""
    lowered = F.lower(query)
    parts = []
    for name, weight in BOOST_WEIGHTS.items():
        value = F.coalesce(fields.get(name, F.lit(None).cast("string")), F.lit(""))
        parts.append(F.when((value != "") & lowered.contains(F.lower(value)), F.lit(weight)).otherwise(F.lit(0.0)))
    return reduce(lambda a, b: a + b, parts)


def union_dedupe(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """All of ``first`` and then what ``second`` adds; duplicates inside ``second`` stay."""
    added = second.join(first.select(*keys).distinct(), keys, "left_anti")
    return (first.withColumn("side", F.lit(0)).unionByName(added.withColumn("side", F.lit(1)), allowMissingColumns=True))


def merge_normalised(dense: DataFrame, sparse: DataFrame, query_col: str = "query_id", id_col: str = "id") -> DataFrame:
    """Full outer union of two ranked lists with per-signal min-max scores and a signal label."""
    def side(df: DataFrame, name: str) -> DataFrame:
        scaled = minmax(df, [query_col], "score", "norm")
        return scaled.select(query_col, id_col, F.col("score").alias(f"{name}_score"),
                             F.col("rn").alias(f"{name}_rank"), F.col("norm").alias(f"{name}_norm"))

    both = side(dense, "dense").join(side(sparse, "sparse"), [query_col, id_col], "full_outer")
    signal = (F.when(F.col("dense_rank").isNull(), "sparse")
              .when(F.col("sparse_rank").isNull(), "dense").otherwise("both"))
    return both.withColumn("signal", signal)


def flatten_ranked(df: DataFrame, keys: list[str], id_col: str = "id", score: str = "score") -> DataFrame:
    """Keep the best row of every id, then number the rest by score; rows without text drop out."""
    rows = df.filter(F.coalesce(F.col("text"), F.lit("")) != "") if "text" in df.columns else df
    ties = [F.asc(c) for c in ("collection", "rn", "rank") if c in rows.columns]
    best = Window.partitionBy(*keys, id_col).orderBy(F.desc(score), *ties)
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(id_col))
    return (rows.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") == 1).drop("_n")
            .withColumn("rank", F.row_number().over(order)))


def u_shape(df: DataFrame, keys: list[str], rank: str = "rn", out: str = "position") -> DataFrame:
    """First half in order, second half reversed; lists of at most two stay."""
    n = F.count("*").over(Window.partitionBy(*keys))
    half = F.ceil(n / 2)
    r = F.col(rank)
    return df.withColumn(out, F.when((n <= 2) | (r <= half), r).otherwise(half + n - r + 1).cast("int"))


def repair_permutation(given: Column, n: Column) -> Column:
    """A permutation of 0..n-1: valid given entries in first-seen order, then the missing ones."""
    valid = F.array_distinct(F.filter(given, lambda i: (i >= 0) & (i < n)))
    rest = F.when(n > 0, F.array_except(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), valid)).otherwise(
        F.array().cast("array<int>"))
    return F.concat(valid, rest)


def slot_split(total: int, sparse_fraction: float) -> tuple[int, int]:
    """(dense slots, sparse slots); the sparse share is rounded half to even."""
    sparse = round(total * sparse_fraction)
    return total - sparse, sparse


def halves(points: DataFrame, queries: DataFrame, k: int, idf: DataFrame | None = None) -> DataFrame:
    """The best k // 2 (one at least) dense hits and as many sparse ones of every query, as two lists under ``signal``.

    ``points`` may be a filtered part of a collection; ``idf`` is then the statistic of the whole of it.
    """
    half = max(1, k // 2)
    dense, sparse = topk.dense_topk(points, queries, half), topk.sparse_topk(points, queries, half, idf=idf)
    return dense.withColumn("signal", F.lit("dense")).unionByName(sparse.withColumn("signal", F.lit("sparse")))


def resolve_sparse(hits: DataFrame, dense: DataFrame, query_col: str = "query_id") -> DataFrame:
    """Turn sparse hits into the dense chunks they point at.

    ``hits``: query, sparse_id, score, rn, dense_chunk_ids. Several chunks of one hit become one
    entry: texts joined in pointer order, composite id, summed tokens, first non-empty title.
    Hits without pointers stand for themselves; dangling pointers drop out.
    """
    hit_cols = [query_col, "sparse_id", "score", "rn"]
    pointed = hits.select(*hit_cols, F.posexplode("dense_chunk_ids").alias("pos", "id"))
    found = pointed.join(dense.select("id", "text", "title", "token_count"), "id")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "id", "text", "title", "token_count")))
    merged = found.groupBy(*hit_cols).agg(ordered.alias("parts"))
    ids = F.transform("parts", lambda p: p["id"].cast("string"))
    titles = F.filter(F.transform("parts", lambda p: p["title"]), lambda t: F.coalesce(t, F.lit("")) != "")
    resolved = merged.select(
        *hit_cols,
        F.array_join(F.array_sort(ids), "+").alias("id"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "\n\n---\n\n").alias("text"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["token_count"]).alias("token_count"),
        F.coalesce(F.get(titles, F.lit(0)), F.lit("")).alias("title"),
        F.transform("parts", lambda p: p["id"]).alias("constituent_ids"),
    )
    own = hits.filter(F.coalesce(F.size("dense_chunk_ids"), F.lit(0)) <= 0)
    if "text" not in hits.columns:
        return resolved
    alone = own.select(*hit_cols, F.col("sparse_id").cast("string").alias("id"), "text",
                       F.col("token_count").cast("long").alias("token_count"),
                       F.coalesce(F.col("title"), F.lit("")).alias("title"),
                       F.array().cast("array<bigint>").alias("constituent_ids"))
    return resolved.unionByName(alone)


def merge_with_sources(dense: DataFrame, resolved: DataFrame, query_col: str = "query_id") -> DataFrame:
    """Dense hits first, then resolved sparse entries, one row per id with every source that found it.

    An entry whose constituents were all found before is dropped. Candidate lists are bounded by
    the two limits of one query, so the ordered pass over them is a small in-row fold.
    """
    d = dense.select(query_col, F.lit(0).alias("side"), F.col("rn").alias("pos"), F.col("id").cast("string").alias("id"),
                     F.array().cast("array<string>").alias("parts"), F.lit("dense").alias("source"))
    s = resolved.select(query_col, F.lit(1).alias("side"), F.col("rn").alias("pos"), "id",
                        F.col("constituent_ids").cast("array<string>").alias("parts"),
                        F.lit("sparse_resolved").alias("source"))
    listed = (d.unionByName(s).groupBy(query_col)
              .agg(F.array_sort(F.collect_list(F.struct("side", "pos", "id", "parts", "source"))).alias("items")))

    empty = F.struct(F.array().cast("array<string>").alias("seen"),
                     F.array().cast("array<string>").alias("kept"))

    def step(state: Column, item: Column) -> Column:
        known = F.array_contains(state["seen"], item["id"])
        covered = (F.size(item["parts"]) > 0) & (F.size(F.array_except(item["parts"], state["seen"])) == 0)
        skip = known | covered
        seen = F.when(skip, state["seen"]).otherwise(
            F.array_union(state["seen"], F.concat(F.array(item["id"]), item["parts"])))
        kept = F.when(skip, state["kept"]).otherwise(F.concat(state["kept"], F.array(item["id"])))
        return F.struct(seen.alias("seen"), kept.alias("kept"))

    folded = listed.select(query_col, "items", F.aggregate("items", empty, step).alias("state"))
    rows = folded.select(query_col, "items", F.posexplode("state.kept").alias("at", "id"))
    sources = F.array_distinct(F.transform(F.filter("items", lambda i: i["id"] == F.col("id")), lambda i: i["source"]))
    return rows.select(query_col, (F.col("at") + 1).alias("rank"), "id", sources.alias("sources"))


def exclude_seen(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Drop candidates that an earlier round returned."""
    return df.join(seen.select(*keys).distinct(), keys, "left_anti")
