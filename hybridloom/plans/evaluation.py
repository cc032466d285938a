"""An evaluation run as one plan: prompts -> rank lists -> fused lists at every weight -> judgements -> tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from hybridloom.operators import evaluation, fusion, models, topk


def judged_lists(points: DataFrame, prompts: DataFrame, weights: list[float], k: int,
                 judge: Callable[[Column, Column], Column] = models.lexical_relevance, deep: int = 3) -> DataFrame:
    """(query_id, weight, rn, id, score, relevance): the best ``k`` at every sparse weight, each hit judged once.

    ``points`` carry id, text, dense and sparse; ``prompts`` query_id, query, dense and sparse. Both signals are ranked once, ``deep`` times
    as deep as the lists, and replayed. A hit that several weights share is judged in one row.
    """
    lists = fusion.rank_lists(topk.dense_topk(points, prompts, deep * k), topk.sparse_topk(points, prompts, deep * k))
    fused = fusion.replay_weights(lists, weights, k)
    pairs = fused.select("query_id", "id").distinct()
    shown = pairs.join(points.select("id", "text"), "id").join(prompts.select("query_id", "query"), "query_id")
    verdicts = shown.select("query_id", "id", judge(F.col("query"), F.col("text")).alias("relevance"))
    return fused.join(verdicts, ["query_id", "id"]).select("query_id", "weight", "rn", "id", "score", "relevance")


def evaluation_run(points: DataFrame, prompts: DataFrame, weights: list[float], k: int, **options) -> DataFrame:
    """(weight, queries, avg_relevance, relevant_share, best): one row for each sparse weight."""
    judged = judged_lists(points, prompts, weights, k, **options)
    means = evaluation.best_weight(evaluation.average_relevance(judged, ["query_id", "weight"]))
    shares = judged.groupBy("weight").agg(F.count_distinct("query_id").alias("queries"), F.avg((F.col("relevance") >= 2).cast("int")).alias("relevant_share"))
    return means.join(shares, "weight").select("weight", "queries", "avg_relevance", "relevant_share", "best")
