"""The same prompts against several sources, each with its own share of k, as one table."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from hybridloom.session import cut_lineage

#: prompt_id, source, rank, type, text, total_results, lookup_time
Search = Callable[[DataFrame, int], DataFrame]


@dataclass(frozen=True)
class Source:
    """A way to search all prompts: ``search(prompts, k)`` gives (query_id, rn, text); ``factor`` times k hits are asked of it and ``shown`` times k kept."""
    name: str
    search: Search
    factor: int = 1
    shown: int | None = None


def fan_out(prompts: DataFrame, sources: list[Source], topk: int) -> DataFrame:
    """(query_id, source, rank, type, text, total_results, lookup_time): the answers of every source to every prompt.

    A source that finds nothing for a prompt gives one row with rank 0 and no text, so every prompt and source is there. ``total_results`` counts what
    the source found before ``shown`` cuts it. All prompts are asked of a source in one plan, whose bounded answer is written; lookup_time is its
    seconds by the number of prompts.
    """
    known = prompts.select("query_id").distinct()
    asked, parts = known.count(), []
    for source in sources:
        start = time.monotonic()
        hits = cut_lineage(source.search(prompts, topk * source.factor).select("query_id", F.col("rn").cast("int").alias("rank"), "text"))
        seconds = (time.monotonic() - start) / max(asked, 1)
        totals = hits.groupBy("query_id").agg(F.count("*").alias("total_results"))
        rows = hits.where(F.col("rank") <= topk * (source.shown or source.factor))
        joined = known.join(totals, "query_id", "left").join(rows, "query_id", "left")
        parts.append(joined.select("query_id", F.lit(source.name).alias("source"), F.coalesce("rank", F.lit(0)).alias("rank"), F.lit("TEXT").alias("type"), "text",
                                   F.coalesce("total_results", F.lit(0)).cast("long").alias("total_results"), F.lit(seconds).alias("lookup_time")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
