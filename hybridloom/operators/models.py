"""Model calls as a row contract: a callable per deployment, a deterministic expression by default."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from hybridloom.functions import replies, text as tx

# Question types of generated queries and the bucket each belongs to.
BUCKET_OF_TYPE = {
    "numeric_fact_lookup": "trivia", "named_entity_lookup": "trivia", "conceptual_explanation": "conceptual", "comparison_tradeoff": "conceptual",
    "paper_or_method_discovery": "conceptual", "implementation_guidance": "operational", "architecture_design": "operational",
    "failure_mode_debugging": "operational", "evaluation_method": "operational", "security_or_governance": "operational",
    "operational_monitoring": "operational"}
FALLBACK_BUCKET, UNKNOWN_TYPE = "operational", "unknown"


def with_samples(df: DataFrame, samples: int) -> DataFrame:
    """Every row ``samples`` times, numbered from 0, for judges that are asked more than once."""
    return df.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))


def call_model(df: DataFrame, inputs: list[str], model: Callable[..., str], out: str, retries: int = 2, pause: float = 1.0,
               accept: Callable[[str], bool] | None = None) -> DataFrame:
    """Append ``model(*inputs)`` and the seconds it took. A failing call, or a reply that ``accept`` refuses, is retried; then the
    last reply is kept with an error value.

    ``model`` travels to the tasks; a client object belongs inside it, made on first use.
    """
    @F.pandas_udf("reply string, elapsed_seconds double, error string")
    def ask(*columns: pd.Series) -> pd.DataFrame:
        rows = []
        for values in zip(*columns):
            start, reply, error = time.monotonic(), None, None
            for attempt in range(retries + 1):
                try:
                    reply, error = model(*values), None
                    if accept is None or accept(reply):
                        break
                    error = "reply not accepted"
                except Exception as problem:
                    error = str(problem)[:500]
                    if attempt < retries:
                        time.sleep(pause * 2 ** attempt)
            rows.append((reply, time.monotonic() - start, error))
        return pd.DataFrame(rows, columns=["reply", "elapsed_seconds", "error"])

    return df.withColumn(out, ask(*[F.col(c) for c in inputs]))


def shared_terms(query: Column, text: Column) -> Column:
    """Distinct terms of the query that the text holds."""
    return F.size(F.array_intersect(tx.terms(query), tx.terms(text)))


def lexical_relevance(query: Column, text: Column) -> Column:
    """Offline relevance judge 1..3: by the share of the query's terms found in the text."""
    share = shared_terms(query, text) / F.greatest(F.size(F.array_distinct(tx.terms(query))), F.lit(1))
    return F.when(share >= 0.5, 3).when(share >= 0.2, 2).otherwise(1)


def lexical_rerank(hits: DataFrame, keys: list[str], query: str = "query", id_col: str = "id", out: str = "reranked") -> DataFrame:
    """Offline listwise reranker: most shared terms first, the given rank decides ties."""
    order = Window.partitionBy(*keys).orderBy(F.desc("shared"), F.asc("rn"), F.asc(id_col))
    return hits.withColumn("shared", shared_terms(F.col(query), F.col("text"))).withColumn(out, F.row_number().over(order))


def generated_query(reply: Column) -> Column:
    """struct<query, query_type, query_bucket> of a generator's JSON; of plain text the first line is the query, its type unknown."""
    bare = replies.strip_wrappers(reply)
    kind = F.coalesce(F.get_json_object(bare, "$.query_type"), F.lit(UNKNOWN_TYPE))
    spoken = F.trim(tx.strip(F.substring_index(tx.strip(bare), "\n", 1)), F.lit('"'))
    bucket = F.lit(FALLBACK_BUCKET)
    for name, group in BUCKET_OF_TYPE.items():
        bucket = F.when(kind == name, group).otherwise(bucket)
    return F.struct(F.coalesce(tx.strip(F.get_json_object(bare, "$.query")), spoken).alias("query"), kind.alias("query_type"), bucket.alias("query_bucket"))


def distinct_queries(replies_: DataFrame, column: str = "query", shortest: int = 10) -> DataFrame:
    """Generated queries once each, the short ones left out."""
    return replies_.select(tx.strip(F.col(column)).alias(column)).filter(F.length(column) > shortest).distinct()


def docket_id(seed: str, *parts: Column) -> Column:
    """Opaque seven-character id of a chunk shown to a judge."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(seed), *[p.cast("string") for p in parts])), 1, 7)


def first_line(rewritten: Column, original: Column) -> Column:
    """First line of a rewritten query, the original where it is blank."""
    return F.coalesce(F.nullif(tx.strip(F.substring_index(tx.strip(rewritten), "\n", 1)), F.lit("")), original)
