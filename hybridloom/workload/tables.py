"""The given tables in the roles the engine expects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.functions import encoders, text as tx
from hybridloom.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, dealt: bool = True) -> DataFrame:
    """Documents as points: source plays source_file, lang plays language and category. For text work they are dealt to the cores first."""
    rows = table(spark, sf_dir, "documents")
    return (spread(rows) if dealt else rows).select(
        F.col("doc_id").alias("id"), "text", F.col("source").alias("source_file"),
        F.col("lang").alias("language"), F.col("lang").alias("category"), "n_chars",
        tx.token_estimate(F.col("text")).cast("long").alias("token_count"))


def encoded_documents(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """Documents with the default dense and/or sparse vector."""
    makers = {"dense": encoders.dense_terms, "sparse": encoders.sparse_terms}
    return documents(spark, sf_dir).withColumns({k: makers[k](F.col("text")) for k in kinds})


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages as user queries."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"),
        encoders.dense_terms(F.col("text")).alias("dense"),
        encoders.sparse_terms(F.col("text")).alias("sparse"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as chunks: the conversation plays the file, the turn its sections."""
    text = F.col("text")
    return spread(table(spark, sf_dir, "conversations")).select(
        (F.col("conv_id") * 100000 + F.col("turn")).alias("id"),
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("source_file"),
        F.col("turn").cast("int").alias("section_index"), F.col("turn").cast("int").alias("chunk_index"),
        F.col("role").alias("section_title"), F.col("role").alias("doc_type"), "text",
        tx.token_estimate(text).cast("long").alias("token_count"))


# SQL pieces shared by the comparison queries.
TERMS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


def sql_terms(name: str, source: str, key: str, out: str) -> str:
    return f"""{name} AS (SELECT {key} AS {out}, t AS term, count(*) AS tf
      FROM (SELECT {key}, unnest({TERMS}) AS t FROM {source}) GROUP BY 1, 2)"""


def sql_vectors(name: str, terms: str, key: str) -> str:
    return f"""{name} AS (SELECT {key}, ('0x' || substr(md5(term), 1, 4))::INT % 64 AS b,
      sum(CASE WHEN ('0x' || substr(md5(term), 5, 1))::INT % 2 = 0 THEN tf ELSE -tf END)::DOUBLE AS v
      FROM {terms} GROUP BY 1, 2)"""


def sql_dense(points: str = "documents", point_key: str = "doc_id", where: str = "true") -> str:
    """dense_scores(query_id, id, score) for every prompt and every point."""
    return f"""{sql_terms('p_terms', points, point_key, 'id')}, {sql_terms('q_terms', 'benchmark', 'item_id', 'query_id')},
    {sql_vectors('p_vec', 'p_terms', 'id')}, {sql_vectors('q_vec', 'q_terms', 'query_id')},
    p_len AS (SELECT id, sqrt(sum(v * v)) AS len FROM p_vec GROUP BY 1),
    q_len AS (SELECT query_id, sqrt(sum(v * v)) AS len FROM q_vec GROUP BY 1),
    dots AS (SELECT query_id, id, sum(p.v * q.v) AS dot FROM p_vec p JOIN q_vec q USING (b) GROUP BY 1, 2),
    dense_scores AS (SELECT b.item_id AS query_id, d.{point_key} AS id,
        CASE WHEN coalesce(p_len.len, 0) * coalesce(q_len.len, 0) = 0 THEN 0
             ELSE coalesce(dot, 0) / (q_len.len * p_len.len) END AS score
      FROM benchmark b CROSS JOIN (SELECT * FROM {points} WHERE {where}) d
      LEFT JOIN dots ON dots.query_id = b.item_id AND dots.id = d.{point_key}
      LEFT JOIN p_len ON p_len.id = d.{point_key} LEFT JOIN q_len ON q_len.query_id = b.item_id)"""


def sql_sparse(with_terms: bool = False, points: str = "documents", point_key: str = "doc_id") -> str:
    """sparse_scores(query_id, id, score); the term tables come along unless sql_dense made them."""
    head = (f"{sql_terms('p_terms', points, point_key, 'id')}, {sql_terms('q_terms', 'benchmark', 'item_id', 'query_id')},"
            if with_terms else "")
    return f"""{head} p_df AS (SELECT term, count(*) AS df FROM p_terms GROUP BY 1),
    p_n AS (SELECT count(*) AS n FROM {points}),
    sparse_scores AS (SELECT query_id, id,
        round(sum(ln(1 + p.tf) * ln(1 + q.tf) * ln(1 + (n - df + 0.5) / (df + 0.5))), 9) AS score
      FROM q_terms q JOIN p_terms p USING (term) JOIN p_df USING (term), p_n GROUP BY 1, 2)"""


def sql_ranked(scores: str, name: str, k: int) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rn
      FROM {scores}) WHERE rn <= {k})"""
