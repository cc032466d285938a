"""A training corpus from the documents table: five stages, each on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.llm.common import free_name, table, written
from hybridloom.llm.decontamination import decontaminate
from hybridloom.llm.minhash import drop_near_duplicates
from hybridloom.llm.mixing import mixed_documents
from hybridloom.llm.sharding import shard_by_key
from hybridloom.llm.toxicity import THRESHOLD, labelled_documents, score_toxicity, train_toxicity

# The classifier and the union-find have no SQL form; the stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; null and empty texts are scored like the others."""
    model = train_toxicity(labelled_documents(docs, table(spark, sf_dir, "labels")))
    score = free_name(docs, "score")
    return score_toxicity(docs, model, out=score).where(F.col(score) < THRESHOLD).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of smallest doc_id."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's words by document, a row for each of a document's up to two passes."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture in eight shards by doc_id, with slots and the shard under nine."""
    return shard_by_key(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
