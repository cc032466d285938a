"""Stored evaluation artefacts: critiques, verdicts, retrievals; and their writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.sources.files import file_name, whole_texts

CRITIQUE_SCHEMA = (
    "prompt_index int, prompt_text string, topk int, sparse_k int, dense_k int, sparse_fraction string, sparse_collection string, "
    "chunks array<struct<docket_id:string,judge_id:string,rank:int,source:string,sources:array<string>>>, "
    "judge_outputs array<struct<raw:string,parsed:struct<chunks:array<struct<id:string,relevance:int,reason:string>>,reply:string,satisfaction:int>,"
    "parse_ok:boolean,retried:boolean,error:string>>, "
    "judge_output struct<raw:string,parsed:struct<chunks:array<struct<id:string,relevance:int,reason:string>>,reply:string,satisfaction:int>,"
    "parse_ok:boolean,retried:boolean,error:string>")


def read_critiques(spark: SparkSession, folder: str) -> DataFrame:
    """Critique files with their name; older fields are folded into the current ones."""
    raw = spark.read.schema(CRITIQUE_SCHEMA).option("multiLine", "true").json(folder)
    named = raw.withColumn("file", file_name(F.col("_metadata.file_path")))
    chunk = lambda c: F.struct(F.coalesce(c["docket_id"], c["judge_id"]).alias("docket_id"), c["rank"].alias("rank"), c["source"].alias("source"),
                               F.coalesce(c["sources"], F.array(c["source"])).alias("sources"))
    return named.withColumn("chunks", F.transform("chunks", chunk))


RETRIEVAL_SCHEMA = (
    "prompt_index int, prompt_text string, topk int, sparse_k int, dense_k int, sparse_fraction string, dense_collection string, sparse_collection string, "
    "timestamp_utc string, dense_raw array<struct<id:string,score:double>>, sparse_raw array<struct<id:string,score:double>>, "
    "merged array<struct<rank:int,id:string,source:string,sources:array<string>,token_count:int,text:string,title:string,docket_id:string,"
    "constituent_ids:array<string>,originating_sparse_id:string>>")


def read_retrievals(spark: SparkSession, folder: str) -> DataFrame:
    """Retrieval files ``prompt_001_sk_2.json`` with their name. The case is in the name where a file does not tell it; ids of any kind are strings, and
    fields that are absent are NULL."""
    raw = spark.read.schema(RETRIEVAL_SCHEMA).option("multiLine", "true").option("pathGlobFilter", "*.json").json(folder)
    named = raw.withColumn("file", file_name(F.col("_metadata.file_path")))
    part = lambda n: F.regexp_extract("file", r"^prompt_(\d+)_sk_(\d+)", n).try_cast("int")
    return named.withColumns({"prompt_index": F.coalesce("prompt_index", part(1)), "sparse_k": F.coalesce("sparse_k", part(2))})


def retrieved_chunks(retrievals: DataFrame) -> DataFrame:
    """A row for each merged chunk of the cases, in rank order of the files."""
    return retrievals.select("prompt_index", "sparse_k", "topk", F.inline("merged"))


def case_of(critiques: DataFrame) -> DataFrame:
    """prompt_index, sparse_k and tag of study files ``prompt_001_sk_2_control.json``."""
    part = lambda n: F.regexp_extract("file", r"^prompt_(\d+)_sk_(\d+)_(control|variable)\.json$", n)
    return critiques.withColumns({"prompt_index": F.coalesce(part(1).try_cast("int"), "prompt_index"),
                                  "sparse_k": F.coalesce(part(2).try_cast("int"), "sparse_k"), "tag": part(3)})


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """key, verdict from a JSON object; older files hold "0" and "1", unreadable values are NULL."""
    entries = whole_texts(spark, path).select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "v"))
    value = F.col("v").try_cast("double")
    return entries.select("key", F.when(value.between(0.0, 1.0), value).alias("verdict"))


def read_convergence(spark: SparkSession, path: str) -> DataFrame:
    """Training telemetry as tab-separated values."""
    schema = "epoch int, step long, samples long, loss double, mse double, aux double, explained_var double, dead_features long, lr double"
    return spark.read.csv(path, sep="\t", header=True, schema=schema)


def write_json(df: DataFrame, path: str) -> None:
    """Artefacts appear together when the job commits."""
    df.write.mode("overwrite").json(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """A small report table as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
