"""Layout-JSON documents on disk: a folder tree per paper, or flat files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.functions import layout
from hybridloom.session import checked_broadcast

# Fixed value: file name of a layout document.
LAYOUT_FILE = "content_list_v2.json"


def dotted(arxiv_id):
    return F.translate(arxiv_id, "_", ".")


def discover(spark: SparkSession, base: str, suffix: str = LAYOUT_FILE) -> DataFrame:
    """arxiv_id, path, value: ``<id>/…/content_list_v2.json`` wins over ``<id>_content_list_v2.json``."""
    # Paths are chosen before any document is read; the listing of paths is what the driver has of a file scan in any case.
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(base).select("path")
    relative = F.element_at(F.split("path", base.rstrip("/").rsplit("/", 1)[-1] + "/"), -1)
    flat = ~relative.contains("/")
    name = F.when(flat, F.regexp_replace(relative, f"_?{suffix}$", "")).otherwise(F.substring_index(relative, "/", 1))
    listed = found.select(dotted(name).alias("arxiv_id"), F.struct(flat.cast("int").alias("rank"), "path").alias("choice"))
    best = listed.groupBy("arxiv_id").agg(F.min("choice").alias("c")).select("arxiv_id", F.col("c.path").alias("chosen")).collect()
    if not best:
        return spark.createDataFrame([], "arxiv_id string, path string, value string")
    plain = lambda path: F.regexp_replace(path, "^file:/+", "/")
    texts = spark.read.text([r["chosen"] for r in best], wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    named = spark.createDataFrame(best, "arxiv_id string, chosen string").select("arxiv_id", plain(F.col("chosen")).alias("_plain"))
    return texts.withColumn("_plain", plain(F.col("path"))).join(checked_broadcast(named), "_plain").select("arxiv_id", "path", "value")


def sections(documents: DataFrame) -> DataFrame:
    """Sections of layout documents; a file that is no JSON array yields none."""
    return documents.select("arxiv_id", F.inline(layout.sections(F.col("value"))))
