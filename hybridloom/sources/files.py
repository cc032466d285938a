"""File discovery and line sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridloom.functions import text as tx

SUPPORTED = ["epub", "pdf", "json"]


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def list_files(spark: SparkSession, folder: str, extensions: list[str], recursive: bool = False) -> DataFrame:
    """path, name, ext, content of the files with a known extension; others are ignored.

    The pattern prunes the listing; file contents are read only where a query asks for them.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.{" + ",".join(extensions) + "}")
    found = reader.option("recursiveFileLookup", str(recursive).lower()).load(folder)
    name = file_name(F.col("path"))
    return found.select("path", name.alias("name"), F.lower(F.element_at(F.split(name, r"\."), -1)).alias("ext"), "length", "content")


def loader_for(name: str) -> str:
    """The loader of a file name; an unknown extension is an error."""
    ext = name.rsplit(".", 1)[-1].lower() if "." in name else ""
    if ext not in SUPPORTED:
        raise ValueError(f"unsupported file type: {name}")
    return {"epub": "epub", "pdf": "pdf", "json": "layout"}[ext]


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def prompts(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """Numbered prompts: a JSON list or object with ``prompts``, else non-blank lines without ``#``."""
    raw = whole_texts(spark, path)
    listed = F.coalesce(F.from_json("value", "array<string>"), F.from_json("value", "prompts array<string>")["prompts"])
    lines = F.filter(F.transform(F.split("value", r"\r?\n"), tx.strip), lambda s: (s != "") & ~s.startswith("#"))
    found = raw.select(F.posexplode(F.coalesce(listed, lines)).alias("i", "text")).select((F.col("i") + 1).alias("prompt_index"), "text")
    return found.filter(F.col("prompt_index") <= first) if first else found


def numeric_prefix_order(name: Column) -> list[Column]:
    """Sort by the leading number of a file name, then by its name."""
    return [F.regexp_extract(name, r"^(\d+)", 1).try_cast("int").asc_nulls_last(), name.asc()]


def assessment_dimensions(name: Column) -> Column:
    """``{id}_{category}_{proficiency}_{topk}.json``; the category may contain underscores."""
    part = lambda n: F.regexp_extract(name, r"^(\d+)_(.+)_(\d+)_(\d+)\.json$", n)
    return F.struct(part(1).try_cast("int").alias("input_id"), part(2).alias("category"),
                    part(3).try_cast("int").alias("proficiency"), part(4).try_cast("int").alias("topk"))


def arxiv_ids(markdown: DataFrame, category: str = "category", subcategory: str = "subcategory", text: str = "value") -> DataFrame:
    """arXiv ids of Markdown indexes per category, with the subcategories that list them."""
    ids = F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(r"arxiv\.org/(?:abs|pdf)/(\d{4}\.\d{4,5})"), F.lit(1)))).alias("arxiv_id")
    return (markdown.select(category, subcategory, ids).groupBy(category, "arxiv_id")
            .agg(F.array_sort(F.collect_set(subcategory)).alias("subcategories")))
