"""Metadata files next to books and papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridloom.functions import text as tx
from hybridloom.sources.files import file_name, whole_texts

OVERRIDES = {"title": "title", "authors": "creator", "publisher": "publisher", "language": "language",
             "isbn": "isbn", "publish_date": "publication_date"}


def attributes(document: Column) -> Column:
    """map<string,string> from ``metadataAttributes``: an object, or a list of "key: value" strings."""
    as_map = F.from_json(document, "metadataAttributes map<string,string>")["metadataAttributes"]
    as_list = F.from_json(document, "metadataAttributes array<string>")["metadataAttributes"]
    pairs = F.transform(F.filter(as_list, lambda s: s.contains(":")), lambda s: F.struct(
        tx.strip(F.substring_index(s, ":", 1)).alias("key"),
        tx.strip(F.regexp_replace(s, r"^[^:]*:", "")).alias("value")))
    # A later entry of the same key wins.
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.coalesce(as_map, F.map_from_entries(last), F.create_map().cast("map<string,string>"))


def read_sidecars(spark: SparkSession, folder: str, suffix: str = ".metadata.json") -> DataFrame:
    """name (of the file described), meta."""
    found = whole_texts(spark, f"{folder.rstrip('/')}/*{suffix}")
    name = F.regexp_replace(file_name(F.col("path")), suffix.replace(".", r"\.") + "$", "")
    return found.select(name.alias("name"), attributes(F.col("value")).alias("meta"))


def override(books: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Sidecar values replace the embedded ones where they are given."""
    joined = books.join(sidecars, "name", "left")
    return joined.withColumns({field: F.coalesce(F.nullif(F.col("meta")[key], F.lit("")), F.col(field))
                               for key, field in OVERRIDES.items()}).drop("meta")
