"""Table layouts and the unified-field rules every reader applies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

SPARSE_VECTOR = T.StructType([
    T.StructField("indices", T.ArrayType(T.StringType())),
    T.StructField("values", T.ArrayType(T.DoubleType())),
])

# The union of the book and the paper payload.
PAYLOAD = {
    "text": "string", "source_file": "string", "title": "string", "section": "string",
    "doc_type": "string", "book_title": "string", "section_title": "string",
    "chapter_index": "int", "section_index": "int", "chunk_index": "int", "doc_chunk_seq": "int",
    "chunk_count": "int", "token_count": "int", "heading_level": "int", "has_heading_context": "boolean",
    "publisher": "string", "language": "string", "isbn": "string", "arxiv_id": "string",
    "category": "string", "subcategory": "string", "publish_date": "string",
    "authors": "array<string>", "year": "int", "dense_chunk_ids": "array<string>",
}

# Metadata fields that belong to equality filters.
KEYWORD_FIELDS = [
    "doc_type", "source_file", "book_title", "section_title", "publisher",
    "language", "isbn", "arxiv_id", "category", "title",
]

SECTION_SCHEMA = "section_index int, title string, content string, heading_level int"


def present(value: Column) -> Column:
    """An empty string counts as missing."""
    return F.nullif(value, F.lit(""))


def first_present(*values: Column) -> Column:
    return F.coalesce(*[present(v) for v in values], F.lit(""))


def has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def column_or(df: DataFrame, name: str, default: Column) -> Column:
    return F.col(name) if has(df, name) else default


def as_points(df: DataFrame) -> DataFrame:
    """Add whatever payload column is absent (as NULL), keep vectors and ids."""
    missing = {n: F.lit(None).cast(t) for n, t in PAYLOAD.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def unify_fields(df: DataFrame) -> DataFrame:
    """title and section as every reader sees them."""
    df = as_points(df)
    return df.withColumns({
        "title": first_present(F.col("title"), F.col("book_title"), F.col("section_title")),
        "section": first_present(F.col("section"), F.col("section_title")),
    })


def equality_filter(df: DataFrame, filter_by: dict | None) -> DataFrame:
    """Conjunction of conditions, applied below the ranking so that it reaches the scan.

    A value is an equality, a list any of its values, and a dictionary a range with gt, gte, lt or lte. An empty list holds for no row.
    """
    tests = {"gt": lambda c, v: c > v, "gte": lambda c, v: c >= v, "lt": lambda c, v: c < v, "lte": lambda c, v: c <= v}
    for name, value in (filter_by or {}).items():
        column = F.col(name)
        if isinstance(value, dict):
            unknown = set(value) - set(tests)
            if unknown:
                raise ValueError(f"filter on {name}: {sorted(unknown)} are no range bounds")
            for bound, limit in value.items():
                df = df.filter(tests[bound](column, F.lit(limit)))
        elif isinstance(value, (list, tuple, set)):
            df = df.filter(column.isin(*value) if value else F.lit(False))
        else:
            df = df.filter(column == F.lit(value))
    return df
