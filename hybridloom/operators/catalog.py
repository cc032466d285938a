"""Catalogue operations over a point table: sources, counts, pages and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hybridloom.schema import as_points, first_present, has, present

BOOK_FIELDS = ["book_title", "publisher", "language", "isbn"]
SOURCE_FIELDS = ["title", "arxiv_id", "category", "subcategory", "authors", "publish_date",
                 "doc_type", "publisher", "language", "isbn"]


def _text(name: str, df: DataFrame) -> Column:
    """A payload value as text; author lists read as ``a, b``."""
    kind = dict(df.dtypes)[name]
    value = F.array_join(name, ", ") if kind.startswith("array") else F.col(name).cast("string")
    return F.coalesce(value, F.lit(""))


def _per_source(df: DataFrame, title: Column, fields: list[str], title_field: str, id_col: str) -> DataFrame:
    """One row per source_file; the attributes come together from the first titled row by id.

    min_by is combined on the map side, so a source holding a third of all rows costs one
    partial row per task.
    """
    df = as_points(df)
    attributes = F.struct(*[(title if f == title_field else _text(f, df)).alias(f) for f in fields])
    source = F.coalesce(F.col("source_file"), F.lit("unknown")).alias("source_file")
    titled = F.when(title != "", attributes)
    order = F.when(title != "", F.col(id_col))
    # Without any titled row the attributes of the last row by id stay.
    found = (df.groupBy(source)
             .agg(F.count("*").alias("chunk_count"), F.min_by(titled, order).alias("first_titled"),
                  F.max_by(attributes, id_col).alias("last_any")))
    chosen = F.coalesce(F.col("first_titled"), F.col("last_any"))
    return found.select("source_file", "chunk_count", *[chosen[f].alias(f) for f in fields])


def list_books(df: DataFrame, id_col: str = "id") -> DataFrame:
    df = as_points(df)
    return _per_source(df, F.coalesce(F.col("book_title"), F.lit("")), BOOK_FIELDS, "book_title", id_col)


def list_sources(df: DataFrame, id_col: str = "id") -> DataFrame:
    df = as_points(df)
    return _per_source(df, first_present(F.col("title"), F.col("book_title")), SOURCE_FIELDS, "title", id_col)


def category_counts(sources: DataFrame) -> DataFrame:
    """Sources per category; doc_type stands in for a missing one."""
    name = F.coalesce(present(F.col("category")), present(F.col("doc_type")), F.lit("uncategorized"))
    return sources.groupBy(name.alias("category")).agg(F.count("*").alias("sources"))


def in_category(sources: DataFrame, category: str) -> DataFrame:
    wanted = F.lower(F.lit(category))
    return sources.filter((F.lower("category") == wanted) | (F.lower("subcategory") == wanted))


def matching(sources: DataFrame, search: str) -> DataFrame:
    """Case-insensitive substring in title, authors, arXiv id or file name."""
    wanted = F.lower(F.lit(search))
    hit = F.lit(False)
    for name in ("title", "authors", "arxiv_id", "source_file"):
        hit = hit | F.lower(F.coalesce(F.col(name), F.lit(""))).contains(wanted)
    return sources.filter(hit)


def page(sources: DataFrame, offset: int, limit: int) -> DataFrame:
    """A page in title order (file name where there is no title); ``limit`` 0 is an empty page."""
    if limit <= 0:
        return sources.limit(0)
    key = F.lower(first_present(F.col("title"), F.col("source_file")))
    return sources.orderBy(key, "source_file").offset(offset).limit(limit)


def sample_order(id_col: str, seed: int | str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def substantive(df: DataFrame, min_tokens: int = 200, source_file: str | None = None) -> DataFrame:
    """Rows worth sampling; predicates apply only where the column exists (a plan-time check)."""
    df = df.filter(F.col("token_count") >= min_tokens)
    if source_file:
        df = df.filter(F.col("source_file") == source_file)
    if has(df, "chunk_count"):
        df = df.filter(F.col("chunk_count") >= 2)
    if has(df, "has_heading_context"):
        df = df.filter(F.col("has_heading_context"))
    return df


def pick_one(df: DataFrame, id_col: str = "id", seed: int | str | None = None) -> DataFrame:
    """One row: random, or the same one for the same seed."""
    order = F.rand() if seed is None else sample_order(id_col, seed)
    return df.orderBy(order, id_col).limit(1)


def representative(df: DataFrame, order: str, batches: int, text: str = "text") -> DataFrame:
    """Rows spread evenly over one source: every n-th by ``order``, blank texts skipped, at most ``batches``."""
    step = max(1, df.count() // batches)
    spaced = dense_position(df, order).filter(F.pmod("position", F.lit(step)) == 0)
    return spaced.filter(F.trim(F.coalesce(F.col(text), F.lit(""))) != "").orderBy("position").limit(batches)


def dense_position(df: DataFrame, order: str, out: str = "position", parts: int | None = None) -> DataFrame:
    """0-based position in the order of a unique numeric column over the whole table.

    Approximate quantiles cut the column into ranges (literals of the plan, so a recomputed task
    cuts at the same values). A row's position is the number of rows in earlier ranges plus its
    place inside its own range; no task sorts more than one range.
    """
    from pyspark.sql import Window

    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.approxQuantile(order, [i / parts for i in range(1, parts)], 0.001) if parts > 1 else []
    piece = F.lit(0)
    for cut in sorted(set(cuts)):
        piece = piece + (F.col(order) > F.lit(cut)).cast("int")
    ranged = df.withColumn("_part", piece)
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))  # one row per range
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy(order)
    return (ranged.join(F.broadcast(starts), "_part")
            .withColumn(out, F.col("_start") + F.row_number().over(inside) - 1).drop("_part", "_start"))


def paper_stems(df: DataFrame) -> DataFrame:
    """Distinct .pdf sources without their extension."""
    return (df.filter(F.col("source_file").endswith(".pdf"))
            .select(F.regexp_replace("source_file", r"\.pdf$", "").alias("paper")).distinct())
