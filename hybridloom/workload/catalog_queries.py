"""Catalogue queries: the documents table is a collection of chunks of 20 sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.functions import text as tx
from hybridloom.operators import catalog
from hybridloom.workload import tables as tb
from hybridloom.workload.registry import query


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Document rows with a title only where the text is longer than 2000 characters."""
    title = F.when(F.col("n_chars") > 2000, F.concat(F.lit("Title "), F.col("source_file"), F.lit("/"), F.col("id").cast("string"))).otherwise("")
    return tb.documents(spark, sf).withColumns({
        "title": title, "book_title": title, "publisher": F.concat(F.lit("pub-"), F.col("language")),
        "subcategory": F.upper("language"), "isbn": F.col("id").cast("string")})


_TITLED = "CASE WHEN n_chars > 2000 THEN 'Title ' || source || '/' || doc_id ELSE '' END"
_BASE = f"""c AS (SELECT doc_id, source AS source_file, {_TITLED} AS title, lang, 'pub-' || lang AS publisher, doc_id::VARCHAR AS isbn FROM documents),
 g AS (SELECT source_file, count(*) AS chunk_count, coalesce(min(doc_id) FILTER (title <> ''), max(doc_id)) AS pick FROM c GROUP BY 1),
 src AS (SELECT g.source_file, chunk_count, title, lang, publisher, isbn FROM g JOIN c ON doc_id = pick)"""


@query("list_books", f"""WITH {_BASE} SELECT source_file, chunk_count, title AS book_title, publisher, lang AS language, isbn FROM src""")
def list_books(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.list_books(chunks(spark, sf))


@query("list_sources", f"""WITH {_BASE} SELECT source_file, chunk_count, title, '' AS arxiv_id, lang AS category, upper(lang) AS subcategory,
 '' AS authors, '' AS publish_date, '' AS doc_type, publisher, lang AS language, isbn FROM src""")
def list_sources(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.list_sources(chunks(spark, sf))


@query("list_sources_page", f"""WITH {_BASE} SELECT source_file, chunk_count, title FROM src
 ORDER BY lower(coalesce(nullif(title, ''), source_file)), source_file LIMIT 5 OFFSET 3""")
def list_sources_page(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.page(catalog.list_sources(chunks(spark, sf)), 3, 5).select("source_file", "chunk_count", "title")


@query("page_totals", f"""WITH {_BASE} SELECT count(*) AS total, 3 + 5 < count(*) AS has_more FROM src""")
def page_totals(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.list_sources(chunks(spark, sf)).agg(F.count("*").alias("total"), (F.lit(8) < F.count("*")).alias("has_more"))


@query("category_counts", f"""WITH {_BASE} SELECT lang AS category, count(*) AS sources FROM src GROUP BY 1""")
def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.category_counts(catalog.list_sources(chunks(spark, sf)))


@query("category_filter", f"""WITH {_BASE} SELECT source_file, title FROM src WHERE lower(lang) = 'en' OR lower(upper(lang)) = 'en'""")
def category_filter(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.in_category(catalog.list_sources(chunks(spark, sf)), "EN").select("source_file", "title")


@query("text_search_sources", f"""WITH {_BASE} SELECT source_file, title FROM src WHERE contains(lower(title), 'src1') OR contains(lower(source_file), 'src1')""")
def text_search_sources(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.matching(catalog.list_sources(chunks(spark, sf)), "SRC1").select("source_file", "title")


@query("text_search_parts", """SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring') OR contains(lower(p_brand), 'ring')""")
def text_search_parts(spark: SparkSession, sf: str) -> DataFrame:
    found = tb.table(spark, sf, "part").withColumns({"title": F.col("p_name"), "authors": F.col("p_brand"), "arxiv_id": F.lit(""), "source_file": F.lit("")})
    return catalog.matching(found, "Ring").select("p_partkey", "p_name")


@query("scroll_page", """SELECT doc_id AS id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM documents
 WHERE trim(text) <> '' ORDER BY doc_id LIMIT 25 OFFSET 50""")
def scroll_page(spark: SparkSession, sf: str) -> DataFrame:
    rows = tb.documents(spark, sf).select("id", tx.strip(F.col("text")).alias("text")).filter("text <> ''")
    return rows.orderBy("id").offset(50).limit(25)


@query("scroll_all", """SELECT doc_id AS id, md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS text_md5 FROM documents WHERE trim(text) <> ''""")
def scroll_all(spark: SparkSession, sf: str) -> DataFrame:
    """(id, text) of a whole collection, stripped, empty ones removed."""
    rows = tb.documents(spark, sf).select("id", tx.strip(F.col("text")).alias("text")).filter("text <> ''")
    return rows.select("id", F.md5("text").alias("text_md5"))


@query("scroll_filtered", "SELECT doc_id AS id, lang AS language, source AS source_file, n_chars FROM documents WHERE source = 'src3' AND lang = 'en'")
def scroll_filtered(spark: SparkSession, sf: str) -> DataFrame:
    from hybridloom.schema import equality_filter
    rows = equality_filter(tb.documents(spark, sf), {"source_file": "src3", "language": "en"})
    return rows.select("id", "language", "source_file", "n_chars")


@query("scroll_any_and_range", "SELECT doc_id AS id, lang AS language, source AS source_file, n_chars FROM documents WHERE source IN ('src3', 'src5') AND n_chars >= 500 AND n_chars < 5000")
def scroll_any_and_range(spark: SparkSession, sf: str) -> DataFrame:
    """Any of several sources and a range of lengths."""
    from hybridloom.schema import equality_filter
    rows = equality_filter(tb.documents(spark, sf), {"source_file": ["src3", "src5"], "n_chars": {"gte": 500, "lt": 5000}})
    return rows.select("id", "language", "source_file", "n_chars")


@query("collection_stats", """SELECT lang AS collection, count(*) AS points, sum(n_chars // 4)::BIGINT AS tokens FROM documents GROUP BY 1""")
def collection_stats(spark: SparkSession, sf: str) -> DataFrame:
    return tb.documents(spark, sf).groupBy(F.col("language").alias("collection")).agg(
        F.count("*").alias("points"), F.sum(F.floor(F.col("n_chars") / 4)).cast("long").alias("tokens"))


@query("seeded_sample", "SELECT doc_id AS id, source AS source_file FROM documents WHERE n_chars // 4 >= 200 ORDER BY md5('42:' || doc_id) LIMIT 1")
def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    kept = catalog.substantive(tb.documents(spark, sf), 200)
    return catalog.pick_one(kept, seed=42).select("id", "source_file")


@query("representative_chunks", """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position, count(*) OVER () AS n FROM documents WHERE source = 'src1')
SELECT doc_id AS id, position FROM r WHERE position % (n // 5) = 0 ORDER BY position LIMIT 5""")
def representative_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Five evenly spaced chunks of one source, the snippets for query generation."""
    book = tb.documents(spark, sf).filter(F.col("source_file") == "src1")
    return catalog.representative(book, "id", 5).select("id", "position")


@query("dense_positions", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders")
def dense_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Running point ids: gap-free positions in key order without a single-task sort."""
    return catalog.dense_position(tb.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("seeded_batches", """WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || doc_id)) - 1 AS place, count(*) OVER () AS n FROM documents)
SELECT doc_id AS id, place, place // 64 AS batch FROM p WHERE place // 64 < n // 64""")
def seeded_batches(spark: SparkSession, sf: str) -> DataFrame:
    from hybridloom.operators.autoencoder import seeded_batches as cut
    return cut(tb.documents(spark, sf).select("id"), "id", 7, 64, drop_last=True).select("id", F.col("place").cast("long").alias("place"), "batch")


@query("common_sources", """SELECT source AS source_file, count(*) FILTER (lang = 'en') AS chunk_count FROM documents GROUP BY 1
 HAVING count(*) FILTER (lang = 'en') > 0 AND count(*) FILTER (lang = 'de') > 0""")
def common_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Sources present in two collections (English and German), rows of the first."""
    docs = tb.documents(spark, sf)
    first, second = (catalog.list_books(docs.filter(F.col("language") == lang)) for lang in ("en", "de"))
    return first.join(second, "source_file", "left_semi").select("source_file", "chunk_count")
