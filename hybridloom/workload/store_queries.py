"""Documents kept in a collection: posting lists, maintained statistics, filtered files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.operators import postings
from hybridloom.session import work_folder
from hybridloom.sources.store import CollectionStore
from hybridloom.workload import tables as tb
from hybridloom.workload.registry import query
from hybridloom.workload.vector_queries import HIT_COLUMNS, shown


def _posted(spark: SparkSession, sf: str) -> DataFrame:
    """Posting lists of all documents, languages apart."""
    folder = work_folder(spark, "postings")
    points = tb.encoded_documents(spark, sf, "sparse").select("id", "sparse", "language")
    postings.write_postings(postings.point_blocks(points, cluster=[F.col("language")], block_points=64), folder)
    return spark.read.parquet(folder)


def _search(spark: SparkSession, sf: str) -> postings.PostingsSearch:
    asked, posted = tb.prompts(spark, sf).select("query_id", "sparse"), _posted(spark, sf)
    wanted = asked.select(F.explode("sparse.indices").alias("term")).distinct()
    statistics = postings.statistics_of(posted, tb.table(spark, sf, "documents").count(), wanted)
    return postings.PostingsSearch(posted, postings.query_terms(asked, postings.idf_of(statistics)), 10)


@query("postings_topk", f"""WITH {tb.sql_sparse(True)}, {tb.sql_ranked('sparse_scores', 'r', 10)}
SELECT {HIT_COLUMNS} FROM r""")
def postings_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse top-k of every prompt from block-max posting lists."""
    return shown(_search(spark, sf).hits())


@query("maintained_statistics", f"""WITH kept AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN lang ELSE text END AS text FROM documents WHERE NOT (source = 'src3' AND doc_id % 40 = 3)),
 {tb.sql_terms('p_terms', 'kept', 'doc_id', 'id')}
SELECT term, count(*) AS df, (SELECT count(*) FROM kept) AS n FROM p_terms GROUP BY 1""")
def maintained_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Document frequencies after three batches that overlap, a replacement of vectors and the retirement of points, from counts kept by the store."""
    store = CollectionStore(spark, work_folder(spark, "store"))
    points, payload = tb.documents(spark, sf), tb.documents(spark, sf, dealt=False).select("id", "text", "source_file", "language")
    name = store.create("documents")
    encoder = lambda rows, text: rows.select("id", tb.encoders.sparse_terms(text).alias("sparse"))
    for part in ("id % 3 = 0", "id % 3 <> 2", "id % 3 <> 0"):
        store.append(name, payload.where(part))
        store.append(name, encoder(points.where(part), F.col("text")), "sparse")
    store.replace(name, encoder(points.where("id % 7 = 0"), F.col("language")), "sparse")
    store.retire(name, payload.where("source_file = 'src3' AND id % 40 <> 3").select("id", "source_file"))
    counts = store.term_statistics(name)
    total = counts.where("term IS NULL").select("df").first()[0]
    return counts.where("term IS NOT NULL").select("term", "df", F.lit(total).cast("long").alias("n"))


@query("filtered_files", "SELECT doc_id AS id, lang AS language, source AS source_file, md5(text) AS text_md5 FROM documents WHERE source IN ('src3', 'src5') AND lang = 'en'")
def filtered_files(spark: SparkSession, sf: str) -> DataFrame:
    """A filtered read of a stored payload: files whose sketch rules the filter out stay closed."""
    store = CollectionStore(spark, work_folder(spark, "store"))
    name = store.create("documents")
    store.append(name, tb.documents(spark, sf).select("id", "text", "source_file", "language"))
    rows = store.read(name, filter_by={"source_file": ["src3", "src5"], "language": "en"})
    return rows.select("id", "language", "source_file", F.md5("text").alias("text_md5"))
