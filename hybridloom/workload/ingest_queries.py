"""Chunking, ingest and table changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.config import ChunkSettings
from hybridloom.functions import text as tx
from hybridloom.functions.tokens import RankTokenizer
from hybridloom.operators import chunking, dml
from hybridloom.workload import tables as tb
from hybridloom.workload.registry import query
from hybridloom.workload.text_queries import SENTENCES_SQL, docs, _trim

_BOUNDARY = rf"""{SENTENCES_SQL}, n AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS i, sentence FROM sentences),
 t AS (SELECT doc_id, i, unnest({tb.TERMS.replace('text', 'sentence')}) AS term FROM n),
 v AS (SELECT doc_id, i, ('0x' || substr(md5(term), 1, 4))::INT % 64 AS b, sum(CASE WHEN ('0x' || substr(md5(term), 5, 1))::INT % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS v FROM t GROUP BY 1, 2, 3),
 l AS (SELECT doc_id, i, greatest(sqrt(sum(v * v)), 1e-10) AS len FROM v GROUP BY 1, 2),
 dt AS (SELECT a.doc_id, a.i, sum(a.v * b.v) AS dot FROM v a JOIN v b ON a.doc_id = b.doc_id AND b.i = a.i + 1 AND a.b = b.b GROUP BY 1, 2),
 dist AS (SELECT n.doc_id, n.i, round(1 - coalesce(dot, 0) / (coalesce(x.len, 1e-10) * coalesce(y.len, 1e-10)), 9) AS d FROM n
   JOIN n m ON m.doc_id = n.doc_id AND m.i = n.i + 1 LEFT JOIN dt ON dt.doc_id = n.doc_id AND dt.i = n.i
   LEFT JOIN l x ON x.doc_id = n.doc_id AND x.i = n.i LEFT JOIN l y ON y.doc_id = n.doc_id AND y.i = n.i + 1),
 cut AS (SELECT doc_id, i FROM (SELECT *, greatest(quantile_cont(d, 0.95) OVER (PARTITION BY doc_id), 0.1) AS th FROM dist) WHERE d >= th)"""


def _with_cuts(spark: SparkSession, sf: str) -> DataFrame:
    found = docs(spark, sf).select("doc_id", tx.sentences(F.col("text")).alias("s"))
    return found.withColumn("cuts", chunking.boundaries(chunking.sentence_distances(F.col("s"))))


@query("boundary_detect", f"WITH {_BOUNDARY} SELECT doc_id, i AS boundary FROM cut")
def boundary_detect(spark: SparkSession, sf: str) -> DataFrame:
    cuts = _with_cuts(spark, sf).select("doc_id", F.explode_outer("cuts").alias("boundary")).filter("boundary IS NOT NULL")
    return cuts.withColumn("boundary", F.col("boundary").cast("long"))


@query("segment_islands", f"""WITH {_BOUNDARY}, g AS (SELECT n.doc_id, n.i, sentence, count(cut.i) OVER (PARTITION BY n.doc_id ORDER BY n.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS segment
   FROM n LEFT JOIN cut ON cut.doc_id = n.doc_id AND cut.i = n.i)
SELECT doc_id, segment, md5(string_agg(sentence, ' ' ORDER BY i)) AS text_md5 FROM g GROUP BY 1, 2""")
def segment_islands(spark: SparkSession, sf: str) -> DataFrame:
    cut = _with_cuts(spark, sf).select("doc_id", F.posexplode(chunking.segments(F.col("s"), F.col("cuts"))).alias("segment", "text"))
    return cut.select("doc_id", F.col("segment").cast("long").alias("segment"), F.md5("text").alias("text_md5"))


def _sections(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", F.col("source").alias("title"), F.col("text").alias("content"))


@query("chunk_section")
def chunk_section(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chunker: topic shifts, recursive split, runts, heading prefix."""
    out = chunking.chunk_sections(_sections(spark, sf))
    return out.select("doc_id", "chunk_index", "chunk_count", "token_count", "has_heading_context", F.md5("text").alias("text_md5"))


@query("chunk_tokens", r"SELECT doc_id, length(regexp_replace(text, '[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+', '', 'g')) AS chars FROM documents")
def chunk_tokens(spark: SparkSession, sf: str, vocabulary: str | None = None) -> DataFrame:
    """Chunks of at most 96 tokens of a byte-pair vocabulary: no character is lost either."""
    import public_tokenizers
    tokenizer = RankTokenizer.from_file(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, spaced=True)
    settings = ChunkSettings(chunk_size=96, min_chunk_tokens=16)
    out = chunking.chunk_sections(_sections(spark, sf).withColumn("title", F.lit("")), settings, tokenizer=tokenizer)
    return out.groupBy("doc_id").agg(F.sum(F.length(F.regexp_replace("text", r"(?U)\s+", ""))).cast("long").alias("chars"))


@query("chunk_coverage", r"SELECT doc_id, length(regexp_replace(text, '[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+', '', 'g')) AS chars FROM documents")
def chunk_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Apart from white space no character is lost by chunking."""
    settings = ChunkSettings(chunk_size=120, min_chunk_tokens=20)
    out = chunking.chunk_sections(_sections(spark, sf).withColumn("title", F.lit("")), settings)
    return out.groupBy("doc_id").agg(F.sum(F.length(F.regexp_replace("text", r"(?U)\s+", ""))).cast("long").alias("chars"))


@query("runt_merge", """WITH l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda s: s <> '') AS l FROM documents),
 p AS (SELECT doc_id, unnest(l) AS t, unnest(range(len(l))) AS i FROM l),
 g AS (SELECT *, sum(CASE WHEN i = 0 OR length(t) // 4 >= 10 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM p),
 m AS (SELECT doc_id, g, string_agg(t, ' ' ORDER BY i) AS t FROM g GROUP BY 1, 2),
 f AS (SELECT doc_id, length(t) // 4 < 10 AS short FROM m WHERE g = 1),
 j AS (SELECT m.doc_id, CASE WHEN short AND g = 2 THEN 1 ELSE g END AS g2, g, t FROM m JOIN f USING (doc_id))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY g2) - 1)::INT AS pos, md5(t) AS text_md5
FROM (SELECT doc_id, g2, string_agg(t, ' ' ORDER BY g) AS t FROM j GROUP BY 1, 2)""")
def runt_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a text merged until none is shorter than ten tokens."""
    lines = docs(spark, sf).select("doc_id", F.filter(F.split("text", "\n"), lambda s: s != "").alias("l"))
    merged = chunking.merged_runts(F.col("l"), 10)
    return lines.select("doc_id", merged.alias("m")).select("doc_id", F.posexplode_outer("m").alias("pos", "t")).filter("pos IS NOT NULL").select("doc_id", "pos", F.md5("t").alias("text_md5"))


@query("paragraph_packing")
def paragraph_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as paragraphs packed to 60 tokens with an overlap of 15."""
    split = docs(spark, sf).select("doc_id", F.split("text", "\n").alias("p"))
    made = split.select("doc_id", chunking.packed(F.col("p"), 60, 15).alias("c"))
    return made.select("doc_id", F.posexplode_outer("c").alias("chunk_index", "t")).filter("chunk_index IS NOT NULL").select(
        "doc_id", "chunk_index", tx.token_estimate(F.col("t")).alias("token_count"), F.md5("t").alias("text_md5"))


@query("paper_chunks")
def paper_chunks(spark: SparkSession, sf: str) -> DataFrame:
    papers = docs(spark, sf).select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("arxiv_id"), "text", F.col("source").alias("abstract"))
    return chunking.paper_chunks(papers).select("id", "arxiv_id", "chunk_index", "chunk_count", "token_count", "abstract")


@query("sparse_from_dense", r"""SELECT doc_id AS id, length(regexp_replace(text, '[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+', '', 'g')) AS chars
 FROM documents WHERE regexp_replace(text, '[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+', '', 'g') <> ''""")
def sparse_from_dense(spark: SparkSession, sf: str) -> DataFrame:
    """The sparse chunks that point at a dense chunk hold all its characters, apart from white space."""
    made = chunking.sparse_chunks(tb.documents(spark, sf).select("id", "text", F.lit("").alias("section_title")), ChunkSettings(chunk_size=256, overlap_ratio=0.0, enable_semantic=False))
    held = made.select(F.explode("dense_chunk_ids").alias("id"), F.length(F.regexp_replace("text", r"(?U)\s+", "")).alias("n"))
    return held.groupBy("id").agg(F.sum("n").cast("long").alias("chars"))


@query("idempotent_append", """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'""")
def idempotent_append(spark: SparkSession, sf: str) -> DataFrame:
    """Orders already stored (status F) are skipped, and an order sent twice is added once."""
    orders = tb.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sent = orders.unionByName(orders)
    return dml.new_rows(sent, orders.filter("o_orderstatus = 'F'"), ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("latest_wins_upsert", """SELECT l_orderkey, max(l_linenumber) AS l_linenumber, arg_max(l_quantity, (l_linenumber, l_partkey, l_suppkey, l_quantity)) AS l_quantity FROM lineitem GROUP BY 1""")
def latest_wins_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Highest line of every order wins."""
    rows = tb.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("version"))
    return dml.latest_wins(rows, ["l_orderkey"], "version").select("l_orderkey", "l_linenumber", "l_quantity")


@query("partial_vector_update", """SELECT vec_id AS id, CASE WHEN label < 5 THEN -embedding[1] ELSE embedding[1] END::DOUBLE AS head FROM embeddings""")
def partial_vector_update(spark: SparkSession, sf: str) -> DataFrame:
    stored = tb.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("dense"))
    fresh = stored.filter("label < 5").withColumn("dense", F.transform("dense", lambda v: -v))
    return dml.replace_component(stored, fresh).select("id", F.col("dense")[0].cast("double").alias("head"))


@query("conditional_patch", """SELECT doc_id, CASE WHEN n_chars > 2000 THEN source WHEN quality IS NOT NULL THEN 'label-' || quality ELSE '' END AS category,
 n_chars <= 2000 AND quality IS NOT NULL AS changed FROM documents LEFT JOIN labels USING (doc_id)""")
def conditional_patch(spark: SparkSession, sf: str) -> DataFrame:
    """Blank categories are filled from the labels, present ones stay."""
    target = tb.table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") > 2000, F.col("source")).otherwise("").alias("category"))
    patch = tb.table(spark, sf, "labels").select("doc_id", F.concat(F.lit("label-"), F.col("quality").cast("string")).alias("category"))
    return dml.patch_blanks(target, patch, ["doc_id"], ["category"])


@query("patch_dry_run", """SELECT count(*) AS rows, count(*) FILTER (n_chars <= 2000 AND quality IS NOT NULL) AS changed FROM documents LEFT JOIN labels USING (doc_id)""")
def patch_dry_run(spark: SparkSession, sf: str) -> DataFrame:
    return dml.patch_report(conditional_patch(spark, sf))


@query("missing_vectors", "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)")
def missing_vectors(spark: SparkSession, sf: str) -> DataFrame:
    vectors = tb.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    return dml.missing_vectors(tb.documents(spark, sf).select("id"), vectors)


@query("ingest_counters", "SELECT count(DISTINCT source) AS papers, count(*) AS chunks, sum(length(text) // 4)::BIGINT AS tokens, count(*) FILTER (length(text) // 4 < 50) AS small_chunks FROM documents")
def ingest_counters(spark: SparkSession, sf: str) -> DataFrame:
    return dml.ingest_counters(tb.documents(spark, sf), ["source_file"])


@query("keep_newest", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 2")
def keep_newest(spark: SparkSession, sf: str) -> DataFrame:
    return dml.keep_newest(tb.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 2)


@query("point_ids", "SELECT md5(source || chr(1) || doc_id || chr(1) || n_chars) AS id, doc_id FROM documents")
def point_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tb.table(spark, sf, "documents").select(dml.point_id(F.col("source"), F.col("doc_id"), F.col("n_chars")).alias("id"), "doc_id")
