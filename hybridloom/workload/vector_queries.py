"""Vector scoring: dense, sparse, statistics and the sparse autoencoder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.operators import autoencoder, topk
from hybridloom.session import work_folder
from hybridloom.sources.store import CollectionStore
from hybridloom.workload import tables as tb
from hybridloom.workload.registry import query

HIT_COLUMNS = "query_id, id, rn::BIGINT AS rn, round(score, 6) AS score"


def shown(hits: DataFrame, *extra: str) -> DataFrame:
    return hits.select("query_id", "id", F.col("rn").cast("long").alias("rn"), F.round("score", 6).alias("score"), *extra)


@query("dense_topk_batch", f"""WITH {tb.sql_dense()}, {tb.sql_ranked('dense_scores', 'r', 10)}
SELECT {HIT_COLUMNS} FROM r""")
def dense_topk_batch(spark: SparkSession, sf: str) -> DataFrame:
    return shown(topk.dense_topk(tb.encoded_documents(spark, sf, "dense"), tb.prompts(spark, sf), 10))


@query("pooled_logits", """SELECT label AS id, (pos - 1)::INT AS term, round(max(ln(1 + v)), 9) AS weight FROM
  (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings) WHERE v > 0 GROUP BY 1, 2""")
def pooled_logits(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse pooling over token rows; vectors play the logits of tokens, labels the texts."""
    rows = tb.table(spark, sf, "embeddings").select(F.col("label").alias("id"), F.col("embedding").alias("logits"))
    return autoencoder.pool_logits(rows).withColumn("weight", F.round("weight", 9))


@query("dense_topk_filtered", f"""WITH {tb.sql_dense(where="lang = 'fr'")}, {tb.sql_ranked('dense_scores', 'r', 10)}
SELECT {HIT_COLUMNS} FROM r""")
def dense_topk_filtered(spark: SparkSession, sf: str) -> DataFrame:
    points = tb.encoded_documents(spark, sf, "dense").filter(F.col("language") == "fr")
    return shown(topk.dense_topk(points, tb.prompts(spark, sf), 10))


@query("dense_topk", """WITH q AS (SELECT label AS query_id, avg(v) AS v, pos FROM
  (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 3),
 p AS (SELECT vec_id AS id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings),
 ql AS (SELECT query_id, sqrt(sum(v*v)) AS len FROM q GROUP BY 1), pl AS (SELECT id, sqrt(sum(v*v)) AS len FROM p GROUP BY 1),
 s AS (SELECT query_id, id, round(sum(p.v*q.v) / (any_value(ql.len) * any_value(pl.len)), 9) AS score
   FROM p JOIN q USING (pos) JOIN ql USING (query_id) JOIN pl USING (id) GROUP BY 1, 2)
SELECT query_id, id, rn::BIGINT AS rn, round(score, 6) AS score FROM
 (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rn FROM s) WHERE rn <= 10""")
def dense_topk_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest stored vectors of every label centroid."""
    points = tb.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("dense"))
    centroids = autoencoder.mean_vectors(points, ["label"], "dense").withColumnRenamed("label", "query_id")
    return shown(topk.dense_topk(points, centroids, 10, decimals=9, query_vector="mean"))


@query("sparse_idf_topk", f"""WITH {tb.sql_sparse(True)}, {tb.sql_ranked('sparse_scores', 'r', 10)}
SELECT {HIT_COLUMNS} FROM r""")
def sparse_idf_topk(spark: SparkSession, sf: str) -> DataFrame:
    return shown(topk.sparse_topk(tb.encoded_documents(spark, sf, "sparse"), tb.prompts(spark, sf), 10))


@query("term_idf", f"""WITH {tb.sql_terms('p_terms', 'documents', 'doc_id', 'id')}, n AS (SELECT count(*) AS n FROM documents),
 d AS (SELECT term, count(*) AS df FROM p_terms GROUP BY 1)
SELECT term, df, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf FROM d, n""")
def term_idf(spark: SparkSession, sf: str) -> DataFrame:
    found = topk.inverse_document_frequency(tb.encoded_documents(spark, sf, "sparse"))
    return found.select("term", "df", F.round("idf", 6).alias("idf"))


@query("sparse_long_weights", f"""WITH {tb.sql_terms('p_terms', 'documents', 'doc_id', 'id')}
SELECT id, count(*) AS terms, round(sum(ln(1 + tf)), 6) AS mass, round(max(ln(1 + tf)), 6) AS top_weight FROM p_terms GROUP BY 1""")
def sparse_long_weights(spark: SparkSession, sf: str) -> DataFrame:
    points = tb.encoded_documents(spark, sf, "sparse")
    values = F.col("sparse.values")
    return points.filter(F.size(values) > 0).select(
        "id", F.size(values).cast("long").alias("terms"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), 6).alias("mass"),
        F.round(F.array_max(values), 6).alias("top_weight"))


@query("dense_encode", f"""WITH {tb.sql_terms('p_terms', 'documents', 'doc_id', 'id')}, {tb.sql_vectors('p_vec', 'p_terms', 'id')}
SELECT id, b::BIGINT AS pos, v AS value FROM p_vec WHERE v <> 0""")
def dense_encode(spark: SparkSession, sf: str) -> DataFrame:
    long = topk.long_vectors(tb.encoded_documents(spark, sf, "dense"), "id", "dense")
    return long.filter("value <> 0").select("id", F.col("pos").cast("long").alias("pos"), "value")


@query("corpus_mean_vector", """SELECT pos - 1 AS pos, round(avg(v), 6) AS mean FROM
 (SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1""")
def corpus_mean_vector(spark: SparkSession, sf: str) -> DataFrame:
    long = topk.long_vectors(tb.table(spark, sf, "embeddings"), "vec_id", "embedding")
    return autoencoder.mean_by_position(long).select(F.col("pos").cast("long").alias("pos"), F.round("mean", 6).alias("mean"))


@query("corpus_mean_sparse", f"""WITH {tb.sql_terms('p_terms', 'documents', 'doc_id', 'id')}
SELECT term, round(sum(ln(1 + tf)) / (SELECT count(*) FROM documents), 6) AS mean FROM p_terms GROUP BY 1""")
def corpus_mean_sparse(spark: SparkSession, sf: str) -> DataFrame:
    points = tb.encoded_documents(spark, sf, "sparse")
    return autoencoder.mean_sparse(points).select("term", F.round("mean", 6).alias("mean"))


@query("nnz_stats", f"""WITH {tb.sql_terms('p_terms', 'documents', 'doc_id', 'id')},
 c AS (SELECT doc_id, count(term) AS nnz FROM documents LEFT JOIN p_terms ON id = doc_id GROUP BY 1)
SELECT count(*) AS n, round(avg(nnz), 6) AS mean, quantile_cont(nnz, 0.5)::DOUBLE AS median, quantile_cont(nnz, 0.1)::DOUBLE AS p10,
 quantile_cont(nnz, 0.9)::DOUBLE AS p90, min(nnz) AS min, max(nnz) AS max FROM c""")
def nnz_stats(spark: SparkSession, sf: str) -> DataFrame:
    points = tb.encoded_documents(spark, sf, "sparse")
    stats = autoencoder.nonzero_stats(points.select(F.size("sparse.values").cast("long").alias("nnz")))
    return stats.withColumn("mean", F.round("mean", 6))


@query("sparse_maxpool", rf"""WITH w AS (SELECT doc_id AS id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS ws FROM documents),
 win AS (SELECT id, s AS window_no, array_to_string(ws[s * 512 + 1 : s * 512 + 512], ' ') AS text
   FROM (SELECT id, ws, unnest(range(0, (len(ws) + 511) // 512)) AS s FROM w)),
 t AS (SELECT id, window_no, unnest({tb.TERMS}) AS term FROM win),
 c AS (SELECT id, window_no, term, count(*) AS tf FROM t GROUP BY ALL)
SELECT id, term, round(max(ln(1 + tf)), 6) AS weight FROM c GROUP BY 1, 2""")
def sparse_maxpool(spark: SparkSession, sf: str) -> DataFrame:
    """512-word windows, each encoded, the maximum weight of every term kept."""
    pooled = autoencoder.maxpool_windows(tb.documents(spark, sf), "id", "text")
    return pooled.select("id", "term", F.round("weight", 6).alias("weight"))


@query("decoder_norms", """WITH w AS (SELECT vec_id AS feature, unnest(embedding)::DOUBLE AS v FROM embeddings)
SELECT feature, round(sqrt(sum(v * v)), 6) AS norm FROM w GROUP BY 1""")
def decoder_norms(spark: SparkSession, sf: str) -> DataFrame:
    rows = tb.table(spark, sf, "embeddings").select(F.col("vec_id").alias("feature"), F.col("embedding").alias("row"))
    return autoencoder.row_norms(rows, "feature", "row").select("feature", F.round("norm", 6).alias("norm"))


_SAE_SQL = """WITH x AS (SELECT vec_id AS id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings),
 b AS (SELECT pos, avg(v) AS mean FROM x GROUP BY 1),
 dec AS (SELECT label AS feature, pos, avg(v) AS w FROM x JOIN embeddings ON vec_id = id GROUP BY 1, 2),
 nrm AS (SELECT feature, sqrt(sum(w * w)) AS norm FROM dec GROUP BY 1),
 act AS (SELECT id, feature, round(sum((v - mean) * w) * any_value(norm), 9) AS a
   FROM x JOIN b USING (pos) JOIN dec USING (pos) JOIN nrm USING (feature) GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY a DESC, feature) AS rn FROM act)
SELECT id, feature, round(greatest(a, 0), 6) AS activation FROM r WHERE rn <= 5 AND a > 0"""


@query("sae_encode_topk", _SAE_SQL)
def sae_encode_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Top-K features of every vector; the label centroids play the encoder rows."""
    points = tb.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("dense"))
    weights = autoencoder.mean_vectors(points, ["label"], "dense").select(F.col("label").alias("feature"), F.col("mean").alias("row"))
    bias = autoencoder.mean_vectors(points, [], "dense").select("mean")
    encoder = autoencoder.load_encoder(weights, bias)
    coded = autoencoder.encode_topk(points, encoder, k=5, id_col="id", vector="dense", decimals=9)
    return coded.select("id", "feature", F.round("activation", 6).alias("activation"))


@query("sae_encode_blocks", _SAE_SQL)
def sae_encode_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same with weights in blocks of about three features each, kept as a collection and read back."""
    points = tb.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("dense"))
    weights = autoencoder.mean_vectors(points, ["label"], "dense").select(F.col("label").alias("feature"), F.col("mean").alias("row"))
    bias = autoencoder.mean_vectors(points, [], "dense").select("mean")
    width = weights.select(F.max(F.size("row"))).first()[0] or 1
    coded = autoencoder.encode(points, weights, bias, k=5, decimals=9, block_bytes=3 * 8 * width)
    store = CollectionStore(spark, work_folder(spark, "store"))
    name = autoencoder.store_features(store, "features", points, coded)
    kept = store.read(name, "sparse").select("id", F.explode(F.arrays_zip("sparse.indices", "sparse.values")).alias("p"))
    return kept.select("id", F.col("p.indices").cast("long").alias("feature"), F.round(F.col("p.values"), 6).alias("activation"))


@query("explained_variance", """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings),
 c AS (SELECT label, pos, avg(v) AS hat FROM x GROUP BY 1, 2), m AS (SELECT pos, avg(v) AS mean FROM x GROUP BY 1)
SELECT round(1 - avg((v - hat) * (v - hat)) / avg((v - mean) * (v - mean)), 6) AS explained_variance
FROM x JOIN c USING (label, pos) JOIN m USING (pos)""")
def explained_variance(spark: SparkSession, sf: str) -> DataFrame:
    """Variance explained when every vector is rebuilt as its label centroid."""
    points = tb.table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("x"))
    return autoencoder.explained_variance(points, ["label"], "x")
