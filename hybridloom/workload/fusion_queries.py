"""Fused retrieval over documents (dense + sparse), one row per query and hit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.config import DEFAULT_DENSE_WEIGHT, DEFAULT_SPARSE_WEIGHT
from hybridloom.functions import text as tx
from hybridloom.operators import fusion, topk
from hybridloom.plans.fanout import Source, fan_out
from hybridloom.schema import equality_filter
from hybridloom.session import broadcast_within, checked_broadcast, cut_lineage
from hybridloom.workload import tables as tb
from hybridloom.workload.registry import query

TOP_K = 10


def signals(spark: SparkSession, sf: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Dense and sparse rank lists of every prompt, from one pass over the texts and one over the prompts' terms for the statistics.

    The lists have at most k rows for each prompt and signal; they are written once, so that whatever reads both does not rank again.
    """
    asked = tb.prompts(spark, sf)
    docs = tb.documents(spark, sf)
    wanted = asked.select(F.explode("sparse.indices").alias("term")).distinct()
    found = docs.select(F.explode(F.array_distinct(tx.terms(F.col("text")))).alias("term")).join(checked_broadcast(wanted), "term", "left_semi")
    total, df = docs.count(), F.col("df")
    idf = found.groupBy("term").agg(F.count("*").alias("df")).withColumn("idf", F.log(1 + (F.lit(total) - df + 0.5) / (df + 0.5)))
    ranked = cut_lineage(topk.signal_topk(docs.select("id", tx.terms(F.col("text")).alias("terms")), asked, k, idf))
    return ranked.filter("signal = 'dense'").drop("signal"), ranked.filter("signal = 'sparse'").drop("signal")


def hybrid(spark: SparkSession, sf: str, k: int = TOP_K, sparse_weight: float = DEFAULT_SPARSE_WEIGHT,
           dense_weight: float = DEFAULT_DENSE_WEIGHT) -> DataFrame:
    dense, sparse = signals(spark, sf, 2 * k)
    return fusion.rrf_fuse({"dense": (dense, dense_weight), "sparse": (sparse, sparse_weight)}, k)


def with_payload(spark: SparkSession, sf: str, hits: DataFrame, k: int) -> DataFrame:
    """Join hits back to their documents; there are at most prompts x k of them."""
    bound = tb.table(spark, sf, "benchmark").count() * k
    return tb.documents(spark, sf).join(broadcast_within(hits, bound), "id")


def with_query(spark: SparkSession, sf: str, hits: DataFrame) -> DataFrame:
    asked = tb.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return hits.join(checked_broadcast(asked), "query_id")


def sql_signals(k: int) -> str:
    """Ranked lists d and s of both signals."""
    return f"""{tb.sql_dense()}, {tb.sql_sparse()},
    {tb.sql_ranked('dense_scores', 'd', k)}, {tb.sql_ranked('sparse_scores', 's', k)}"""


def sql_fused(k: int = TOP_K, sparse_weight: float = DEFAULT_SPARSE_WEIGHT, dense_weight: float = DEFAULT_DENSE_WEIGHT) -> str:
    """fused(query_id, id, score, rn): weighted reciprocal ranks of both lists."""
    return f"""{sql_signals(2 * k)}, parts AS (SELECT query_id, id, {dense_weight} / (60 + rn)::DOUBLE AS part FROM d
      UNION ALL SELECT query_id, id, {sparse_weight} / (60 + rn)::DOUBLE FROM s),
    fused AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, id) AS rn
      FROM (SELECT query_id, id, sum(part) AS score FROM parts GROUP BY 1, 2)) WHERE rn <= {k})"""


def shown(df: DataFrame) -> DataFrame:
    return df.select("query_id", "id", F.col("rn").cast("long").alias("rn"), F.round("score", 6).alias("score"))


@query("rrf_hybrid_topk", f"WITH {sql_fused()} SELECT query_id, id, rn, round(score, 6) AS score FROM fused")
def rrf_hybrid_topk(spark: SparkSession, sf: str) -> DataFrame:
    return shown(hybrid(spark, sf))


@query("rrf_zero_weight", f"WITH {tb.sql_dense()}, {tb.sql_ranked('dense_scores', 'd', TOP_K)}"
       "SELECT query_id, id, rn, round(1.0 / (60 + rn)::DOUBLE, 6) AS score FROM d")
def rrf_zero_weight(spark: SparkSession, sf: str) -> DataFrame:
    """A sparse weight of zero removes the sparse branch from the plan."""
    points = tb.encoded_documents(spark, sf, "dense")
    dense = topk.dense_topk(points, tb.prompts(spark, sf), 2 * TOP_K)
    return shown(fusion.rrf_fuse({"dense": (dense, 1.0), "sparse": (dense, 0.0)}, TOP_K))


_WEIGHTS = [0.0, 0.4, 0.8, 1.2, 1.6, 2.0]


@query("rrf_weight_sweep", f"""WITH {sql_signals(15)},
 lists AS (SELECT query_id, id, d.rn AS dr, s.rn AS sr FROM d FULL JOIN s USING (query_id, id)),
 g AS (SELECT query_id, id, w AS weight, coalesce(1.0::DOUBLE / (60 + dr), 0) + coalesce(w / (60 + sr), 0) AS score
   FROM lists CROSS JOIN (SELECT unnest({_WEIGHTS}::DOUBLE[]) AS w))
SELECT query_id, id, weight, rn, round(score, 6) AS score FROM
 (SELECT *, row_number() OVER (PARTITION BY query_id, weight ORDER BY round(score, 12) DESC, id) AS rn FROM g) WHERE rn <= 5""")
def rrf_weight_sweep(spark: SparkSession, sf: str) -> DataFrame:
    lists = fusion.rank_lists(*signals(spark, sf, 15))
    swept = fusion.replay_weights(lists, _WEIGHTS, 5)
    return swept.select("query_id", "id", "weight", F.col("rn").cast("long").alias("rn"), F.round("score", 6).alias("score"))


@query("rank_lists_merged", f"""WITH {sql_signals(15)}
SELECT query_id, id, d.rn AS dense_rank, s.rn AS sparse_rank, s.rn - d.rn AS rank_change FROM d FULL JOIN s USING (query_id, id)""")
def rank_lists_merged(spark: SparkSession, sf: str) -> DataFrame:
    lists = fusion.rank_lists(*signals(spark, sf, 15))
    d, s = F.col("dense_rank").cast("long"), F.col("sparse_rank").cast("long")
    return lists.select("query_id", "id", d.alias("dense_rank"), s.alias("sparse_rank"), (s - d).alias("rank_change"))


@query("signal_overlap", f"""WITH {sql_signals(20)}, l AS (SELECT query_id, id, d.rn AS dr, s.rn AS sr FROM d FULL JOIN s USING (query_id, id))
SELECT query_id, count(*) FILTER (dr IS NOT NULL AND sr IS NOT NULL) AS shared, count(*) FILTER (sr IS NULL) AS only_dense,
 count(*) FILTER (dr IS NULL) AS only_sparse FROM l GROUP BY 1""")
def signal_overlap(spark: SparkSession, sf: str) -> DataFrame:
    lists = fusion.rank_lists(*signals(spark, sf, 20))
    d, s = F.col("dense_rank").isNotNull(), F.col("sparse_rank").isNotNull()
    return lists.groupBy("query_id").agg(F.count_if(d & s).alias("shared"), F.count_if(d & ~s).alias("only_dense"),
                                         F.count_if(s & ~d).alias("only_sparse"))


@query("full_outer_minmax", f"""WITH {sql_signals(10)},
 dn AS (SELECT *, CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS norm
   FROM d WINDOW w AS (PARTITION BY query_id)),
 sn AS (SELECT *, CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS norm
   FROM s WINDOW w AS (PARTITION BY query_id))
SELECT query_id, id, CASE WHEN dn.rn IS NULL THEN 'sparse' WHEN sn.rn IS NULL THEN 'dense' ELSE 'both' END AS signal,
 round(dn.norm, 6)::DOUBLE AS dense_norm, round(sn.norm, 6)::DOUBLE AS sparse_norm, dn.rn AS dense_rank, sn.rn AS sparse_rank
FROM dn FULL JOIN sn USING (query_id, id)""")
def full_outer_minmax(spark: SparkSession, sf: str) -> DataFrame:
    merged = fusion.merge_normalised(*signals(spark, sf, 10))
    return merged.select("query_id", "id", "signal", F.round("dense_norm", 6).alias("dense_norm"),
                         F.round("sparse_norm", 6).alias("sparse_norm"), F.col("dense_rank").cast("long").alias("dense_rank"),
                         F.col("sparse_rank").cast("long").alias("sparse_rank"))


def _by_language(spark: SparkSession, sf: str, k: int) -> DataFrame:
    """Dense hits of every collection; here a collection is a language."""
    points = tb.encoded_documents(spark, sf, "dense")
    asked = tb.prompts(spark, sf)
    return topk.dense_topk(points, asked, k, group="language").withColumnRenamed("language", "collection")


def _sql_by_language(k: int) -> str:
    return f"""{tb.sql_dense()}, c AS (SELECT query_id, id, score, lang AS collection, row_number() OVER
      (PARTITION BY query_id, lang ORDER BY score DESC, id) AS rn FROM dense_scores JOIN documents ON doc_id = id),
      h AS (SELECT * FROM c WHERE rn <= {k})"""


@query("zscore_cross_collection", f"""WITH {_sql_by_language(10)}
SELECT query_id, id, collection, round((score - avg(score) OVER w) / (stddev_pop(score) OVER w + 1e-8), 5) AS score
FROM h WINDOW w AS (PARTITION BY query_id, collection)""")
def zscore_cross_collection(spark: SparkSession, sf: str) -> DataFrame:
    scaled = fusion.zscore(_by_language(spark, sf, 10), ["query_id", "collection"])
    return scaled.select("query_id", "id", "collection", F.round("score", 5).alias("score"))


@query("dense_multi_collection", f"""WITH {_sql_by_language(10)}
SELECT query_id, id, collection, rn, round(score, 6) AS score FROM (SELECT query_id, id, collection, score, row_number() OVER
 (PARTITION BY query_id ORDER BY score DESC, id) AS rn FROM h) WHERE rn <= 10""")
def dense_multi_collection(spark: SparkSession, sf: str) -> DataFrame:
    """Global top-k over the per-collection lists, raw scores."""
    best = topk.topk_per_group(_by_language(spark, sf, 10).drop("rn"), ["query_id"], [F.desc("score"), F.asc("id")], 10)
    return best.select("query_id", "id", "collection", F.col("rn").cast("long").alias("rn"), F.round("score", 6).alias("score"))


@query("hybrid_minmax", f"""WITH {sql_fused()}
SELECT query_id, id, rn, round(CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0
 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END, 6) AS score FROM fused WINDOW w AS (PARTITION BY query_id)""")
def hybrid_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return shown(fusion.minmax(hybrid(spark, sf), ["query_id"], "score", "norm").withColumn("score", F.col("norm")))


@query("metadata_boost", f"""WITH {sql_fused()}
SELECT query_id, id, boost::DOUBLE AS boost, round(score + boost, 6) AS score FROM (SELECT query_id, id, score,
  (CASE WHEN contains(lower(b.text), lower(split_part(p.text, ' ', 1))) AND split_part(p.text, ' ', 1) <> '' THEN 0.15 ELSE 0 END
 + CASE WHEN contains(lower(b.text), lower(lang)) THEN 0.10 ELSE 0 END
 + CASE WHEN contains(lower(b.text), lower(p.source)) THEN 0.10 ELSE 0 END)::DOUBLE AS boost
 FROM fused JOIN documents p ON p.doc_id = id JOIN benchmark b ON item_id = query_id)""")
def metadata_boost(spark: SparkSession, sf: str) -> DataFrame:
    """The first word plays the publisher, language the category and source the subcategory."""
    hits = hybrid(spark, sf)
    rows = with_query(spark, sf, with_payload(spark, sf, hits, TOP_K))
    boost = fusion.metadata_boost(F.col("query"), {
        "publisher": F.substring_index("text", " ", 1), "category": F.col("category"), "subcategory": F.col("source_file")})
    return rows.select("query_id", "id", F.round(boost, 6).alias("boost"), F.round(F.col("score") + boost, 6).alias("score"))


@query("union_dedupe_priority", f"""WITH {sql_signals(6)}
SELECT query_id, id, 0 AS side, rn FROM d WHERE rn <= 4 UNION ALL
SELECT query_id, id, 1, rn FROM s WHERE rn <= 2 AND NOT EXISTS (FROM d WHERE d.rn <= 4 AND d.query_id = s.query_id AND d.id = s.id)""")
def union_dedupe_priority(spark: SparkSession, sf: str) -> DataFrame:
    """Six slots, a third of them sparse: dense first, then what sparse adds."""
    dense_slots, sparse_slots = fusion.slot_split(6, 0.33)
    dense, sparse = signals(spark, sf, 6)
    both = fusion.union_dedupe(dense.filter(F.col("rn") <= dense_slots), sparse.filter(F.col("rn") <= sparse_slots), ["query_id", "id"])
    return both.select("query_id", "id", "side", F.col("rn").cast("long").alias("rn"))


@query("filtered_halves", f"""WITH {tb.sql_dense()}, {tb.sql_sparse()}, f AS (SELECT doc_id AS id FROM documents WHERE source IN ('src1', 'src2', 'src4')),
 df_ AS (SELECT * FROM dense_scores SEMI JOIN f USING (id)), sf_ AS (SELECT * FROM sparse_scores SEMI JOIN f USING (id)), {tb.sql_ranked('df_', 'dh', 3)}, {tb.sql_ranked('sf_', 'sh', 3)}
SELECT query_id, id, rn, round(score, 6) AS score, 'dense' AS signal FROM dh UNION ALL SELECT query_id, id, rn, round(score, 6), 'sparse' FROM sh""")
def filtered_halves(spark: SparkSession, sf: str) -> DataFrame:
    """Six hits among three files: half of them dense, half sparse, with the term statistics of the whole collection."""
    points = tb.encoded_documents(spark, sf, "dense", "sparse")
    asked = tb.prompts(spark, sf)
    chosen = equality_filter(points, {"source_file": ["src1", "src2", "src4"]})
    hits = fusion.halves(chosen, asked, 6, topk.inverse_document_frequency(points))
    return hits.select("query_id", "id", F.col("rn").cast("long").alias("rn"), F.round("score", 6).alias("score"), "signal")


@query("exclusion_search", f"""WITH {sql_signals(10)}, first AS (SELECT query_id, id FROM d WHERE rn <= 3),
 second AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rn FROM dense_scores x
   WHERE NOT EXISTS (FROM first f WHERE f.query_id = x.query_id AND f.id = x.id))
SELECT query_id, id, rn, 'dense' AS signal FROM second WHERE rn <= 3
UNION ALL SELECT query_id, id, rn + 3, 'sparse' FROM s WHERE rn <= 3""")
def exclusion_search(spark: SparkSession, sf: str) -> DataFrame:
    """Second round of a multi-hop search: seen dense ids are excluded, sparse ranks follow the dense ones."""
    points, asked = tb.encoded_documents(spark, sf, "dense", "sparse"), tb.prompts(spark, sf)
    wide = topk.dense_topk(points, asked, 6)
    seen = wide.filter("rn <= 3").select("query_id", "id")
    # The best 3 unseen are among the best 6: at most 3 of those were seen.
    fresh = topk.topk_per_group(fusion.exclude_seen(wide.drop("rn"), seen, ["query_id", "id"]), ["query_id"],
                                [F.desc("score"), F.asc("id")], 3)
    sparse = topk.sparse_topk(points, asked, 3)
    return (fresh.select("query_id", "id", F.col("rn").cast("long").alias("rn"), F.lit("dense").alias("signal"))
            .unionByName(sparse.select("query_id", "id", (F.col("rn") + 3).cast("long").alias("rn"), F.lit("sparse").alias("signal"))))


@query("u_shape_order", f"""WITH {sql_fused(9)}, n AS (SELECT *, count(*) OVER (PARTITION BY query_id) AS n FROM fused)
SELECT query_id, id, rn, CASE WHEN n <= 2 OR rn <= ceil(n / 2) THEN rn ELSE ceil(n / 2)::BIGINT + n - rn + 1 END AS position FROM n""")
def u_shape_order(spark: SparkSession, sf: str) -> DataFrame:
    placed = fusion.u_shape(hybrid(spark, sf, 9), ["query_id"])
    return placed.select("query_id", "id", F.col("rn").cast("long").alias("rn"), F.col("position").cast("long").alias("position"))


def _pointed_sparse(spark: SparkSession, sf: str, k: int) -> DataFrame:
    """Sparse hits whose pointers are the document itself and its neighbour by id."""
    _, sparse = signals(spark, sf, k)
    ids = F.array(F.col("id"), F.col("id") + 1)
    return sparse.select("query_id", F.col("id").alias("sparse_id"), "score", "rn", ids.alias("dense_chunk_ids"))


def _dense_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return tb.documents(spark, sf).select("id", "text", F.col("source_file").alias("title"), "token_count")


_SQL_RESOLVED = f"""{sql_signals(5)}, pt AS (SELECT query_id, id AS sparse_id, rn, score, u.pos, CASE u.pos WHEN 0 THEN id ELSE id + 1 END AS cid
   FROM s CROSS JOIN (SELECT unnest([0, 1]) AS pos) u),
 res AS (SELECT query_id, sparse_id, rn, string_agg(cid::VARCHAR, '+' ORDER BY cid::VARCHAR) AS id,
   md5(string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY pos)) AS text_md5,
   sum(length(text) // 4)::BIGINT AS token_count, arg_min(source, pos) AS title, list(cid::VARCHAR) AS parts
   FROM pt JOIN documents ON doc_id = cid GROUP BY 1, 2, 3)"""


@query("sparse_to_dense_resolve", f"WITH {_SQL_RESOLVED} SELECT query_id, sparse_id, rn, id, text_md5, token_count, title FROM res")
def sparse_to_dense_resolve(spark: SparkSession, sf: str) -> DataFrame:
    done = fusion.resolve_sparse(_pointed_sparse(spark, sf, 5), _dense_chunks(spark, sf))
    return done.select("query_id", "sparse_id", F.col("rn").cast("long").alias("rn"), "id", F.md5("text").alias("text_md5"),
                       "token_count", "title")


@query("merged_provenance")
def merged_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """Dense hits and resolved sparse entries with the sources of each, an ordered pass per query."""
    dense, _ = signals(spark, sf, 5)
    done = fusion.resolve_sparse(_pointed_sparse(spark, sf, 5), _dense_chunks(spark, sf))
    merged = fusion.merge_with_sources(dense, done)
    return merged.select("query_id", F.col("rank").cast("long").alias("rank"), "id", F.array_join("sources", ",").alias("sources"))


@query("permutation_repair", f"""WITH {sql_fused(8)}, n AS (SELECT query_id, count(*) AS n FROM fused GROUP BY 1),
 given AS (SELECT query_id, rn AS pos, (id % 11)::INT AS i FROM fused),
 ok AS (SELECT query_id, i, min(pos) AS pos FROM given JOIN n USING (query_id) WHERE i < n GROUP BY 1, 2),
 slots AS (SELECT query_id, unnest(range(0, n))::INT AS i FROM n),
 al AS (SELECT query_id, i, pos FROM ok UNION ALL SELECT query_id, i, 1000 + i FROM slots ANTI JOIN ok USING (query_id, i))
SELECT query_id, string_agg(i::VARCHAR, ',' ORDER BY pos) AS order_given FROM al GROUP BY 1""")
def permutation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """An untrusted listwise ranking (ids folded onto 0..10) made a permutation of the candidate list."""
    hits = hybrid(spark, sf, 8)
    given = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rn", (F.col("id") % 11).cast("int").alias("i")))).alias("g"),
                                         F.count("*").cast("int").alias("n"))
    fixed = fusion.repair_permutation(F.transform("g", lambda p: p["i"]), F.col("n"))
    return given.select("query_id", F.array_join(fixed.cast("array<string>"), ",").alias("order_given"))


@query("slot_split", """SELECT doc_id, CASE WHEN (x - floor(x)) = 0.5 THEN (floor(x) + floor(x) % 2)::BIGINT ELSE round(x)::BIGINT END AS sparse_slots
 FROM (SELECT doc_id, n_chars * 0.25::DOUBLE AS x FROM documents)""")
def slot_split(spark: SparkSession, sf: str) -> DataFrame:
    """Share of sparse slots, half to even, with the document length as the slot total."""
    return tb.documents(spark, sf).select(F.col("id").alias("doc_id"), F.bround(F.col("n_chars") * 0.25).cast("long").alias("sparse_slots"))


@query("dedupe_keep_best", f"""WITH {sql_signals(10)}, u AS (SELECT query_id, id, score FROM d UNION ALL SELECT query_id, id, score FROM s),
 b AS (SELECT query_id, id, max(score) AS score FROM u GROUP BY 1, 2)
SELECT query_id, id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM b""")
def dedupe_keep_best(spark: SparkSession, sf: str) -> DataFrame:
    dense, sparse = signals(spark, sf, 10)
    flat = fusion.flatten_ranked(dense.unionByName(sparse), ["query_id"])
    return flat.select("query_id", "id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("three_source_fanout", f"""WITH {sql_fused(8)}, ws AS (SELECT * FROM s WHERE rn <= 4), wd AS (SELECT * FROM d WHERE rn <= 4),
 u AS (SELECT query_id, id, rn, 'papers' AS source FROM wd UNION ALL SELECT query_id, id, rn, 'papers_semantic' FROM fused UNION ALL SELECT query_id, id, rn, 'kb' FROM ws),
 n AS (SELECT query_id, source, count(*) AS total_results FROM u GROUP BY 1, 2), a AS (SELECT item_id AS query_id, source FROM benchmark, (SELECT unnest(['papers', 'papers_semantic', 'kb']) AS source))
SELECT query_id, source, coalesce(rn, 0)::INT AS rank, 'TEXT' AS type, md5(text) AS text_md5, coalesce(total_results, 0) AS total_results
FROM a LEFT JOIN n USING (query_id, source) LEFT JOIN u USING (query_id, source) LEFT JOIN documents ON doc_id = id""")
def three_source_fanout(spark: SparkSession, sf: str) -> DataFrame:
    """Dense hits with k, fused ones with 2k and lexical ones with k, of every prompt."""
    dense, sparse = signals(spark, sf, 16)

    def ranked(hits: DataFrame):
        return lambda asked, k: with_payload(spark, sf, hits.filter(F.col("rn") <= k), k).select("query_id", "rn", "text")

    fused = lambda asked, k: with_payload(spark, sf, fusion.rrf_fuse({"dense": (dense, DEFAULT_DENSE_WEIGHT), "sparse": (sparse, DEFAULT_SPARSE_WEIGHT)}, k), k).select("query_id", "rn", "text")
    prompts = tb.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"))
    rows = fan_out(prompts, [Source("papers", ranked(dense)), Source("papers_semantic", fused, 2), Source("kb", ranked(sparse))], 4)
    return rows.select("query_id", "source", "rank", "type", F.md5("text").alias("text_md5"), "total_results")
