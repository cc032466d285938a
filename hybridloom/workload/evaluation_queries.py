"""Evaluation queries. Prompts are the benchmark passages, relevance comes from the labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.operators import autoencoder, evaluation as ev, fusion, models
from hybridloom.workload import tables as tb
from hybridloom.workload.fusion_queries import hybrid, signals, sql_fused, sql_signals, with_payload, with_query
from hybridloom.workload.registry import query
from hybridloom.workload.text_queries import _STOPS, _trim

TOPK = 6
# The prompts' vocabulary is one value of a plan up to so many bytes; above that it is gone through in blocks of about that size.
TERMS_BYTES = 1 << 20


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return tb.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality", "toxic")


def _methods(spark: SparkSession, sf: str, k: int) -> DataFrame:
    dense, sparse = signals(spark, sf, k)
    cols = ["query_id", "id", "rn", "score"]
    both = ev.union_all([dense.select(*cols, F.lit("dense").alias("method")), sparse.select(*cols, F.lit("sparse").alias("method"))])
    return with_query(spark, sf, with_payload(spark, sf, both, 2 * k))


_Q_TERMS = f"list_filter(list_distinct(regexp_extract_all(lower(b.text), '[A-Za-z]+')), lambda w: length(w) >= 3 AND NOT list_contains({_STOPS}, w))"
_CITED = r"(regexp_matches({0}, '\[\d[\d, ]*\]') OR regexp_matches({0}, '\([A-Z][a-z]+(, [A-Z][a-z]+)*, \d{{4}}\)') OR regexp_matches({0}, '(et al\.|et al)\s*,\s*\d{{4}}') OR regexp_matches({0}, 'arXiv[:\s]*\d+\.\d{{4,}}'))".format("d.text")


@query("six_metrics", f"""WITH {sql_signals(10)}, u AS (SELECT *, 'dense' AS method FROM d UNION ALL BY NAME SELECT *, 'sparse' AS method FROM s),
 r AS (SELECT query_id, method, score, d.text, source, lang, length(d.text) // 4 AS tokens, {_Q_TERMS} AS ts, {_CITED} AS cited
   FROM u JOIN documents d ON d.doc_id = u.id JOIN benchmark b ON b.item_id = query_id)
SELECT query_id, method, round(avg(CASE WHEN len(ts) = 0 OR len(list_filter(ts, lambda t: contains(lower(text), t))) > 0 THEN 1 ELSE 0 END), 4) AS keyword_hit_rate,
 round(count(DISTINCT source) / count(*), 4) AS section_diversity, round(avg(cited::INT), 4) AS citation_density,
 round(avg((lang = 'en')::INT), 4) AS papers_coverage, round(max(score) - min(score), 4) AS score_spread, round(avg(tokens), 2) AS token_efficiency FROM r GROUP BY 1, 2""")
def six_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """English documents play papers, the source plays the section."""
    hits = _methods(spark, sf, 10).withColumns({"section_title": F.col("source_file"), "doc_type": F.when(F.col("language") == "en", "paper").otherwise("book")})
    return ev.hit_metrics(hits, ["query_id", "method"])


@query("keyword_hit_rate", f"""SELECT d.lang, round(avg(CASE WHEN len(list_filter(ts, lambda t: contains(lower(d.text), t))) > 0 THEN 1 ELSE 0 END), 6) AS hit_rate
 FROM documents d, (SELECT list_distinct(flatten(list({_Q_TERMS}))) AS ts FROM benchmark b) GROUP BY 1""")
def keyword_hit_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Share of documents per language that hold any term of any prompt."""
    from hybridloom.functions import text as tx
    terms = tb.table(spark, sf, "benchmark").select(F.explode(tx.query_terms(F.col("text"))).alias("t")).distinct()
    size = terms.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    docs = tb.documents(spark, sf).select("language", "text")
    # A document meets the terms in blocks of bounded size, one after the other in its own row.
    blocks = max(1, -(-size // TERMS_BYTES))
    hits = docs.withColumn("hit", F.lit(False))
    for block in range(blocks):
        held = terms.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == block).agg(F.collect_set("t")).scalar()
        hits = hits.withColumn("terms", held).withColumn("hit", F.col("hit") | ev.contains_any(F.col("text"), F.col("terms"))).drop("terms")
    hits = hits.select("language", F.col("hit").cast("int").alias("hit"))
    return hits.groupBy(F.col("language").alias("lang")).agg(F.round(F.avg("hit"), 6).alias("hit_rate"))


@query("jaccard_docs", f"""WITH {sql_signals(10)}, a AS (SELECT query_id, list(DISTINCT source) AS l FROM d JOIN documents ON doc_id = id GROUP BY 1),
 b AS (SELECT query_id, list(DISTINCT source) AS l FROM s JOIN documents ON doc_id = id GROUP BY 1)
SELECT query_id, len(list_intersect(a.l, b.l)) AS common, len(a.l) - len(list_intersect(a.l, b.l)) AS only_left, len(b.l) - len(list_intersect(a.l, b.l)) AS only_right,
 round(len(list_intersect(a.l, b.l)) / len(list_distinct(list_concat(a.l, b.l))), 6) AS jaccard FROM a JOIN b USING (query_id)""")
def jaccard_docs(spark: SparkSession, sf: str) -> DataFrame:
    return _overlaps(spark, sf, F.col("source_file"), 1.0)


def _overlaps(spark: SparkSession, sf: str, item, both_empty: float) -> DataFrame:
    rows = _methods(spark, sf, 10)
    out = ev.list_overlap(rows.filter("method = 'dense'"), rows.filter("method = 'sparse'"), ["query_id"], item, both_empty)
    return out.select("query_id", *[F.col(c).cast("long").alias(c) for c in ("common", "only_left", "only_right")], F.round("jaccard", 6).alias("jaccard"))


@query("fingerprint_overlap", f"""WITH {sql_signals(10)}, f AS (SELECT doc_id, lower({_trim('text')}) AS fp FROM documents),
 a AS (SELECT query_id, list(DISTINCT fp) AS l FROM d JOIN f ON doc_id = id GROUP BY 1), b AS (SELECT query_id, list(DISTINCT fp) AS l FROM s JOIN f ON doc_id = id GROUP BY 1)
SELECT query_id, len(list_intersect(a.l, b.l)) AS common, len(a.l) - len(list_intersect(a.l, b.l)) AS only_left, len(b.l) - len(list_intersect(a.l, b.l)) AS only_right,
 round(len(list_intersect(a.l, b.l)) / len(list_distinct(list_concat(a.l, b.l))), 6) AS jaccard FROM a JOIN b USING (query_id)""")
def fingerprint_overlap(spark: SparkSession, sf: str) -> DataFrame:
    from hybridloom.functions import text as tx
    return _overlaps(spark, sf, tx.fingerprint(F.col("text")), 0.0)


@query("overlap_bands", f"""WITH {sql_signals(10)}, l AS (SELECT query_id, id, d.rn AS dr, s.rn AS sr FROM d FULL JOIN s USING (query_id, id)),
 j AS (SELECT query_id, count(*) FILTER (dr IS NOT NULL AND sr IS NOT NULL) / count(*) AS jaccard FROM l GROUP BY 1)
SELECT count(*) FILTER (jaccard >= 0.7) AS high, count(*) FILTER (jaccard >= 0.3 AND jaccard < 0.7) AS middle, count(*) FILTER (jaccard < 0.3) AS low,
 round(avg(jaccard), 6) AS mean_jaccard FROM j""")
def overlap_bands(spark: SparkSession, sf: str) -> DataFrame:
    dense, sparse = signals(spark, sf, 10)
    bands = ev.overlap_bands(ev.list_overlap(dense, sparse, ["query_id"], F.col("id").cast("string")))
    return bands.withColumn("mean_jaccard", F.round("mean_jaccard", 6))


_OPEN = "list_distinct(list_filter(string_split_regex(lower({0}), '\\s+'), lambda w: w <> ''))"


@query("hit_rank", f"""WITH {sql_signals(10)}, seed AS (SELECT query_id, source AS seed_file, id - 1 AS lo, id + 1 AS hi, b.text AS seed_text
   FROM s JOIN documents ON doc_id = id JOIN benchmark b ON b.item_id = query_id WHERE s.rn = 1),
 h AS (SELECT query_id, rn, source = seed_file AND id BETWEEN lo AND hi AS inside,
   len(list_intersect({_OPEN.format('seed_text')}, {_OPEN.format('c.text')})) / greatest(len({_OPEN.format('seed_text')}), 1) > 0.5 AS fuzzy
   FROM d JOIN seed USING (query_id) JOIN documents c ON c.doc_id = id),
 m AS (SELECT query_id, min(rn) FILTER (inside) AS e, min(rn) FILTER (fuzzy) AS f FROM h GROUP BY 1)
SELECT query_id, coalesce(e, f) AS rank, CASE WHEN e IS NOT NULL THEN 'chunk_index' WHEN f IS NOT NULL THEN 'text_overlap' ELSE 'none' END AS match_method FROM m""")
def hit_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Where the dense list finds the passage that the best sparse hit came from."""
    rows = _methods(spark, sf, 10)
    seed = rows.filter("method = 'sparse' AND rn = 1").select("query_id", F.col("source_file").alias("seed_file"), (F.col("id") - 1).alias("range_low"),
                                                              (F.col("id") + 1).alias("range_high"), F.col("query").alias("seed_text"))
    hits = rows.filter("method = 'dense'").withColumn("chunk_index", F.col("id")).join(seed, "query_id")
    return ev.hit_rank(hits, ["query_id"]).withColumn("rank", F.col("rank").cast("long"))


@query("cross_collection_ratio", f"""WITH {sql_fused(10)}, r AS (SELECT query_id, rn, score, lang, n_chars > 2000 AS book FROM fused JOIN documents ON doc_id = id),
 c AS (SELECT query_id, lang, count(*) AS n, min(rn) AS f FROM r GROUP BY 1, 2), k AS (SELECT query_id, book, count(*) AS n FROM r GROUP BY 1, 2)
SELECT query_id, (SELECT round(avg(score), 4) FROM r WHERE r.query_id = x.query_id AND rn <= 5) AS top5_avg_score,
 (SELECT lang FROM c WHERE c.query_id = x.query_id ORDER BY n DESC, f LIMIT 1) AS top1_category,
 (SELECT CASE WHEN count(*) <= 1 THEN 0 ELSE round(1 - (max(n) - min(n)) / sum(n), 4) END FROM k WHERE k.query_id = x.query_id)::DOUBLE AS cross_collection_ratio
FROM (SELECT DISTINCT query_id FROM r) x""")
def cross_collection_ratio(spark: SparkSession, sf: str) -> DataFrame:
    hits = with_payload(spark, sf, hybrid(spark, sf, 10), 10)
    hits = hits.withColumns({"book_title": F.when(F.col("n_chars") > 2000, "b").otherwise(""), "doc_type": F.lit("short")})
    return ev.result_profile(hits, ["query_id"])


_WEIGHTS = [0.0, 0.5, 1.0, 1.5, 2.0]


@query("relevance_by_weight", f"""WITH {sql_signals(15)}, lists AS (SELECT query_id, id, d.rn AS dr, s.rn AS sr FROM d FULL JOIN s USING (query_id, id)),
 g AS (SELECT query_id, id, w AS weight, coalesce(1.0::DOUBLE / (60 + dr), 0) + coalesce(w / (60 + sr), 0) AS score FROM lists CROSS JOIN (SELECT unnest({_WEIGHTS}::DOUBLE[]) AS w)),
 t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, weight ORDER BY round(score, 12) DESC, id) AS rn FROM g) WHERE rn <= 5),
 a AS (SELECT query_id, weight, avg(coalesce(quality * 2 + 1, 1)) AS rel FROM t LEFT JOIN labels ON doc_id = id GROUP BY 1, 2),
 m AS (SELECT weight, avg(rel) AS avg_relevance FROM a GROUP BY 1)
SELECT weight, round(avg_relevance, 6) AS avg_relevance, row_number() OVER (ORDER BY round(avg_relevance, 9) DESC, weight) = 1 AS best FROM m""")
def relevance_by_weight(spark: SparkSession, sf: str) -> DataFrame:
    """Mean relevance@5 at every sparse weight, replayed from one pair of rank lists."""
    ranked = fusion.replay_weights(fusion.rank_lists(*signals(spark, sf, 15)), _WEIGHTS, 5)
    judged = ranked.join(_labels(spark, sf), "id", "left").withColumn("relevance", F.col("quality") * 2 + 1)
    means = ev.best_weight(ev.average_relevance(judged, ["query_id", "weight"]))
    return means.select("weight", F.round("avg_relevance", 6).alias("avg_relevance"), "best")


@query("quality_by_source", """SELECT source, count(*) AS judged, round(avg(quality), 6) AS quality, sum(toxic)::BIGINT AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def quality_by_source(spark: SparkSession, sf: str) -> DataFrame:
    rows = tb.table(spark, sf, "documents").select("doc_id", "source").join(tb.table(spark, sf, "labels"), "doc_id")
    return rows.groupBy("source").agg(F.count("*").alias("judged"), F.round(F.avg("quality"), 6).alias("quality"), F.sum("toxic").alias("toxic"))


_BUCKET = "CASE query_id % 3 WHEN 0 THEN 'trivia' WHEN 1 THEN 'conceptual' ELSE 'operational' END"


@query("win_rate_buckets", f"""WITH {sql_signals(10)}, l AS (SELECT query_id, id, d.rn AS dr, s.rn AS sr FROM d FULL JOIN s USING (query_id, id)),
 x AS (SELECT query_id, {_BUCKET} AS query_bucket, 1 + least(2, count(*) FILTER (quality = 1)) AS judge_score, min(dr) FILTER (quality = 1) AS dense_rank,
   min(sr) FILTER (quality = 1) AS sparse_rank, count(*) AS set_size, count(*) FILTER (dr IS NOT NULL AND sr IS NOT NULL) AS both_count FROM l LEFT JOIN labels ON doc_id = id GROUP BY 1)
SELECT coalesce(query_bucket, 'total') AS query_bucket, count(*) AS samples, round(avg(judge_score), 2) AS avg_score, count(*) FILTER (judge_score = 1) AS score_1,
 count(*) FILTER (judge_score = 2) AS score_2, count(*) FILTER (judge_score = 3) AS score_3, round(avg((dense_rank IS NOT NULL)::INT), 3) AS dense_hit_rate,
 round(avg((sparse_rank IS NOT NULL)::INT), 3) AS sparse_hit_rate, round(avg(set_size), 1) AS avg_set_size, round(avg(both_count), 1) AS avg_both_count FROM x GROUP BY ROLLUP (query_bucket)""")
def win_rate_buckets(spark: SparkSession, sf: str) -> DataFrame:
    lists = fusion.rank_lists(*signals(spark, sf, 10)).join(_labels(spark, sf), "id", "left")
    good = F.col("quality") == 1
    bucket = F.element_at(F.array(*[F.lit(b) for b in ev.QUERY_BUCKETS]), (F.col("query_id") % 3).cast("int") + 1)
    samples = lists.groupBy("query_id").agg(
        (F.least(F.lit(2), F.count_if(good)) + 1).alias("judge_score"), F.min(F.when(good, F.col("dense_rank"))).alias("dense_rank"),
        F.min(F.when(good, F.col("sparse_rank"))).alias("sparse_rank"), F.count("*").alias("set_size"),
        F.count_if(F.col("dense_rank").isNotNull() & F.col("sparse_rank").isNotNull()).alias("both_count")).withColumn("query_bucket", bucket)
    return ev.bucket_report(samples)


@query("win_report", f"""WITH {sql_fused(10)}, b AS (SELECT query_id, avg(coalesce(quality, 0)) AS q FROM d LEFT JOIN labels ON doc_id = id WHERE rn <= 10 GROUP BY 1),
 n AS (SELECT query_id, avg(coalesce(quality, 0)) AS q FROM fused LEFT JOIN labels ON doc_id = id GROUP BY 1)
SELECT count(*) FILTER (n.q > b.q) AS wins, count(*) FILTER (n.q < b.q) AS losses, count(*) FILTER (n.q = b.q) AS ties, round(avg((n.q > b.q)::INT), 4) AS win_rate,
 round(avg(n.q - b.q), 4) AS avg_score_improvement FROM n JOIN b USING (query_id)""")
def win_report(spark: SparkSession, sf: str) -> DataFrame:
    """Hybrid against dense: the list with the better labelled documents wins."""
    dense, sparse = signals(spark, sf, 20)
    fused = fusion.rrf_fuse({"dense": (dense, 1.0), "sparse": (sparse, 1.2)}, 10)
    judged = lambda df, name: df.join(_labels(spark, sf), "id", "left").groupBy("query_id").agg(F.avg(F.coalesce("quality", F.lit(0))).alias(name))
    pairs = judged(fused, "new_score").join(judged(dense.filter("rn <= 10"), "base_score"), "query_id")
    won = F.when(F.col("new_score") > F.col("base_score"), "new").when(F.col("new_score") < F.col("base_score"), "base").otherwise("tie")
    return ev.win_report(pairs.withColumn("winner", won))


FRACTIONS = [f"{k / TOPK:.2f}" for k in range(TOPK + 1)]


def critiques(spark: SparkSession, sf: str) -> DataFrame:
    """Judged cases prompts x sparse_k. Two judges read the labels; the second answers even prompts only."""
    dense, sparse = signals(spark, sf, TOPK)
    lists = fusion.rank_lists(dense, sparse).withColumn("sparse_k", F.explode(F.sequence(F.lit(0), F.lit(TOPK))))
    in_d, in_s = F.col("dense_rank") <= TOPK - F.col("sparse_k"), F.col("sparse_rank") <= F.col("sparse_k")
    kept = (lists.withColumns({"in_d": F.coalesce(in_d, F.lit(False)), "in_s": F.coalesce(in_s, F.lit(False))}).filter("in_d OR in_s")
            .join(_labels(spark, sf), "id", "left"))
    base = F.when(F.col("quality") == 1, 8).when(F.col("quality") == 0, 3).otherwise(1)
    docket = F.substring(F.md5(F.col("id").cast("string")), 1, 7)
    chunk = F.struct(docket.alias("docket_id"), F.when(F.col("in_d"), "dense").otherwise("sparse_resolved").alias("source"),
                     F.filter(F.array(F.when(F.col("in_d"), F.lit("dense")), F.when(F.col("in_s"), F.lit("sparse_resolved"))), lambda s: s.isNotNull()).alias("sources"),
                     base.alias("base"))
    cases = kept.groupBy("query_id", "sparse_k").agg(F.collect_list(chunk).alias("all"), F.count_if(F.col("quality") == 1).cast("int").alias("good"))
    judge = lambda j: F.struct(F.struct(F.transform("all", lambda c: F.struct(c["docket_id"].alias("id"), (c["base"] + F.lit(j - 1)).alias("relevance"))).alias("chunks"),
                                        F.lit("reply").alias("reply"), F.least(F.lit(10), F.col("good") + 1 + j).alias("satisfaction")).alias("parsed"),
                               ((F.lit(j) == 1) | (F.col("query_id") % 2 == 0)).alias("parse_ok"))
    return cases.select(F.col("query_id").alias("prompt_index"), "sparse_k", F.format_string("%.2f", F.col("sparse_k") / TOPK).alias("sparse_fraction"),
                        F.transform("all", lambda c: F.struct(c["docket_id"], c["source"], c["sources"])).alias("chunks"),
                        F.array(judge(1), judge(2)).alias("judge_outputs"))


_CRITIQUES = f"""{sql_signals(TOPK)}, mem AS (SELECT query_id, sk, id, bool_or(side = 'd') AS in_d, bool_or(side = 's') AS in_s FROM (
   SELECT query_id, id, sk, 'd' AS side FROM d, (SELECT unnest(range(0, {TOPK + 1})) AS sk) WHERE rn <= {TOPK} - sk UNION ALL
   SELECT query_id, id, sk, 's' FROM s, (SELECT unnest(range(0, {TOPK + 1})) AS sk) WHERE rn <= sk) GROUP BY 1, 2, 3),
 rel AS (SELECT mem.*, quality, CASE WHEN quality = 1 THEN 8 WHEN quality = 0 THEN 3 ELSE 1 END AS base FROM mem LEFT JOIN labels ON doc_id = id),
 judged AS (SELECT query_id, sk, j, id, base + j - 1 AS relevance, in_d, in_s FROM rel, (SELECT unnest([1, 2]) AS j) WHERE j = 1 OR query_id % 2 = 0),
 sat AS (SELECT query_id, sk, avg(satisfaction) AS satisfaction FROM (SELECT query_id, sk, j, least(10, count(*) FILTER (quality = 1) + 1 + j) AS satisfaction
   FROM rel, (SELECT unnest([1, 2]) AS j) WHERE j = 1 OR query_id % 2 = 0 GROUP BY 1, 2, 3) GROUP BY 1, 2),
 mass AS (SELECT query_id, sk, avg(sm) AS sparse_mass, avg(dm) AS dense_mass FROM (SELECT query_id, sk, j, coalesce(sum(relevance) FILTER (NOT in_d), 0) / 100 AS sm,
   coalesce(sum(relevance) FILTER (in_d), 0) / 100 AS dm FROM judged GROUP BY 1, 2, 3) GROUP BY 1, 2),
 avgs AS (SELECT query_id, sk, avg(relevance) AS avg_relevance, avg(relevance) FILTER (in_d) AS relevance_dense, avg(relevance) FILTER (in_s) AS relevance_sparse FROM judged GROUP BY 1, 2),
 m AS (SELECT query_id AS prompt_index, printf('%.2f', sk / {TOPK}) AS frac, satisfaction, avg_relevance, relevance_dense, relevance_sparse, sparse_mass, dense_mass,
   CASE WHEN sk > 0 AND sk < {TOPK} THEN sparse_mass / printf('%.2f', sk / {TOPK})::DOUBLE END AS sparse_lift, satisfaction * sparse_mass AS sparse_component
   FROM sat JOIN mass USING (query_id, sk) JOIN avgs USING (query_id, sk))"""


@query("critique_metrics", f"""WITH {_CRITIQUES} SELECT prompt_index, frac, {', '.join(f'round({c}, 6) AS {c}' for c in
 ['satisfaction', 'avg_relevance', 'relevance_dense', 'relevance_sparse', 'sparse_mass', 'dense_mass', 'sparse_lift', 'sparse_component'])} FROM m""")
def critique_metrics(spark: SparkSession, sf: str) -> DataFrame:
    out = ev.critique_metrics(critiques(spark, sf))
    return out.select("prompt_index", "frac", *[F.round(c, 6).alias(c) for c in (
        "satisfaction", "avg_relevance", "relevance_dense", "relevance_sparse", "sparse_mass", "dense_mass", "sparse_lift", "sparse_component")])


@query("judge_means_by_fraction", f"""WITH {_CRITIQUES} SELECT frac, {', '.join(f'round(round(avg({c}), 9), 3) AS {c}' for c in ev.METRIC_COLUMNS)} FROM m GROUP BY 1""")
def judge_means_by_fraction(spark: SparkSession, sf: str) -> DataFrame:
    return ev.by_fraction(ev.critique_metrics(critiques(spark, sf)), [])


@query("satisfaction_histogram", f"WITH {_CRITIQUES} SELECT floor(satisfaction + 0.5)::BIGINT AS bin, count(*) AS cases FROM m GROUP BY 1")
def satisfaction_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return ev.satisfaction_histogram(ev.critique_metrics(critiques(spark, sf)), [])


_VERDICTS = "v AS (SELECT prompt_index, frac, round(avg_relevance / 10, 2) AS verdict FROM m WHERE satisfaction >= 3)"


def verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """Meta-verdicts in [0, 1]; cases of low satisfaction have none."""
    m = ev.critique_metrics(critiques(spark, sf)).filter("satisfaction >= 3")
    return m.select("prompt_index", "frac", F.round(F.col("avg_relevance") / 10, 2).alias("verdict"))


@query("verdict_pivot", f"WITH {_CRITIQUES}, {_VERDICTS} SELECT prompt_index, " + ", ".join(f"min(verdict) FILTER (frac = '{f}') AS \"{f}\"" for f in FRACTIONS) + " FROM v GROUP BY 1")
def verdict_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return ev.verdict_pivot(verdicts(spark, sf), FRACTIONS)


@query("preference_percent", f"WITH {_CRITIQUES}, {_VERDICTS} SELECT frac, floor(round(avg(verdict) * 1000, 6)) / 10 AS preference FROM v GROUP BY 1")
def preference_percent(spark: SparkSession, sf: str) -> DataFrame:
    return ev.preference_percent(verdicts(spark, sf))


@query("sweep_grid_completeness", f"""WITH {_CRITIQUES}, {_VERDICTS} SELECT item_id AS prompt_index, f AS frac FROM benchmark CROSS JOIN (SELECT unnest({FRACTIONS}) AS f)
 ANTI JOIN v ON v.prompt_index = item_id AND v.frac = f""")
def sweep_grid_completeness(spark: SparkSession, sf: str) -> DataFrame:
    prompts = tb.table(spark, sf, "benchmark").select(F.col("item_id").alias("prompt_index"))
    return ev.missing_cases(verdicts(spark, sf), prompts, FRACTIONS)


@query("case_discovery", f"""WITH {_CRITIQUES}, a AS (SELECT prompt_index, frac, 'control' AS tag FROM m WHERE satisfaction >= 3), b AS (SELECT prompt_index, frac, 'variable' AS tag FROM m WHERE avg_relevance < 4)
SELECT prompt_index, frac AS sparse_k, coalesce(a.tag, b.tag) AS tag FROM a FULL JOIN b USING (prompt_index, frac)""")
def case_discovery(spark: SparkSession, sf: str) -> DataFrame:
    m = ev.critique_metrics(critiques(spark, sf)).drop("sparse_k").withColumnRenamed("frac", "sparse_k")
    return ev.discover_cases(m.filter("satisfaction >= 3").withColumn("tag", F.lit("control")),
                             m.filter("avg_relevance < 4").withColumn("tag", F.lit("variable")), ["tag"])


@query("smoothed_surface", """WITH p AS (SELECT l_discount * 10 AS x, l_tax * 10 AS y, l_quantity AS z FROM lineitem),
 g AS (SELECT a / 4.0::DOUBLE AS gx, b / 4.0::DOUBLE AS gy FROM (SELECT unnest(range(0, 5)) AS a), (SELECT unnest(range(0, 5)) AS b)),
 w AS (SELECT gx, gy, z, exp(-(pow((gx - x) / 0.07, 2) + pow((gy - y) / 0.08, 2)) / 2) AS w FROM p, g)
SELECT gx, gy, round(sum(w * z) / sum(w), 6) AS value FROM w GROUP BY 1, 2""")
def smoothed_surface(spark: SparkSession, sf: str) -> DataFrame:
    """Smoothed mean over a 5 x 5 grid, the kernel widths of the satisfaction surface."""
    points = tb.table(spark, sf, "lineitem").select((F.col("l_discount") * 10).alias("x"), (F.col("l_tax") * 10).alias("y"), F.col("l_quantity").alias("z"))
    grid = [i / 4 for i in range(5)]
    return ev.smoothed_surface(points, "x", "y", "z", grid, grid, 0.07, 0.08).withColumn("value", F.round("value", 6))


@query("lift_surface", """WITH r AS (SELECT (l_discount * 10)::DOUBLE AS x, (l_tax * 40 * l_discount * 10)::DOUBLE AS raw, (l_quantity / 4)::DOUBLE AS z FROM lineitem),
 p AS (SELECT x, least(raw, 2.0::DOUBLE) AS y, z FROM r WHERE x > 0 AND x < 1 AND z >= 1), m AS (SELECT min(x) AS low, max(x) AS high FROM p),
 g AS (SELECT low + (high - low) * a / 11 AS gx, 2.0::DOUBLE * b / 11 AS gy FROM m, (SELECT unnest(range(0, 12)) AS a), (SELECT unnest(range(0, 12)) AS b)),
 e AS (SELECT x, min(y) AS lo, max(y) AS hi FROM p GROUP BY 1),
 edge AS (SELECT gx, min(CASE WHEN b.x = a.x THEN a.lo ELSE a.lo + (b.lo - a.lo) * (gx - a.x) / (b.x - a.x) END) AS lo, max(CASE WHEN b.x = a.x THEN a.hi ELSE a.hi + (b.hi - a.hi) * (gx - a.x) / (b.x - a.x) END) AS hi
   FROM (SELECT DISTINCT gx FROM g) c JOIN e a ON a.x <= gx + 1e-9 JOIN e b ON b.x >= gx - 1e-9 AND b.x >= a.x GROUP BY 1),
 s AS (SELECT gx, gy, sum(w * z) / sum(w) AS v FROM (SELECT gx, gy, z, exp(-(pow((gx - x) / 0.07, 2) + pow((gy - y) / 0.08, 2)) / 2) AS w FROM g, p) GROUP BY 1, 2)
SELECT round(gx, 6) AS gx, round(gy, 6) AS gy, CASE WHEN gy >= lo - 1e-9 AND gy <= hi + 1e-9 THEN round(greatest(1, least(10, v)), 6) END AS value FROM s JOIN edge USING (gx)""")
def lift_surface(spark: SparkSession, sf: str) -> DataFrame:
    """The satisfaction surface: lifts and values cut, cells outside the points' convex hull left blank."""
    points = tb.table(spark, sf, "lineitem").select((F.col("l_discount") * 10).alias("x"), (F.col("l_tax") * 40 * F.col("l_discount") * 10).alias("y"), (F.col("l_quantity") / 4).alias("z"))
    out = ev.lift_surface(points, "x", "y", "z", 12, 12)
    return out.select(F.round("gx", 6).alias("gx"), F.round("gy", 6).alias("gy"), F.round("value", 6).alias("value"))


@query("assessment_rows", """SELECT doc_id AS input_id, lang AS category, n_chars AS topk, s AS source,
 CASE WHEN s = 'kb' THEN 1 + n_chars % 10 WHEN s = 'dense' AND lang = 'en' THEN 2 END AS retrieval_score, CASE WHEN s = 'kb' THEN 5 WHEN s = 'dense' AND lang = 'en' THEN 6 END::BIGINT AS response_score,
 CASE WHEN s = 'kb' THEN n_chars / 100.0::DOUBLE END AS response_elapsed_seconds, CASE WHEN s = 'kb' AND n_chars < 100 THEN 'short' END AS response_error
FROM documents CROSS JOIN (SELECT unnest(['dense', 'hybrid', 'kb']) AS s)""")
def assessment_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Assessment records as maps per source; the hybrid source answered nothing."""
    docs = tb.documents(spark, sf)
    score = lambda a, b: F.struct(a.cast("long").alias("retrieval_score"), b.cast("long").alias("response_score"))
    scores = F.map_concat(F.create_map(F.lit("kb"), score(F.col("n_chars") % 10 + 1, F.lit(5))),
                          F.when(F.col("language") == "en", F.create_map(F.lit("dense"), score(F.lit(2), F.lit(6)))).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<struct<retrieval_score:bigint,response_score:bigint>>"))))
    answers = F.create_map(F.lit("kb"), F.struct((F.col("n_chars") / 100).alias("elapsed_seconds"), F.when(F.col("n_chars") < 100, "short").alias("error")))
    records = docs.select(F.col("id").alias("input_id"), F.col("category"), F.col("n_chars").alias("topk"), scores.alias("scores"), answers.alias("responses"))
    return ev.assessment_rows(records, ["dense", "hybrid", "kb"])


@query("epoch_convergence", """WITH e AS (SELECT date_trunc('day', ts)::DATE::VARCHAR AS epoch, event_id AS step, value AS loss FROM events)
SELECT epoch, count(*) AS steps, round(avg(loss), 6) AS loss_mean, arg_max(loss, step) AS loss_last, min(loss) AS loss_best,
 min(step) FILTER (loss = best) AS loss_best_step FROM (SELECT *, min(loss) OVER (PARTITION BY epoch) AS best FROM e) GROUP BY 1""")
def epoch_convergence(spark: SparkSession, sf: str) -> DataFrame:
    """Training telemetry per epoch: the day is the epoch, the event the step, its value the loss."""
    rows = tb.table(spark, sf, "events").select(F.col("ts").cast("date").cast("string").alias("epoch"), F.col("event_id").alias("step"), F.col("value").alias("loss"))
    out = autoencoder.epoch_summary(rows)
    return out.withColumn("loss_mean", F.round("loss_mean", 6))


@query("phase_merge", """SELECT o_orderpriority AS phase, count(*) AS cases, 'new' AS run FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
UNION ALL SELECT o_orderpriority, count(*), 'old' FROM orders WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""")
def phase_merge(spark: SparkSession, sf: str) -> DataFrame:
    orders = tb.table(spark, sf, "orders")
    count = lambda df, run: df.groupBy(F.col("o_orderpriority").alias("phase")).agg(F.count("*").alias("cases")).withColumn("run", F.lit(run))
    return ev.merge_phases(count(orders, "old"), count(orders.filter("o_orderstatus = 'F'"), "new"))


_SHARED = f"len(list_intersect(list_distinct({tb.TERMS.replace('text', 'b.text')}), list_distinct({tb.TERMS.replace('text', 'p.text')})))"


@query("lexical_rerank", f"""WITH {sql_fused(10)}, h AS (SELECT query_id, id, rn, {_SHARED} AS shared FROM fused JOIN documents p ON p.doc_id = id JOIN benchmark b ON b.item_id = query_id)
SELECT query_id, id, rn, shared, row_number() OVER (PARTITION BY query_id ORDER BY shared DESC, rn, id) AS reranked FROM h""")
def lexical_rerank(spark: SparkSession, sf: str) -> DataFrame:
    hits = with_query(spark, sf, with_payload(spark, sf, hybrid(spark, sf, 10), 10))
    out = models.lexical_rerank(hits, ["query_id"])
    return out.select("query_id", "id", *[F.col(c).cast("long").alias(c) for c in ("rn", "shared", "reranked")])


@query("evaluation_run", f"""WITH {sql_signals(15)}, lists AS (SELECT query_id, id, d.rn AS dr, s.rn AS sr FROM d FULL JOIN s USING (query_id, id)),
 g AS (SELECT query_id, id, w AS weight, coalesce(1.0::DOUBLE / (60 + dr), 0) + coalesce(w / (60 + sr), 0) AS score FROM lists CROSS JOIN (SELECT unnest({_WEIGHTS}::DOUBLE[]) AS w)),
 t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, weight ORDER BY round(score, 12) DESC, id) AS rn FROM g) WHERE rn <= 5),
 h AS (SELECT query_id, weight, {_SHARED} / greatest(len(list_distinct({tb.TERMS.replace('text', 'b.text')})), 1) AS share
   FROM t JOIN documents p ON p.doc_id = id JOIN benchmark b ON b.item_id = query_id),
 j AS (SELECT query_id, weight, CASE WHEN share >= 0.5 THEN 3 WHEN share >= 0.2 THEN 2 ELSE 1 END AS rel FROM h),
 m AS (SELECT weight, avg(r) AS avg_relevance FROM (SELECT query_id, weight, avg(rel) AS r FROM j GROUP BY 1, 2) GROUP BY 1),
 c AS (SELECT weight, count(DISTINCT query_id) AS queries, avg((rel >= 2)::INT) AS relevant_share FROM j GROUP BY 1)
SELECT weight, queries, round(avg_relevance, 6) AS avg_relevance, round(relevant_share, 6) AS relevant_share,
 row_number() OVER (ORDER BY round(avg_relevance, 9) DESC, weight) = 1 AS best FROM m JOIN c USING (weight)""")
def evaluation_run(spark: SparkSession, sf: str) -> DataFrame:
    """Retrieval at every sparse weight, judged offline: the whole run as one plan."""
    from hybridloom.plans.evaluation import evaluation_run as run
    out = run(tb.encoded_documents(spark, sf, "dense", "sparse"), tb.prompts(spark, sf), _WEIGHTS, 5)
    return out.select("weight", "queries", F.round("avg_relevance", 6).alias("avg_relevance"), F.round("relevant_share", 6).alias("relevant_share"), "best")


@query("generated_queries", """WITH k AS (SELECT conv_id, turn, role, trim(split_part(trim(text, chr(10) || ' '), chr(10), 1)) AS line, turn % 4 AS m FROM conversations)
SELECT conv_id, turn, md5(CASE WHEN m = 3 THEN trim(line, '"') ELSE line END) AS query_md5,
 CASE m WHEN 0 THEN 'numeric_fact_lookup' WHEN 1 THEN 'comparison_tradeoff' WHEN 2 THEN 'odd' ELSE 'unknown' END AS query_type,
 CASE m WHEN 0 THEN 'trivia' WHEN 1 THEN 'conceptual' ELSE 'operational' END AS query_bucket FROM k""")
def generated_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Generator replies made of the turns: three question types as JSON, every fourth as plain text, read back into buckets."""
    turns, m = tb.table(spark, sf, "conversations"), F.col("turn") % 4
    line = F.trim(F.substring_index(F.trim(F.col("text"), F.lit("\n ")), "\n", 1))
    kind = F.when(m == 0, "numeric_fact_lookup").when(m == 1, "comparison_tradeoff").otherwise("odd")
    reply = F.when(m == 3, F.col("text")).otherwise(F.to_json(F.struct(line.alias("query"), kind.alias("query_type"))))
    got = turns.select("conv_id", "turn", models.generated_query(reply).alias("q"))
    return got.select("conv_id", "turn", F.md5("q.query").alias("query_md5"), "q.query_type", "q.query_bucket")


@query("relevance_judge", f"""WITH {sql_fused(10)}, h AS (SELECT query_id, id, {_SHARED} / greatest(len(list_distinct({tb.TERMS.replace('text', 'b.text')})), 1) AS share
   FROM fused JOIN documents p ON p.doc_id = id JOIN benchmark b ON b.item_id = query_id)
SELECT query_id, id, CASE WHEN share >= 0.5 THEN 3 WHEN share >= 0.2 THEN 2 ELSE 1 END AS relevance, substr(md5('s:' || query_id || ':' || id), 1, 7) AS docket_id FROM h""")
def relevance_judge(spark: SparkSession, sf: str) -> DataFrame:
    """Offline relevance 1..3 of every hit, with the opaque id a judge would see."""
    hits = with_query(spark, sf, with_payload(spark, sf, hybrid(spark, sf, 10), 10))
    return hits.select("query_id", "id", models.lexical_relevance(F.col("query"), F.col("text")).alias("relevance"),
                       models.docket_id("s", F.col("query_id"), F.col("id")).alias("docket_id"))
