"""Context expansion and grouping: conversations play files, their turns play sections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.functions import encoders
from hybridloom.operators import catalog, context, topk
from hybridloom.session import broadcast_within, cut_lineage
from hybridloom.workload import tables as tb
from hybridloom.workload.fusion_queries import hybrid, sql_fused, with_payload
from hybridloom.workload.registry import query

_TURNS = """turns AS (SELECT conv_id * 100000 + turn AS id, 'conv-' || conv_id AS source_file, turn AS section_index, turn AS chunk_index,
   role AS section_title, text, length(text) // 4 AS token_count FROM conversations)"""
_HITS = f"""WITH {_TURNS}, {tb.sql_dense('turns', 'id')}, {tb.sql_ranked('dense_scores', 'top', 3)},
 hits AS (SELECT query_id, id, score, rn, source_file, section_index, chunk_index, section_title, text, token_count FROM top JOIN turns USING (id))"""
_K = 3


def _bound(spark: SparkSession, sf: str, per_query: int) -> int:
    return tb.table(spark, sf, "benchmark").count() * per_query


def turn_hits(spark: SparkSession, sf: str, k: int = _K) -> DataFrame:
    turns = tb.turns(spark, sf)
    found = topk.dense_topk(turns.withColumn("dense", encoders.dense_terms(F.col("text"))), tb.prompts(spark, sf), k)
    # Several branches read the hits; the short list is written once.
    return turns.join(broadcast_within(cut_lineage(found), _bound(spark, sf, k)), "id")


@query("context_expansion", f"""{_HITS}, near AS (SELECT DISTINCT h.query_id, t.id, t.source_file, t.section_index, t.chunk_index FROM hits h JOIN turns t
   ON t.source_file = h.source_file AND t.section_index BETWEEN h.section_index - 2 AND h.section_index + 2)
SELECT query_id, id, 0 AS added, round(score, 6) AS score FROM hits UNION ALL
SELECT query_id, id, 1, 0 FROM near ANTI JOIN hits USING (query_id, id)""")
def context_expansion(spark: SparkSession, sf: str) -> DataFrame:
    out = context.expand_hits(turn_hits(spark, sf), tb.turns(spark, sf), 2, bound=_bound(spark, sf, _K * 5))
    return out.select("query_id", "id", "added", F.round("score", 6).alias("score"))


@query("context_window_radius", f"""{_HITS} SELECT h.query_id, h.id AS seed, t.id, t.section_index::BIGINT - h.section_index::BIGINT AS offset_turns FROM hits h JOIN turns t
 ON t.source_file = h.source_file AND t.section_index BETWEEN h.section_index - 2 AND h.section_index + 2 WHERE h.rn = 1""")
def context_window_radius(spark: SparkSession, sf: str) -> DataFrame:
    seeds = turn_hits(spark, sf).filter("rn = 1").withColumnRenamed("id", "seed")
    near = context.around(seeds, tb.turns(spark, sf), 2, ["query_id", "seed"], bound=_bound(spark, sf, 5))
    return near.select("query_id", "seed", "id", F.col("offset").cast("long").alias("offset_turns"))


@query("radius_sweep", f"""{_HITS} SELECT query_id, radius, count(*) AS chunks, sum(t.token_count)::BIGINT AS tokens, round(avg(t.token_count), 1) AS avg_tokens,
 count(*) FILTER (t.token_count < 50) AS small_chunks FROM hits h CROSS JOIN (SELECT unnest([0, 1, 2, 4, 8]) AS radius) r JOIN turns t
 ON t.source_file = h.source_file AND abs(t.section_index - h.section_index) <= radius WHERE h.rn = 1 GROUP BY 1, 2""")
def radius_sweep(spark: SparkSession, sf: str) -> DataFrame:
    seeds = turn_hits(spark, sf).filter("rn = 1")
    return context.radius_sweep(seeds, tb.turns(spark, sf), [0, 1, 2, 4, 8], bound=_bound(spark, sf, 17))


@query("budget_expand", f"""{_HITS}, near AS (SELECT h.query_id, t.id, t.chunk_index, t.token_count, t.text, t.chunk_index - h.chunk_index AS d FROM hits h JOIN turns t
   ON t.source_file = h.source_file WHERE h.rn = 1),
 run AS (SELECT *, coalesce(sum(token_count) OVER (PARTITION BY query_id ORDER BY abs(d), d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM near)
SELECT query_id, md5(string_agg(text, chr(10) || chr(10) ORDER BY chunk_index)) AS text_md5, min(chunk_index) AS first_chunk, max(chunk_index) AS last_chunk,
 count(*) AS chunks_used, sum(token_count)::BIGINT AS total_tokens FROM run WHERE d = 0 OR before < 600 GROUP BY 1""")
def budget_expand(spark: SparkSession, sf: str) -> DataFrame:
    """Grow the best turn of every prompt to 600 tokens."""
    seeds = turn_hits(spark, sf).filter("rn = 1")
    grown = context.passage(context.budget_expand(seeds, tb.turns(spark, sf), 600))
    return grown.select("query_id", F.md5("text").alias("text_md5"), F.col("first_chunk").cast("long").alias("first_chunk"),
                        F.col("last_chunk").cast("long").alias("last_chunk"), "chunks_used", "total_tokens")


@query("pick_random_chunk", f"""WITH {_TURNS}, seed AS (SELECT * FROM turns WHERE token_count >= 50 ORDER BY md5('7:' || id), id LIMIT 1),
 near AS (SELECT t.*, t.chunk_index - s.chunk_index AS d FROM seed s JOIN turns t ON t.source_file = s.source_file),
 run AS (SELECT *, coalesce(sum(token_count) OVER (ORDER BY abs(d), d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM near)
SELECT (SELECT id FROM seed) AS query_id, md5(string_agg(text, chr(10) || chr(10) ORDER BY chunk_index)) AS text_md5, count(*) AS chunks_used,
 sum(token_count)::BIGINT AS total_tokens FROM run WHERE d = 0 OR before < 4000""")
def pick_random_chunk(spark: SparkSession, sf: str) -> DataFrame:
    """A seeded sample of one substantive turn, grown to the default passage budget."""
    turns = tb.turns(spark, sf)
    seed = catalog.pick_one(turns.filter("token_count >= 50"), seed=7).withColumn("query_id", F.col("id"))
    grown = context.passage(context.budget_expand(seed, turns, 4000))
    return grown.select("query_id", F.md5("text").alias("text_md5"), "chunks_used", "total_tokens")


_RICH = """rich AS (SELECT query_id, fused.id, score, rn, source AS title, source AS source_file, lang AS language, lang AS section_title, text,
   CASE WHEN quality = 1 THEN 'd' || d.doc_id ELSE '' END AS arxiv_id, CASE WHEN n_chars > 2000 THEN [lang, source] END AS authors,
   CASE WHEN toxic = 0 THEN 2000 + quality END AS year, 'pub-' || lang AS publisher
   FROM fused JOIN documents d ON d.doc_id = fused.id LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def rich_hits(spark: SparkSession, sf: str, k: int = 12) -> DataFrame:
    """Hybrid hits with uneven metadata: arXiv ids and years come from the labels."""
    # The list is read by several branches; cut here, it is ranked once.
    hits = with_payload(spark, sf, cut_lineage(hybrid(spark, sf, k)), k)
    labels = tb.table(spark, sf, "labels").withColumnRenamed("doc_id", "id")
    return hits.join(labels, "id", "left").select(
        "query_id", "id", "score", "rn", F.col("source_file").alias("title"), "source_file", "language", F.col("language").alias("section_title"), "text",
        F.when(F.col("quality") == 1, F.concat(F.lit("d"), F.col("id").cast("string"))).otherwise("").alias("arxiv_id"),
        F.when(F.col("n_chars") > 2000, F.array("language", "source_file")).alias("authors"),
        F.when(F.col("toxic") == 0, F.col("quality") + 2000).alias("year"), F.concat(F.lit("pub-"), "language").alias("publisher"))


@query("group_by_section", f"""WITH {sql_fused(12)}, {_RICH}
SELECT query_id, title || '::' || section_title AS group_key, section_title AS group_label, round(max(score), 6) AS best_score, round(avg(score), 6) AS avg_score,
 count(*) AS chunk_count FROM rich GROUP BY query_id, title, section_title""")
def group_by_section(spark: SparkSession, sf: str) -> DataFrame:
    out = context.group_summary(rich_hits(spark, sf), "section")
    return out.withColumns({"best_score": F.round("best_score", 6), "avg_score": F.round("avg_score", 6)})


@query("group_by_book", f"""WITH {sql_fused(12)}, {_RICH}
SELECT query_id, title AS group_key, title AS group_label, round(max(score), 6) AS best_score, round(avg(score), 6) AS avg_score, count(*) AS chunk_count
FROM rich GROUP BY query_id, title""")
def group_by_book(spark: SparkSession, sf: str) -> DataFrame:
    out = context.group_summary(rich_hits(spark, sf), "book")
    return out.withColumns({"best_score": F.round("best_score", 6), "avg_score": F.round("avg_score", 6)})


_BIB = """e AS (SELECT query_id, title, source_file, rn, {'rn': rn, 'arxiv_id': arxiv_id, 'authors': coalesce(array_to_string(authors, ', '), ''), 'year': coalesce(year, 0), 'publisher': publisher} AS v FROM rich),
 f AS (SELECT query_id, title, source_file, min(rn) AS first_rn, list_reduce(list(v ORDER BY rn), lambda a, b: CASE
     WHEN (b.arxiv_id <> '' AND a.arxiv_id = '') OR (b.authors <> '' AND a.authors = '') OR (b.year <> 0 AND a.year = 0) THEN b ELSE a END) AS v FROM e GROUP BY 1, 2, 3),
 bib AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY first_rn) AS source_id, title, source_file, v.arxiv_id AS arxiv_id, v.authors AS authors,
   nullif(v.year, 0) AS year, v.publisher AS publisher FROM f)"""


@query("bibliography", f"""WITH {sql_fused(12)}, {_RICH}, {_BIB}
SELECT query_id, source_id, title, source_file, arxiv_id, authors, year::BIGINT AS year, publisher FROM bib""")
def bibliography(spark: SparkSession, sf: str) -> DataFrame:
    out = context.bibliography(rich_hits(spark, sf))
    return out.withColumns({"source_id": F.col("source_id").cast("long"), "year": F.col("year").cast("long")})


@query("prompt_context", f"""WITH {sql_fused(12)}, {_RICH}, {_BIB}, tags AS (SELECT query_id, source_file, max(source_id) AS tag FROM bib GROUP BY 1, 2),
 g AS (SELECT query_id, title, section_title, max(score) AS best FROM rich GROUP BY 1, 2, 3),
 gr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY best DESC, title || '::' || section_title) AS group_rank FROM g),
 ln AS (SELECT query_id, title, section_title, string_agg(printf('[score:%.4f] ', round(score, 4)) || text || ' [publisher:' || publisher || ' lang:' || language
   || CASE WHEN arxiv_id <> '' THEN ' arxiv:' || arxiv_id ELSE '' END || '] [Source: ' || tag || ']', chr(10) ORDER BY score DESC, id) AS body
   FROM rich JOIN tags USING (query_id, source_file) GROUP BY 1, 2, 3),
 ps AS (SELECT query_id, string_agg(chr(10) || '=== ' || section_title || ' (' || title || ') ===' || chr(10) || body || chr(10), chr(10) ORDER BY group_rank) AS passages
   FROM gr JOIN ln USING (query_id, title, section_title) GROUP BY 1),
 sl AS (SELECT query_id, string_agg('[' || source_id || '] ' || CASE WHEN authors <> '' THEN authors || ' ' ELSE '' END || title
   || CASE WHEN arxiv_id <> '' THEN ' arXiv:' || arxiv_id || ',' ELSE ' ' || publisher || ',' END || coalesce(' ' || year, '') || '.', chr(10) ORDER BY source_id) AS listing FROM bib GROUP BY 1)
SELECT query_id, md5(passages || chr(10) || chr(10) || '**Sources:**' || chr(10) || listing) AS context_md5 FROM ps JOIN sl USING (query_id)""")
def prompt_context(spark: SparkSession, sf: str) -> DataFrame:
    return context.prompt_context(rich_hits(spark, sf)).select("query_id", F.md5("prompt_context").alias("context_md5"))


@query("passage_blocks", f"""{_HITS} SELECT query_id, md5(string_agg('[Passage ' || rn || '] ' || source_file || ' — ' || section_title || chr(10) || text, chr(10) || chr(10) ORDER BY rn)) AS passages_md5
 FROM hits GROUP BY 1""")
def passage_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return context.passages_block(turn_hits(spark, sf)).select("query_id", F.md5("passages").alias("passages_md5"))


@query("exact_section", f"""WITH {_TURNS} SELECT id, section_index, token_count FROM turns WHERE source_file = 'conv-3' AND section_title = 'assistant' ORDER BY section_index""")
def exact_section(spark: SparkSession, sf: str) -> DataFrame:
    found = context.exact_section(tb.turns(spark, sf), "conv-3", "assistant")
    return found.select("id", F.col("section_index").cast("long").alias("section_index"), "token_count")


@query("normalised_titles", """SELECT page_id, CASE WHEN t IN ('front matter', 'no title', 'copyright') THEN NULL WHEN t = 'acknowledgements' THEN 'acknowledgments' ELSE t END AS title
 FROM (SELECT page_id, CASE WHEN url LIKE 'https://m%' THEN 'front matter' WHEN url LIKE 'http://%' THEN 'acknowledgements' ELSE url END AS t FROM pages)""")
def normalised_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Placeholder titles become NULL, spelling variants one form; url classes play the titles."""
    url = F.col("url")
    title = F.when(url.like("https://m%"), " Front Matter ").when(url.like("http://%"), "Acknowledgements").otherwise(url)
    return tb.table(spark, sf, "pages").select("page_id", context.normalise_title(title).alias("title"))


@query("semantic_anchor", f"""WITH {_TURNS}, {tb.sql_dense('turns', 'id', "section_title = 'assistant'")}, {tb.sql_ranked('dense_scores', 'r', 1)}
SELECT query_id, id, round(score, 6) AS score FROM r""")
def semantic_anchor(spark: SparkSession, sf: str) -> DataFrame:
    """Best matching chunk inside a filtered scope; the filter is below the ranking, so no hit is lost."""
    scope = tb.turns(spark, sf).filter("section_title = 'assistant'").withColumn("dense", encoders.dense_terms(F.col("text")))
    return topk.dense_topk(scope, tb.prompts(spark, sf), 1).select("query_id", "id", F.round("score", 6).alias("score"))
