"""Search over stored collections: hybrid, dense, cross-collection, context and catalogue.

Plans run over whole collections; what reaches the driver is a result list bounded by top_k.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridloom.config import MIN_TOTAL_TOKENS, SearchSettings
from hybridloom.functions import encoders
from hybridloom.operators import catalog, context, fusion, postings, topk
from hybridloom.schema import PAYLOAD, unify_fields
from hybridloom.session import broadcast_within, checked_broadcast
from hybridloom.sources.store import CollectionStore

HIT_SCHEMA = "query_id long, id string, score double, rn long, collection string, " + ", ".join(f"{n} {t}" for n, t in PAYLOAD.items())


class SearchEngine:
    def __init__(self, spark: SparkSession, store: CollectionStore, settings: SearchSettings = SearchSettings(),
                 dense: Callable[[Column], Column] = encoders.dense_terms, sparse: Callable[[Column], Column] = encoders.sparse_terms,
                 rewrite: Callable[[str], str] = lambda q: q):
        self.spark, self.store, self.settings = spark, store, settings
        self.dense, self.sparse, self.rewrite = dense, sparse, rewrite

    # Ranking

    def queries(self, texts: list[str]) -> DataFrame:
        rows = self.spark.createDataFrame([(i, self.rewrite(t)) for i, t in enumerate(texts)], "query_id long, query string")
        return rows.withColumns({"dense": self.dense(F.col("query")), "sparse": self.sparse(F.col("query"))})

    def _component(self, collection: str, component: str, filter_by: dict | None) -> DataFrame:
        """A vector component; a metadata filter limits it before the ranking."""
        vectors = self.store.read(collection, component)
        if not filter_by:
            return vectors
        return vectors.join(self._allowed(collection, filter_by), "id", "left_semi")

    def _allowed(self, collection: str, filter_by: dict) -> DataFrame:
        """Ids of the filtered payload; files that can't hold one are not opened."""
        return self.store.read(collection, filter_by=filter_by).select("id")

    def dense_hits(self, queries: DataFrame, collection: str, k: int, filter_by: dict | None = None) -> DataFrame:
        return topk.dense_topk(self._component(collection, "dense", filter_by), queries, k)

    def sparse_hits(self, queries: DataFrame, collection: str, k: int, filter_by: dict | None = None) -> DataFrame:
        """Term statistics are those of the whole collection, filtered or not, as the store keeps them. Where the collection has posting lists, only the
        blocks that can reach the result are read."""
        at = self.store.snapshot(collection)
        wanted = queries.select(F.explode("sparse.indices").alias("term")).distinct()
        idf = postings.idf_of(self.store.term_statistics(collection, at), wanted)
        lists = self.store.sparse_postings(collection, at)
        if lists is not None:
            return postings.postings_topk(lists, queries, k, idf, allowed=self._allowed(collection, filter_by) if filter_by else None)
        return topk.sparse_topk(self._component(collection, "sparse", filter_by), queries, k, idf=idf)

    def hybrid_hits(self, queries: DataFrame, collection: str, k: int, filter_by: dict | None = None,
                    sparse_weight: float | None = None, dense_weight: float | None = None) -> DataFrame:
        """Weighted reciprocal-rank fusion; a signal of weight zero is not even ranked."""
        sw = self.settings.sparse_weight if sparse_weight is None else sparse_weight
        dw = self.settings.dense_weight if dense_weight is None else dense_weight
        signals = {}
        if dw > 0:
            signals["dense"] = (self.dense_hits(queries, collection, 2 * k, filter_by), dw)
        if sw > 0:
            signals["sparse"] = (self.sparse_hits(queries, collection, 2 * k, filter_by), sw)
        if not signals:
            return self.dense_hits(queries, collection, 1).limit(0)
        return fusion.rrf_fuse(signals, k)

    def with_payload(self, hits: DataFrame, collection: str, bound: int | None = None) -> DataFrame:
        """Join hits to their payload; without a known bound their number is checked first."""
        side = checked_broadcast(hits) if bound is None else broadcast_within(hits, bound)
        rows = self.store.points(collection).join(side, "id")
        return rows.withColumn("collection", F.lit(collection))

    def _collected(self, hits: DataFrame) -> DataFrame:
        """The bounded result list as a local table, so that grouping and citing do not rank again."""
        rows = unify_fields(hits).selectExpr(*[f"cast({part.split()[0]} as {part.split()[1]}) as {part.split()[0]}" for part in HIT_SCHEMA.split(", ")])
        return self.spark.createDataFrame(rows.collect(), HIT_SCHEMA)

    # Search

    def search(self, query: str, top_k: int | None = None, group_by: str | None = None, collection: str | None = None,
               filter_by: dict | None = None, sparse_weight: float | None = None, dense_weight: float | None = None,
               expand: bool | None = None) -> dict:
        """One collection: hybrid where it has sparse vectors, else dense with the surrounding sections."""
        name = self.store.resolve(collection or self.settings.default_collection)
        k = self.settings.top_k if top_k is None else top_k
        asked = self.queries([query])
        hybrid = self.store.has(name, "sparse")
        hits = (self.hybrid_hits(asked, name, k, filter_by, sparse_weight, dense_weight) if hybrid
                else self.dense_hits(asked, name, k, filter_by))
        rows = self._collected(self.with_payload(hits, name, k))
        if (not hybrid) if expand is None else expand:
            rows = self._expanded(rows, name, self.settings.context_radius)
        return self.bundle(query, rows, group_by, [])

    def search_collections(self, query: str, top_k: int | None = None, group_by: str | None = None, collections: list[str] | None = None,
                           filter_by: dict | None = None, sparse_weight: float | None = None, dense_weight: float | None = None) -> dict:
        """All collections: fused scores as they are, dense ones as z-scores, plus the metadata boost.

        Hybrid collections contribute 2k rows, dense ones k, and the merged list is not cut again.
        """
        names = [self.store.resolve(c) for c in (collections or self.settings.collections)]
        unknown = [n for n in names if not self.store.has(n, "dense")]
        if unknown:
            raise LookupError(f"collections without vectors: {', '.join(unknown)}")
        k, asked, parts = self.settings.top_k if top_k is None else top_k, self.queries([query]), []
        for name in names:
            if self.store.has(name, "sparse"):
                hits = self.hybrid_hits(asked, name, 2 * k, filter_by, sparse_weight, dense_weight)
            else:
                hits = fusion.zscore(self.dense_hits(asked, name, k, filter_by), ["query_id"])
            parts.append(self.with_payload(hits, name, 2 * k))
        if not parts:
            return self.bundle(query, self.spark.createDataFrame([], HIT_SCHEMA), group_by, names)
        merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        boost = fusion.metadata_boost(F.lit(query), {f: F.col(f) for f in ("publisher", "category", "subcategory", "doc_type")})
        scored = self._collected(merged.withColumn("score", F.col("score") + boost))
        ranked = fusion.flatten_ranked(scored, ["query_id", "collection"])
        order = topk.topk_per_group(ranked.drop("rank", "rn"), ["query_id"], [F.desc("score"), F.asc("collection"), F.asc("id")], 2 * k * len(names))
        return self.bundle(query, order, group_by, names)

    def search_raw(self, query: str, top_k: int | None = None, collection: str | None = None) -> list[dict]:
        name = self.store.resolve(collection or self.settings.default_collection)
        k = self.settings.top_k if top_k is None else top_k
        rows = self._collected(self.with_payload(self.dense_hits(self.queries([query]), name, k), name, k))
        return [r.asDict() for r in rows.orderBy("rn").select(F.round("score", 4).alias("score"), "text", "doc_type", "title", "section",
                                                             "source_file", "chunk_index").collect()]

    def _expanded(self, hits: DataFrame, collection: str, radius: int) -> DataFrame:
        """Hits and the chunks of nearby sections, each once."""
        points = self.store.points(collection)
        more = context.expand_hits(hits, points.select("id", "source_file", "section_index", "chunk_index"), radius, bound=hits.count() * (2 * radius + 1))
        extra = more.filter("added = 1").select("query_id", "id", "score", F.lit(None).cast("long").alias("rn"))
        added = self._collected(self.with_payload(extra, collection))
        order = F.row_number().over(_reading_order()) + hits.count()
        return hits.unionByName(added.withColumn("rn", order.cast("long")))

    def bundle(self, query: str, hits: DataFrame, group_by: str | None, collections: list[str]) -> dict:
        """Groups, sources and prompt text of a bounded result list."""
        by = group_by or self.settings.group_by
        rows = context.group_hits(hits, by).orderBy("group_rank", "place").collect()
        groups: dict[str, dict] = {}
        for r in rows:
            group = groups.setdefault(r["group_key"], {
                "group_key": r["group_key"], "group_label": r["group_label"], "title": r["title"] or r["book_title"] or "", "source_file": r["source_file"],
                "best_score": round(r["best_score"], 4), "avg_score": round(r["avg_score"], 4), "chunk_count": r["chunk_count"], "chunks": []})
            group["chunks"].append({"score": round(r["score"], 4), "text": r["text"] or "", "point_id": r["id"], **{c: r[c] for c in (
                "doc_type", "title", "section", "source_file", "chunk_index", "token_count", "arxiv_id", "category", "book_title", "section_title", "authors", "year")}})
        prompt = context.prompt_context(hits, by).select("prompt_context").first() if rows else None
        sources = context.bibliography(hits).orderBy("source_id").withColumn("formatted", context.format_source()).collect() if rows else []
        return {"query": query, "total_chunks": len(rows), "groups": list(groups.values()), "prompt_context": prompt[0] if prompt else "",
                "collections_queried": collections, "sources": [s.asDict() for s in sources]}

    # Context

    def get_context(self, source_file: str, section_title: str | None = None, query: str | None = None, radius: int | None = None,
                    collection: str | None = None) -> dict:
        """The chunks around a section: exact title, else the best matching chunk of the file as anchor."""
        name, r = self.store.resolve(collection or self.settings.default_collection), self.settings.context_radius if radius is None else radius
        anchor = section_title or query
        label = f"context for {source_file}"
        if not anchor:
            return {"query": label, "total_chunks": 0, "groups": []}
        points = self.store.points(name)
        usable = self.spark.range(1).select(context.normalise_title(F.lit(anchor)).alias("t")).first()[0] is not None
        exact = context.exact_section(points, source_file, anchor).withColumns({"score": F.lit(1.0), "query_id": F.lit(0).cast("long"), "rn": F.lit(0), "collection": F.lit(name)})
        window = self._collected(exact) if usable else self.spark.createDataFrame([], HIT_SCHEMA)
        if window.isEmpty():
            best = self.dense_hits(self.queries([anchor]), name, 1, {"source_file": source_file})
            seed = self._collected(self.with_payload(best, name, 1))
            if seed.isEmpty():
                return {"query": label, "total_chunks": 0, "groups": []}
            near = context.around(seed.select("query_id", "source_file", "section_index", F.col("score").alias("_s")), points, r, ["query_id"], bound=2 * r + 1)
            window = self._collected(near.withColumns({"score": F.lit(0.0), "rn": F.lit(0), "collection": F.lit(name)}))
        window = window.withColumn("rn", F.row_number().over(_reading_order()).cast("long"))
        if window.count() < 2 * r + 1:
            window = self._expanded(window, name, r)
        rows = window.orderBy("rn").collect()
        chunks = [{"id": x["id"], "score": round(x["score"], 4), "text": x["text"], "chunk_index": x["chunk_index"], "section_index": x["section_index"]} for x in rows]
        return {"query": label, "total_chunks": len(rows), "groups": [{"group_key": f"{source_file}::{anchor}", "group_label": anchor, "title": rows[0]["title"], "chunks": chunks}]}

    def pick_random_chunk(self, collection: str | None = None, min_tokens: int = 200, min_total_tokens: int = MIN_TOTAL_TOKENS,
                          source_file: str | None = None, seed: int | None = None) -> dict:
        """A substantive chunk grown outwards in its file to the token budget."""
        name = self.store.resolve(collection or self.settings.default_collection)
        points = self.store.read(name)
        chosen = catalog.pick_one(catalog.substantive(points, min_tokens, source_file), "id", seed).collect()
        if not chosen:
            return {"error": "No substantive chunks found in collection", "collection": name}
        row = chosen[0]
        seeds = self.spark.createDataFrame(chosen, points.schema).withColumn("query_id", F.lit(0))
        grown = context.passage(context.budget_expand(seeds, points, min_total_tokens, position="doc_chunk_seq"), position="doc_chunk_seq").first()
        return {"point_id": row["id"], "collection": name, "text": grown["text"], "source_file": row["source_file"], "title": row["book_title"] or row["title"] or "",
                "section_title": row["section_title"], "seed_chunk_index": row["doc_chunk_seq"], "chunk_range": [grown["first_chunk"], grown["last_chunk"]],
                "chunks_used": grown["chunks_used"], "total_tokens": grown["total_tokens"], "token_count": row["token_count"]}

    # Catalogue

    def list_books(self, collection: str | None = None) -> list[dict]:
        books = catalog.list_books(self.store.read(collection or self.settings.default_collection))
        return [r.asDict() for r in books.orderBy("source_file").toLocalIterator()]

    def list_sources(self, collection: str | None = None, offset: int = 0, limit: int = 50, category: str | None = None, search: str | None = None) -> dict:
        sources = catalog.list_sources(self.store.read(collection or self.settings.default_collection))
        categories = {r["category"]: r["sources"] for r in catalog.category_counts(sources).collect()}
        if category:
            sources = catalog.in_category(sources, category)
        if search:
            sources = catalog.matching(sources, search)
        total = sources.count()
        return {"sources": [r.asDict() for r in catalog.page(sources, offset, limit).collect()], "total": total, "offset": offset, "limit": limit,
                "has_more": limit > 0 and offset + limit < total, "categories": categories}

    # Multi-hop

    def multi_hop(self, query: str, collection: str, k: int, depth: int, next_query: Callable[[str, list[str]], str | None],
                  search: Callable[[DataFrame, str, int], DataFrame] | None = None) -> DataFrame:
        """Search, exclude what was seen, ask again; stops at ``depth`` or when ``next_query`` returns None.

        ``search`` (queries, collection, k) ranks a hop's hits, :meth:`dense_hits` by default, :meth:`hybrid_hits` or any other plan with query_id, id and
        score. Every hop asks for k rows beyond the number seen, so the best k unseen ones of its ranking are exact.
        """
        name, found, text = self.store.resolve(collection), None, query
        for hop in range(depth):
            asked = self.queries([text])
            seen = [r["id"] for r in found.select("id").collect()] if found is not None else []
            ranked = (search or self.dense_hits)(asked, name, k + len(seen)).select("query_id", "id", "score", "rn").filter(~F.col("id").isin(seen) if seen else F.lit(True))
            rows = self._collected(self.with_payload(ranked.drop("rn").withColumn("rn", F.lit(hop)), name, k + len(seen)))
            fresh = rows.orderBy(F.desc("score"), "id").limit(k)
            found = fresh if found is None else found.unionByName(fresh)
            text = next_query(text, [r["text"] for r in fresh.select("text").collect()])
            if not text:
                break
        return found


def _reading_order():
    from pyspark.sql import Window
    return Window.partitionBy("query_id").orderBy("section_index", "chunk_index", "id")
