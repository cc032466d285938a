"""Bulk ingest: sections -> chunks -> payload, dense and sparse components of a collection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from hybridloom.config import SPARSE_WINDOW_WORDS, ChunkSettings
from hybridloom.functions import encoders, text as tx
from hybridloom.operators import autoencoder, chunking, dml
from hybridloom.schema import PAYLOAD, as_points
from hybridloom.session import cut_lineage
from hybridloom.sources.store import CollectionStore

SECTIONS_PER_BLOCK = 1000


def running_sequence(chunks: DataFrame, key: str = "source_file") -> DataFrame:
    """doc_chunk_seq: the 0-based place of a chunk in its file.

    Chunks are counted per section, sections in blocks of a thousand; only block totals of one file
    meet in one task.
    """
    chapter = F.coalesce(F.col("chapter_index"), F.lit(0)).cast("long").alias("chapter")
    rows = chunks.withColumn("_order", F.struct(chapter, F.col("section_index").alias("section"))).withColumn(
        "_block", F.struct(chapter, F.floor(F.col("section_index") / SECTIONS_PER_BLOCK).alias("block")))
    sections = rows.groupBy(key, "_block", "_order").agg(F.count("*").alias("_n"))
    before = lambda *keys, by: Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    blocks = sections.groupBy(key, "_block").agg(F.sum("_n").alias("_t"))
    starts = blocks.select(key, "_block", F.coalesce(F.sum("_t").over(before(key, by="_block")), F.lit(0)).alias("_base"))
    inside = sections.select(key, "_block", "_order", F.coalesce(F.sum("_n").over(before(key, "_block", by="_order")), F.lit(0)).alias("_local"))
    place = inside.join(starts, [key, "_block"]).select(key, "_order", (F.col("_base") + F.col("_local")).alias("_start"))
    return (rows.join(place, [key, "_order"]).withColumn("doc_chunk_seq", (F.col("_start") + F.col("chunk_index")).cast("int"))
            .drop("_order", "_block", "_start"))


def chunks_of(sections: DataFrame, settings: ChunkSettings, splitter: Callable[[Column], Column] = tx.sentences) -> DataFrame:
    """Chunk rows with a content-derived id. ``sections`` carry source_file, title, content, section_index and metadata."""
    rows = sections.withColumn("section_title", F.col("title"))
    made = chunking.chunk_sections(rows, settings, splitter=splitter).drop("title")
    if "chapter_index" not in made.columns:
        made = made.withColumn("chapter_index", F.lit(0))
    made = running_sequence(made)
    key = dml.point_id(F.col("source_file"), F.col("chapter_index"), F.col("section_index"), F.col("chunk_index"), F.md5("text"))
    return as_points(made.withColumn("id", key)).select("id", *PAYLOAD)


def embed_text(points: DataFrame, prefixed: bool) -> Column:
    """What the dense encoder reads: papers put their metadata in front of the text."""
    if not prefixed:
        return F.col("text")
    prefix = tx.metadata_prefix(F.col("category"), F.col("subcategory"), F.col("publish_date"), F.col("section_title"))
    return F.concat_ws("\n", F.nullif(prefix, F.lit("")), "text")


def dense_component(points: DataFrame, encoder=encoders.dense_terms, prefixed: bool = False) -> DataFrame:
    return points.select("id", encoder(embed_text(points, prefixed)).alias("dense"))


def sparse_component(points: DataFrame, encoder=encoders.sparse_terms, window: int = SPARSE_WINDOW_WORDS) -> DataFrame:
    """Windows of a chunk are encoded one by one and pooled per term; a chunk of one window is encoded directly.

    Pooling is keyed by (id, term), so nothing depends on how windows fall into batches.
    """
    windows = points.select("id", tx.word_windows(F.col("text"), window).alias("w"))
    single = windows.filter(F.size("w") <= 1).select("id", encoder(F.coalesce(F.get("w", F.lit(0)), F.lit(""))).alias("sparse"))
    many = windows.filter(F.size("w") > 1).select("id", F.explode("w").alias("w"))
    pooled = autoencoder.maxpool_sparse(many.select("id", encoder(F.col("w")).alias("sparse")))
    packed = pooled.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("p")).select(
        "id", F.struct(F.transform("p", lambda p: p["term"]).alias("indices"), F.transform("p", lambda p: p["weight"]).alias("values")).alias("sparse"))
    return single.unionByName(packed)


def ingest(store: CollectionStore, collection: str, sections: DataFrame, settings: ChunkSettings = ChunkSettings.for_service(),
           dense=encoders.dense_terms, sparse=encoders.sparse_terms, prefixed: bool = False) -> dict:
    """Create, append new chunks, then encode what has no vector yet.

    Ids hold a hash of the text: running it again adds nothing, and a file whose text has changed loses its old chunks and their vectors.
    """
    name = store.create(collection)
    # Written once: retirement and the order of a batch read them again.
    chunks = cut_lineage(chunks_of(sections, settings))
    if store.has(name, "payload"):
        store.retire(name, chunks)
    store.append(name, chunks)
    if dense is not None:
        fill_vectors(store, name, "dense", lambda p: dense_component(p, dense, prefixed))
    if sparse is not None:
        fill_vectors(store, name, "sparse", lambda p: sparse_component(p, sparse))
    counters = dml.ingest_counters(store.read(name), ["source_file"]).first()
    return {"collection": name, **counters.asDict()}


def fill_vectors(store: CollectionStore, name: str, component: str, make: Callable[[DataFrame], DataFrame]) -> None:
    """Encode the points that miss a component."""
    points = store.read(name)
    if store.has(name, component):
        points = dml.missing_vectors(points, store.read(name, component))
    store.append(name, make(points), component)


def ingest_papers(store: CollectionStore, collection: str, papers: DataFrame, settings: ChunkSettings = ChunkSettings.for_service(), **encoders_) -> dict:
    """Papers whose arXiv id is stored already are skipped before any text is read.

    ``papers``: sections with arxiv_id and metadata; ids are kept in their dotted form.
    """
    rows = papers.withColumn("arxiv_id", F.translate("arxiv_id", "_", ".")).withColumn("doc_type", F.lit("paper"))
    if "source_file" not in rows.columns:
        rows = rows.withColumn("source_file", F.concat("arxiv_id", F.lit(".pdf")))
    if store.has(collection, "payload"):
        rows = dml.exclude_keys(rows, store.read(collection), ["arxiv_id"])
    return ingest(store, collection, rows, settings, prefixed=True, **encoders_)


def derive_sparse_collection(store: CollectionStore, dense_name: str, sparse_name: str, encoder=encoders.sparse_terms) -> None:
    """A sparse collection of smaller chunks that point back at the dense chunks."""
    made = chunking.sparse_chunks(store.read(dense_name))
    key = dml.point_id(F.col("dense_chunk_ids")[0], F.col("chunk_index"))
    arxiv = F.coalesce(F.col("arxiv_id"), F.lit(""))
    rows = made.withColumn("id", key).withColumn("source_url", F.when(arxiv != "", tx.document_url(arxiv)).otherwise(""))
    name = store.create(sparse_name)
    store.append(name, rows)
    fill_vectors(store, name, "sparse", lambda p: sparse_component(p, encoder))
