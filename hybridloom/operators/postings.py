"""Posting lists of sparse vectors in blocks with their largest weight: top-k without reading what can't reach it."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hybridloom.operators.topk import topk_per_group
from hybridloom.session import checked_broadcast, cut_lineage

BLOCK_POINTS, BUCKETS, PILOT_BLOCKS = 1024, 64, 4
#: Up to this many distinct terms a query set's terms are pushed into the scan as a list.
PUSHED_TERMS = 2000
#: Slack of a bound, far above the rounding of a sum and below a step of the rounded scores.
SLACK = 5e-9


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def point_blocks(points: DataFrame, id_col: str = "id", vector: str = "sparse", cluster: list[Column] | None = None, block_points: int = BLOCK_POINTS) -> DataFrame:
    """(id, indices, values, block): points in blocks of at most ``block_points``.

    Points are put in order of ``cluster``, then of their total weight, and cut into blocks where they lie, so a block holds points of like
    size and subject and its bounds are tight. The result is a checkpoint: a block never changes under its postings.
    """
    mass = F.aggregate(F.coalesce(F.col("values"), F.array().cast("array<double>")), F.lit(0.0), lambda a, v: a + v)
    flat = points.select(F.col(id_col).alias("id"), F.col(f"{vector}.indices").alias("indices"), F.col(f"{vector}.values").alias("values"), *[c.alias(f"by{i}") for i, c in enumerate(cluster or [])])
    # Encoders run once: the order is computed from written vectors.
    flat = cut_lineage(flat).withColumn("mass", mass)
    order = [F.col(c) for c in flat.columns if c.startswith("by")] + [F.col("mass"), F.col("id")]
    dealt = flat.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "indices", "values")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first, seen = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            blocks = [first + (seen + i) // block_points for i in range(batch.num_rows)]
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks, pa.int64())], names=["id", "indices", "values", "block"])

    return cut_lineage(dealt.mapInArrow(numbered, StructType([*dealt.schema.fields, StructField("block", LongType())])))


def build_postings(blocks: DataFrame) -> DataFrame:
    """(bucket, term, block, low, top, ids, weights), a row for each term of a block: at most as long as a block, however common the term."""
    long = blocks.select("id", "block", F.explode(F.arrays_zip("indices", "values")).alias("p")).select("block", "id", F.col("p.indices").alias("term"), F.col("p.values").alias("weight"))
    listed = long.groupBy("term", "block").agg(F.min("weight").alias("low"), F.max("weight").alias("top"), F.sort_array(F.collect_list(F.struct("id", "weight"))).alias("l"))
    return listed.select(_bucket(F.col("term")).alias("bucket"), "term", "block", "low", "top", F.col("l.id").alias("ids"), F.col("l.weight").alias("weights"))


def write_postings(blocks: DataFrame, folder: str) -> None:
    """Postings by bucket of the term, sorted by term: a term is a directory and a range of row groups. Ranges spread a term of all blocks over tasks."""
    rows = build_postings(blocks)
    rows.repartitionByRange("bucket", "term", "block").sortWithinPartitions("bucket", "term", "block").write.partitionBy("bucket").parquet(folder)


def query_terms(queries: DataFrame, idf: DataFrame, query_col: str = "query_id", query_vector: str = "sparse") -> DataFrame:
    """(query, term, bucket, w): the terms of queries, weighted by the collection's inverse document frequency."""
    pairs = queries.select(F.col(query_col).alias("query"), F.explode(F.arrays_zip(F.col(f"{query_vector}.indices"), F.col(f"{query_vector}.values"))).alias("p"))
    terms = pairs.select("query", F.col("p.indices").alias("term"), F.col("p.values").alias("value"))
    return terms.join(idf.select("term", "idf"), "term").select("query", "term", _bucket(F.col("term")).alias("bucket"), (F.col("value") * F.col("idf")).alias("w"))


class PostingsSearch:
    """One search: which blocks can matter, their scores, and what was passed over.

    A block's bound for a query sums, over the query's terms, the largest product its weights allow. The ``pilot`` blocks of largest bound are scored
    first; their k-th score is one that the result's k-th can't be below, so only blocks whose bound reaches it are scored too. Bounds come from
    block heads alone: weights and ids are not read for them. The result equals scoring all points.
    """

    def __init__(self, postings: DataFrame, terms: DataFrame, k: int, pilot: int = PILOT_BLOCKS, decimals: int = 9, allowed: DataFrame | None = None):
        """``terms`` as from :func:`query_terms`; ``allowed`` (id) limits hits to these points before they are ranked."""
        self.k, self.decimals, self.allowed = k, decimals, allowed
        self.terms = cut_lineage(terms)
        buckets = [r["bucket"] for r in self.terms.select("bucket").distinct().collect()]  # at most BUCKETS
        self.postings = postings.where(F.col("bucket").isin(buckets) if buckets else F.lit(False))
        names = [r["term"] for r in self.terms.select("term").distinct().limit(PUSHED_TERMS + 1).collect()]
        if len(names) <= PUSHED_TERMS:
            self.postings = self.postings.where(F.col("term").isin(names) if names else F.lit(False))
        products = F.greatest(F.lit(0.0), F.col("w") * F.col("top"), F.col("w") * F.col("low"))
        heads = self.postings.select("term", "block", "low", "top").join(checked_broadcast(self.terms.select("query", "term", "w")), "term")
        self.bounds = cut_lineage(heads.groupBy("query", "block").agg(F.sum(products).alias("bound")))
        first = topk_per_group(self.bounds, ["query"], [F.desc("bound"), F.asc("block")], pilot).select("query", "block")
        self.first = cut_lineage(self._scores(first))
        floor = topk_per_group(self.first, ["query"], [F.desc("score"), F.asc("id")], k).where(F.col("rn") == k).select("query", F.col("score").alias("floor"))
        rest = self.bounds.join(first, ["query", "block"], "left_anti").join(floor, "query", "left")
        self.rest = rest.where(F.col("floor").isNull() | (F.col("bound") + SLACK >= F.col("floor"))).select("query", "block")
        self.pilots = first

    def _scores(self, chosen: DataFrame) -> DataFrame:
        met = self.postings.join(checked_broadcast(self.terms.select("query", "term", "w")), "term").join(checked_broadcast(chosen), ["query", "block"])
        each = met.select("query", "w", F.explode(F.arrays_zip("ids", "weights")).alias("p")).select("query", F.col("p.ids").alias("id"), (F.col("w") * F.col("p.weights")).alias("part"))
        scored = each.groupBy("query", "id").agg(F.round(F.sum("part"), self.decimals).alias("score"))
        return scored.join(self.allowed.select("id"), "id", "left_semi").select("query", "id", "score") if self.allowed is not None else scored

    def hits(self, query_col: str = "query_id") -> DataFrame:
        """(query, id, score, rn), ties to the smaller id."""
        best = topk_per_group(self.first.unionByName(self._scores(self.rest)), ["query"], [F.desc("score"), F.asc("id")], self.k)
        return best.withColumnRenamed("query", query_col)

    def report(self, query_col: str = "query_id") -> DataFrame:
        """(query, blocks, scored, skipped_share): blocks that hold a term of the query, and how many of them were scored."""
        done = self.pilots.unionByName(self.rest).groupBy("query").agg(F.count(F.lit(1)).alias("scored"))
        all_ = self.bounds.groupBy("query").agg(F.count(F.lit(1)).alias("blocks"))
        return all_.join(done, "query", "left").select(F.col("query").alias(query_col), "blocks", F.coalesce("scored", F.lit(0)).alias("scored"),
                                                       (1 - F.coalesce("scored", F.lit(0)) / F.col("blocks")).alias("skipped_share"))


def postings_topk(postings: DataFrame, queries: DataFrame, k: int, idf: DataFrame, query_col: str = "query_id", query_vector: str = "sparse", **options) -> DataFrame:
    """The rows of :func:`hybridloom.operators.topk.sparse_topk` from posting lists."""
    return PostingsSearch(postings, query_terms(queries, idf, query_col, query_vector), k, **options).hits(query_col)


def statistics_of(postings: DataFrame, total: int, wanted: DataFrame | None = None) -> DataFrame:
    """Statistics (term, df) of the points in posting lists, whose lengths are the counts, with ``total`` points under the null term. No point is encoded again."""
    lists = postings if wanted is None else postings.join(checked_broadcast(wanted), "term", "left_semi")
    counts = lists.groupBy("term").agg(F.sum(F.size("ids")).cast("long").alias("df"))
    return counts.unionByName(postings.sparkSession.range(1).select(F.lit(None).cast("string").alias("term"), F.lit(total).cast("long").alias("df")))


def idf_of(statistics: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(term, df, idf) from maintained statistics (term, df), whose null term counts the points; ``wanted`` limits the terms."""
    total = statistics.where("term IS NULL").select(F.sum("df")).first()[0] or 0
    known = statistics.where("term IS NOT NULL")
    known = known if wanted is None else known.join(checked_broadcast(wanted), "term", "left_semi")
    return known.withColumn("idf", F.log(1 + (F.lit(total) - F.col("df") + 0.5) / (F.col("df") + 0.5)))


def term_counts(rows: DataFrame, vector: str = "sparse") -> DataFrame:
    """(term, df) of points: in how many each term is, and under the null term how many there are. Counts of parts add up."""
    terms = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(F.col(f"{vector}.indices"), F.array().cast("array<string>")))
    return rows.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
