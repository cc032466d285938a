"""Retrieval evaluation: metrics over hit lists, judged critiques, sweeps and comparisons."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hybridloom.functions import text as tx
from hybridloom.schema import as_points, first_present
from hybridloom.session import cut_lineage

# Source labels and bucket names of stored artefacts.
SPARSE_SOURCES = ["sparse", "sparse_resolved"]
QUERY_BUCKETS = ["trivia", "conceptual", "operational"]
OVERLAP_BANDS = {"papers": (0.7, 0.3), "collections": (0.8, 0.4)}


def contains_any(text: Column, terms: Column) -> Column:
    lowered = F.lower(text)
    return F.exists(terms, lambda t: F.contains(lowered, t))


def hit_metrics(hits: DataFrame, keys: list[str], query: str = "query") -> DataFrame:
    """The six metrics of every result list; ``hits`` carry the query text."""
    hits = as_points(hits)
    terms = tx.query_terms(F.col(query))
    section = F.nullif(first_present(F.col("section_title"), F.col("section"), F.col("title")), F.lit(""))
    paper = (F.coalesce(F.col("arxiv_id"), F.lit("")) != "") | (F.col("doc_type") == "paper")
    share = lambda flag: F.avg(F.coalesce(flag, F.lit(False)).cast("int"))
    keyword = F.when(F.size(terms) == 0, F.lit(True)).otherwise(contains_any(F.col("text"), terms))
    return hits.groupBy(*keys).agg(
        F.round(share(keyword), 4).alias("keyword_hit_rate"),
        F.round(F.count_distinct(section) / F.count("*"), 4).alias("section_diversity"),
        F.round(share(tx.has_citation(F.col("text"))), 4).alias("citation_density"),
        F.round(share(paper), 4).alias("papers_coverage"),
        F.round(F.max("score") - F.min("score"), 4).alias("score_spread"),
        F.round(F.avg("token_count"), 2).alias("token_efficiency"))


def document_key(arxiv_id: Column, book_title: Column, text: Column) -> Column:
    """Stable document id with a type prefix."""
    title = F.lower(tx.strip(book_title))
    return F.coalesce(F.concat(F.lit("paper:"), F.nullif(arxiv_id, F.lit(""))),
                      F.when(F.coalesce(book_title, F.lit("")) != "", F.concat(F.lit("book:"), title)),
                      F.concat(F.lit("chunk:"), F.md5(text)))


def jaccard(a: Column, b: Column, both_empty: float = 1.0) -> Column:
    """|A and B| / |A or B| of two id arrays; document ids count two empty sets as equal, texts as 0."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(both_empty)).otherwise(F.size(F.array_intersect(a, b)) / union)


def list_overlap(left: DataFrame, right: DataFrame, keys: list[str], item: Column, both_empty: float = 1.0) -> DataFrame:
    """Overlap of two bounded result lists per key."""
    a = left.groupBy(*keys).agg(F.collect_set(item).alias("a"))
    b = right.groupBy(*keys).agg(F.collect_set(item).alias("b"))
    none = F.array().cast("array<string>")
    both = a.join(b, keys, "full_outer").select(*keys, F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b"))
    return both.select(*keys, F.size(F.array_intersect("a", "b")).alias("common"), F.size(F.array_except("a", "b")).alias("only_left"),
                       F.size(F.array_except("b", "a")).alias("only_right"), jaccard(F.col("a"), F.col("b"), both_empty).alias("jaccard"))


def overlap_bands(overlaps: DataFrame, bands: str = "papers") -> DataFrame:
    high, low = OVERLAP_BANDS[bands]
    j = F.col("jaccard")
    return overlaps.agg(F.count_if(j >= high).alias("high"), F.count_if((j >= low) & (j < high)).alias("middle"),
                        F.count_if(j < low).alias("low"), F.avg("jaccard").alias("mean_jaccard"))


def hit_rank(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Rank of the source passage in every result list.

    ``hits`` carry the source chunk (seed_file, range_low, range_high, seed_text). The first hit of
    the file inside the chunk range counts; failing that the first whose text holds
    more than half of the passage's words.
    """
    distinct_words = lambda c: F.array_distinct(tx.words(F.lower(c)))
    source = distinct_words(F.col("seed_text"))
    shared = F.size(F.array_intersect(source, distinct_words(F.col("text")))) / F.greatest(F.size(source), F.lit(1))
    inside = (F.col("source_file") == F.col("seed_file")) & F.col("chunk_index").between(F.col("range_low"), F.col("range_high"))
    found = hits.groupBy(*keys).agg(F.min(F.when(inside, F.col("rn"))).alias("exact"),
                                    F.min(F.when(shared > 0.5, F.col("rn"))).alias("fuzzy"))
    method = F.when(F.col("exact").isNotNull(), "chunk_index").when(F.col("fuzzy").isNotNull(), "text_overlap").otherwise("none")
    return found.select(*keys, F.coalesce("exact", "fuzzy").alias("rank"), method.alias("match_method"))


def result_profile(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Mean score of the first five, most frequent category (first seen wins ties) and collection balance."""
    hits = as_points(hits)
    category = F.lower(tx.strip(first_present(F.col("category"), F.col("subcategory"), F.col("publisher"))))
    kind = (F.when(F.coalesce(F.col("book_title"), F.lit("")) != "", "book")
            .when(F.coalesce(F.col("arxiv_id"), F.lit("")) != "", "paper").otherwise(F.coalesce("doc_type", F.lit(""))))
    rows = hits.select(*keys, "rn", "score", category.alias("cat"), kind.alias("kind"))
    top5 = rows.groupBy(*keys).agg(F.round(F.avg(F.when(F.col("rn") <= 5, F.col("score"))), 4).alias("top5_avg_score"))
    counted = rows.filter("cat <> ''").groupBy(*keys, "cat").agg(F.count("*").alias("n"), F.min("rn").alias("first"))
    mode = counted.groupBy(*keys).agg(F.max_by("cat", F.struct("n", (-F.col("first")).alias("f"))).alias("top1_category"))
    kinds = rows.groupBy(*keys, "kind").agg(F.count("*").alias("n"))
    balance = kinds.groupBy(*keys).agg(F.when(F.count("*") <= 1, F.lit(0.0)).otherwise(
        F.round(1 - (F.max("n") - F.min("n")) / F.sum("n"), 4)).alias("cross_collection_ratio"))
    return top5.join(mode, keys, "left").join(balance, keys).withColumn("top1_category", F.coalesce("top1_category", F.lit("")))


def average_relevance(ranked: DataFrame, keys: list[str], relevance: str = "relevance") -> DataFrame:
    """Mean relevance of ranked lists; a missing judgement counts as 1."""
    return ranked.groupBy(*keys).agg(F.avg(F.coalesce(F.col(relevance), F.lit(1))).alias("avg_relevance"))


def best_weight(per_query: DataFrame, weight: str = "weight") -> DataFrame:
    """Mean over queries per weight, and whether it is the best (the first of equals)."""
    means = per_query.groupBy(weight).agg(F.avg("avg_relevance").alias("avg_relevance"))
    order = Window.orderBy(F.desc(F.round("avg_relevance", 9)), F.asc(weight))  # one row per weight
    return means.withColumn("best", F.row_number().over(order) == 1)


def bucket_report(samples: DataFrame, bucket: str = "query_bucket") -> DataFrame:
    """Score averages, hit rates and distribution per bucket and in total, one pass with grouping sets."""
    s = F.col("judge_score")
    share = lambda c: F.round(F.avg(F.col(c).isNotNull().cast("int")), 3)
    return (samples.rollup(bucket).agg(
        F.count("*").alias("samples"), F.round(F.avg(s), 2).alias("avg_score"),
        *[F.count_if(s == v).alias(f"score_{v}") for v in (1, 2, 3)],
        share("dense_rank").alias("dense_hit_rate"), share("sparse_rank").alias("sparse_hit_rate"),
        F.round(F.avg("set_size"), 1).alias("avg_set_size"), F.round(F.avg("both_count"), 1).alias("avg_both_count"))
        .withColumn(bucket, F.coalesce(bucket, F.lit("total"))))


def win_report(pairs: DataFrame) -> DataFrame:
    """Wins, losses, ties, win rate and mean improvement of a new method over a baseline."""
    w = F.col("winner")
    return pairs.agg(F.count_if(w == "new").alias("wins"), F.count_if(w == "base").alias("losses"), F.count_if(w == "tie").alias("ties"),
                     F.round(F.avg((w == "new").cast("int")), 4).alias("win_rate"),
                     F.round(F.avg(F.col("new_score") - F.col("base_score")), 4).alias("avg_score_improvement"))


# Critiques: one row per judged case, chunks and judge outputs as nested arrays of bounded size.

def judgements(critique: DataFrame) -> Column:
    """The judge outputs of a stored critique; older files hold a single one."""
    single = F.array("judge_output") if "judge_output" in critique.columns else None
    return F.coalesce("judge_outputs", single) if single is not None else F.col("judge_outputs")


def fraction_label(value: Column) -> Column:
    return F.coalesce(F.format_string("%.2f", value.try_cast("double")), value.cast("string"))


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v.cast("double"))
    return F.when(F.size(values) > 0, total / F.size(values))


def critique_metrics(critiques: DataFrame) -> DataFrame:
    """Satisfaction, relevance, mass, lift and component of every case, computed inside its row."""
    parsed = F.filter(judgements(critiques), lambda j: j["parse_ok"] & j["parsed"].isNotNull())
    between = lambda v: v.isNotNull() & (v >= 1) & (v <= 10)
    satisfaction = _mean(F.filter(F.transform(parsed, lambda j: j["parsed"]["satisfaction"]), between))
    rated = F.flatten(F.transform(parsed, lambda j: j["parsed"]["chunks"]))
    valid = F.filter(rated, lambda c: between(c["relevance"]))
    found_by = lambda cid: F.flatten(F.transform(F.filter("chunks", lambda c: c["docket_id"] == cid), lambda c: c["sources"]))
    source_of = lambda cid: F.get(F.transform(F.filter("chunks", lambda c: c["docket_id"] == cid), lambda c: c["source"]), F.lit(0))
    by = lambda names: _mean(F.transform(F.filter(valid, lambda c: F.arrays_overlap(
        found_by(c["id"]), F.array(*[F.lit(n) for n in names]))), lambda c: c["relevance"]))

    def mass(names: list[str]) -> Column:
        per_judge = F.transform(F.filter(parsed, lambda j: F.size(j["parsed"]["chunks"]) > 0), lambda j: F.aggregate(
            F.filter(j["parsed"]["chunks"], lambda c: source_of(c["id"]).isin(names)), F.lit(0.0),
            lambda a, c: a + F.coalesce(c["relevance"], F.lit(0))) / 100)
        return _mean(per_judge)

    fraction = F.col("sparse_fraction").try_cast("double")
    out = critiques.withColumns({
        "frac": fraction_label(F.col("sparse_fraction")), "satisfaction": satisfaction,
        "avg_relevance": _mean(F.transform(valid, lambda c: c["relevance"])),
        "relevance_dense": by(["dense"]), "relevance_sparse": by(SPARSE_SOURCES),
        "sparse_mass": mass(SPARSE_SOURCES), "dense_mass": mass(["dense"])})
    return out.withColumns({
        "sparse_lift": F.when((fraction > 0) & (fraction < 1), F.col("sparse_mass") / fraction),
        "sparse_component": F.col("satisfaction") * F.col("sparse_mass")}).drop("chunks", "judge_outputs", "judge_output")


METRIC_COLUMNS = ["satisfaction", "sparse_mass", "dense_mass", "sparse_lift", "sparse_component"]


def by_fraction(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """Means per fraction; missing values do not count."""
    return metrics.groupBy(*keys, "frac").agg(*[F.round(F.round(F.avg(c), 9), 3).alias(c) for c in METRIC_COLUMNS])


def satisfaction_histogram(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """Cases per unit-wide bin centred on the integers 1..10."""
    return (metrics.filter(F.col("satisfaction").isNotNull())
            .groupBy(*keys, F.floor(F.col("satisfaction") + 0.5).cast("long").alias("bin")).agg(F.count("*").alias("cases")))


def verdict_pivot(verdicts: DataFrame, fractions: list[str]) -> DataFrame:
    """Prompt x fraction table of verdicts."""
    return verdicts.groupBy("prompt_index").pivot("frac", fractions).agg(F.first("verdict"))


def preference_percent(verdicts: DataFrame) -> DataFrame:
    """Mean verdict per fraction in percent, truncated to one decimal."""
    return verdicts.groupBy("frac").agg((F.floor(F.round(F.avg("verdict") * 1000, 6)) / 10).alias("preference"))


def missing_cases(present: DataFrame, prompts: DataFrame, fractions: list[str]) -> DataFrame:
    """Cases of the prompts x fractions grid that are absent."""
    grid = prompts.select("prompt_index", F.explode(F.array(*[F.lit(f) for f in fractions])).alias("frac"))
    return grid.join(present.select("prompt_index", "frac").distinct(), ["prompt_index", "frac"], "left_anti")


def smoothed_surface(points: DataFrame, x: str, y: str, z: str, xs: list[float], ys: list[float], hx: float, hy: float) -> DataFrame:
    """Gaussian-weighted mean of z on a grid. Every row adds to the grid cells; partial sums are combined per task."""
    grid = F.explode(F.array(*[F.struct(F.lit(gx).alias("gx"), F.lit(gy).alias("gy")) for gx in xs for gy in ys])).alias("g")
    rows = points.select(x, y, z, grid)
    w = F.exp(-(F.pow((F.col("g.gx") - F.col(x)) / hx, 2) + F.pow((F.col("g.gy") - F.col(y)) / hy, 2)) / 2)
    return rows.groupBy(F.col("g.gx").alias("gx"), F.col("g.gy").alias("gy")).agg((F.sum(w * F.col(z)) / F.nullif(F.sum(w), F.lit(0.0))).alias("value"))


def hull_of(points: Iterable[tuple[float, float]]) -> list[tuple[float, float]]:
    """Corners of the convex hull, counter-clockwise from the leftmost: two chains over the points in order of x, then y."""
    ordered = sorted(set(points))
    if len(ordered) < 3:
        return ordered

    def chain(run: Iterable[tuple[float, float]]) -> list[tuple[float, float]]:
        kept: list[tuple[float, float]] = []
        for p in run:
            while len(kept) > 1 and (kept[-1][0] - kept[-2][0]) * (p[1] - kept[-2][1]) <= (kept[-1][1] - kept[-2][1]) * (p[0] - kept[-2][0]):
                kept.pop()
            kept.append(p)
        return kept[:-1]

    return chain(ordered) + chain(reversed(ordered))


def convex_hull(points: DataFrame, x: str, y: str, gathered: int = 10_000) -> list[tuple[float, float]]:
    """Corners of the convex hull of all points. Every task reduces its points to their own hull, in further rounds while more than ``gathered`` corners
    are left and rounds still shrink them; the driver joins what is left, which is no more than the hull's own order of size."""
    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[float, float]] = []
        for batch in batches:
            kept = hull_of(kept + list(zip(*(c.to_pylist() for c in batch.columns))))
        xs, ys = zip(*kept) if kept else ((), ())
        yield pa.record_batch([pa.array(xs, pa.float64()), pa.array(ys, pa.float64())], names=["x", "y"])

    plain = points.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    corners, left = cut_lineage(plain.mapInArrow(reduced, "x double, y double")), None
    while (now := corners.count()) > gathered and (left is None or now < left / 2):
        corners, left = cut_lineage(corners.repartition(-(-now // gathered)).mapInArrow(reduced, "x double, y double")), now
    return hull_of((r["x"], r["y"]) for r in corners.collect())


def inside(hull: list[tuple[float, float]], at: tuple[float, float], slack: float = 1e-9) -> bool:
    """Whether a point lies in the hull or on its edge."""
    edges = zip(hull, hull[1:] + hull[:1])
    return len(hull) > 2 and all((b[0] - a[0]) * (at[1] - a[1]) - (b[1] - a[1]) * (at[0] - a[0]) >= -slack for a, b in edges)


def lift_surface(points: DataFrame, fraction: str, lift: str, value: str, nx: int = 300, ny: int = 300, hx: float = 0.07, hy: float = 0.08) -> DataFrame:
    """(gx, gy, value): a smoothed surface over fraction and lift, null outside the convex hull of the points.

    Fractions of 0 and 1, values below 1 and missing numbers stay out, lifts are cut to 2 and values to 1 .. 10. Fractions run from the least to
    the largest one, lifts from 0 to 2. Fewer than three points, or points on one line along an axis, give no surface.
    """
    known = points.select(F.col(fraction).cast("double").alias("x"), F.least(F.col(lift).cast("double"), F.lit(2.0)).alias("y"), F.col(value).cast("double").alias("z"),
                          F.col(lift).cast("double").alias("raw")).where("x > 0 AND x < 1 AND z >= 1 AND raw IS NOT NULL AND NOT isnan(raw)")
    seen = known.agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"), F.min("y").alias("bottom"), F.max("y").alias("top")).first()
    if seen["n"] < 3 or seen["low"] == seen["high"] or seen["bottom"] == seen["top"]:
        return points.sparkSession.createDataFrame([], "gx double, gy double, value double")
    xs = [seen["low"] + (seen["high"] - seen["low"]) * i / (nx - 1) for i in range(nx)]
    ys = [2.0 * i / (ny - 1) for i in range(ny)]
    hull = convex_hull(known, "x", "y")
    cells = [(a, b) for a in xs for b in ys]
    shown = [c for c in cells if inside(hull, c)]
    sums = _surface_sums(known, shown, hx, hy)
    grid = points.sparkSession.createDataFrame(cells, "gx double, gy double")
    return grid.join(F.broadcast(sums), ["gx", "gy"], "left").select("gx", "gy", F.when(F.col("value").isNotNull(), F.greatest(F.lit(1.0), F.least(F.lit(10.0), F.col("value")))).alias("value"))


def _surface_sums(points: DataFrame, cells: list[tuple[float, float]], hx: float, hy: float) -> DataFrame:
    """Kernel means at the cells: each task adds its points to one array of the grid's size, and the arrays are added up."""
    gx, gy = np.array([c[0] for c in cells]), np.array([c[1] for c in cells])

    # Equal points are one with a weight in the sum, so a hot point costs one row a task.
    merged = points.groupBy("x", "y").agg(F.sum("z").alias("z"), F.count("*").alias("n"))

    def weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, sums = np.zeros(len(gx)), np.zeros(len(gx))
        for batch in batches:
            for x, y, z, n in zip(*(np.asarray(c) for c in batch.columns)):
                w = np.exp(-(((gx - x) / hx) ** 2 + ((gy - y) / hy) ** 2) / 2)
                weights += w * n
                sums += w * z
        if len(gx):
            yield pa.record_batch([pa.array(gx), pa.array(gy), pa.array(weights), pa.array(sums)], names=["gx", "gy", "w", "s"])

    parts = merged.select("x", "y", "z", "n").mapInArrow(weighted, "gx double, gy double, w double, s double")
    return parts.groupBy("gx", "gy").agg((F.sum("s") / F.nullif(F.sum("w"), F.lit(0.0))).alias("value"))


def assessment_rows(records: DataFrame, sources: list[str]) -> DataFrame:
    """Long form of assessment records: one row per record and source, blanks where a source is absent."""
    source = F.explode(F.array(*[F.lit(s) for s in sources])).alias("source")
    rows = records.select("*", source)
    score, answer = F.col("scores")[F.col("source")], F.col("responses")[F.col("source")]
    return rows.select("input_id", "category", "topk", "source", score["retrieval_score"].alias("retrieval_score"),
                       score["response_score"].alias("response_score"), answer["elapsed_seconds"].alias("response_elapsed_seconds"),
                       answer["error"].alias("response_error"))


def discover_cases(control: DataFrame, variable: DataFrame, fields: list[str]) -> DataFrame:
    """Cases present in either tagged run; metadata of the control run first."""
    keys = ["prompt_index", "sparse_k"]
    c = control.select(*keys, *[F.col(f).alias(f"c_{f}") for f in fields])
    v = variable.select(*keys, *[F.col(f).alias(f"v_{f}") for f in fields])
    return c.join(v, keys, "full_outer").select(*keys, *[F.coalesce(f"c_{f}", f"v_{f}").alias(f) for f in fields])


def merge_phases(old: DataFrame, new: DataFrame, phase: str = "phase") -> DataFrame:
    """Aggregates of other phases stay, those of the current phases are replaced."""
    return old.join(new.select(phase).distinct(), phase, "left_anti").unionByName(new)


def first_reply(outputs: Column) -> Column:
    """Reply of the first judgement; NULL when it is unparsed or blank."""
    first = F.get(outputs, F.lit(0))
    reply = F.when(first["parse_ok"], first["parsed"]["reply"])
    return F.when(tx.strip(F.coalesce(reply, F.lit(""))) != "", reply)


def first_parsed_reply(outputs: Column) -> Column:
    return F.get(F.filter(outputs, lambda j: j["parse_ok"]), F.lit(0))["parsed"]["reply"]


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
