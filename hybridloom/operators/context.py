"""Context around hits, grouping, bibliography and prompt text.

Hits are bounded (queries x k), point tables are not. Neighbours are found by an equi-join on
(source_file, position): each hit lists the positions it wants, so a source that holds a third of
all rows is spread over its positions instead of meeting the hits in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from hybridloom.functions import text as tx
from hybridloom.schema import as_points, first_present
from hybridloom.session import broadcast_within, cut_lineage

# Section titles that are normalised, or (None) answered by semantic search instead.
SECTION_TITLES = {
    "front matter": None, "frontmatter": None, "preface": "preface", "introduction": "introduction",
    "foreword": "foreword", "acknowledgments": "acknowledgments", "acknowledgements": "acknowledgments",
    "copyright": None, "(no title)": None, "no title": None,
}
SMALL_CHUNK_TOKENS = 50


def normalise_title(title: Column) -> Column:
    """The canonical title; NULL for an empty or a placeholder title."""
    lowered = F.lower(tx.strip(title))
    out = title
    for name, canonical in SECTION_TITLES.items():
        out = F.when(lowered == name, F.lit(canonical)).otherwise(out)
    return F.when(F.coalesce(title, F.lit("")) == "", F.lit(None).cast("string")).otherwise(out)


def around(seeds: DataFrame, points: DataFrame, radius: Column | int, seed_cols: list[str],
           position: str = "section_index", bound: int | None = None) -> DataFrame:
    """Points of the seed's file whose position is within ``radius`` of the seed's.

    Output: the seed columns, ``offset`` and the point's own columns. The seed keeps its position
    under ``seed_position``.
    """
    r = radius if isinstance(radius, Column) else F.lit(radius)
    wanted = (seeds.select(*seed_cols, "source_file", F.col(position).alias("seed_position"),
                           F.explode(F.sequence(-r, r)).alias("offset"))
              .withColumn(position, (F.col("seed_position") + F.col("offset")).cast("int")))
    if bound is not None:
        wanted = broadcast_within(wanted, bound)
    return points.join(wanted, ["source_file", position])


def expand_hits(hits: DataFrame, points: DataFrame, radius: int, query_col: str = "query_id",
                id_col: str = "id", bound: int | None = None) -> DataFrame:
    """Hits first, then every chunk of a nearby section once, without a score of its own.

    ``hits``: query, id, source_file, section_index, chunk_index, score, rn.
    """
    key = [query_col, "source_file", "section_index", "chunk_index"]
    near = (around(hits, points, radius, [query_col], bound=bound)
            .select(*key, id_col).dropDuplicates([query_col, id_col]))
    fresh = near.join(hits.select(*key).distinct(), key, "left_anti")
    listed = (hits.select(*key, id_col, "score", F.lit(0).alias("added"), F.col("rn").cast("long").alias("pos"))
              .unionByName(fresh.select(*key, id_col, F.lit(0.0).alias("score"), F.lit(1).alias("added"),
                                        F.lit(None).cast("long").alias("pos"))))
    first = Window.partitionBy(*key).orderBy("added", "pos", id_col)
    return listed.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def radius_sweep(seeds: DataFrame, points: DataFrame, radii: list[int], query_col: str = "query_id",
                 bound: int | None = None) -> DataFrame:
    """Chunk and token counts of the window at every radius, in one pass over the points."""
    near = around(seeds, points, max(radii), [query_col], bound=bound)
    each = near.select(query_col, "token_count", "offset", F.explode(F.array(*[F.lit(r) for r in radii])).alias("radius"))
    return (each.filter(F.abs("offset") <= F.col("radius")).groupBy(query_col, "radius").agg(
        F.count("*").alias("chunks"), F.sum("token_count").alias("tokens"),
        F.round(F.avg("token_count"), 1).alias("avg_tokens"),
        F.count_if(F.col("token_count") < SMALL_CHUNK_TOKENS).alias("small_chunks")))


def budget_expand(seeds: DataFrame, points: DataFrame, budget: int, query_col: str = "query_id",
                  position: str = "chunk_index", tokens: str = "token_count", first_reach: int = 20) -> DataFrame:
    """Grow outwards from each seed until its passage reaches the token budget or its file ends.

    Neighbours are taken before and after alternately; a chunk joins while the passage is still below the budget. The reach is
    doubled for the seeds that are still short, so a seed looks at no more than twice the positions that it needs.
    """
    files = seeds.select("source_file").distinct()
    ends = points.join(files, "source_file", "left_semi").groupBy("source_file").agg(F.min(position).alias("_low"), F.max(position).alias("_high"))
    short = cut_lineage(seeds.select(query_col, "source_file", position).join(ends, "source_file").withColumn("_r", F.lit(first_reach)))
    settled: DataFrame | None = None
    while True:
        held = around(short, points, F.col("_r"), [query_col], position).groupBy(query_col).agg(F.sum(tokens).alias("_held"))
        measured = cut_lineage(short.join(held, query_col, "left"))
        enough = ((F.coalesce("_held", F.lit(0)) >= budget)
                  | ((F.col(position) - F.col("_r") <= F.col("_low")) & (F.col(position) + F.col("_r") >= F.col("_high"))))
        done = measured.filter(enough)
        settled = done if settled is None else settled.unionByName(done)
        short = measured.filter(~enough).withColumn("_r", F.col("_r") * 2).drop("_held")
        if short.isEmpty():
            break
    near = around(settled, points, F.col("_r"), [query_col], position)
    order = Window.partitionBy(query_col).orderBy(F.abs("offset"), "offset").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(tokens).over(order), F.lit(0))
    return near.withColumn("_before", before).filter((F.col("offset") == 0) | (F.col("_before") < budget)).drop("_before")


def passage(expanded: DataFrame, query_col: str = "query_id", position: str = "chunk_index", tokens: str = "token_count") -> DataFrame:
    """The expanded chunks of every seed as one text in reading order."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col("text").alias("t"))))
    return expanded.groupBy(query_col).agg(
        F.array_join(F.transform(parts, lambda x: x["t"]), "\n\n").alias("text"),
        F.min(position).alias("first_chunk"), F.max(position).alias("last_chunk"),
        F.count("*").alias("chunks_used"), F.sum(tokens).alias("total_tokens"))


def with_group_key(hits: DataFrame, group_by: str = "section") -> DataFrame:
    hits = as_points(hits)
    title = first_present(F.col("title"), F.col("book_title"), F.col("source_file"))
    section = first_present(F.col("section"), F.col("section_title"))
    if group_by == "book":
        return hits.withColumns({"group_key": title, "group_label": title})
    grouped = section != ""
    return hits.withColumns({"group_key": F.when(grouped, F.concat_ws("::", title, section)).otherwise(title),
                             "group_label": F.when(grouped, section).otherwise(title)})


def group_hits(hits: DataFrame, group_by: str = "section", query_col: str = "query_id", id_col: str = "id") -> DataFrame:
    """Hits with their group: best, average, count, rank of the group and place inside it."""
    keyed = with_group_key(hits, group_by)
    group = Window.partitionBy(query_col, "group_key")
    inside = group.orderBy(F.desc("score"), F.asc(id_col))
    scored = keyed.withColumns({
        "best_score": F.max("score").over(group), "avg_score": F.avg("score").over(group),
        "chunk_count": F.count("*").over(group), "place": F.row_number().over(inside)})
    order = Window.partitionBy(query_col).orderBy(F.desc("best_score"), F.asc("group_key"))
    return scored.withColumn("group_rank", F.dense_rank().over(order))


def group_summary(hits: DataFrame, group_by: str = "section", query_col: str = "query_id") -> DataFrame:
    keyed = with_group_key(hits, group_by)
    return keyed.groupBy(query_col, "group_key", "group_label").agg(
        F.max("score").alias("best_score"), F.avg("score").alias("avg_score"), F.count("*").alias("chunk_count"))


def bibliography(hits: DataFrame, query_col: str = "query_id") -> DataFrame:
    """Deduplicated sources of every query's hits, numbered in first-seen order.

    Hits of one (title, source_file) are read in rank order; a later one replaces the kept one when
    it brings an arXiv id, authors or a year the kept one lacks. The fold runs over the few hits
    of one source within one query.
    """
    hits = as_points(hits)
    title = first_present(F.col("title"), F.col("book_title"))
    entry = F.struct("rn", F.coalesce(F.col("arxiv_id"), F.lit("")).alias("arxiv_id"), "authors", "year",
                     F.coalesce(F.col("publisher"), F.lit("")).alias("publisher"))
    lists = (hits.groupBy(query_col, title.alias("title"), "source_file")
             .agg(F.array_sort(F.collect_list(entry)).alias("seen"), F.min("rn").alias("first_rn")))
    known = lambda e: {"arxiv": e["arxiv_id"] != "", "authors": F.coalesce(F.size(e["authors"]), F.lit(0)) > 0,
                       "year": F.coalesce(e["year"], F.lit(0)) != 0}

    def richer(kept: Column, new: Column) -> Column:
        a, b = known(kept), known(new)
        upgrade = reduce(lambda x, y: x | y, [b[n] & ~a[n] for n in a])
        return F.when(upgrade, new).otherwise(kept)

    best = F.aggregate(F.slice("seen", F.lit(2), F.size("seen")), F.col("seen")[0], richer)
    order = Window.partitionBy(query_col).orderBy("first_rn")
    return (lists.withColumn("best", best).withColumn("source_id", F.row_number().over(order))
            .select(query_col, "source_id", "title", "source_file", F.col("best.arxiv_id").alias("arxiv_id"),
                    F.coalesce(F.array_join("best.authors", ", "), F.lit("")).alias("authors"),
                    F.when(F.col("best.year") != 0, F.col("best.year")).alias("year"),
                    F.col("best.publisher").alias("publisher")))


def format_source() -> Column:
    """``[1] Authors Title arXiv:id, year.``"""
    part = lambda name, value: F.when(F.col(name) != "", value)
    origin = F.when(F.col("arxiv_id") != "", F.concat(F.lit("arXiv:"), "arxiv_id", F.lit(","))).otherwise(
        part("publisher", F.concat("publisher", F.lit(","))))
    body = F.concat_ws(" ", part("authors", F.col("authors")), F.col("title"), origin, F.col("year").cast("string"))
    return F.concat(F.lit("["), F.col("source_id").cast("string"), F.lit("] "), body, F.lit("."))


def prompt_context(hits: DataFrame, group_by: str = "section", query_col: str = "query_id", id_col: str = "id") -> DataFrame:
    """One prompt text per query: grouped passages with citation tags, then the bibliography."""
    hits = as_points(hits)
    sources = bibliography(hits, query_col)
    # One tag per file; the last source of a file names it.
    tags = sources.groupBy(query_col, "source_file").agg(F.max("source_id").alias("tag"))
    rows = group_hits(hits, group_by, query_col, id_col).join(tags, [query_col, "source_file"], "left")
    labels = {"type": "doc_type", "publisher": "publisher", "lang": "language", "isbn": "isbn", "arxiv": "arxiv_id", "cat": "category"}
    meta = F.concat_ws(" ", *[F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(n + ":"), c)) for n, c in labels.items()])
    line = F.concat(F.format_string("[score:%.4f] ", "score"), "text",
                    F.when(meta != "", F.concat(F.lit(" ["), meta, F.lit("]"))).otherwise(""),
                    F.when(F.col("tag").isNotNull(), F.concat(F.lit(" [Source: "), F.col("tag").cast("string"), F.lit("]"))).otherwise(""))
    heading = F.concat(F.lit("\n=== "), "group_label", F.lit(" ("), first_present(F.col("title"), F.col("book_title")), F.lit(") ==="))
    grouped = rows.groupBy(query_col, "group_rank").agg(
        F.max_by(heading, -F.col("place")).alias("heading"),
        F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("lines"))
    block = F.concat_ws("\n", "heading", F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), F.lit(""))
    texts = grouped.groupBy(query_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("group_rank", block.alias("b")))), lambda x: x["b"]), "\n").alias("passages"))
    listed = sources.groupBy(query_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("source_id", format_source().alias("s")))), lambda x: x["s"]), "\n").alias("listing"))
    return texts.join(listed, query_col, "left").select(query_col, F.concat_ws(
        "\n", "passages", F.lit("\n**Sources:**"), "listing").alias("prompt_context"))


def passages_block(hits: DataFrame, query_col: str = "query_id", place: str = "rn") -> DataFrame:
    """``[Passage n] file — section`` blocks in rank order."""
    hits = as_points(hits)
    block = F.concat(F.lit("[Passage "), F.col(place).cast("string"), F.lit("] "), F.coalesce("source_file", F.lit("")), F.lit(" — "),
                     first_present(F.col("section_title"), F.col("section")), F.lit("\n"), "text")
    return hits.groupBy(query_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct(F.col(place).alias("p"), block.alias("b")))), lambda x: x["b"]), "\n\n").alias("passages"))


def exact_section(points: DataFrame, source_file: str, section_title: str, limit: int | None = None) -> DataFrame:
    """Chunks of one titled section of one file in reading order; the first ``limit`` of them where one is given."""
    found = (as_points(points).filter((F.col("source_file") == source_file) & (F.col("section_title") == section_title))
             .orderBy("section_index", "chunk_index"))
    return found if limit is None else found.limit(limit)
