"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, rare shingles for windows further off, exact verification."""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridloom.llm.common import broadcast_if_small, let, table, written

SHINGLE, SIMILARITY = 5, 0.75
# 64 bits in five blocks: at a distance of at most 14 one block differs in at most two bits.
BLOCKS, FLIPS = (13, 13, 13, 13, 12), 2
RADIUS = len(BLOCKS) * (FLIPS + 1) - 1
# The number under which shingles stand beside the blocks.
RARE = len(BLOCKS)


def bench_words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased, so that case, punctuation and white space don't tell texts apart. Null: none."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.array().cast("array<string>"))


def _shingled(words: Column, made: Callable[[Column], Column]) -> Column:
    return let(words, lambda w: F.when(F.size(w) >= SHINGLE, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - SHINGLE + 1, F.lit(1))), lambda i: made(F.slice(w, i, SHINGLE)))))


def counted_shingles(words: Column) -> Column:
    """The multiset of five-word shingles as a set: the k-th repetition of a shingle carries its number."""
    tagged = lambda plain: F.transform(plain, lambda x, i: F.concat(
        x, F.lit(" "), F.size(F.filter(F.slice(plain, 1, i + 1), lambda y: y == x)).cast("string")))
    return let(_shingled(words, lambda w: F.array_join(w, " ")), lambda plain: F.when(
        F.size(F.array_distinct(plain)) == F.size(plain), F.transform(plain, lambda x: F.concat(x, F.lit(" 1")))).otherwise(tagged(plain)))


def simhash(words: Column) -> Column:
    """64-bit SimHash: every word votes on every bit, as often as it occurs."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")

    def counted(votes: Column) -> Column:
        def bit(fingerprint: Column, b: Column) -> Column:
            ones = F.aggregate(votes, zero, lambda n, v: n + F.call_function("shiftrightunsigned", v, b).bitwiseAND(one))
            return fingerprint.bitwiseOR(F.when(ones * 2 > F.size(votes), F.call_function("shiftleft", one, b)).otherwise(zero))
        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), zero, bit)

    return let(F.transform(words, lambda w: F.xxhash64(w)), counted)


def _block(fingerprint: Column, k: int) -> Column:
    return F.shiftrightunsigned(fingerprint, sum(BLOCKS[:k])).bitwiseAND(F.lit((1 << BLOCKS[k]) - 1).cast("long"))


def _flips(width: int) -> Column:
    masks = sorted(sum(1 << b for b in bits) for n in range(FLIPS + 1) for bits in combinations(range(width), n))
    return F.array(*[F.lit(m).cast("long") for m in masks])


def hamming_index(items: DataFrame) -> DataFrame:
    """(n_words, block, value, item_id, fingerprint): every value a block can have within FLIPS bits of an item's."""
    def values(k: int) -> Column:
        return F.transform(_flips(BLOCKS[k]), lambda m: F.struct(F.lit(k).alias("block"), _block(F.col("fingerprint"), k).bitwiseXOR(m).alias("value")))

    rows = [values(k) for k in range(len(BLOCKS))]
    return items.select("n_words", "item_id", F.col("fingerprint").alias("item_print"), F.explode(F.concat(*rows)).alias("e")).select("n_words", "item_id", "item_print", "e.block", "e.value")


def _marks(shingles: Column) -> Column:
    return F.transform(shingles, lambda x: F.xxhash64(x))


def rare_shingles(items: DataFrame, similarity: float) -> DataFrame:
    """(item_id, n_words, fingerprint, shingles, rare): with hashes of so many counted shingles of an item, those that the fewest items
    of its size have, that every window of ``similarity`` or more has one of them.

    Such a window has at least s n of an item's n shingles, so it can't miss n - ceil(s n) + 1 of them.
    """
    marked = items.select("item_id", "n_words", "fingerprint", "shingles", F.explode(_marks(F.col("shingles"))).alias("mark"))
    counts = marked.groupBy("n_words", "mark").agg(F.count(F.lit(1)).alias("c"))
    ranked = marked.join(counts, ["n_words", "mark"]).groupBy("item_id", "n_words", "fingerprint", "shingles").agg(F.sort_array(F.collect_set(F.struct("c", "mark"))).alias("by"))
    n = F.size("shingles")
    rare = F.transform(F.slice("by", F.lit(1), n - F.ceil(n * similarity - 1e-9).cast("int") + 1), lambda r: r["mark"])
    return ranked.select("item_id", "n_words", "fingerprint", "shingles", rare.alias("rare"))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_key, item_id, similarity, first_word, n_words): the best window of a document for every benchmark item it holds.

    A window has as many words as the item and starts anywhere (the last ones are cut by the end of the text). Its similarity
    is the sum of the smaller over the sum of the larger counts of five-word shingles; ``similarity`` or more is a hit, the most
    similar window and then the first is reported. A window of m shingles that is so similar to an item of n shares at least
    s (n + m) / (1 + s) shingles with items of its size, so windows below that are not fingerprinted. The others are looked up by SimHash:
    fingerprints within RADIUS bits of an item's agree with it, up to FLIPS bits, in one of the blocks, and all values a block can
    so have are in the index. Windows may be that similar and further off; these meet the item at one of its rare shingles.
    Candidates are verified on their whole shingle multisets.

    Null texts, empty texts and items under five words have no shingles and match nothing. Rows that agree in doc_id and text
    are reported once; text_key is a hash of the text. Items with equal texts are all reported. Only ids and word positions are shuffled.
    """
    share = 2 * similarity / (1 + similarity)
    items = written(benchmark.select("item_id", bench_words(F.col("text")).alias("words")).where(F.size("words") >= SHINGLE).withColumns({
        "n_words": F.size("words"), "fingerprint": simhash(F.col("words")), "shingles": counted_shingles(F.col("words"))}), "bench-items")
    hashed = lambda words: _shingled(words, lambda w: F.xxhash64(w))
    known = items.select("n_words", F.explode(hashed(F.col("words"))).alias("shingle")).distinct()
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    whole = keyed.withColumn("all", hashed(bench_words(F.col("text")))).withColumn("total", F.size("all"))
    shingles = whole.select("doc_id", "text_key", "total", F.posexplode("all").alias("pos", "shingle"))
    # A word position is kept with each item size it can count for; positions of a document meet in one row, which its text bounds.
    hits = shingles.join(broadcast_if_small(known, 32), "shingle").groupBy("doc_id", "text_key", "n_words").agg(F.sort_array(F.collect_set("pos")).alias("at"), F.max("total").alias("total"))
    n, need = F.col("n_words") - (SHINGLE - 1), F.ceil((F.col("n_words") - (SHINGLE - 1)) * share - 1e-9).cast("int")
    # From hit j on, need hits end at hit j + need - 1; get() is null past the last one.
    runs = F.filter(F.transform("at", lambda p, j: F.struct((F.get(F.col("at"), j + need - 1) - n + 1).alias("lo"), p.alias("hi"))),
                    lambda r: r["lo"].isNotNull() & (r["lo"] <= r["hi"]))
    full = F.flatten(F.transform(runs, lambda r: F.sequence(F.greatest(r["lo"], F.lit(0)), r["hi"])))
    # Windows that the end of the text cuts have total - start shingles, at least ``least``; where the end holds fewer hits than that, none is tried.
    least, before = F.ceil(n * similarity - 1e-9).cast("int"), F.greatest(F.col("total") - n + 1, F.lit(0))
    ends = F.when(F.get(F.col("at"), F.size("at") - least) >= before, F.filter(F.sequence(before, F.col("total") - least), lambda s: F.size(
        F.filter("at", lambda p: p >= s)) >= F.ceil((n + F.col("total") - s) * (share / 2) - 1e-9)))
    starts = F.array_distinct(F.concat(full, F.coalesce(ends, F.array().cast("array<int>"))))
    places = F.flatten(F.collect_list(F.transform(starts, lambda s: F.struct(F.col("n_words"), s.alias("first_word")))))
    windows = written(hits.groupBy("doc_id", "text_key").agg(places.alias("places")).where(F.size("places") > 0), "bench-windows")
    near = windows.withColumnRenamed("doc_id", "__doc")
    found = keyed.join(broadcast_if_small(near, 1024), keyed["doc_id"].eqNullSafe(near["__doc"]) & (keyed["text_key"] == near["text_key"])).select(
        "doc_id", keyed["text_key"], bench_words(F.col("text")).alias("words"), "places").dropDuplicates(["doc_id", "text_key"])
    cut = found.select("doc_id", "text_key", F.explode(F.transform("places", lambda p: F.struct(
        p["n_words"].alias("n_words"), p["first_word"].alias("first_word"), F.slice("words", p["first_word"] + 1, p["n_words"]).alias("window")))).alias("w"))
    marked = cut.select("doc_id", "text_key", "w.*").withColumn("print", simhash(F.col("window")))
    blocks = F.array(*[F.struct(F.lit(k).alias("block"), _block(F.col("print"), k).alias("value")) for k in range(len(BLOCKS))])
    probes = marked.withColumn("marks", _marks(counted_shingles(F.col("window")))).withColumn("probe", F.explode(F.concat(
        blocks, F.transform("marks", lambda m: F.struct(F.lit(RARE).alias("block"), m.alias("value"))))))
    rare = written(rare_shingles(items, similarity), "bench-rare")
    index = hamming_index(items).unionByName(rare.select("n_words", "item_id", F.col("fingerprint").alias("item_print"), F.lit(RARE).alias("block"), F.explode("rare").alias("value")))
    joined = probes.select("*", "probe.*").join(broadcast_if_small(index, 64), ["n_words", "block", "value"])
    apart = F.col("print").bitwiseXOR(F.col("item_print"))
    first = F.coalesce(*[F.when(F.bit_count(_block(apart, k)) <= FLIPS, F.lit(k)) for k in range(len(BLOCKS))])
    near = F.bit_count(apart) <= RADIUS
    pairs = joined.where(F.when(near, F.col("block") == first).otherwise(F.col("block") == RARE))
    paired = pairs.join(broadcast_if_small(rare.select("item_id", "shingles", "rare"), 8192), "item_id")
    once = (F.col("block") < RARE) | (F.get(F.array_intersect("marks", "rare"), F.lit(0)) == F.col("value"))  # a pair may share several rare shingles
    verified = paired.where(once).withColumn("mine", counted_shingles(F.col("window")))
    both = F.size(F.array_intersect("mine", "shingles"))
    scored = verified.withColumn("similarity", let(both, lambda b: b / (F.size("mine") + F.size("shingles") - b)))
    best = scored.groupBy("doc_id", "text_key", "item_id").agg(F.max(F.struct("similarity", -F.col("first_word"), "n_words")).alias("b")).where(F.col("b.similarity") >= similarity)
    return best.select("doc_id", "text_key", "item_id", "b.similarity", (-F.col("b.col2")).cast("int").alias("first_word"), "b.n_words")


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item. All other rows and all columns stay."""
    hits = written(contaminated(docs, benchmark, similarity).select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key")).distinct(), "bench-hits")
    hits = broadcast_if_small(hits, 32)
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["__doc"]) & (F.xxhash64(docs["text"]) == hits["__key"]), "left_anti")


def op2_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in any document."""
    hits = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "first_word", "n_words")


_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
_SHARE = 2 * SIMILARITY / (1 + SIMILARITY)

BENCHMARK_HITS_SQL = f"""WITH items AS (SELECT item_id, w, len(w) AS n_words, len(w) - {SHINGLE - 1} AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) >= {SHINGLE}),
  docs AS (SELECT DISTINCT doc_id, text, {_WORDS} AS w FROM documents),
  item_rows AS (SELECT item_id, n, n_words, array_to_string(w[k + 1:k + {SHINGLE}], ' ') AS sh FROM (SELECT *, unnest(range(n)) AS k FROM items)),
  doc_rows AS (SELECT doc_id, text, k, len(w) - {SHINGLE - 1} AS total, array_to_string(w[k + 1:k + {SHINGLE}], ' ') AS sh FROM (SELECT *, unnest(range(len(w) - {SHINGLE - 1})) AS k FROM docs)),
  item_counts AS (SELECT item_id, n, n_words, sh, count(*) AS c FROM item_rows GROUP BY ALL),
  hits AS (SELECT DISTINCT doc_id, text, item_id, n, n_words, k, total FROM doc_rows JOIN item_counts USING (sh)),
  starts AS (SELECT DISTINCT doc_id, text, item_id, n, n_words, total, unnest(range(greatest(k - n + ceil(n * {_SHARE} - 1e-9)::BIGINT, 0), k + 1)) AS s FROM hits),
  dense AS (SELECT s.* FROM starts s JOIN hits h ON s.doc_id = h.doc_id AND s.text = h.text AND s.item_id = h.item_id AND h.k BETWEEN s.s AND s.s + s.n - 1
    GROUP BY ALL HAVING count(*) >= ceil((s.n + least(s.n, s.total - s.s)) * {_SHARE / 2} - 1e-9)),
  window_counts AS (SELECT d.doc_id, d.text, d.item_id, d.n, d.n_words, d.s, r.sh, count(*) AS c FROM dense d JOIN doc_rows r ON d.doc_id = r.doc_id AND d.text = r.text
    AND r.k BETWEEN d.s AND d.s + d.n - 1 GROUP BY ALL),
  sums AS (SELECT w.doc_id, w.text, w.item_id, w.n, w.n_words, s, sum(least(w.c, coalesce(i.c, 0))) AS shared, sum(w.c) AS mine
    FROM window_counts w LEFT JOIN item_counts i ON i.item_id = w.item_id AND i.sh = w.sh GROUP BY ALL),
  scored AS (SELECT *, shared / (mine + n - shared) AS similarity FROM sums),
  best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text, item_id ORDER BY similarity DESC, s) AS r FROM scored WHERE similarity >= {SIMILARITY})
  SELECT doc_id, item_id, round(similarity, 6) AS similarity, s::INT AS first_word, n_words::INT AS n_words FROM best WHERE r = 1"""
