"""Mixing sources to target weights: multinomial block counts per output shard, drawn through index permutations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hybridloom.llm.common import WORD, broadcast_if_small, digest, free_name, let, running, sql_digest, table, word_count, written

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
BLOCK, SHARD_SLOTS, ROUNDS, SEED = 64, 1024, 24, 7
PRIME = 2147483647
UNIT = float(1 << 60)


@dataclass(frozen=True)
class Mixture:
    """sources: sid, source, source_size, target, n_blocks. rows: the input's rows with sid, row, offset and size. slots: shard,
    slot, sid, epoch, block. Blocks are ``block`` consecutive words of a source's rows in the order of offset."""

    sources: DataFrame
    rows: DataFrame
    slots: DataFrame
    block: int

    def pieces(self) -> DataFrame:
        """The parts of rows that blocks hold: sid, row, size, block, first word of the part inside the row, words."""
        first, last = F.expr(f"offset div {self.block}"), F.expr(f"(offset + size - 1) div {self.block}")
        cut = self.rows.where("size > 0").select("sid", "row", "offset", "size", F.explode(F.sequence(first, last)).alias("block"))
        begin, end = F.greatest(F.col("block") * self.block, F.col("offset")), F.least((F.col("block") + 1) * self.block, F.col("offset") + F.col("size"))
        return cut.select("sid", "row", "size", "block", (begin - F.col("offset")).alias("first"), (end - begin).alias("words"))

    def taken(self) -> DataFrame:
        """sid, row and the words the mix takes of it; rows without any are absent."""
        drawn = self.slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
        return self.pieces().join(drawn, ["sid", "block"]).groupBy("sid", "row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Source sizes and target words: sid, source, source_size, target.

    Sources in code point order, null last, weigh ``weights`` in turn. The level L with sum(min(most * size, L * weight)) =
    share * total solves the capping and resharing in one go: sources are looked at in the order in which L reaches their
    cap, and the first that keeps below it tells L. One row per source is sorted, never the rows.
    """
    one = Window.partitionBy(F.lit(0))
    sized = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sized.withColumn("sid", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    caps = ranked.withColumns({"weight": weight, "cap": F.col("source_size") * most, "reach": (F.col("source_size") * most).cast("double") / weight})
    by_reach = one.orderBy("reach", "sid")
    earlier = by_reach.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(one) * share - F.coalesce(F.sum("cap").over(earlier), F.lit(0))) / (
        F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
    levels = caps.withColumns({"level": level, "place": F.row_number().over(by_reach)})
    found = levels.withColumn("level", F.min_by("level", F.when(F.col("level") <= F.col("reach"), F.col("place"))).over(one))
    return found.select("sid", "source", "source_size", F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")), F.lit(0.0)).alias("target"))


def permuted(index: Column, n: Column, keys: Column) -> Column:
    """Place of ``index`` under a pseudorandom permutation of 0 .. n-1: swap-or-not rounds, exact for every n.

    A round pairs x with (k - x) mod n and swaps the pair when a hash of its larger member is odd, which undoes itself.
    """
    def swap(x: Column, key: Column) -> Column:
        other = F.pmod(F.pmod(key["pair"], n) - x, n)
        mixed = (key["times"] * (F.greatest(x, other) % PRIME) + key["plus"]) % PRIME
        return F.when(F.shiftright(mixed, 15) % 2 == 1, other).otherwise(x)

    return F.aggregate(keys, index.cast("long"), swap)


def _round_keys(source: Column, epoch: int, seed: int, rounds: int) -> Column:
    drawn = lambda what, i: digest(F.lit(what), F.lit(seed), source, F.lit(epoch), i)
    return F.transform(F.sequence(F.lit(1), F.lit(rounds)), lambda i: F.struct(
        drawn("pair", i).alias("pair"), (drawn("times", i) % (PRIME - 1) + 1).alias("times"), (drawn("plus", i) % PRIME).alias("plus")))


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK,
        shard_slots: int = SHARD_SLOTS, seed: int = SEED, rounds: int = ROUNDS, lanes: int = 256) -> Mixture:
    """A mixture of ``rows`` (doc_id, source, size in words): ``share`` of all words, sources in proportion to ``weights``.

    The words of a source form one stream, cut into blocks of ``block`` words (the last may be shorter). Every output shard has
    ``shard_slots`` slots (the last fewer). A source's count in a shard is the whole part of its expected count plus what a
    multinomial draw with the fractional parts gives it, so counts stay within a few blocks of their expectation. The s-th
    slot of a source takes the block at place s mod n of the source's permutation number s div n; slots from most * n
    on are left out, so nothing is taken more than ``most`` times. Every draw is a hash of seed, source and number: reruns agree.

    Null sources are one source, null sizes count as 0, rows without words and repeated rows keep their places, an empty table
    gives an empty mixture. A source with a third of all rows is numbered in ``lanes`` parts and its slots are made shard by shard.
    """
    spark = rows.sparkSession
    rows = written(rows.select("doc_id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size")), "mix-rows")
    sources = source_targets(rows, weights, share, most).withColumn("n_blocks", F.ceil(F.col("source_size") / block))
    sources = written(sources.withColumn("keys", F.array(*[_round_keys(F.col("source"), e, seed, rounds) for e in range(most)])), "mix-sources")
    known = sources.select("sid", F.col("source").alias("__source"))
    tagged = rows.join(broadcast_if_small(known, 64), rows["source"].eqNullSafe(F.col("__source"))).drop("__source")
    placed = running(tagged, ["sid"], digest(F.col("doc_id"), F.col("size")), [F.col("doc_id"), F.col("size")], {"row": F.lit(1), "offset": F.col("size")}, lanes)
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    n_slots = round(share * total / block)
    full, rest = divmod(n_slots, shard_slots)

    def kind(slots: int) -> tuple[DataFrame, int]:
        """Whole parts and bounds of the fractional parts for shards of ``slots`` slots, and how many draws those leave."""
        expected = F.col("target") * slots / max(share * total, 1.0)
        cut = sources.where("target > 0").select("sid", F.floor(expected).alias("base"), (expected - F.floor(expected)).alias("part"))
        upto = cut.withColumn("upto", F.sum("part").over(Window.partitionBy(F.lit(0)).orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)))
        left = slots - (cut.agg(F.sum("base")).first()[0] or 0)
        return upto, left

    def counts(shards: DataFrame, slots: int) -> DataFrame:
        upto, left = kind(slots)
        bounds = upto.where("part > 0").agg(F.sort_array(F.collect_list(F.struct("upto", "sid")))).scalar()
        lists = upto.where("base > 0").agg(F.collect_list(F.struct("sid", F.col("base").alias("n")))).scalar()
        sure = shards.select("shard", F.explode(lists).alias("c")).select("shard", "c.sid", "c.n")
        if left <= 0:
            return sure
        drawn = shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(left - 1))).alias("r"))
        at = digest(F.lit("draw"), F.lit(seed), F.col("shard"), F.col("r")) / UNIT
        cut = drawn.withColumns({"bounds": bounds, "at": at}).withColumn("at", F.col("at") * F.element_at("bounds", -1)["upto"])
        picked = cut.select("shard", F.filter("bounds", lambda b: b["upto"] > F.col("at"))[0]["sid"].alias("sid"), F.lit(1).cast("long").alias("n"))
        return sure.unionByName(picked)

    each = counts(spark.range(full).withColumnRenamed("id", "shard"), shard_slots)
    if rest:
        each = each.unionByName(counts(spark.range(full, full + 1).withColumnRenamed("id", "shard"), rest))
    each = each.groupBy("shard", "sid").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard").orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    started = each.withColumns({"start": F.coalesce(F.sum("n").over(before), F.lit(0)), "slot": F.coalesce(F.sum("n").over(inside), F.lit(0))})
    keyed = started.join(broadcast_if_small(sources.select("sid", "n_blocks", "keys"), 4096), "sid")
    kept = keyed.withColumn("n", F.least(F.col("n"), F.col("n_blocks") * most - F.col("start"))).where("n > 0")
    # The rows are few but each stands for many slots: keep them from being put into one task.
    kept = kept.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard", "sid")
    drawn = kept.select("shard", "sid", "slot", "start", "n_blocks", "keys", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    at = F.col("start") + F.col("i")
    epoch = F.floor(at / F.col("n_blocks"))
    slots = drawn.select("shard", (F.col("slot") + F.col("i")).alias("slot"), "sid", epoch.alias("epoch"),
                         permuted(at % F.col("n_blocks"), F.col("n_blocks"), F.element_at("keys", (epoch + 1).cast("int"))).alias("block"))
    return Mixture(sources, placed, slots, block)


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents of the mixture: a row for each document and permutation that takes words of it, in the columns of ``docs``.

    The text holds the taken words in their order, joined by single spaces; it stays as it is when every word is taken. n_chars
    follows the text where there is such a column. Documents of which nothing is taken (those without words too) are absent.
    """
    kept = docs.columns
    d, s, z, k, number, size, parts_, taken = (free_name(docs, n) for n in ("d", "s", "z", "k", "number", "size", "parts", "n"))
    mixture = mix(docs.select("doc_id", "source", word_count(F.col(text)).alias("size")), **options)
    parts = mixture.pieces().join(mixture.slots.select("sid", "block", "epoch"), ["sid", "block"])
    lists = parts.groupBy("sid", "row", "size", "epoch").agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias(parts_), F.sum("words").alias(taken))
    # Rows are told apart by id, source, size and a number among those that agree in all three.
    same = Window.partitionBy("doc_id", "source", "size")
    left = lists.join(mixture.rows.withColumn(k, F.row_number().over(same.orderBy("row"))), ["sid", "row", "size"]).select(
        F.col("doc_id").alias(d), F.col("source").alias(s), F.col("size").alias(z), k, parts_, taken)
    right = docs.withColumn(size, word_count(F.col(text))).withColumn(
        number, F.row_number().over(Window.partitionBy("doc_id", "source", size).orderBy(text)))
    joined = right.join(left, F.col("doc_id").eqNullSafe(F.col(d)) & F.col("source").eqNullSafe(F.col(s))
                        & (F.col(size) == F.col(z)) & (F.col(number) == F.col(k)))
    cut = let(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), lambda words: F.array_join(F.flatten(F.transform(
        parts_, lambda p: F.slice(words, (p["first"] + 1).cast("int"), p["words"].cast("int")))), " "))
    made = joined.withColumn(text, F.when(F.col(taken) == F.col(size), F.col(text)).otherwise(cut))
    if "n_chars" in kept:
        made = made.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return made.select(*kept)


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixture = mix(docs)
    # Documents without a block in the mix join nothing; a document's pieces are few, so rows meet by (sid, row) without a hot key.
    rows = mixture.rows.join(mixture.taken(), ["sid", "row"], "left")
    about = broadcast_if_small(mixture.sources.select("sid", "source_size", "target"), 64)
    return rows.join(about, "sid").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def _sql_counts(name: str, slots: str, shards: str) -> str:
    return f"""{name}_parts AS (SELECT sid, floor(target * {slots} / {SHARE} / total)::BIGINT AS base, target * {slots} / ({SHARE} * total)
        - floor(target * {slots} / ({SHARE} * total)) AS part FROM (SELECT t.*, sum(source_size) OVER () AS total FROM targets t), plan WHERE target > 0),
  {name}_upto AS (SELECT *, sum(part) OVER (ORDER BY sid ROWS UNBOUNDED PRECEDING) AS upto FROM {name}_parts),
  {name}_shards AS (SELECT unnest({shards}) AS shard FROM plan),
  {name} AS (SELECT shard, sid, base AS n FROM {name}_shards, {name}_upto WHERE base > 0
    UNION ALL SELECT shard, (SELECT min(sid) FROM {name}_upto u WHERE part > 0 AND u.upto > d.x) AS sid, 1 AS n FROM (
      SELECT shard, {sql_digest("'draw'", str(SEED), 'shard', 'r')} / {UNIT} * (SELECT max(upto) FROM {name}_upto WHERE part > 0) AS x
      FROM {name}_shards, (SELECT unnest(range({slots} - (SELECT sum(base) FROM {name}_upto)::BIGINT)) AS r FROM plan)) d)"""


def _sql_keys(what: str, i: str) -> str:
    return sql_digest(f"'{what}'", str(SEED), "source", "epoch", i)


SOURCE_MIX_SQL = f"""WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
  ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY 1)),
  caps AS (SELECT *, [3, 1, 2][(sid % 3 + 1)::INT] AS weight, 2 * source_size AS cap, (2 * source_size)::DOUBLE / [3, 1, 2][(sid % 3 + 1)::INT] AS reach FROM ranked),
  levels AS (SELECT *, row_number() OVER (ORDER BY reach, sid) AS place,
    (sum(source_size) OVER () * {SHARE}::DOUBLE - coalesce(sum(cap) OVER (ORDER BY reach, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY reach, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM caps),
  targets AS (SELECT sid, source, source_size, least(cap::DOUBLE, (SELECT arg_min(level, place) FROM levels WHERE level <= reach) * weight) AS target,
    ceil(source_size / {BLOCK}.0)::BIGINT AS n_blocks FROM levels),
  plan AS (SELECT round({SHARE}::DOUBLE * sum(source_size) / {BLOCK})::BIGINT AS n_slots, n_slots // {SHARD_SLOTS} AS whole, n_slots % {SHARD_SLOTS} AS rest FROM targets),
  {_sql_counts('most', str(SHARD_SLOTS), 'range(whole)')}, {_sql_counts('last', 'rest', 'CASE WHEN rest > 0 THEN [whole] ELSE []::BIGINT[] END')},
  each AS (SELECT shard, sid, sum(n)::BIGINT AS n FROM (SELECT * FROM most UNION ALL SELECT * FROM last) GROUP BY 1, 2),
  starts AS (SELECT shard, sid, n, n_blocks, coalesce(sum(n) OVER (PARTITION BY sid ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM each JOIN targets USING (sid)),
  drawn AS (SELECT sid, n_blocks, unnest(range(start, start + least(n, {MOST} * n_blocks - start))) AS s FROM starts),
  round_keys AS (SELECT sid, epoch, list({{'pair': {_sql_keys('pair', 'i')} % n_blocks, 'times': {_sql_keys('times', 'i')} % {PRIME - 1} + 1,
      'plus': {_sql_keys('plus', 'i')} % {PRIME}, 'x': 0::BIGINT}} ORDER BY i) AS keys
    FROM targets, (SELECT unnest(range({MOST})) AS epoch), (SELECT unnest(range(1, {ROUNDS + 1})) AS i) WHERE n_blocks > 0 GROUP BY 1, 2),
  taken_blocks AS (SELECT sid, block, count(*) AS times FROM (SELECT sid, list_reduce(list_prepend(
      {{'pair': 0::BIGINT, 'times': 0::BIGINT, 'plus': 0::BIGINT, 'x': s % n_blocks}}, keys), lambda a, k: {{'pair': 0::BIGINT, 'times': 0::BIGINT, 'plus': 0::BIGINT,
      'x': CASE WHEN (((k.times * (greatest(a.x, (k.pair - a.x + n_blocks) % n_blocks) % {PRIME}) + k.plus) % {PRIME}) >> 15) % 2 = 1
        THEN (k.pair - a.x + n_blocks) % n_blocks ELSE a.x END}}).x AS block FROM drawn d JOIN round_keys k USING (sid) WHERE k.epoch = s // n_blocks) GROUP BY 1, 2),
  placed AS (SELECT doc_id, size, sid, row_number() OVER w AS row, coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source WINDOW w AS (PARTITION BY sid ORDER BY {sql_digest('doc_id', 'size')}, doc_id, size)),
  cut AS (SELECT *, unnest(range(off // {BLOCK}, (off + size - 1) // {BLOCK} + 1)) AS block FROM placed WHERE size > 0),
  taken AS (SELECT sid, row, sum((least((block + 1) * {BLOCK}, off + size) - greatest(block * {BLOCK}, off)) * times)::BIGINT AS taken
    FROM cut JOIN taken_blocks USING (sid, block) GROUP BY 1, 2)
  SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM placed JOIN targets USING (sid) LEFT JOIN taken USING (sid, row)"""
