"""Sharding by jump consistent hashing: no ring table, and appended shards take rows only into themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridloom.llm.common import digest, free_name, running_slots, sql_digest, table

# Fixed values of the published algorithm: multiplier of its 64-bit generator, word size, and the range of a draw.
MULTIPLIER, MODULUS, DRAW, SHIFT = "2862933555777941757", "18446744073709551616", 2147483648.0, "8589934592"
SHARDS = 8


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 .. shards-1 of a non-negative 63-bit key.

    Each step draws the next shard count at which the key would move; the last one below ``shards`` is its place.
    The number of jumps is about ln(shards) + 1; 128 steps are provided for, whose chance of being too few is below 1e-40.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    wide = lambda value: F.lit(value).cast("decimal(20,0)")

    def step(state: Column, _: Column) -> Column:
        seed = ((state["seed"] * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1)) % wide(MODULUS)).cast("decimal(20,0)")
        after = F.struct(seed.alias("seed"), state["next"].alias("at"), F.floor(
            (state["next"] + 1) * (F.lit(DRAW) / (F.floor(seed / wide(SHIFT)).cast("double") + 1))).cast("long").alias("next"))
        return F.when(state["next"] < shards, after).otherwise(state)

    start = F.struct(key.cast("decimal(20,0)").alias("seed"), F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("next"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, 128))), start, step, lambda state: state["at"]).cast("int")


def shard_by_key(df: DataFrame, key: str = "doc_id", shards: int = SHARDS, grow: int = 1, lanes: int = 256) -> DataFrame:
    """``df`` with shard, slot and grown_shard.

    shard depends on ``key`` and ``shards`` alone; grown_shard is the place with ``grow`` more shards and differs from shard
    only where a new shard takes the row. slot counts a shard's rows from 0 without gaps, in a pseudorandom order of the rows,
    so reading a shard by slot reads it shuffled. Null keys share one shard; repeated rows keep their own slots (equal rows
    in any order); an empty table gives an empty one. Columns named shard, slot or grown_shard are replaced.
    A key with a third of all rows fills its shard, as the law demands, but its slots are numbered in ``lanes`` parts
    (copies that agree in every column share a part).
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot", "grown_shard")]
    place = free_name(df, "place")
    placed = df.select(*kept).withColumn(place, digest(F.col(key)))
    placed = placed.withColumns({"shard": jump_shard(F.col(place), shards), "grown_shard": jump_shard(F.col(place), shards + grow)})
    plain = [c for c, kind in df.select(*kept).dtypes if not kind.startswith(("map", "variant"))]
    rows = running_slots(placed, ["shard"], digest(*[F.to_json(F.struct(c)) if kind.startswith(("array", "struct")) else F.col(c)
                                                     for c, kind in df.select(*plain).dtypes]), [F.col(c) for c in plain], "slot", lanes)
    return rows.select(*kept, "shard", "slot", "grown_shard")


def op1_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards under the key law."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                                                    F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"))
    return shard_by_key(docs).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _sql_jump(shards: int, name: str) -> str:
    return f"""{name} AS (SELECT doc_id, place::HUGEINT AS seed, -1::BIGINT AS here, 0::BIGINT AS next FROM keys
      UNION ALL SELECT doc_id, ns, next, floor((next + 1) * ({DRAW}::DOUBLE / ((ns // {SHIFT})::DOUBLE + 1)))::BIGINT
      FROM (SELECT doc_id, next, (seed * {MULTIPLIER}::HUGEINT + 1) % {MODULUS}::HUGEINT AS ns FROM {name} WHERE next < {shards}))"""


JUMP_SHARDS_SQL = f"""WITH RECURSIVE crc_table AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(
    list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b))),
  docs AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda h: ('0x' || h)::BIGINT)), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)))::BIGINT AS text_crc32
    FROM documents, crc_table),
  keys AS (SELECT DISTINCT doc_id, {sql_digest('doc_id')} AS place FROM documents),
  {_sql_jump(SHARDS, 'jumps')}, {_sql_jump(SHARDS + 1, 'grown')},
  shards AS (SELECT doc_id, max(here) AS shard FROM jumps GROUP BY 1), more AS (SELECT doc_id, max(here) AS grown_shard FROM grown GROUP BY 1)
  SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard, row_number() OVER (PARTITION BY shard ORDER BY
    {sql_digest('doc_id', 'size', 'text_crc32')}, doc_id, size, text_crc32) - 1 AS slot, grown_shard::INT AS grown_shard
  FROM docs JOIN shards USING (doc_id) JOIN more USING (doc_id)"""
