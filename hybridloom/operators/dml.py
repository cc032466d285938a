"""Changes to point tables as plans: idempotent append, upsert, patch, retention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hybridloom.session import BROADCAST_BYTE_LIMIT, BROADCAST_ROW_LIMIT, checked_broadcast, cut_lineage, fits

# Bits of a key filter for each key, bits of one of its pages, and bits that a key sets in its page.
BITS_PER_KEY, PAGE_BITS, KEY_BITS = 12, 32768, 4


def point_id(*parts: Column) -> Column:
    """Content-derived 128-bit id: the same chunk gets the same id on every run."""
    return F.md5(F.concat_ws("\u0001", *[p.cast("string") for p in parts]))


def new_rows(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet, each key once."""
    return incoming.dropDuplicates(keys).join(existing.select(*keys).distinct(), keys, "left_anti")


def _page(key: Column, pages: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key.cast("string")), F.lit(pages))


def _places(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), key.cast("string")), F.lit(PAGE_BITS)).cast("int") for seed in range(1, KEY_BITS + 1)]


def _key_filter(listed: DataFrame, key: str, pages: int) -> DataFrame:
    """(page, bits): a Bloom filter of keys in pages of 4 KB, each made by one task, so no task holds more than its pages."""
    placed = listed.where(F.col(key).isNotNull()).select(_page(F.col(key), pages).alias("page"), F.col(key)).repartition("page")
    return placed.select("page", F.explode(F.array(*_places(F.col(key)))).alias("at")).groupBy("page").agg(F.bitmap_construct_agg("at").alias("bits"))


def _may_be_listed(key: Column, pages: int) -> Column:
    byte = lambda at: F.conv(F.hex(F.substring(F.col("bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (_page(key, pages) == F.col("page")) & reduce(lambda a, b: a & b, [F.getbit(byte(at), at % 8) == 1 for at in _places(key)])


def _listed_filter(listed: DataFrame, key: str) -> tuple[DataFrame, Column] | None:
    """A filter of keys to broadcast, with the condition that it leaves room for a row; None beyond what a broadcast may hold."""
    pages = -(-listed.count() * BITS_PER_KEY // PAGE_BITS)
    if pages * PAGE_BITS // 8 > BROADCAST_BYTE_LIMIT:
        return None
    return F.broadcast(cut_lineage(_key_filter(listed, key, pages))), _may_be_listed(F.col(key), pages)


def within(rows: DataFrame, listed: DataFrame, key: str, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Rows whose key is among the listed ones. Few keys are broadcast; of more, a Bloom filter is, and only rows that pass it are shuffled."""
    listed = listed.select(key)
    if fits(listed, limit):
        return rows.join(F.broadcast(listed), key, "left_semi")
    made = _listed_filter(listed, key)
    return (rows.join(*made, "left_semi") if made else rows).join(listed, key, "left_semi")


def without(rows: DataFrame, listed: DataFrame, key: str, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Rows whose key is not among the listed ones. Wide rows stay where they are.

    Few keys are broadcast; of more, a Bloom filter is, and keys that pass it without being listed are found by a join of keys alone. Beyond what a
    broadcast may hold, rows are shuffled. ``rows`` is read more than once, so a costly one should be written before.
    """
    listed = listed.select(key)
    if fits(listed, limit):
        return rows.join(F.broadcast(listed), key, "left_anti")
    made = _listed_filter(listed, key)
    if made is None:
        return rows.join(listed, key, "left_anti")
    wrongly_hit = cut_lineage(rows.select(key).join(*made, "left_semi").join(listed, key, "left_anti").distinct())
    return rows.join(*made, "left_anti").unionByName(rows.join(checked_broadcast(wrongly_hit), key, "left_semi").select(*rows.columns))


def latest_wins(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row with the highest version of every key, of equal versions the greatest row in column order. Combined on the map
    side, so copies of one key do not pile up."""
    others = [c for c in rows.columns if c not in keys]
    ties = [c for c, kind in rows.dtypes if c in others and c != version and not kind.startswith(("map", "variant"))]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(version, *ties)).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in others])


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows without the incoming keys, plus the incoming rows."""
    return existing.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(incoming, allowMissingColumns=True)


def patch_blanks(target: DataFrame, patch: DataFrame, keys: list[str], fields: list[str], placeholder: dict[str, Column] | None = None) -> DataFrame:
    """Fill blank (or placeholder) fields from a metadata table; ``changed`` tells which rows differ."""
    side = patch.select(*keys, *[F.col(f).alias(f"_new_{f}") for f in fields])
    joined = target.join(checked_broadcast(side), keys, "left")
    changed, out = F.lit(False), {}
    for f in fields:
        new = F.col(f"_new_{f}")
        current = F.coalesce(F.col(f), F.lit(""))
        blank = (current == placeholder[f]) if placeholder and f in placeholder else (current == "")
        fill = blank & (F.coalesce(new, F.lit("")) != "")
        out[f], changed = F.when(fill, new).otherwise(F.col(f)), changed | fill
    return joined.withColumns({**out, "changed": changed}).drop(*[f"_new_{f}" for f in fields])


def patch_report(patched: DataFrame) -> DataFrame:
    """Dry run: how many rows a patch would change."""
    return patched.agg(F.count("*").alias("rows"), F.count_if("changed").alias("changed"))


def missing_vectors(points: DataFrame, vectors: DataFrame, id_col: str = "id") -> DataFrame:
    """Points that have no vector yet."""
    return points.join(vectors.select(id_col).distinct(), id_col, "left_anti")


def replace_component(stored: DataFrame, fresh: DataFrame, id_col: str = "id") -> DataFrame:
    """Partial update of one vector component: rows of the given ids are replaced, others stay."""
    return without(stored, fresh, id_col).unionByName(fresh, allowMissingColumns=True)


def keep_newest(rows: DataFrame, order: str, keep: int = 2) -> DataFrame:
    """The newest ``keep`` rows (checkpoint pruning keeps what this returns)."""
    return rows.orderBy(F.desc(order)).limit(keep)


def strided(rows: DataFrame, position: str, rank: int, world: int) -> DataFrame:
    """Rows rank, rank + world, rank + 2 world … of a positioned table."""
    return rows.filter(F.pmod(F.col(position), F.lit(world)) == rank)


def ingest_counters(papers: DataFrame, keys: list[str]) -> DataFrame:
    """Papers, chunks and tokens of an ingest in one pass."""
    return papers.agg(F.count_distinct(*keys).alias("papers"), F.count("*").alias("chunks"), F.sum("token_count").alias("tokens"),
                      F.count_if(F.col("token_count") < 50).alias("small_chunks"))


def exclude_keys(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored at all; several rows of one new key stay."""
    return rows.join(stored.select(*keys).distinct(), keys, "left_anti")
