"""Layout of payload batches and a sketch of each file, so that a filtered search opens only files that may hold what it asks for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hybridloom.schema import KEYWORD_FIELDS

#: Bits of a file's filter for one field, and hashes of a value.
BLOOM_BITS, BLOOM_HASHES = 32768, 2


def _spread(x: Column) -> Column:
    """The 16 low bits of a number with a gap before each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = (x.bitwiseOR(F.shiftleft(x, shift))).bitwiseAND(F.lit(mask).cast("long"))
    return x


def place(source_file: Column, key: Column) -> Column:
    """Place of a row on a space-filling curve over file and id: rows of a file lie in few ranges, and so do ids that hash alike."""
    low = lambda c: F.xxhash64(c).bitwiseAND(F.lit(0xFFFF).cast("long"))
    return F.shiftleft(_spread(low(source_file)), 1).bitwiseOR(_spread(low(key)))


def clustered(rows: DataFrame, files: int | None = None) -> DataFrame:
    """Rows in ranges of the curve; without ``files`` the ranges are merged to the advised partition size."""
    at = [place(F.col("source_file"), F.col("id").cast("string")), F.col("source_file"), F.col("id")] if "source_file" in rows.columns else [F.col("id")]
    return (rows.repartitionByRange(files, *at) if files else rows.repartitionByRange(*at)).sortWithinPartitions(*at)


def _bits(value: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(value, F.lit(seed)), F.lit(BLOOM_BITS)) for seed in range(BLOOM_HASHES)]


def file_sketches(rows: DataFrame) -> DataFrame:
    """(file, field, low, high, bits) of a written batch: the range of each keyword field and of id in each file, and a Bloom filter of its values.

    Ranges and filters are combined on the map side, so what is shuffled is a row for each file, field and task.
    """
    fields = [f for f in ("id", *KEYWORD_FIELDS) if f in rows.columns]
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    held = rows.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), pairs.alias("p")).select("file", "p.field", "p.value").where("value IS NOT NULL")
    bits = held.select("file", "field", "value", F.explode(F.array(*_bits(F.col("value")))).alias("bit"))
    return bits.groupBy("file", "field").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.bitmap_construct_agg("bit").alias("bits"))


def _has_bit(bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), bit % 8)), F.lit(2)) == 1


def _may_hold(field: str, value) -> Column:
    """Whether a sketch row of ``field`` leaves room for a condition of :func:`hybridloom.schema.equality_filter`."""
    if isinstance(value, dict):
        tests = {"gt": lambda v: F.col("high") > v, "gte": lambda v: F.col("high") >= v, "lt": lambda v: F.col("low") < v, "lte": lambda v: F.col("low") <= v}
        return reduce(lambda a, b: a & b, [tests[b](F.lit(str(v))) for b, v in value.items()], F.lit(True))
    wanted = list(value) if isinstance(value, (list, tuple, set)) else [value]
    known = [str(v) for v in wanted if v is not None]
    options = [(F.col("low") <= v) & (F.col("high") >= v) & reduce(lambda a, b: a & b, map(_has_bit, _bits(F.lit(v)))) for v in known]
    return reduce(lambda a, b: a | b, options, F.lit(False))


def matching_files(sketches: DataFrame, filter_by: dict) -> list[str] | None:
    """Files that may hold a row of every condition on a keyword field or id; None if there is no such condition. The list is as long as what is then opened."""
    asked = {f: v for f, v in filter_by.items() if f in ("id", *KEYWORD_FIELDS)}
    if not asked:
        return None
    fits = reduce(lambda a, b: a | b, [(F.col("field") == f) & _may_hold(f, v) for f, v in asked.items()])
    return [r["file"] for r in sketches.where(fits).groupBy("file").agg(F.count_distinct("field").alias("n")).where(F.col("n") == len(asked)).select("file").collect()]
