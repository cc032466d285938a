"""Runs of words that repeat with a period: tiles by period octave, boundary Z-functions in each, fragments stitched by document and period."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, BooleanType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from hybridloom.llm.common import WORD, by_bytes, free_name, let, table, written

# A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
# Octave 3 holds the periods below 16, octave k those from 2^k on; boundaries are 2^k words apart, a tile owns this many of them.
FIRST_OCTAVE, TILE_BOUNDARIES, LEAST_TILE = 3, 16, 1024
# Tiles are dealt to tasks of this many bytes of words, and to this many tasks at most.
TASK_BYTES, MOST_TASKS = 4 << 20, 20_000

_RUN = StructType([StructField(n, LongType(), False) for n in ("start", "length", "period")])
_TILE = StructType([StructField("octave", IntegerType()), StructField("low", LongType()), StructField("own", IntegerType()), StructField("words", BinaryType())])
_MIX = [np.uint64(0x9E3779B97F4A7C15 + 2 * k) for k in range(64)]


def _octaves(n: int) -> int:
    """The last octave whose periods fit a text of ``n`` words three times, below FIRST_OCTAVE if runs are too long for it."""
    return FIRST_OCTAVE - 1 if n < LEAST_WORDS else max(FIRST_OCTAVE, (n // LEAST_PERIODS).bit_length() - 1)


def _tile_size(octave: int) -> int:
    return max(TILE_BOUNDARIES << octave, LEAST_TILE)


def _suspects(texts: list[list[bytes]]) -> list[list[tuple]]:
    """For each text its tiles (octave, low, own, words) in which some boundary's next 2^k words come again one period of octave k later.

    A run of period p holds its first p + 2^k words after its first boundary, so a tile that owns a run's boundary is always among them.
    Equal stretches are told by hashes of 2^k words, doubled from octave to octave; equal hashes of different words cost a tile and no more.
    """
    codes_of: dict[bytes, int] = {}
    found: list[list[tuple]] = [[] for _ in texts]
    last = np.array([_octaves(len(t)) for t in texts])
    able = np.flatnonzero(last >= FIRST_OCTAVE)
    if not len(able):
        return found
    codes, starts, at = [], [], 0
    for i in able.tolist():  # each text begins at a multiple of its largest boundary distance, at least a word after the one before
        step = 1 << int(last[i])
        start = -(-(at + 1) // step) * step
        own = np.fromiter((codes_of.setdefault(w, len(codes_of)) for w in texts[i]), np.int64, len(texts[i]))
        codes += [-np.arange(at + 1, start + 1), own]
        starts.append(start)
        at = start + len(own)
    top = int(last.max())
    codes = np.concatenate([*codes, -np.arange(at + 1, at + 1 + (4 << top))])
    starts = np.array(starts)
    ends = starts + [len(texts[i]) for i in able]
    keep = codes.astype(np.int32)
    hashes = codes.astype(np.uint64) * _MIX[62] + _MIX[63]
    octave, width = FIRST_OCTAVE, 1
    while octave <= top:
        while width < 1 << octave:
            hashes = (hashes[:-width] ^ (hashes[:-width] >> np.uint64(29))) * _MIX[width.bit_length()] + hashes[width:]
            width *= 2
        blocks = len(hashes) // width
        grid = hashes[:blocks * width].reshape(blocks, width)
        hit = (grid[1:] == grid[:-1, :1]).any(axis=1)
        if octave == FIRST_OCTAVE:
            hit |= (grid[:-1, 1:] == grid[:-1, :1]).any(axis=1)
        hits = np.flatnonzero(hit) * width
        if len(hits):
            of = np.searchsorted(starts, hits, "right") - 1
            good = (of >= 0) & (hits < ends[of]) & (last[able[of]] >= octave)
            size = _tile_size(octave)
            for k, tile in sorted(set(zip(of[good].tolist(), ((hits[good] - starts[of[good]]) // size).tolist()))):
                low = max(0, tile * size - width)
                high = min(int(ends[k] - starts[k]), (tile + 1) * size + 4 * width)
                found[able[k]].append((octave, low, tile * size - low, keep[starts[k] + low:starts[k] + high].tobytes()))
        octave += 1
    return found


def _agree(words: np.ndarray, i: int, j: int) -> int:
    """How many words agree from ``i`` and from ``j`` (> i) on."""
    done, step = 0, 16
    while True:
        a = words[i + done:i + done + step]
        b = words[j + done:j + done + step]
        same = a[:len(b)] == b
        if not same.all():
            return done + int(same.argmin())
        done += len(b)
        if len(b) < step:
            return done
        step *= 2


def _z(words: np.ndarray, base: int, count: int, known: np.ndarray | None = None) -> np.ndarray:
    """Z-function: how many words agree from ``base`` and from ``base + i`` on, for i below ``count``.

    With ``known``, the values of the stretch that begins at ``base``, the other side runs over the ``count`` words before ``base`` instead.
    """
    shift = base if known is None else base - count
    values = np.zeros(count, np.int64)
    inner = values if known is None else known
    at = words.tolist() if count > 64 else words
    left = right = 0
    for i in range(1 if known is None else 0, count):
        near = min(right - i, int(inner[i - left])) if i < right else 0
        if i + near >= right and shift + i + near < len(words) and base + near < len(words) and at[base + near] == at[shift + i + near]:
            low, high = sorted((base + near, shift + i + near))
            near += _agree(words, low, high)
        if i + near > right:
            left, right = i, i + near
        values[i] = near
    return values


def tile_fragments(words: np.ndarray, octave: int, own: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of the stretches of a tile with a period of ``octave`` around one of its own boundaries, as far as the tile shows them.

    For each own boundary the Z-function of what follows and that of what precedes, read backwards, tell for all periods of the octave at once how far they
    reach. Periods whose root is itself a repetition are left to the octave of that root.
    """
    n, step = len(words), 1 << octave
    least, most = (1 if octave == FIRST_OCTAVE else step), 2 * step
    found = []
    reached = np.zeros(most, np.int64)  # by period: up to where it is known
    backwards = words[::-1]
    for b in range(own, min(own + _tile_size(octave), n - least - step + 1), step):
        top = min(most, n - b - step + 1)
        if top <= least:
            break
        ahead = words[b + least:b + top + step]
        periods = np.arange(least, top)
        likely = (ahead[:top - least] == words[b]) & (ahead[step - 1:step - 1 + top - least] == words[b + step - 1])
        likely &= (ahead[step // 2:step // 2 + top - least] == words[b + step // 2]) & (reached[periods] < b + periods + step)
        if not likely.any():
            continue
        forward = _z(words, b, top)
        periods = periods[forward[periods] >= step]
        if not len(periods):
            continue
        # In the reversed tile the words before b begin at n - b, those before b + p at n - b - p.
        own_z = _z(backwards, n - b, min(top, b)) if b else np.zeros(0, np.int64)
        reach = top - 1
        known = np.zeros(reach + 1, np.int64)
        known[:len(own_z)] = own_z
        known[0] = b
        back = _z(backwards, n - b, reach, known)  # index i belongs to the period reach - i
        whole = np.zeros(most, bool)  # periods of which a shorter one is the root
        for q in np.flatnonzero(forward[1:min(step, top)] >= np.arange(1, min(step, top))) + 1:
            if not whole[q]:
                whole[2 * q:min(most, int(q + forward[q]) + 1):q] = True
        for p in periods.tolist():
            start, end = b - min(int(back[reach - p]), b), b + p + int(forward[p])
            if reached[p] >= b + p + step:
                continue
            reached[p] = end
            if not whole[p]:
                found.append((p, start, end))
    return found


def _split(text: bytes | None) -> list[bytes]:
    return text.split() if text else []  # bytes split at the blank and the controls 9 to 13 alone


def _tiled(place: int, names: list[str], suspect: bool):
    """Rows that have suspect tiles, with these, or rows that have none."""
    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, place):
            tiles = _suspects([_split(t) for t in batch.column(place).cast(pa.binary()).to_pylist()])
            rows = pa.array([i for i, t in enumerate(tiles) if bool(t) == suspect], pa.int32())
            taken = batch.take(rows)
            if suspect:
                kind = pa.struct([("octave", pa.int32()), ("low", pa.int64()), ("own", pa.int32()), ("words", pa.binary())])
                column = pa.array([[dict(zip(("octave", "low", "own", "words"), x)) for x in t] for t in tiles if t], pa.list_(kind))
            else:
                column = pa.nulls(len(rows), pa.bool_())
            yield pa.RecordBatch.from_arrays([*taken.columns, column], names=names)
    return tiled


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, 4):
        rows = []
        for key, octave, low, own, words in zip(*(c.to_pylist() for c in batch.columns)):
            rows += [(key, p, low + s, low + e) for p, s, e in tile_fragments(np.frombuffer(words, np.int32), octave, own)]
        key, period, start, end = zip(*rows) if rows else ((), (), (), ())
        yield pa.record_batch([pa.array(key, pa.string()), pa.array(period, pa.int64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["key", "period", "start", "end"])


def stitched(fragments: DataFrame) -> DataFrame:
    """Runs (key, start, length, period) of fragments (key, period, start, end): those of a key and period that share a period's words are one stretch."""
    order = Window.partitionBy("key", "period").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = fragments.distinct().withColumn("fresh", (F.coalesce(before, F.lit(0)) < F.col("start") + F.col("period")).cast("int"))
    islands = fresh.withColumn("island", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = islands.groupBy("key", "period", "island").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"))
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), LEAST_PERIODS * F.col("period"))).select("key", "start", "length", "period")


def periodic_runs(df: DataFrame, text: str = "text", runs: str = "runs") -> DataFrame:
    """``df`` with ``runs``: array of (start, length, period) of its words' runs, by start, then period.

    A run is a stretch of words with smallest period q, at least 24 words and 3 q long, that no neighbouring word extends. Words are what stands
    between blanks and the controls 9 to 13. Null and empty texts have no runs; repeated rows give a row each, equal texts equal runs; an empty table
    gives an empty one; a column named like ``runs`` is replaced.

    Texts without a suspect tile have no run and are neither shuffled nor written. The others are written with their tiles; each tile is solved for
    itself wherever it lands, so a long text is spread over tasks, and only fragments meet by text and period. A tile of octave k has
    21 * 2^k words, at least 1 064, and a stretch of one period leaves one fragment a tile.
    """
    kept = [c for c in df.columns if c.lower() != runs.lower()]
    plain = df.select(*[F.col(f"`{c}`") for c in kept])
    place, key = kept.index(text), free_name(plain, "key")
    tiles = free_name(plain, "tiles")
    kinds = plain.schema.fields
    held = written(plain.mapInArrow(_tiled(place, [*kept, tiles], True), StructType([*kinds, StructField(tiles, ArrayType(_TILE))])), "periodic")
    # Runs depend on the text alone, so equal texts are one key.
    held = held.withColumn(key, F.sha2(F.col(f"`{text}`"), 256))
    each = held.select(F.col(key).alias("key"), F.explode(tiles).alias("t")).select("key", "t.octave", "t.low", "t.own", "t.words")
    size = each.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0]
    dealt = each.repartition(max(1, min(MOST_TASKS, -(-size // TASK_BYTES))), "key", "octave", "low")
    found = stitched(dealt.mapInArrow(_fragments, "key string, period long, start long, end long"))
    listed = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("found"))
    listed = listed.select(F.col("key").alias("__k"), F.transform("found", lambda r: F.struct(r["start"], r["length"], r["period"])).alias("__f"))
    none = F.array().cast(ArrayType(_RUN, False))
    with_runs = held.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(key).alias("__key")).join(listed, F.col("__key") == F.col("__k"), "left")
    with_runs = with_runs.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], F.coalesce(F.col("__f"), none).alias(runs))
    clear = plain.mapInArrow(_tiled(place, [*kept, tiles], False), StructType([*kinds, StructField(tiles, BooleanType())]))
    return clear.select(*[F.col(f"`{c}`") for c in kept], none.alias(runs)).union(with_runs)


def collapse_runs(df: DataFrame, text: str = "text", runs: str = "runs", out: str = "collapsed") -> DataFrame:
    """``df`` with ``out``: the words of ``text`` joined by one blank, without those that a run holds after its first period. Null texts
    and null lists of runs count as empty; a column named like ``out`` is replaced."""
    kept = [c for c in df.columns if c.lower() != out.lower()]
    place, listed = kept.index(text), kept.index(runs)

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, place):
            texts = []
            for value, found in zip(batch.column(place).cast(pa.binary()).to_pylist(), batch.column(listed).to_pylist()):
                words = _split(value)
                if found:
                    edges = np.zeros(len(words) + 1, np.int64)
                    for r in found:
                        edges[r["start"] + r["period"]] += 1
                        edges[r["start"] + r["length"]] -= 1
                    words = [w for w, depth in zip(words, np.cumsum(edges).tolist()) if not depth]
                texts.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*kept, out])

    plain = df.select(*[F.col(f"`{c}`") for c in kept])
    return plain.mapInArrow(collapsed, StructType([*plain.schema.fields, StructField(out, StringType())]))


def _repeating(doc_id: Column, text: Column) -> Column:
    """The contract's text: in a tenth of the documents the words from a on repeat the p words at a."""
    code = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")).cast("long")

    def rewritten(words: Column) -> Column:
        count, g = F.size(words).cast("long"), F.floor(code / 10).cast("long")
        start = g % F.greatest(count, F.lit(1))
        period = F.lit(1) + F.floor((count - start) / (F.lit(3) + g % 8)).cast("long")
        tail = F.slice(words, (start + 1).cast("int"), period.cast("int"))
        repeats = F.flatten(F.array_repeat(tail, F.ceil((count - start) / period).cast("int")))
        return F.when(count > 0, F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), start.cast("int")), repeats), F.lit(1), count.cast("int")), " ")).otherwise(text)

    return F.when(F.coalesce(code % 10 == 0, F.lit(False)), let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), rewritten)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", _repeating(F.col("doc_id"), F.col("text")).alias("text"))
    found = collapse_runs(periodic_runs(docs))
    line = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    # Exponents are compared as fractions; the list is in the order that breaks ties.
    best = F.aggregate(F.slice("runs", F.lit(2), F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
                       lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a))
    lines = F.when(F.size("runs") > 0, F.concat(line, F.lit("\n"))).otherwise("")
    shown = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
    return shown.select("doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
