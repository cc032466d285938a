"""Exact substring dedup: suffixes are range-partitioned by leading bytes, sorted in their buckets and compared."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from hybridloom.llm.common import broadcast_if_small, free_name, table, written
from hybridloom.llm.minhash import _mixed

WINDOW, LEAD = 100, 32
SAMPLE_DOCS, HOT_COUNT = 10_000, 64
BUCKET_BYTES, BUCKET_SPANS, MOST_RIVALS = 16 << 20, 8_000, 30_000
_PIECE, _PLACE = (1 << 20) - 512, np.uint64((1 << 20) - 1)
_LAST = (1 << 63) - 1
_BASE = 0x100000001B3


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, np.uint64(b)))), dtype=np.uint64) for b in (_BASE, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of WINDOW bytes, cut into runs that share their anchor: hash of the anchor, its place, first window, windows,
    and a hash of all bytes of the run.

    The anchor of a window is its LEAD-byte string of smallest hash (the first on a tie). It depends on the window's bytes alone,
    so equal windows have equal anchors at equal offsets, and a window can only equal windows in runs with its anchor's bytes.
    """
    found = []
    for begin in range(0, len(data) - WINDOW + 1, _PIECE):
        plain = data[begin:begin + _PIECE + WINDOW - 1].astype(np.uint64) + np.uint64(1)
        hashed, step = plain, 1
        while step < LEAD:
            hashed = hashed[:-step] * np.uint64(pow(_BASE, step, 1 << 64)) + hashed[step:]
            step *= 2
        hashed = _mixed(hashed)
        low, width = (hashed & ~_PLACE) | np.arange(len(hashed), dtype=np.uint64), 1
        while 2 * width <= WINDOW - LEAD + 1:
            low, width = np.minimum(low[:-width], low[width:]), 2 * width
        rest = WINDOW - LEAD + 1 - width
        low = np.minimum(low[:-rest], low[rest:]) if rest else low
        place = (low & _PLACE).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        n = np.diff(np.concatenate((first, [len(place)])))
        powers, inverses = _powers(len(plain))
        upto = np.concatenate(([np.uint64(0)], np.cumsum(plain * powers, dtype=np.uint64)))
        whole = _mixed((upto[first + n + WINDOW - 1] - upto[first]) * inverses[first] ^ _mixed(n.astype(np.uint64)))
        found.append((hashed[place[first]], begin + place[first], begin + first, n, whole))
    if not found:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*found))


def _dealt(hashed: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot and 32-bit key of anchors. An anchor is the least of many hashes, so its leading bits crowd near zero; it is hashed once more."""
    again = _mixed(hashed ^ np.uint64(_BASE))
    return (again >> np.uint64(32)) % np.uint64(slots), again & np.uint64(0xFFFFFFFF)


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _bytes(scalar: pa.Scalar) -> bytes:
    return (scalar.as_py() or "").encode("utf-8", "replace")


def equal_windows(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Group number of each window of ``data`` that equals another one, -1 for the others: a multikey sort.

    Eight bytes are one character. Windows are ordered by their next character inside the groups that agree so far, and only groups
    of two or more go on to the character after it.
    """
    words = np.ndarray((max(len(data) - 7, 0),), ">u8", data, strides=(1,)) if len(data) >= 8 else np.zeros(0, ">u8")
    group, alive = np.full(len(starts), -1, np.int64), np.arange(len(starts))
    inside = np.zeros(len(starts), np.int64)
    for offset in [*range(0, WINDOW - 7, 8), *([WINDOW - 8] if WINDOW % 8 else [])]:
        key = words[starts[alive] + offset].astype(np.uint64)
        order = np.lexsort((key, inside))
        alive, key, inside = alive[order], key[order], inside[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (inside[1:] != inside[:-1])))
        number = np.cumsum(new) - 1
        many = np.bincount(number)[number] > 1
        alive, inside = alive[many], number[many]
        if not len(alive):
            return group
    group[alive] = inside
    return group


def _packed(d: np.ndarray, t: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """One (d, t, bytes of its values) for each document; rows of ``values`` keep their order."""
    if len(d):
        order = np.lexsort((t, d))
        d, t, values = d[order], t[order], values[order]
        for at in np.split(np.arange(len(d)), np.flatnonzero((np.diff(d) != 0) | (np.diff(t) != 0)) + 1):
            yield int(d[at[0]]), int(t[at[0]]), values[at].astype(np.int64).tobytes()


def _mark_batches(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    held = list(rows)
    for at in range(0, len(held), 10_000):
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held[at:at + 10_000]), (pa.int64(), pa.int64(), pa.binary()))], names=["d", "t", "marks"])


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of the buckets of one partition, one bucket after the other."""
    buckets: dict[int, list[tuple]] = {}
    for batch in batches:
        for k, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "d", "t", "begin", "data"))):
            buckets.setdefault(k, []).append(tuple(row))
    while buckets:
        yield from _bucket_repeats(sorted(buckets.popitem()[1], key=lambda r: r[:3]))


def _bucket_repeats(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Of the windows of spans (d, t, begin, data) that share anchors, in order, the runs that equal an earlier one."""
    data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    sizes = np.array([len(r[3]) for r in rows])
    counts = sizes - WINDOW + 1
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), counts)
    inner = (np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.int32)
    group = equal_windows(data, np.repeat(np.cumsum(sizes) - sizes, counts) + inner)
    again = group >= 0
    known = np.flatnonzero(again)
    if not len(known):
        return
    again[known[np.unique(group[known], return_index=True)[1]]] = False  # windows are numbered in the order of documents and places
    hit = np.flatnonzero(again)
    if len(hit):
        first = np.concatenate(([0], np.flatnonzero((np.diff(hit) != 1) | (np.diff(owner[hit]) != 0)) + 1))
        run = owner[hit[first]]
        d, t, begin = (np.array([r[k] for r in rows], np.int64)[run] for k in range(3))
        yield from _mark_batches(_packed(d, t, np.stack((begin + inner[hit[first]], np.diff(np.concatenate((first, [len(hit)])))), axis=1)))


def _batches(rows: Iterator[tuple], names: str) -> Iterator[pa.RecordBatch]:
    """Record batches of rows; binary columns are those with ``names`` in capitals, the others are long."""
    held: list[tuple] = []
    kinds = [pa.binary() if n.isupper() else pa.int64() for n in names.split()]
    for row in rows:
        held.append(row)
        if len(held) == 20_000:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names.lower().split())
            held = []
    if held:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names.lower().split())


_MARKS = "d long, t long, marks binary"
_FIELDS = (("hash", np.uint32), ("whole", np.uint64), ("d", np.int64), ("t", np.uint32), ("begin", np.int32), ("n", np.uint8))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(d, t, marks): runs of windows that also start earlier, as packed pairs of first window and number of windows.

    ``docs`` has d, t, text; d and t order the documents. The runs of ``spans`` are the suffixes that are compared. A sample of at
    most SAMPLE_DOCS documents (those of lowest hash) gives the splitters of the buckets and the anchors that many documents hold.

    1. Runs are dealt out by the hash of their anchor, without their bytes. Of equal runs all but the first are marked; an anchor
       with one distinct run ends there. 2. The distinct runs of the other anchors are range-partitioned, with their bytes, by the
       leading bytes of the anchor; a bucket holds all that could equal what it holds, so nothing is left to compare across
       its boundaries. It sorts their windows. 3. Of the runs at anchors that many documents hold a task
       marks its own equal ones, and the others are grouped for the earliest, which Spark combines before the shuffle. The distinct
       runs of such an anchor get a bucket of their own up to MOST_RIVALS; above that their windows are grouped for the earliest too.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    dealt = max(1, -(-size // BUCKET_BYTES))
    slots = 4 * dealt  # several for each partition, so that partitions come out alike

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for text in batch.column(0):
                    data = _bytes(text)
                    hashed, at, *_ = spans(np.frombuffer(data, np.uint8))
                    for h, a in dict(zip(hashed.view(np.int64).tolist(), at.tolist())).items():
                        yield h, data[a:a + LEAD]
        yield from _batches(rows(), "hash LEAD")

    place = F.xxhash64("d", "t")
    chosen = docs.select("d", "t", place.alias("p")).orderBy("p", "d", "t").limit(SAMPLE_DOCS).select(F.col("d").alias("d0"), F.col("t").alias("t0"))
    sample = docs.join(F.broadcast(chosen), (F.col("d") == F.col("d0")) & (F.col("t") == F.col("t0"))).select("text").mapInArrow(sampled, "hash long, lead binary")
    counted = written(sample.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("lead").alias("lead")), "sampled-anchors")
    hot = np.sort(np.array([r["hash"] for r in counted.where(F.col("n") >= HOT_COUNT).select("hash").collect()], np.int64).view(np.uint64))
    def cold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of some documents by slot, one row for a slot: the columns of _FIELDS, one after the other."""
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                parts = []
                for d, t, text in zip(*(c.to_pylist() for c in batch.slice(at, 2000).columns[:2]), batch.column(2).slice(at, 2000)):
                    hashed, _, begin, n, whole = spans(np.frombuffer(_bytes(text), np.uint8))
                    keep = ~_member(hashed, hot)
                    k = int(keep.sum())
                    parts.append((*_dealt(hashed[keep], slots), whole[keep], np.full(k, d), np.full(k, t), begin[keep], n[keep]))
                slot, *columns = (np.concatenate(c) for c in zip(*parts))
                if len(slot):
                    columns = [c.astype(kind) for c, (_, kind) in zip(columns, _FIELDS)]
                    order = np.argsort(slot, kind="stable")
                    cuts = np.split(order, np.flatnonzero(np.diff(slot[order])) + 1)
                    yield pa.record_batch([pa.array([int(slot[c[0]]) for c in cuts], pa.int32()), pa.array([len(c) for c in cuts], pa.int32()),
                                           pa.array([b"".join(x[c].tobytes() for x in columns) for c in cuts], pa.binary())], names=["slot", "n", "runs"])

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Marks of equal runs, and the first windows of distinct runs whose anchor has several, by document."""
        slots_, held = [], []
        for batch in batches:
            for slot, n, packed in zip(*(batch.column(c).to_pylist() for c in range(3))):
                at, row = 0, []
                for _, kind in _FIELDS:
                    row.append(np.frombuffer(packed, kind, n, at))
                    at += n * np.dtype(kind).itemsize
                slots_.append(np.full(n, slot, np.uint64))
                held.append(row)
        if not held:
            return
        slot = np.concatenate(slots_)
        hashed, whole, d, t, begin, n = (np.concatenate(c) for c in zip(*held))
        anchor = slot << np.uint64(32) | hashed
        order = np.lexsort((begin, t, d, n, whole, anchor))
        anchor, whole, d, t, begin, n = (c[order] for c in (anchor, whole, d, t, begin, n))
        new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        first = new_anchor | np.concatenate(([True], (whole[1:] != whole[:-1]) | (n[1:] != n[:-1])))
        lead = np.flatnonzero(first)[np.cumsum(first) - 1]
        same = (d == d[lead]) & (t == t[lead]) & (begin == begin[lead])  # a repeated row is no earlier document
        again = ~first & ~same
        number = np.cumsum(new_anchor) - 1
        rival = first & (np.bincount(number, weights=first)[number] > 1)
        kept: dict[tuple[int, int], list[bytes]] = {}
        for which, values in ((again, np.stack((begin, n), axis=1)), (rival, begin[:, None])):
            for d_, t_, packed in _packed(d[which], t[which], values[which]):
                kept.setdefault((d_, t_), [b"", b""])[which is rival] = packed
        yield from _batches(((*k, *v) for k, v in kept.items()), "d t MARKS RIVALS")

    parts = docs.select("d", "t", "text").mapInArrow(cold, "slot int, n int, runs binary")
    found = written(parts.repartition(dealt, "slot").mapInArrow(settled, _MARKS + ", rivals binary"), "settled-runs")
    equal = found.where(F.octet_length("marks") > 0).select("d", "t", "marks")
    rivals = found.where(F.octet_length("rivals") > 0)
    buckets = max(1, -(-(rivals.agg(F.coalesce(F.sum(F.octet_length("rivals")), F.lit(0))).first()[0] // 8) // BUCKET_SPANS))
    leads = counted.where(F.col("n") < HOT_COUNT).select("lead").orderBy(F.xxhash64("lead")).limit(max(20_000, 16 * buckets)).collect()
    leads = np.sort(np.array([r["lead"] for r in leads], f"S{LEAD}"))
    splitters = leads[np.linspace(0, len(leads), buckets + 1)[1:-1].astype(int)] if len(leads) else leads

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for d, t, text, lists in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                    data = _bytes(text)
                    _, at, begin, n, _ = spans(np.frombuffer(data, np.uint8))
                    keep = np.isin(begin, np.frombuffer(b"".join(lists), np.int64))
                    at, begin, n = at[keep], begin[keep], n[keep]
                    lead = np.array([data[a:a + LEAD] for a in at.tolist()], f"S{LEAD}")
                    for k, b, w in zip(np.searchsorted(splitters, lead, side="right").tolist(), begin.tolist(), n.tolist()):
                        yield k, d, t, b, data[b:b + w + WINDOW - 1]
        yield from _batches(rows(), "bucket d t begin DATA")

    wanted = rivals.groupBy(F.col("d").alias("d1"), F.col("t").alias("t1")).agg(F.collect_list("rivals").alias("rivals"))
    joined = docs.join(wanted, (F.col("d") == F.col("d1")) & (F.col("t") == F.col("t1"))).select("d", "t", "text", "rivals")
    sorted_ = joined.mapInArrow(cut, "bucket long, d long, t long, begin long, data binary").repartition(buckets, "bucket").mapInArrow(_repeats, _MARKS)
    marks = equal.unionByName(sorted_)
    if not len(hot):
        return marks

    def warm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct runs at hot anchors, with their earliest place in this task; the task's other equal runs as marks."""
        runs: dict[bytes, tuple[int, int, int, int]] = {}
        later: list[tuple[int, int, int, int]] = []
        for batch in batches:
            for d, t, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = _bytes(text)
                hashed, at, begin, n, _ = spans(np.frombuffer(data, np.uint8))
                for i in np.flatnonzero(_member(hashed, hot)).tolist():
                    b, key = int(begin[i]), (d, t, int(begin[i]), int(at[i] - begin[i]))
                    piece = data[b:b + int(n[i]) + WINDOW - 1]
                    low, high = sorted((runs.get(piece, key), key), key=lambda k: k[:3])
                    runs[piece] = low
                    if high[:3] != low[:3]:
                        later.append((*high[:3], int(n[i])))
        made = np.array(later, np.int64).reshape(-1, 4)
        yield from _batches(((d, t, b, p[a:a + LEAD], p, b"") for p, (d, t, b, a) in runs.items()), "d t begin LEAD DATA MARKS")
        yield from _batches(((d, t, 0, b"", b"", m) for d, t, m in _packed(made[:, 0], made[:, 1], made[:, 2:])), "d t begin LEAD DATA MARKS")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for d, t, begin, data in zip(*(batch.column(c).to_pylist() for c in ("d", "t", "begin", "data"))):
                    for i in range(len(data) - WINDOW + 1):
                        yield d, t, begin + i, hashlib.blake2b(data[i:i + WINDOW], digest_size=16).digest()
        yield from _batches(rows(), "d t begin KEY")

    def packed(rows: DataFrame, n: Column) -> DataFrame:
        """Marks of rows (d, t, begin) with ``n`` windows each, as bytes in the order of the machine's integers."""
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                d, t, begin, n_ = (np.asarray(batch.column(c), np.int64) for c in range(4))
                yield from _mark_batches(_packed(d, t, np.stack((begin, n_), axis=1)))
        return rows.select("d", "t", "begin", n.cast("long").alias("n")).mapInArrow(pack, _MARKS)

    earliest = F.min(F.struct("d", "t", "begin")).alias("e")
    is_first = (F.col("d") == F.col("e.d")) & (F.col("t") == F.col("e.t")) & (F.col("begin") == F.col("e.begin"))
    warmed = written(docs.select("d", "t", "text").mapInArrow(warm, "d long, t long, begin long, lead binary, data binary, marks binary"), "hot-runs")
    runs = warmed.where(F.octet_length("data") > 0).select("d", "t", "begin", "lead", "data")
    firsts = written(runs.groupBy("data").agg(earliest, F.min("lead").alias("lead")), "hot-firsts")
    whole = packed(runs.drop("lead").join(firsts.drop("lead"), "data").where(~is_first), F.octet_length("data") - (WINDOW - 1))
    # One row for each hot anchor, of which the sample has a bounded number.
    crowded = F.broadcast(firsts.groupBy("lead").agg((F.count(F.lit(1)) > MOST_RIVALS).alias("crowded")))
    rivals_ = firsts.join(crowded, "lead").select("lead", "e.d", "e.t", "e.begin", "data", "crowded")
    near = rivals_.where("NOT crowded").select(F.xxhash64("lead").alias("bucket"), "d", "t", "begin", "data").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "bucket")
    single = written(rivals_.where("crowded").select("d", "t", "begin", "data").mapInArrow(windows, "d long, t long, begin long, key binary"), "hot-windows")
    some = packed(single.join(single.groupBy("key").agg(earliest), "key").where(~is_first), F.lit(1)).unionByName(near.mapInArrow(_repeats, _MARKS))
    return marks.unionByName(warmed.where(F.octet_length("marks") > 0).select("d", "t", "marks")).unionByName(whole).unionByName(some)


def cut_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with kept (the bytes that stay, as binary), n_bytes, n_removed and n_spans.

    A byte goes when a string of WINDOW bytes that covers it also starts earlier: in a document of smaller doc_id, or before in the same
    one; strings are judged on the input and never cross documents. Copies of a whole text are settled by its hash, so only
    one of them is searched. Rows that share a doc_id are ordered by a hash of their texts; rows that agree in both count as one
    document and get the same result; rows without a doc_id come last. Null and empty texts have no bytes. Other columns stay;
    columns of these names are replaced. Spans of a document meet in one row, which its text bounds.
    """
    kept = [c for c in docs.columns if c.lower() not in ("kept", "n_bytes", "n_removed", "n_spans")]
    sha, d, t = (free_name(docs, n) for n in ("sha", "d", "t"))
    plain = F.coalesce(F.col(text), F.lit(""))
    known = docs.select(*kept).withColumn(sha, F.sha2(F.encode(plain, "UTF-8"), 256)).withColumns({
        d: F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), t: F.conv(F.substring(sha, 1, 8), 16, 10).cast("long")})
    ids = written(known.where(F.octet_length(text) >= WINDOW).select(F.col(sha).alias("sha"), F.col(d).alias("d"), F.col(t).alias("t"), F.octet_length(text).alias("n")), "repeat-ids")
    groups = ids.groupBy("sha").agg(F.min("d").alias("first"), F.max("d").alias("last")).where("first < last")
    copies = written(ids.join(groups, "sha").where("d > first").select("d", "t", (F.col("n") - (WINDOW - 1)).cast("long").alias("windows")).distinct(), "copies")
    plain_docs = known.where(F.octet_length(text) >= WINDOW).select(F.col(d).alias("d"), F.col(t).alias("t"), F.col(text).alias("text"), F.col(sha).alias("sha"))
    searched = plain_docs.join(broadcast_if_small(copies.select("d", "t"), 48), ["d", "t"], "left_anti")
    again = written(ids.groupBy("sha", "d", "t").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("d", "t").distinct().join(
        copies.select("d", "t"), ["d", "t"], "left_anti"), "repeated-rows")
    if not again.isEmpty():  # repeated rows are searched once; only their texts are shuffled
        again = broadcast_if_small(again, 48)
        once = written(searched.join(again, ["d", "t"], "left_semi").dropDuplicates(["d", "t", "sha"]), "repeated-once")
        searched = searched.join(again, ["d", "t"], "left_anti").unionByName(once)
    searched = searched.drop("sha")
    gone = repeated_windows(searched).withColumn("windows", F.lit(None).cast("long")).unionByName(copies.withColumn("marks", F.lit(None).cast("binary")))
    on_d, on_t, marks, windows = (free_name(known, n) for n in ("on_d", "on_t", "marks", "windows"))
    found = written(gone.groupBy(F.col("d").alias(on_d), F.col("t").alias(on_t)).agg(F.collect_list("marks").alias(marks), F.max("windows").alias(windows)), "repeat-marks")
    joined = known.join(found, (F.col(d) == F.col(on_d)) & (F.col(t) == F.col(on_t)), "left").select(*[F.col(f"`{c}`") for c in kept], marks, windows)
    place = kept.index(text)

    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            for value, lists, windows_ in zip(batch.column(place), batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()):
                data = _bytes(value)
                change = np.zeros(len(data) + 1, np.int32)
                runs = np.frombuffer(b"".join(lists or ()), np.int64).reshape(-1, 2) if not windows_ else np.array([[0, windows_]])
                np.add.at(change, runs[:, 0], 1)
                np.add.at(change, runs[:, 0] + runs[:, 1] + WINDOW - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                made.append((np.frombuffer(data, np.uint8)[~gone].tobytes(), len(data), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum())))
            columns = list(zip(*made)) or [()] * 4
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(columns[0], pa.binary()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                                             names=[*kept, "kept", "n_bytes", "n_removed", "n_spans"])

    fields = [StructField("kept", BinaryType()), *[StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")]]
    return joined.mapInArrow(trimmed, StructType([*docs.select(*kept).schema.fields, *fields]))


def op5_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that longer strings repeat from earlier ones."""
    cut = cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
