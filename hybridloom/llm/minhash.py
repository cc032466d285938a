"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, union-find."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.llm.common import broadcast_if_small, table, written

SHINGLE, NEAR = 5, (75, 100)
SLOTS, BANDS = 128, 32
# A pair at 0.75 agrees in 96 of 128 slots on average; fewer than 72 are 4.9 standard deviations away.
LEAST_AGREEING = 72
_CHUNK, _BLOCK = 200_000, 2048
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], _U)
_POWERS = np.ones(1, _U)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words, A-Z lower-cased; words are what blanks and the controls 9 to 13 leave."""
    global _POWERS
    data = np.frombuffer(text.encode("utf-8", "replace").translate(_LOWER), np.uint8)
    inside = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    begins, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(begins):
        return np.zeros(0, _U)
    most = int(lengths.max())
    if len(_POWERS) < most:
        _POWERS = np.cumprod(np.concatenate(([_U(1)], np.full(2 * most, _U(0x100000001B3)))), dtype=_U)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(int(lengths.sum())) - np.repeat(starts, lengths)
    sums = np.add.reduceat((data[inside].astype(_U) + _U(1)) * _POWERS[place], starts)
    return _mixed(sums ^ (lengths.astype(_U) * _ODD[0]))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; fewer words are one shingle, no words none."""
    words = word_hashes(text or "")
    n = len(words)
    if not n:
        return words
    width = min(n, SHINGLE)
    total = np.full(n - width + 1, _U(width))
    for k in range(width):
        total += words[k:n - width + 1 + k] * _ODD[k]
    return np.unique(_mixed(total))


def super_minhash(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash signatures of non-empty sets, one row of SLOTS values each.

    In step j every element gives the j-th slot of its own random permutation the value j plus a fraction; a slot keeps its
    smallest. When all slots of a set have a value, later steps can't lower any, and the set is done: large sets after one step.
    The elements of many sets are worked through together, in chunks that bound the memory for permutations.
    """
    out, begin = np.full((len(sets), SLOTS), 0xFFFFFFFF, np.uint32), 0
    while begin < len(sets):
        end, size = begin, 0
        while end < len(sets) and (end == begin or size + len(sets[end]) <= _CHUNK):
            size += len(sets[end])
            end += 1
        elements = np.concatenate(sets[begin:end])
        owner = np.repeat(np.arange(end - begin), [len(s) for s in sets[begin:end]])
        part, order, rows = out[begin:end].reshape(-1), None, None
        for j in range(SLOTS):
            drawn = _mixed(elements + _U((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            k = (j + (((drawn & _U(0xFFFFFFFF)) * _U(SLOTS - j)) >> _U(32))).astype(np.int64)
            if order is None:
                slot = k
            else:
                slot, swapped = order[rows, k], order[rows, j]
                order[rows, j], order[rows, k] = slot, swapped
            np.minimum.at(part, owner * SLOTS + slot, ((drawn >> _U(40)) | _U(j << 24)).astype(np.uint32))
            open_sets = (out[begin:end] == 0xFFFFFFFF).any(axis=1)
            if not open_sets.any():
                break
            left = open_sets[owner]
            if order is None:
                elements, owner, k = elements[left], owner[left], k[left]
                order, rows = np.tile(np.arange(SLOTS, dtype=np.uint8), (len(elements), 1)), np.arange(len(elements))
                order[rows, 0] = k
                order[rows, k] = np.where(k == 0, k, 0)
            elif left.mean() < 0.7:
                elements, owner, order = elements[left], owner[left], order[left]
                rows = np.arange(len(elements))
        begin = end
    return out


def _bands(signatures: np.ndarray) -> np.ndarray:
    rows = signatures.reshape(len(signatures), BANDS, SLOTS // BANDS).astype(_U)
    total = np.arange(BANDS, dtype=_U) * _ODD[4]
    for k in range(rows.shape[2]):
        total = _mixed(total + rows[:, :, k] * _ODD[k])
    return total.view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            piece = batch.slice(at, 1000)
            sets = [shingle_set(t.as_py()) for t in piece.column(1)]
            full = [s for s in sets if len(s)]
            signatures = super_minhash(full)
            bands, low = iter(_bands(signatures).tolist()), iter((signatures >> np.uint32(8)).astype(np.uint8))
            rows = [(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), next(bands), next(low).tobytes()) if len(s) else (None, None, None) for s in sets]
            yield pa.record_batch([piece.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([r[0] for r in rows], pa.binary()),
                                   pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.binary())],
                                  names=["doc_id", "n_shingles", "node", "bands", "sig"])


def _agreeing(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose signatures agree in LEAST_AGREEING slots (of eight bits each) or more."""
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SLOTS) for c in (2, 3))
                yield batch.select([0, 1]).filter(pa.array((left == right).sum(axis=1) >= LEAST_AGREEING))

    side = lambda n: sketches.select(F.col("node").alias(n), F.col("sig").alias(f"sig_{n}"), F.col("n_shingles").alias(f"n_{n}"))
    fitting = pairs.join(side("a"), "a").join(side("b"), "b").where(NEAR[1] * F.least("n_a", "n_b") >= NEAR[0] * F.greatest("n_a", "n_b"))
    return fitting.select("a", "b", "sig_a", "sig_b").mapInArrow(chosen, "a binary, b binary")


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([batch.column(0), pa.array([shingle_set(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())], names=["node", "shingles"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose whole shingle sets are near. Texts travel, not sets: they are smaller and compress."""
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            keep = []
            for b, text_a, text_b in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if b != last:
                    last, known = b, shingle_set(text_b.as_py())
                mine = shingle_set(text_a.as_py())
                shared = len(np.intersect1d(mine, known, assume_unique=True))
                keep.append(NEAR[1] * shared >= NEAR[0] * (len(mine) + len(known) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    side = lambda n: texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(near, "a binary, b binary")


def _local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one partition: each node with the smallest node it is linked to here."""
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    nodes = list(parent)
    for at in range(0, len(nodes), 10_000):
        part = nodes[at:at + 10_000]
        yield pa.record_batch([pa.array(part, pa.binary()), pa.array([root(x) for x in part], pa.binary())], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node of its component.

    Union-find inside each partition turns its links into stars; the stars are then merged by rounds in which every node takes the
    smallest label around it and the label of that label, so the rounds grow with the logarithm of a chain's length. Each
    round is written to the shared folder; only the number of changed labels reaches the driver.
    """
    stars = written(links.mapInArrow(_local_roots, "a binary, b binary").where("a <> b"), "stars")
    both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("low"))
        hooked = labels.join(around, "node").select("node", "root", F.least("root", "low").alias("low"))
        target = labels.select(F.col("node").alias("low"), F.col("root").alias("next"))
        jumped = written(hooked.join(target, "low").select("node", F.least("low", "next").alias("root"), (F.least("low", "next") != F.col("root")).alias("changed")), "labels")
        labels = jumped.select("node", "root")
        if not jumped.where("changed").limit(1).count():
            return labels


def _cross_links(part: pa.Table) -> pa.Table:
    """Links between the components of one block of a bucket, at most one fewer than there are components.

    Rows of side 0 meet those of side 1, or each other where there are none. A pair is looked at where it first shares a band, fits
    in size, agrees in enough slots and is still apart in this block's union-find; then its whole sets are compared.
    """
    node, size, side = part.column("node").to_pylist(), np.asarray(part.column("n_shingles")), np.asarray(part.column("side"))
    sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint8).reshape(-1, SLOTS)
    bands, here = np.asarray(part.column("bands").combine_chunks().flatten()).reshape(-1, BANDS), part.column("band")[0].as_py()
    number: dict[bytes, int] = {}
    comp = np.array([number.setdefault(c, len(number)) for c in part.column("comp").to_pylist()])
    sets = [np.frombuffer(s, _U) for s in part.column("shingles").to_pylist()]
    values, local = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    seen = np.zeros(len(values), bool)
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    links = []
    for i in left:
        able = right[(comp[right] != comp[i]) & (NEAR[1] * np.minimum(size[right], size[i]) >= NEAR[0] * np.maximum(size[right], size[i]))]
        able = able[(sig[able] == sig[i]).sum(axis=1) >= LEAST_AGREEING]
        same = bands[able] == bands[i]
        able = able[bands[i][same.argmax(axis=1)] == here]
        if not len(able):
            continue
        mine = local[cuts[i]:cuts[i + 1]]
        seen[mine] = True
        for k in able:
            if comp[k] != comp[i]:
                shared = int(seen[local[cuts[k]:cuts[k + 1]]].sum())
                if NEAR[1] * shared >= NEAR[0] * (size[i] + size[k] - shared):
                    links.append((node[i], node[k]))
                    comp[comp == comp[k]] = comp[i]
        seen[mine] = False
    return pa.table({"a": pa.array([x[0] for x in links], pa.binary()), "b": pa.array([x[1] for x in links], pa.binary())})


def near_duplicates(docs: DataFrame, block: int = _BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text).

    Rows with the same shingle set are one node, however many they are. A bucket of a band links its nodes to its most
    central one first (the node whose own buckets hold most), so large groups of near copies cost a comparison for each member,
    not for each pair. Buckets whose nodes are then still in different components are gone through whole, in blocks of ``block``
    nodes: what fits in size and signature is compared, and a block gives at most a link for each component. Every link
    is confirmed on whole sets. With 32 bands of 4 slots a pair at similarity 0.75 is
    missed with a chance of 5e-6.

    Null and empty texts have no shingles and no links: component_id is their own doc_id. Rows without a doc_id are in no
    component (null) and are kept. Repeated rows give a row each. Rows that share a doc_id are kept or dropped by their own texts.
    """
    sketches = written(docs.select("doc_id", "text").mapInArrow(_sketches, "doc_id long, n_shingles long, node binary, bands array<long>, sig binary"), "sketches")
    known = sketches.where("node IS NOT NULL AND doc_id IS NOT NULL")
    nodes = written(known.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "nodes")
    firsts = written(known.join(nodes, ["node", "doc_id"]).dropDuplicates(["node"]).select("node", "doc_id", "n_shingles", "bands", "sig"), "firsts")
    buckets = firsts.select("node", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(buckets.join(shared, "band"), "members")
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    central = members.join(weights, "node").groupBy("band").agg(F.max(F.struct("weight", "node")).alias("hub")).select("band", "hub.node")
    stars = members.join(central.withColumnRenamed("node", "hub"), "band").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()

    def texts_of(pairs: DataFrame) -> DataFrame:
        """Texts of the nodes in ``pairs``; where rows share a doc_id, those whose set is the node's."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        some = docs.select("doc_id", "text").join(broadcast_if_small(firsts.join(wanted, "node", "left_semi").select("doc_id", "node"), 64), "doc_id")

        def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                same = [hashlib.blake2b(shingle_set(t.as_py()).tobytes(), digest_size=16).digest() == n for t, n in zip(batch.column(1), batch.column(2).to_pylist())]
                yield batch.select([2, 1]).filter(pa.array(same, pa.bool_()))

        return some.mapInArrow(own, "node binary, text string").dropDuplicates(["node"])

    links = written(_agreeing(stars, firsts), "hub-pairs")
    links = written(_verified(links, texts_of(links)), "hub-links")
    placed = members.join(components(links), "node", "left").select("band", "node", "n", F.coalesce("root", "node").alias("comp"))
    mixed = placed.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("band")
    dirty = written(placed.join(mixed, "band", "left_semi"), "mixed")
    sets = texts_of(dirty.select(F.col("node").alias("a"), F.col("node").alias("b"))).mapInArrow(_set_rows, "node binary, shingles binary")
    cut = dirty.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    about = cut.join(firsts.select("node", "n_shingles", "bands", "sig").join(sets, "node"), "node")
    copies = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        F.least(F.col("mine"), k).alias("i"), F.greatest(F.col("mine"), k).alias("j"), (F.col("mine") > k).cast("int").alias("side")))
    spread = about.select("band", "node", "comp", "n_shingles", "bands", "sig", "shingles", F.explode(copies).alias("c")).select("*", "c.*").drop("c")
    more = spread.groupBy("band", "i", "j").applyInArrow(_cross_links, "a binary, b binary")
    ends = components(links.unionByName(written(more, "cross-links")))
    least = nodes.join(ends, "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_node = nodes.join(ends.join(least, "root").select("node", "component_id"), "node", "left").select("node", F.coalesce("component_id", "doc_id").alias("component_id"))
    of_node = written(of_node, "components")
    joined = sketches.select("doc_id", "n_shingles", "node").join(broadcast_if_small(of_node, 64), "node", "left")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", "node", found.alias("component_id"), F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one of smallest doc_id. All columns stay; repeated rows of it
    stay. Rows that share a doc_id with a dropped row go with it."""
    gone = written(near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct(), "near-gone")
    gone = broadcast_if_small(gone, 16)
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


NEAR_DUPLICATES_SQL = r"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  shingles AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 5 THEN array_to_string(w[k + 1:k + 5], ' ') ELSE array_to_string(w, ' ') END AS s
    FROM (SELECT *, unnest(range(greatest(len(w) - 4, 1))) AS k FROM words WHERE len(w) > 0)),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
  links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2) p
    JOIN sizes m ON m.doc_id = a JOIN sizes o ON o.doc_id = b WHERE 100 * c >= 75 * (m.n + o.n - c)),
  reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
  SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
  FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) LEFT JOIN sizes USING (doc_id)"""
