"""Collections as folders of Parquet: payload, dense and sparse components keyed by id.

``<root>/<collection>/_log`` holds numbered commits; a commit names the batches, folders of their own, that it adds to a component or
puts in place of all earlier ones. What no commit names is never read, so a job that dies half-way leaves the collection as it was. Writers that meet
retry on top of each other's commits, and a reader keeps the batches of the commit it began with.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridloom.operators import dml, postings
from hybridloom.schema import as_points, equality_filter
from hybridloom.session import checked_broadcast, cut_lineage
from hybridloom.sources import sketches
from hybridloom.sources.commits import CommitLog

COMPONENTS = ("payload", "dense", "sparse")
#: Batches are written once and again by replacement and retirement, so they are packed tighter than by default.
COMPRESSION = "zstd"


def safe_name(name: str) -> str:
    """Lower case; letters, digits and ``-_.`` only; at most 63 characters."""
    kept = [c for c in name.strip().lower() if c.isalnum() or c in "-_."]
    return "".join(kept)[:63]


class Folder(str):
    """A collection's folder, as :meth:`CollectionStore.resolve` has found it for its owner's name."""


@dataclass
class Snapshot:
    """What one commit leaves: the owner's name, the components that may be written with the size of their vectors, and the batches of each."""
    version: int = 0
    owner: str | None = None
    sizes: dict[str, int | None] = field(default_factory=dict)
    batches: dict[str, list[dict]] = field(default_factory=dict)

    def after(self, number: int, entry: dict) -> "Snapshot":
        batches = {c: list(b) for c, b in self.batches.items()}
        for change in entry.get("changes", []):
            held = batches.setdefault(change["component"], [])
            if change["mode"] == "describe":
                known = {b["folder"]: b for b in change["batches"]}
                batches[change["component"]] = [{**b, **known.get(b["folder"], {})} for b in held]
            else:
                batches[change["component"]] = ([] if change["mode"] == "set" else held) + change["batches"]
        return Snapshot(number, entry.get("owner", self.owner), entry.get("sizes", self.sizes), batches)

    def has(self, component: str) -> bool:
        return bool(self.batches.get(component))


class CollectionStore:
    def __init__(self, spark: SparkSession, root: str, protected: frozenset[str] = frozenset()):
        self.spark, self.root, self.protected = spark, root.rstrip("/"), frozenset(map(safe_name, protected))

    # Names and commits

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root,) + parts))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _children(self, *parts: str) -> list[str]:
        path, files = self._path(*parts), self._files()
        return [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()] if files.exists(path) else []

    def _log(self, folder: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/{folder}/_log")

    def snapshot(self, name: str) -> Snapshot:
        """The collection after its newest commit; empty where it has none."""
        summary, entries = self._log(self.resolve(name)).entries()
        state = Snapshot(**summary) if summary else Snapshot()
        return reduce(lambda s, e: s.after(s.version + 1, e), entries, state)

    def resolve(self, name: str) -> Folder:
        """Folder of a collection. A folder belongs to the name it was made with, but for case and outer blanks, and goes by its own name, which
        listings show; any other name that would lead there is refused, in every call."""
        if isinstance(name, Folder):
            return name
        safe = safe_name(name)
        if not safe:
            raise ValueError(f"no usable collection name in {name!r}")
        owner = self.snapshot(Folder(safe)).owner
        if owner is not None and name.strip().lower() not in (owner, safe):
            raise ValueError(f"{name!r} would share folder {safe} with {owner!r}; choose a name of letters, digits and -_. with at most 63 characters")
        return Folder(safe)

    def _writable(self, name: str) -> Folder:
        folder = self.resolve(name)
        if folder in self.protected:
            raise PermissionError(f"collection {folder} is protected")
        return folder

    def _commit(self, folder: Folder, make: Callable[[Snapshot], dict | None]) -> Snapshot:
        """Put ``make(newest snapshot)`` as the next entry, again and again until no other writer was faster; None commits nothing."""
        while True:
            base = self.snapshot(folder)
            entry = make(base)
            if entry is None:
                return base
            if self._log(folder).put(base.version + 1, entry):
                done = base.after(base.version + 1, entry)
                self._log(folder).summarise(done.version, {"version": done.version, "owner": done.owner, "sizes": done.sizes, "batches": done.batches})
                return done

    # Definition

    def create(self, name: str, components: tuple[str, ...] = COMPONENTS, dense_size: int | None = None) -> Folder:
        """Make the collection unless it is there. Only ``components`` can be written to, a sparse-only collection having no dense one, and
        dense vectors have ``dense_size`` numbers where that is given. A folder made under another name is not made again under its own."""
        folder, plain = self._writable(name), name.strip().lower()
        sizes = {c: dense_size if c == "dense" else None for c in components}
        found = self._commit(folder, lambda base: None if base.version else {"owner": plain, "sizes": sizes})
        if not isinstance(name, Folder) and found.owner not in (None, plain):
            raise ValueError(f"folder {folder} belongs to {found.owner!r}")
        return folder

    def drop(self, name: str) -> None:
        folder = self._writable(name)
        self._files().delete(self._path(folder), True)

    def names(self) -> list[str]:
        return sorted(self._children())

    def has(self, name: str, component: str) -> bool:
        """Plan-time capability check."""
        return self.snapshot(name).has(component)

    def info(self) -> list[dict]:
        return [{"name": n, "points": self.read(n, "payload").count() if self.has(n, "payload") else 0,
                 "dense": self.has(n, "dense"), "sparse": self.has(n, "sparse")} for n in self.names()]

    # Reading

    def read(self, name: str, component: str = "payload", at: Snapshot | None = None, filter_by: dict | None = None) -> DataFrame:
        """A component at a snapshot, by default the newest. Of a filtered payload only files are opened whose sketch leaves room for the condition."""
        folder = self.resolve(name)
        at = at or self.snapshot(folder)
        if not at.has(component):
            raise LookupError(f"collection {folder} has no {component}")
        rows = self._rows(folder, at.batches[component], filter_by)
        return equality_filter(rows, filter_by) if filter_by else rows

    def _rows(self, folder: str, batches: list[dict], filter_by: dict | None = None) -> DataFrame:
        paths = []
        for batch in batches:
            base = f"{self.root}/{folder}/{batch['folder']}"
            found = sketches.matching_files(self.spark.read.parquet(f"{self.root}/{folder}/{batch['sketch']}"), filter_by) if filter_by and batch.get("sketch") else None
            paths += [base] if found is None else [f"{base}/{f}" for f in found]
        schema = self.spark.read.parquet(*[f"{self.root}/{folder}/{b['folder']}" for b in batches]).schema
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def points(self, name: str, *vectors: str) -> DataFrame:
        """Payload with the asked vector components joined on, all of one snapshot."""
        at = self.snapshot(name)
        out = as_points(self.read(name, "payload", at))
        for component in vectors:
            out = out.join(self.read(name, component, at), "id", "left")
        return out

    # Writing

    def _batch(self, folder: str, component: str, rows: DataFrame, statistics: DataFrame | None = None, unique: bool = True) -> dict:
        """Write rows to a folder of their own: payload along the curve with a sketch of each file, sparse vectors with their term counts. Rows whose ids
        may not be ``unique`` are written as they come; only where the written ids then repeat, one of each is written anew."""
        own = uuid.uuid4().hex
        batch = {"folder": f"{component}/{own}"}
        target = f"{self.root}/{folder}/{batch['folder']}"
        (sketches.clustered(rows) if component == "payload" else rows).write.parquet(target, compression=COMPRESSION)
        stored = self.spark.read.schema(rows.schema).parquet(target)
        if not unique and not stored.groupBy("id").count().where("count > 1").isEmpty():
            return self._batch(folder, component, stored.dropDuplicates(["id"]), statistics)
        if component == "payload":
            batch["sketch"] = f"sketch/{own}"
            sketches.file_sketches(stored).write.parquet(f"{self.root}/{folder}/{batch['sketch']}")
        elif component == "sparse":
            batch["statistics"] = f"statistics/{own}"
            counts = postings.term_counts(stored) if statistics is None else statistics
            counts.write.parquet(f"{self.root}/{folder}/{batch['statistics']}", compression=COMPRESSION)
        return batch

    def _check(self, base: Snapshot, component: str, rows: DataFrame) -> None:
        if base.sizes and component not in base.sizes:
            raise ValueError(f"the collection was made without {component} vectors")
        size = base.sizes.get(component)
        if size is not None and rows.where(F.size(component) != size).limit(1).count():
            raise ValueError(f"{component} vectors must have {size} numbers")

    def append(self, name: str, rows: DataFrame, component: str = "payload") -> None:
        """Add rows whose id is not stored yet; sending a batch again adds nothing. Batches of other writers that commit meanwhile are met in a
        retry, which reads those batches alone."""
        folder = self._writable(name)
        held: dict = {"batch": None, "seen": []}

        def make(base: Snapshot) -> dict:
            self._check(base, component, rows)
            stored = base.batches.get(component, [])
            others = [b for b in stored if b["folder"] not in held["seen"]]
            if held["batch"] is None or others:
                first = held["batch"] is None
                own = rows if first else self._rows(folder, [held["batch"]])
                fresh = dml.without(own, self._rows(folder, others), "id") if others else own
                held["batch"] = self._batch(folder, component, fresh, unique=not first)
            held["seen"] = [b["folder"] for b in stored]
            return {"changes": [{"component": component, "mode": "add", "batches": [held["batch"]]}]}

        self._commit(folder, make)

    def replace(self, name: str, rows: DataFrame, component: str) -> None:
        """Upsert one component: the given ids get new values, the others stay."""
        folder = self._writable(name)
        rows = cut_lineage(rows.dropDuplicates(["id"]))

        def make(base: Snapshot) -> dict:
            self._check(base, component, rows)
            if not base.has(component):
                return {"changes": [{"component": component, "mode": "set", "batches": [self._batch(folder, component, rows)]}]}
            stored = self.read(folder, component, base)
            gone = dml.within(stored, rows, "id") if component == "sparse" else None
            counts = self._changed(folder, base, gone, rows) if gone is not None else None
            return {"changes": [{"component": component, "mode": "set", "batches": [self._batch(folder, component, dml.replace_component(stored, rows), counts)]}]}

        self._commit(folder, make)

    def retire(self, name: str, chunks: DataFrame) -> None:
        """Drop the stored points, and their vectors, of files in ``chunks`` that ``chunks`` no longer holds, from all components in one commit."""
        folder = self._writable(name)

        def make(base: Snapshot) -> dict | None:
            if not base.has("payload"):
                return None
            files = chunks.select("source_file").distinct()
            gone = self.read(folder, "payload", base).join(checked_broadcast(files), "source_file", "left_semi").select("id").join(chunks.select("id"), "id", "left_anti")
            gone = cut_lineage(gone)
            if gone.isEmpty():
                return None
            changes = []
            for component in COMPONENTS:
                if base.has(component):
                    stored = self.read(folder, component, base)
                    counts = self._changed(folder, base, dml.within(stored, gone, "id"), None) if component == "sparse" else None
                    changes.append({"component": component, "mode": "set", "batches": [self._batch(folder, component, dml.without(stored, gone, "id"), counts)]})
            return {"changes": changes}

        self._commit(folder, make)

    def patch(self, name: str, metadata: DataFrame, keys: list[str], fields: list[str], dry_run: bool = False) -> DataFrame:
        """Fill blank payload fields from a metadata table; reports rows and changes."""
        patched = dml.patch_blanks(self.read(name, "payload"), metadata, keys, fields)
        report = self.spark.createDataFrame(dml.patch_report(patched).collect(), "rows long, changed long")
        if not dry_run:
            self.replace(name, patched.filter("changed").drop("changed"), "payload")
        return report

    def compact(self, name: str, component: str) -> None:
        """One batch in place of all; the rows stay. Small batches of many commits cost a reader a folder each."""
        folder = self._writable(name)

        def make(base: Snapshot) -> dict | None:
            if len(base.batches.get(component, [])) < 2:
                return None
            counts = self._changed(folder, base, None, None) if component == "sparse" else None
            return {"changes": [{"component": component, "mode": "set", "batches": [self._batch(folder, component, self.read(folder, component, base), counts)]}]}

        self._commit(folder, make)

    def vacuum(self, name: str) -> int:
        """Delete folders that the newest snapshot does not name, and tell how many. Not while others write or read older snapshots."""
        folder = self._writable(name)
        at = self.snapshot(folder)
        named = {v for batches in at.batches.values() for b in batches for v in b.values()}
        loose = [f"{kind}/{own}" for kind in self._children(folder) if kind != "_log" for own in self._children(folder, kind) if f"{kind}/{own}" not in named]
        for path in loose:
            self._files().delete(self._path(folder, path), True)
        return len(loose)

    # Term statistics and posting lists

    def _statistics(self, folder: str, at: Snapshot) -> DataFrame:
        return self.spark.read.schema("term string, df long").parquet(*[f"{self.root}/{folder}/{b['statistics']}" for b in at.batches["sparse"]])

    def _changed(self, folder: str, base: Snapshot, gone: DataFrame | None, new: DataFrame | None) -> DataFrame:
        """Statistics of a snapshot less those of the rows that go, plus those of the rows that come: no other row is read."""
        parts = [self._statistics(folder, base)]
        parts += [postings.term_counts(gone).withColumn("df", -F.col("df"))] if gone is not None else []
        parts += [postings.term_counts(new)] if new is not None else []
        return reduce(DataFrame.unionByName, parts).groupBy("term").agg(F.sum("df").alias("df")).where("df <> 0")

    def term_statistics(self, name: str, at: Snapshot | None = None) -> DataFrame:
        """(term, df) of a collection, kept beside its sparse batches; the null term counts the points."""
        folder = self.resolve(name)
        at = at or self.snapshot(folder)
        if not at.has("sparse"):
            raise LookupError(f"collection {folder} has no sparse")
        return self._statistics(folder, at).groupBy("term").agg(F.sum("df").alias("df"))

    def index_sparse(self, name: str, **options) -> None:
        """Posting lists of the sparse batches that have none yet."""
        folder = self._writable(name)

        def make(base: Snapshot) -> dict | None:
            made = []
            for batch in base.batches.get("sparse", []):
                if not batch.get("postings"):
                    target = f"postings/{uuid.uuid4().hex}"
                    blocks = postings.point_blocks(self._rows(folder, [batch]), **options)
                    if not blocks.where(F.size("indices") > 0).isEmpty():
                        postings.write_postings(blocks, f"{self.root}/{folder}/{target}")
                        made.append({"folder": batch["folder"], "postings": target})
            return {"changes": [{"component": "sparse", "mode": "describe", "batches": made}]} if made else None

        self._commit(folder, make)

    def sparse_postings(self, name: str, at: Snapshot | None = None) -> DataFrame | None:
        """Posting lists of all sparse batches, blocks told apart by batch; None while a batch has none."""
        folder = self.resolve(name)
        at = at or self.snapshot(folder)
        batches = at.batches.get("sparse", [])
        if not batches or any(not b.get("postings") for b in batches):
            return None
        parts = [self.spark.read.parquet(f"{self.root}/{folder}/{b['postings']}").withColumn("block", F.struct(F.lit(i).alias("batch"), F.col("block"))) for i, b in enumerate(batches)]
        return reduce(lambda a, b: a.unionByName(b), parts)

    def sparse_long(self, name: str) -> DataFrame:
        from hybridloom.operators.topk import long_sparse
        return long_sparse(self.read(name, "sparse").select("id", F.col("sparse")))
