"""Books, papers and layout documents of a folder as one table: ``spark.read.format("library")`` and ``readStream``."""

from __future__ import annotations

import fnmatch
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from hybridloom.functions import layout
from hybridloom.sources import books
from hybridloom.sources.files import loader_for

#: One row per file. items are a book's documents in reading order; text is what a paper holds, as pages or as layout JSON.
SCHEMA = ("path string, name string, kind string, size long, modified long, title string, creator string, publisher string, publication_date string, "
          "language string, rights string, isbn string, items array<string>, text string, error string")
_COLUMNS = [part.split()[0] for part in SCHEMA.split(", ")]
#: Files that belong to another one.
SIDECARS = ("*.metadata.json",)


@dataclass
class Files(InputPartition):
    """Paths with their sizes and times of change, of about a task's share of bytes."""
    listed: list[tuple[str, int, int]]


def _listing(folder: str, recursive: bool) -> list[tuple[str, int, int]]:
    """(path, size, modified in ns) of the files below a folder, in order of their names; only names and sizes are read."""
    found, stack = [], [folder]
    while stack:
        with os.scandir(stack.pop()) as entries:
            for entry in entries:
                if entry.is_dir():
                    if recursive:
                        stack.append(entry.path)
                elif not entry.name.startswith((".", "_")) and not any(fnmatch.fnmatch(entry.name.lower(), s) for s in SIDECARS):
                    stat = entry.stat()
                    found.append((entry.path, stat.st_size, stat.st_mtime_ns))
    return sorted(found)


def _dealt(files: list[tuple[str, int, int]], share: int) -> list[Files]:
    parts, held, used = [], [], 0
    for file in files:
        if held and used + file[1] > share:
            parts.append(Files(held))
            held, used = [], 0
        held.append(file)
        used += file[1]
    return [*parts, Files(held)]


def _load(path: str, size: int, modified: int) -> dict:
    """A file's row by the loader of its extension; a damaged file has an error."""
    name = os.path.basename(path)
    kind = loader_for(name)
    row = {"path": path, "name": name, "kind": kind, "size": size, "modified": modified}
    try:
        with open(path, "rb") as file:
            content = file.read()
        if kind == "epub":
            return row | books.unpack_epub(name, content)
        if kind == "pdf":
            return row | books.unpack_pdf(name, content)
        text = content.decode("utf-8")
        if not isinstance(json.loads(text), list):
            raise ValueError("no list of pages")
        return row | {"text": text}
    except Exception as problem:  # a row with an error, as the file loaders give it
        return row | {"error": str(problem)[:500]}


def _rows(partition: Files) -> Iterator[tuple]:
    for file in partition.listed:
        row = _load(*file)
        yield tuple(row.get(c) for c in _COLUMNS)


class _Base:
    def __init__(self, options):
        if not options.get("path"):
            raise ValueError("the library source needs a path")
        self.folder = options["path"].removeprefix("file://")
        self.recursive = str(options.get("recursive", "false")).lower() == "true"
        self.share = int(options.get("bytesPerTask", 32 << 20))
        self.unknown = options.get("unknown", "error")
        self.kind, self.pattern = options.get("kind"), options.get("nameGlob", "*")
        if self.unknown not in ("error", "ignore"):
            raise ValueError("unknown must be error or ignore")

    def files(self) -> list[tuple[str, int, int]]:
        """Files of the asked names and kind that have a loader. Without one a file is an error, unless the option says to pass over it. What is not asked for
        is not opened. (These are options, as pushed filters of several scans of one frame would overwrite each other.)"""
        kept = []
        for file in _listing(self.folder, self.recursive):
            name = os.path.basename(file[0])
            if fnmatch.fnmatch(name, self.pattern):
                try:
                    if loader_for(name) == (self.kind or loader_for(name)):
                        kept.append(file)
                except ValueError:
                    if self.unknown == "error":
                        raise
        return kept


class LibraryReader(_Base, DataSourceReader):
    def partitions(self) -> list[Files]:
        return _dealt(self.files(), self.share)

    def read(self, partition: Files) -> Iterator[tuple]:
        return _rows(partition)


class LibraryStream(_Base, DataSourceStreamReader):
    """New and changed files, in order of their times of change. An offset is the newest time and the names that share it, so it stays small."""

    def initialOffset(self) -> dict:
        return {"modified": 0, "names": []}

    def latestOffset(self) -> dict:
        files = self.files()
        newest = max((f[2] for f in files), default=0)
        return {"modified": newest, "names": sorted(f[0] for f in files if f[2] == newest)}

    @staticmethod
    def _passed(file: tuple[str, int, int], offset: dict) -> bool:
        return file[2] < offset["modified"] or (file[2] == offset["modified"] and file[0] in offset["names"])

    def partitions(self, start: dict, end: dict) -> list[Files]:
        return _dealt([f for f in self.files() if self._passed(f, end) and not self._passed(f, start)], self.share)

    def read(self, partition: Files) -> Iterator[tuple]:
        return _rows(partition)

    def commit(self, end: dict) -> None:
        pass


class LibrarySource(DataSource):
    """Files of a mounted folder that all workers see, such as a network share; object stores are read with
    :func:`hybridloom.sources.files.list_files`. Options: path, recursive, kind (epub, pdf or layout), nameGlob, bytesPerTask,
    unknown (error or ignore)."""

    @classmethod
    def name(cls) -> str:
        return "library"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return LibraryReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LibraryStream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LibrarySource)


def sections(files: DataFrame) -> DataFrame:
    """Sections of library rows with what ingest needs: books by chapter, papers by heading or layout. Rows with an error have none."""
    good = files.filter("error IS NULL")
    read = books.book_sections(good.filter("kind = 'epub'").select("name", "title", "creator", "publisher", "publication_date", "language", "rights", "isbn", "items", "error"))
    told = read.withColumns({"source_file": F.col("name"), "doc_type": F.lit("book")}).withColumnRenamed("publication_date", "publish_date")
    papers = good.filter("kind <> 'epub'").select(F.col("name").alias("source_file"), "kind", "text", F.lit("paper").alias("doc_type"))
    plain = books.text_sections(papers.filter("kind = 'pdf'").drop("kind"))
    laid = papers.filter("kind = 'layout'").select("source_file", "doc_type", F.inline(layout.sections(F.col("text"))))
    return told.unionByName(plain, allowMissingColumns=True).unionByName(laid, allowMissingColumns=True)
