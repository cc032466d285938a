"""Command line: python -m hybridloom.plans.cli --root DIR COMMAND …"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, functions as F

from hybridloom.config import SearchSettings
from hybridloom.plans import ingest as ing
from hybridloom.plans.search import SearchEngine
from hybridloom.session import build_session
from hybridloom.sources import books, files, layouts, library, sidecar
from hybridloom.sources.store import CollectionStore


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="hybridloom")
    root.add_argument("--root", required=True, help="folder of the collections")
    commands = root.add_subparsers(dest="command", required=True)
    commands.add_parser("health")
    commands.add_parser("list-collections")
    for name in ("create-collection", "delete-collection", "list-books"):
        commands.add_parser(name).add_argument("collection")
    for name in ("ingest", "ingest-dense", "ingest-sparse", "ingest-papers", "ingest-library"):
        command = commands.add_parser(name)
        command.add_argument("collection")
        command.add_argument("folder")
        if name == "ingest-papers":
            command.add_argument("--metadata-dir")
        if name == "ingest-library":
            command.add_argument("--unknown", choices=("error", "ignore"), default="error", help="what to do with files that no loader reads")
    search = commands.add_parser("search")
    search.add_argument("query")
    search.add_argument("--collection")
    search.add_argument("--top-k", type=int, default=10)
    return root


def run(args: argparse.Namespace, spark=None):
    spark = spark or build_session()
    store = CollectionStore(spark, args.root)
    engine = SearchEngine(spark, store, SearchSettings(collections=tuple(store.names()), default_collection=next(iter(store.names()), None)))
    if args.command == "health":
        return {"spark": spark.version, "collections": len(store.names())}
    if args.command == "list-collections":
        return store.info()
    if args.command == "create-collection":
        return {"created": store.create(args.collection)}
    if args.command == "delete-collection":
        store.drop(args.collection)
        return {"deleted": args.collection}
    if args.command == "list-books":
        return engine.list_books(args.collection)
    if args.command == "search":
        return engine.search(args.query, top_k=args.top_k, collection=args.collection)
    if args.command == "ingest-papers":
        papers = layouts.sections(layouts.discover(spark, args.folder))
        if args.metadata_dir:
            meta = sidecar.read_sidecars(spark, args.metadata_dir, ".pdf.metadata.json").select(F.translate("name", "_", ".").alias("arxiv_id"), "meta")
            given = lambda key: F.col("meta")[key]
            papers = papers.join(meta, "arxiv_id", "left").withColumns({"book_title": F.lit(""), "category": given("category"), "subcategory": given("subcategory"),
                                                                        "publish_date": given("publish_date")}).drop("meta")
        return ing.ingest_papers(store, args.collection, papers)
    if args.command == "ingest-library":
        library.register(spark)
        found = spark.read.format("library").options(recursive="true", unknown=args.unknown).load(args.folder)
        return {**ing.ingest(store, args.collection, library.sections(found)), "unreadable_files": found.filter("error IS NOT NULL").count()}
    rows, unreadable = library_sections(spark, args.folder)
    dense = {} if args.command != "ingest-sparse" else {"dense": None}
    sparse = {} if args.command != "ingest-dense" else {"sparse": None}
    return {**ing.ingest(store, args.collection, rows, **dense, **sparse), "unreadable_files": unreadable.count()}


def library_sections(spark, folder: str) -> tuple[DataFrame, DataFrame]:
    """Sections of the EPUB and PDF files of a folder, by extension, and the files that no loader could read (name, error).

    A PDF is taken from its layout document where the folder has one, else from its own text.
    """
    listed = files.list_files(spark, folder, ["epub", "pdf"])
    found = books.read_epubs(listed.filter("ext = 'epub'"))
    sections = books.book_sections(sidecar.override(found, sidecar.read_sidecars(spark, folder)) if _matches(spark, folder, "*.metadata.json") else found)
    rows = sections.withColumn("source_file", F.col("name")).withColumn("doc_type", F.lit("book")).withColumnRenamed("publication_date", "publish_date")
    pdfs = listed.filter("ext = 'pdf'")
    if not _matches(spark, folder, "*.[pP][dD][fF]"):
        return rows, found.filter("error IS NOT NULL").select("name", "error")
    read = books.read_pdfs(pdfs)
    plain = books.text_sections(read.filter("error IS NULL").select(F.col("name").alias("source_file"), "text"))
    unreadable = read.filter("error IS NOT NULL").select("name", "error")
    if _matches(spark, folder, f"*{layouts.LAYOUT_FILE}") or _matches(spark, folder, f"*/{layouts.LAYOUT_FILE}"):
        named = pdfs.select(F.col("name").alias("source_file"), layouts.dotted(F.regexp_replace("name", r"(?i)\.pdf$", "")).alias("arxiv_id"))
        laid = layouts.sections(layouts.discover(spark, folder)).join(named, "arxiv_id").drop("arxiv_id")
        done = laid.select("source_file").distinct()
        plain = laid.unionByName(plain.join(done, "source_file", "left_anti"), allowMissingColumns=True)
        unreadable = unreadable.join(done.withColumnRenamed("source_file", "name"), "name", "left_anti")
    papers = plain.withColumn("doc_type", F.lit("paper"))
    return rows.unionByName(papers, allowMissingColumns=True), found.filter("error IS NOT NULL").select("name", "error").unionByName(unreadable)


def _matches(spark, folder: str, glob: str) -> bool:
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{glob}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return found is not None and len(found) > 0


def main() -> None:
    print(json.dumps(run(parser().parse_args()), indent=2, default=str))


if __name__ == "__main__":
    main()
