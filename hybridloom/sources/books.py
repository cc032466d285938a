"""EPUB and PDF files as tables. A small per-file helper unpacks the container, the rest are expressions."""

from __future__ import annotations

import io
import posixpath
import urllib.parse
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from hybridloom.functions import headings, html, text as tx

# Document namespaces and the shortest PDF text that counts.
DC = "{http://purl.org/dc/elements/1.1/}"
OPF = "{http://www.idpf.org/2007/opf}"
CONTAINER = "{urn:oasis:names:tc:opendocument:xmlns:container}"
SHORTEST_PDF = 100
BOOK_SCHEMA = ("name string, title string, creator string, publisher string, publication_date string, language string, "
               "rights string, isbn string, items array<string>, error string")


def unpack_epub(name: str, content: bytes) -> dict:
    """Metadata and the spine documents of one EPUB."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        rootfile = ElementTree.fromstring(archive.read("META-INF/container.xml")).find(f".//{CONTAINER}rootfile").get("full-path")
        package = ElementTree.fromstring(archive.read(rootfile))
        texts = lambda tag: [(e.text or "").strip() for e in package.iter(DC + tag) if (e.text or "").strip()]
        first = lambda tag, default=None: next(iter(texts(tag)), default)
        identifiers = [e for e in package.iter(DC + "identifier") if (e.text or "").strip()]
        isbn = next((e for e in identifiers if "isbn" in (e.get(OPF + "scheme") or "").lower()), next(iter(identifiers), None))
        hrefs = {i.get("id"): i.get("href") for i in package.iter(OPF + "item")}
        folder, names, items = posixpath.dirname(rootfile), set(archive.namelist()), []
        for ref in package.iter(OPF + "itemref"):
            href = hrefs.get(ref.get("idref"))
            path = posixpath.normpath(posixpath.join(folder, urllib.parse.unquote(href))) if href else None
            if path in names:
                items.append(archive.read(path).decode("utf-8", errors="replace"))
    return {"name": name, "title": first("title", name.rsplit(".", 1)[0]), "creator": first("creator", "Unknown"),
            "publisher": first("publisher"), "publication_date": first("date"), "language": first("language"),
            "rights": first("rights"), "isbn": isbn.text.strip() if isbn is not None else None, "items": items, "error": None}


def _each(unpack, columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                try:
                    row = unpack(name, content)
                except Exception as problem:  # a damaged file becomes a row with an error
                    row = {"name": name, "error": str(problem)[:500]}
                yield pd.DataFrame([{c: row.get(c) for c in columns}])
    return run


def read_epubs(files: DataFrame) -> DataFrame:
    """One row per book with its spine items. ``files``: name, content."""
    columns = [part.split()[0] for part in BOOK_SCHEMA.split(", ")]
    return files.select("name", "content").mapInPandas(_each(unpack_epub, columns), BOOK_SCHEMA)


def book_sections(books: DataFrame) -> DataFrame:
    """Sections of every book. Items without text do not count as chapters; contents of up to 20 characters drop out."""
    meta = [c for c in books.columns if c not in ("items", "error")]
    readable = books.filter(F.col("error").isNull()).withColumn("cleaned", html.clean_all("items"))
    kept = F.filter(F.col("items"), lambda i, at: F.get("cleaned", at) != "")
    chapters = readable.select(*meta, F.posexplode(kept).alias("chapter_index", "item"))
    found = chapters.select(*meta, "chapter_index", html.sections(F.col("item")).alias("s"))
    rows = found.select(*[c if c != "title" else F.col("title").alias("book_title") for c in meta], "chapter_index", F.inline_outer("s"))
    return rows.filter(F.length("content") > html.SHORT_CONTENT)


def unpack_pdf(name: str, content: bytes) -> dict:
    """Page texts joined by a blank line; needs the optional PDF reader."""
    from pypdf import PdfReader  # optional dependency

    pages = [page.extract_text() or "" for page in PdfReader(io.BytesIO(content)).pages]
    return {"name": name, "text": "\n\n".join(pages), "error": None}


PDF_SCHEMA = "name string, text string, error string"


def read_pdfs(files: DataFrame) -> DataFrame:
    """Text of every PDF; unreadable ones and those below 100 characters carry an error."""
    read = files.select("name", "content").mapInPandas(_each(unpack_pdf, ["name", "text", "error"]), PDF_SCHEMA)
    short = F.length(tx.strip(F.coalesce("text", F.lit("")))) < SHORTEST_PDF
    return read.withColumn("error", F.coalesce("error", F.when(short, "too little text")))


def first_success(backends: list[DataFrame], key: str = "name") -> DataFrame:
    """Rows of the first backend that read a file; what failed goes to the next one.

    Every backend lists (key, …, error); a failure has an error.
    """
    done = backends[0].filter(F.col("error").isNull())
    for backend in backends[1:]:
        good = backend.filter(F.col("error").isNull())
        done = done.unionByName(good.join(done.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)
    return done


def text_sections(papers: DataFrame, markdown: bool = False, text: str = "text") -> DataFrame:
    """Sections of plain or Markdown paper texts."""
    split = headings.markdown_sections if markdown else headings.paper_sections
    keep = [c for c in papers.columns if c not in (text, "error")]
    return papers.select(*keep, F.inline(split(F.col(text))))
