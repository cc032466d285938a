"""Layout JSON (pages of typed blocks) to sections, within the row that holds the document."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hybridloom.functions import text as tx
from hybridloom.functions.headings import excluded_layout
from hybridloom.functions.html import numbered, tables_to_tsv

# Block types that carry text, and where each keeps its spans.
SPAN_FIELDS = {"title": "title_content", "paragraph": "paragraph_content",
               "code": "code_content", "algorithm": "algorithm_content"}
TEXT_BLOCKS = ["title", "paragraph", "list", "table", "code", "algorithm"]
INLINE = ["text", "equation_inline"]
PREAMBLE = "Preamble"
SPAN_LIST = "array<struct<type:string,content:string>>"


def assemble_inline(spans: Column) -> Column:
    """Join text and inline-equation spans; one space where neither side brings white space."""
    kept = F.filter(spans, lambda s: s["type"].isin(INLINE) & (F.coalesce(s["content"], F.lit("")) != ""))
    joined = F.aggregate(kept, F.lit(""), lambda acc, s: F.when(
        (acc == "") | acc.rlike(r"[ \n\t]\z") | s["content"].rlike(r"\A[ \n\t]"), F.concat(acc, s["content"])
    ).otherwise(F.concat(acc, F.lit(" "), s["content"])))
    return tx.strip(F.coalesce(joined, F.lit("")))


def _get(block: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(block, path, kind)


def _spans_text(block: Column, field: str) -> Column:
    return assemble_inline(_get(block, f"$.content.{field}", SPAN_LIST))


def _list_text(block: Column) -> Column:
    items = _get(block, "$.content.list_items", "array<variant>")
    texts = F.transform(items, lambda i: assemble_inline(F.try_variant_get(i, "$.item_content", SPAN_LIST)))
    return F.coalesce(F.array_join(F.filter(texts, lambda t: t != ""), "\n"), F.lit(""))


def _level(block: Column) -> Column:
    """Only a JSON integer of at least one is a level."""
    raw = F.schema_of_variant(_get(block, "$.content.level", "variant"))
    value = _get(block, "$.content.level", "int")
    return F.when((raw == "BIGINT") & (value >= 1), value).otherwise(F.lit(1))


def blocks(document: Column) -> Column:
    """array<struct<kind, text, level>> of the text-bearing blocks in reading order."""
    pages = F.try_variant_get(F.try_parse_json(document), "$", "array<variant>")
    lists = F.filter(F.transform(pages, lambda p: F.try_variant_get(p, "$", "array<variant>")), lambda p: p.isNotNull())
    kind_of = lambda b: F.coalesce(_get(b, "$.type", "string"), F.lit(""))
    typed = F.filter(F.flatten(lists), lambda b: kind_of(b).isin(TEXT_BLOCKS))
    tables = tables_to_tsv(F.transform(typed, lambda b: F.when(kind_of(b) == "table", _get(b, "$.content.html", "string"))))
    listed = F.zip_with(typed, tables, lambda b, t: F.struct(b.alias("b"), kind_of(b).alias("kind"), t.alias("tsv")))

    def body(x: Column) -> Column:
        block, kind = x["b"], x["kind"]
        table = F.concat_ws("\n", F.nullif(_spans_text(block, "table_caption"), F.lit("")),
                            F.nullif(F.coalesce(x["tsv"], F.lit("")), F.lit("")))
        text = F.when(kind == "list", _list_text(block)).when(kind == "table", table)
        for name, field in SPAN_FIELDS.items():
            text = text.when(kind == name, _spans_text(block, field))
        return F.struct(kind.alias("kind"), text.alias("text"), _level(block).alias("level"))

    return F.filter(F.transform(listed, body), lambda b: (b["kind"] == "title") | (tx.strip(b["text"]) != ""))


def sections_of(found: Column) -> Column:
    """Sections of a block array: a title opens one, text before the first title is the preamble."""
    return tx.bind(found, _sections_of)


def _sections_of(found: Column) -> Column:
    marks = F.filter(F.transform(found, lambda b, i: F.when(b["kind"] == "title", i)), lambda i: i.isNotNull())

    def spans_of(at: Column) -> Column:
        return F.transform(F.concat(F.array(F.lit(-1)), at), lambda a, j: F.struct(
            a.alias("at"), F.coalesce(F.get(at, j), F.size(found)).alias("until")))

    def content(s: Column) -> Column:
        inside = F.slice(found, s["at"] + 2, F.greatest(s["until"] - s["at"] - 1, F.lit(0)))
        return F.array_join(F.transform(inside, lambda b: b["text"]), "\n\n")

    opened = F.transform(tx.bind(marks, spans_of), lambda s: F.struct(
        F.when(s["at"] < 0, F.lit(PREAMBLE)).otherwise(F.get(found, s["at"])["text"]).alias("title"),
        content(s).alias("content"),
        F.when(s["at"] < 0, F.lit(1)).otherwise(F.get(found, s["at"])["level"]).alias("heading_level")))
    filled = F.filter(opened, lambda s: tx.strip(s["content"]) != "")
    # A title block without spans is named by the number of sections finished before it.
    titled = F.transform(filled, lambda s, i: F.struct(
        F.when(s["title"] == "", F.concat(F.lit("Untitled-"), i.cast("string"))).otherwise(s["title"]).alias("title"),
        s["content"].alias("content"), s["heading_level"].alias("heading_level")))
    return numbered(F.filter(titled, lambda s: ~excluded_layout(s["title"], s["heading_level"])))


def sections(document: Column) -> Column:
    return sections_of(blocks(document))
