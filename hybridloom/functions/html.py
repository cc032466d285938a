"""HTML to clean text, headings and sections. Only entity decoding and table cells leave the JVM."""

from __future__ import annotations

import html as html_entities
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from hybridloom.functions import text as tx
from hybridloom.functions.slices import in_slices

# Patterns that decide what counts as markup.
HEADING = r"(?is)<h([1-3])[^>]*>(.*?)</h\1>"
TAG = r"<[^>]+>"
SCRIPT = r"(?s)<script[^>]*>.*?</script>"
STYLE = r"(?s)<style[^>]*>.*?</style>"
NO_TITLE = "(no title)"
SHORT_CONTENT = 20
# Tags without attributes, whose content is no raw text; markup of nothing else needs no parser.
PLAIN_TAG = re.compile(r"<(/?(?:table|thead|tbody|tfoot|tr|td|th|b|i|p))>", re.IGNORECASE | re.ASCII)


@F.arrow_udf(T.ArrayType(T.StringType()))
@in_slices
def _unescape(lists: pa.Array) -> pa.Array:
    coded = lists.flatten().dictionary_encode()
    decoded = pa.array([None if s is None else html_entities.unescape(s) for s in coded.dictionary.to_pylist()], pa.string())
    lengths = [n or 0 for n in lists.value_lengths().to_pylist()]
    offsets, at = [0], 0
    for n in lengths:
        at += n
        offsets.append(at)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), decoded.take(coded.indices))


class _Table(HTMLParser):
    """Collects the stripped cell texts of every table row."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.inside = False

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
            self.inside = False
        elif tag in ("td", "th") and self.rows:
            self.rows[-1].append("")
            self.inside = True

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr"):
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.rows[-1][-1] += data.strip()


def _plain_rows(parts: list[str]) -> list[list[str]]:
    """The rows :class:`_Table` finds, from markup cut at its tags: a text, a tag, a text and so on."""
    rows: list[list[str]] = []
    inside = False
    for tag, data in zip(parts[1::2], parts[2::2]):
        name = tag.lower()
        if name in ("td", "th"):
            if rows:
                rows[-1].append("")
                inside = True
        elif name == "tr":
            rows.append([])
            inside = False
        elif name in ("/td", "/th", "/tr"):
            inside = False
        if inside and data:
            rows[-1][-1] += (html_entities.unescape(data) if "&" in data else data).strip()
    return rows


def table_to_tsv(markup: str | None) -> str:
    if not markup or not markup.strip():
        return ""
    parts = PLAIN_TAG.split(markup)
    if markup.count("<") == len(parts) // 2:  # every tag is plain
        rows = _plain_rows(parts)
    else:
        parser = _Table()
        parser.feed(markup)
        parser.close()
        rows = parser.rows
    return "\n".join("\t".join(cells) for cells in rows if cells)


@F.arrow_udf(T.ArrayType(T.StringType()))
@in_slices
def tables_to_tsv(lists: pa.Array) -> pa.Array:
    """Rows of every HTML table of an array, cells joined by tabs."""
    return pa.array([None if row is None else [table_to_tsv(m) for m in row] for row in lists.to_pylist()],
                    pa.list_(pa.string()))


def _without_scripts(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(value, SCRIPT, ""), STYLE, "")


def _without_tags(value: Column) -> Column:
    bare = F.regexp_replace(value, TAG, "")
    return tx.strip(F.regexp_replace(F.regexp_replace(bare, r"\n+", "\n"), r" {2,}", " "))


def clean_all(values: Column) -> Column:
    """Clean every element: scripts out, entities decoded, then tags out, white space collapsed."""
    return F.transform(_unescape(F.transform(values, _without_scripts)), _without_tags)


def clean(value: Column) -> Column:
    return clean_all(F.array(value))[0]


def headings(value: Column) -> Column:
    """array<struct<level, title>> of the h1-h3 headings with a non-empty title."""
    levels = F.regexp_extract_all(value, F.lit(HEADING), F.lit(1))
    inner = F.regexp_extract_all(value, F.lit(HEADING), F.lit(2))
    pairs = F.zip_with(levels, inner, lambda level, t: F.struct(
        level.cast("int").alias("level"), tx.strip(F.regexp_replace(t, TAG, "")).alias("title")))
    return F.filter(pairs, lambda h: h["title"] != "")


def sections(value: Column) -> Column:
    """array<struct<section_index, title, content, heading_level>> of a page.

    Text before the first heading is dropped, an empty heading still ends the section before it,
    contents of at most 20 characters drop out, and a page left without any becomes one
    untitled section.
    """
    parsed = F.struct(F.regexp_extract_all(value, F.lit(HEADING), F.lit(1)).alias("levels"),
                      F.regexp_extract_all(value, F.lit(HEADING), F.lit(2)).alias("inner"),
                      clean_all(F.concat(F.split(value, HEADING), F.array(value))).alias("cleaned"))
    return tx.bind(parsed, _sections_of)


def _sections_of(page: Column) -> Column:
    made = F.transform(page["levels"], lambda level, i: F.struct(
        tx.strip(F.regexp_replace(F.get(page["inner"], i), TAG, "")).alias("title"),
        F.get(page["cleaned"], i + 1).alias("content"), level.cast("int").alias("heading_level")))
    whole = F.struct(F.lit(NO_TITLE).alias("title"), F.element_at(page["cleaned"], -1).alias("content"),
                     F.lit(0).alias("heading_level"))
    titled = F.filter(made, lambda s: (s["title"] != "") & (F.length(s["content"]) > SHORT_CONTENT))
    return numbered(tx.bind(titled, lambda kept: F.when(F.size(kept) > 0, kept).otherwise(
        F.filter(F.array(whole), lambda s: s["content"] != ""))))


def numbered(found: Column) -> Column:
    """Add a 0-based section_index to an array of section structs."""
    return F.transform(found, lambda s, i: F.struct(
        i.alias("section_index"), s["title"].alias("title"), s["content"].alias("content"),
        s["heading_level"].alias("heading_level")))
