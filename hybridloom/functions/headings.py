"""Section splitters for Markdown and for plain paper text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hybridloom.functions import text as tx
from hybridloom.functions.html import numbered

# Heading patterns and the titles left out.
MARKDOWN_HEADING = r"(?mdU)^(#{1,3})\s+(.+)"
PAPER_HEADING = (
    r"(?imdU)^(?:(?:Abstract|Introduction|Related\s+Work|Background|"
    r"Methodology|Methods?|Approach|Experiments?|Results?|Evaluation|"
    r"Discussion|Analysis|Conclusion|Summary|Future\s+Work|"
    r"References|Bibliography|Appendix)|(?:\d+\.?\s+\w.{2,60}))$")
BACK_MATTER = ["references", "bibliography", "appendix"]
LAYOUT_BACK_MATTER = ["references", "bibliography"]
LAYOUT_TOP_LEVEL_BACK_MATTER = ["appendix", "appendices"]
FULL_TEXT = "Full Text"


def excluded_markdown(title: Column) -> Column:
    """Back matter with or without a leading number, letter or word."""
    bare = F.lower(tx.strip(F.regexp_replace(title, r"^[A-Za-z0-9]+\.?\s*", "")))
    return bare.isin(BACK_MATTER) | F.lower(tx.strip(title)).isin(BACK_MATTER)


def excluded_paper(title: Column) -> Column:
    """Back matter with or without a leading number."""
    return F.lower(tx.strip(F.regexp_replace(title, r"^\d+\.?\s*", ""))).isin(BACK_MATTER)


def excluded_layout(title: Column, level: Column) -> Column:
    """References anywhere; an appendix only under exactly that title at level 1 or 2."""
    bare = F.lower(tx.strip(F.regexp_replace(tx.strip(title), r"^\d+[\.\)]\s*", "")))
    return bare.isin(LAYOUT_BACK_MATTER) | (bare.isin(LAYOUT_TOP_LEVEL_BACK_MATTER) & (level <= 2))


def _split(value: Column, pattern: str, titles: Column, levels: Column, excluded) -> Column:
    """Sections between heading matches; one "Full Text" section when there is no structure."""
    whole = F.struct(F.lit(FULL_TEXT).alias("title"), tx.strip(F.coalesce(value, F.lit(""))).alias("content"),
                     F.lit(1).alias("heading_level"))
    parsed = F.struct(titles.alias("titles"), levels.alias("levels"), F.split(value, pattern).alias("parts"))

    def build(doc: Column) -> Column:
        made = F.transform(doc["titles"], lambda t, i: F.struct(
            t.alias("title"), tx.strip(F.get(doc["parts"], i + 1)).alias("content"),
            F.get(doc["levels"], i).alias("heading_level")))
        kept = F.filter(made, lambda s: ~excluded(s["title"]) & (s["content"] != ""))
        return F.when(F.size(doc["titles"]) >= 2, kept).otherwise(F.slice(kept, 1, 0))

    return numbered(tx.bind(tx.bind(parsed, build), lambda kept: F.when(F.size(kept) > 0, kept).otherwise(F.array(whole))))


def markdown_sections(value: Column) -> Column:
    titles = F.transform(F.regexp_extract_all(value, F.lit(MARKDOWN_HEADING), F.lit(2)), tx.strip)
    levels = F.transform(F.regexp_extract_all(value, F.lit(MARKDOWN_HEADING), F.lit(1)), F.length)
    return _split(value, MARKDOWN_HEADING, titles, levels, excluded_markdown)


def paper_sections(value: Column) -> Column:
    """Named or numbered academic headers; paper sections carry no heading level."""
    titles = F.transform(F.regexp_extract_all(value, F.lit(PAPER_HEADING), F.lit(0)), tx.strip)
    levels = F.transform(titles, lambda t: F.lit(None).cast("int"))
    return _split(value, PAPER_HEADING, titles, levels, excluded_paper)


def heading_census(value: Column) -> Column:
    """How many headings of exactly each level a Markdown text has."""
    count = lambda n: F.regexp_count(value, F.lit(rf"(?m)^#{{{n}}}\s")).cast("int")
    return F.struct(count(1).alias("h1"), count(2).alias("h2"), count(3).alias("h3"))
