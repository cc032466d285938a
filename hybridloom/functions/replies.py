"""Parsing of model replies: wrappers, judge documents, scores and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hybridloom.functions import text as tx

# Reply formats.
THINK = r"(?is)<think>.*?</think>\s*"
OPEN_THINK = r"(?is)^.*?</think>\s*"
JUDGE_SCHEMA = "struct<chunks:array<struct<id:variant,relevance:variant,reason:string>>,reply:string,satisfaction:variant>"
UNIT_SCORE = r"\b(0(?:\.\d+)?|1(?:\.0+)?|\.\d+)\b"


def strip_fences(value: Column) -> Column:
    """Remove a surrounding ``` fence with its optional language tag."""
    trimmed = tx.strip(value)
    opened = F.regexp_replace(trimmed, r"^```[^\n]*\n?", "")
    closed = F.regexp_replace(opened, r"(?s)\s*```\s*$", "")
    return F.when(trimmed.startswith("```"), tx.strip(closed)).otherwise(trimmed)


def strip_wrappers(value: Column) -> Column:
    """Remove think blocks, an unopened think end, and fences."""
    bare = F.regexp_replace(tx.strip(value), THINK, "")
    orphan = F.lower(bare).contains("</think>") & ~F.lower(bare).contains("<think>")
    return strip_fences(F.when(orphan, F.regexp_replace(bare, OPEN_THINK, "")).otherwise(bare))


def repair_json(value: Column) -> Column:
    """Escape bare line breaks and tabs inside string literals.

    The text is cut at unescaped quotes; every second piece is the inside of a literal.
    """
    pieces = F.split(value, r'(?<!\\)(?:\\\\)*"')
    quotes = F.regexp_extract_all(value, F.lit(r'(?<!\\)((?:\\\\)*")'), F.lit(1))

    def escape(piece: Column) -> Column:
        for raw, escaped in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            piece = F.replace(piece, F.lit(raw), F.lit(escaped))
        return F.regexp_replace(piece, r"[\x00-\x1f]", " ")

    fixed = F.transform(pieces, lambda p, i: F.concat(
        F.when(F.pmod(i, F.lit(2)) == 1, escape(p)).otherwise(p), F.coalesce(F.get(quotes, i), F.lit(""))))
    return F.array_join(fixed, "")


def _is(value: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(value) == kind, F.lit(False))


def parse_judgement(raw: Column, issued: Column) -> Column:
    """Parse and validate one judge reply.

    ``issued`` lists the ids that were shown. Repeated ids collapse to the first. The result is
    struct<parsed, parse_ok, error>; relevance must be an integer of any size, satisfaction 1..10.
    """
    parsed = F.from_json(repair_json(strip_wrappers(raw)), JUDGE_SCHEMA)
    return tx.bind(parsed, lambda p: _validated(p, issued))


def _validated(parsed: Column, issued: Column) -> Column:
    named = F.transform(F.filter(parsed["chunks"], lambda c: _is(c["id"], "STRING")), lambda c: F.struct(
        F.try_variant_get(c["id"], "$", "string").alias("id"),
        F.when(_is(c["relevance"], "BIGINT"), F.try_variant_get(c["relevance"], "$", "int")).alias("relevance"),
        c["reason"].alias("reason")))
    return tx.bind(tx.bind(named, _first_of_each), lambda kept: _verdict(parsed, kept, issued))


def _first_of_each(named: Column) -> Column:
    ids = F.transform(named, lambda c: c["id"])
    return F.filter(named, lambda c, i: F.array_position(ids, c["id"]) == i + 1)


def _verdict(parsed: Column, kept: Column, issued: Column) -> Column:
    satisfaction = F.when(_is(parsed["satisfaction"], "BIGINT"), F.try_variant_get(parsed["satisfaction"], "$", "int"))
    error = (F.when(parsed.isNull() | parsed["chunks"].isNull(), "missing chunks")
             .when(F.size(kept) != F.size(issued), "chunks array length mismatch")
             .when(F.exists(kept, lambda c: ~F.array_contains(issued, c["id"])), "unknown id")
             .when(F.exists(kept, lambda c: c["relevance"].isNull()), "relevance not int")
             .when(parsed["reply"].isNull(), "missing reply")
             .when(~F.coalesce(satisfaction.between(1, 10), F.lit(False)), "satisfaction not int 1..10"))
    typed = F.struct(kept.alias("chunks"), parsed["reply"].alias("reply"), satisfaction.alias("satisfaction"))
    return F.struct(F.when(error.isNull(), typed).alias("parsed"), error.isNull().alias("parse_ok"), error.alias("error"))


def unit_score(raw: Column) -> Column:
    """First number in [0, 1]: a strict reading of the whole reply, then a lenient search, else NULL."""
    bare = strip_wrappers(raw)
    strict = bare.try_cast("double")
    lenient = present_match(F.regexp_extract(bare, UNIT_SCORE, 1)).try_cast("double")
    return F.coalesce(F.when(strict.between(0.0, 1.0), strict), lenient)


def present_match(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def score_or(raw: Column, low: int, high: int, default: int, key: str = "score") -> Column:
    """Integer score of a JSON or plain reply, the default when absent or out of range."""
    bare = strip_wrappers(raw)
    value = F.coalesce(F.get_json_object(bare, f"$.{key}").try_cast("int"), bare.try_cast("int"))
    return F.coalesce(F.when(value.between(low, high), value), F.lit(default))


def winner(raw: Column) -> Column:
    """A, B or tie of a pairwise judge reply; anything unreadable is a tie."""
    said = F.get_json_object(strip_fences(raw), "$.winner")
    return F.when(said.isin("A", "B"), said).otherwise(F.lit("tie"))


def map_verdict(won: Column, a: Column, b: Column) -> Column:
    return F.when(won == "A", a).when(won == "B", b).otherwise(F.lit("tie"))


def knowledge_base_reply(raw: Column, k: int, source: str = "knowledge_base") -> Column:
    """struct<content array<struct<type, text>>, total_results, source> of a knowledge base's flat JSON list of hits.

    A hit's content is an object with text and type or a plain string; absent texts are empty, absent types TEXT. The first ``k``
    hits are listed, all are counted. No list at all is an empty one.
    """
    hits = F.coalesce(F.from_json(raw, "array<string>"), F.array().cast("array<string>"))

    def item(hit: Column) -> Column:
        content = F.get_json_object(hit, "$.content")
        is_object = F.substring(F.ltrim(F.coalesce(content, F.lit("{}"))), 1, 1) == "{"
        text = F.when(is_object, F.coalesce(F.get_json_object(hit, "$.content.text"), F.lit(""))).otherwise(content)
        kind = F.when(is_object, F.coalesce(F.get_json_object(hit, "$.content.type"), F.lit("TEXT"))).otherwise("TEXT")
        return F.struct(kind.alias("type"), text.alias("text"))

    return F.struct(F.transform(F.slice(hits, 1, k), item).alias("content"), F.size(hits).cast("long").alias("total_results"), F.lit(source).alias("source"))


def trimmed_pair(a: Column, b: Column) -> tuple[Column, Column]:
    """Both answers cut to 1.2 times the shorter one."""
    limit = (F.least(F.length(a), F.length(b)) * 1.2).cast("int")
    return F.substring(a, F.lit(1), limit), F.substring(b, F.lit(1), limit)


def markdown_of(response: Column) -> Column:
    """Markdown text of a converter response in any of its shapes."""
    paths = ["$.md_content", "$.markdown", "$.results[0].md_content", "$.results[0].markdown",
             "$[0].md_content", "$[0].markdown"]
    return F.coalesce(*[present_match(F.get_json_object(response, p)) for p in paths])
