"""Text expressions. Everything here stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Patterns and word lists that decide results.
TERM_PATTERN = r"[\p{L}\p{N}]+"
BLANK = r"(?U)\s+"
# What (?U)\s matches.
BLANKS = " \t\n\x0b\f\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"
PARAGRAPH_BREAK = r"(?U)\n\s*\n"
TITLE_ABBREVIATIONS = "Dr|Mr|Mrs|Ms|Prof|Sr|Jr|St|Vs|Rev|Gen|Gov|Sgt|Cpl|Pvt|Capt|Lt|Col|Maj"
SENTENCE_OPENER = r"""(?=[A-Z"'(])"""
STOP_WORDS = [
    "how", "what", "when", "where", "who", "why", "the", "and", "for",
    "with", "that", "this", "have", "has", "had", "not", "but", "are",
    "been", "was", "were", "being", "do", "does", "did", "will",
    "would", "could", "should", "may", "might", "can", "shall", "an",
    "a", "in", "to", "of", "or", "on", "at", "by", "from", "as", "is",
    "it", "its", "i", "me", "my", "we", "our", "you", "your",
]
CITATION_PATTERNS = [
    r"\[\d[\d, ]*\]",
    r"\([A-Z][a-z]+(?:, [A-Z][a-z]+)*, \d{4}\)",
    r"(?:et al\.|et al)\s*,\s*\d{4}",
    r"arXiv[:\s]*\d+\.\d{4,}",
]
CJK = r"[一-鿿㐀-䶿豈-﫿]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``, within one expression."""
    return F.transform(F.array(value), body)[0]


def strip(value: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(value, F.lit(BLANKS))


def words(value: Column) -> Column:
    """White-space separated words without empty ones."""
    return F.filter(F.split(value, BLANK), lambda w: w != "")


def terms(value: Column) -> Column:
    """Lower-cased letter and digit runs, in order, with repeats."""
    return F.regexp_extract_all(F.lower(value), F.lit(TERM_PATTERN), F.lit(0))


def token_estimate(value: Column) -> Column:
    """Four characters per token."""
    return F.floor(F.length(value) / 4).cast("int")


def paragraphs(value: Column) -> Column:
    return F.filter(F.transform(F.split(value, PARAGRAPH_BREAK), strip), lambda p: p != "")


def sentences(value: Column) -> Column:
    """Split after . ! ? before an upper-case letter, quote or parenthesis.

    A single letter with a dot ("U.") never ends a sentence, and a title abbreviation
    ("Dr.") keeps the following fragment, joined by one space.
    """
    # The lookahead for first letters passes over most places before the costlier tests.
    title_end = rf"(?U)(?=[CDGJLMPRSVcdgjlmprsv\x80-\x{{10FFFF}}][AEGOPRSTVaegoprstv\x80-\x{{10FFFF}}])(?<![^\s])((?i:{TITLE_ABBREVIATIONS})\.)\s+{SENTENCE_OPENER}"
    glued = F.regexp_replace(value, title_end, "$1\u0001")
    cut = rf"(?U)(?-U:(?=[\t-\r \x80-\x{{10FFFF}}]))(?<=[.!?])(?<!\b\w\.)\s+{SENTENCE_OPENER}"
    parts = F.transform(F.split(glued, cut), lambda s: F.replace(strip(s), F.lit("\u0001"), F.lit(" ")))
    return F.filter(parts, lambda s: s != "")


def query_terms(value: Column, min_length: int = 3) -> Column:
    """Distinct ASCII words of a query without stop words, sorted."""
    found = F.regexp_extract_all(F.lower(value), F.lit("[A-Za-z]+"), F.lit(0))
    kept = F.filter(F.array_distinct(found), lambda w: F.length(w) >= min_length)
    return F.array_sort(F.array_except(kept, F.array(*[F.lit(w) for w in STOP_WORDS])))


def has_citation(value: Column) -> Column:
    """True where any of the academic citation markers occurs."""
    hit = value.rlike(CITATION_PATTERNS[0])
    for pattern in CITATION_PATTERNS[1:]:
        hit = hit | value.rlike(pattern)
    return hit


def has_cjk(value: Column) -> Column:
    return value.rlike(CJK)


def word_windows(value: Column, size: int) -> Column:
    """Consecutive windows of ``size`` words, each joined by single spaces."""
    window = rf"(?U)\S+(?:\s+\S+){{0,{size - 1}}}"
    return F.transform(F.regexp_extract_all(value, F.lit(window), F.lit(0)), lambda w: F.regexp_replace(w, BLANK, " "))


def fingerprint(value: Column, opening: int | None = None) -> Column:
    """Comparison key of a passage: a hash of the whole text, trimmed and lower-cased; of its first ``opening`` characters where given."""
    part = value if opening is None else F.substring(value, 1, opening)
    return F.md5(F.lower(strip(part)))


def document_url(value: Column) -> Column:
    return F.concat(F.lit("https://arxiv.org/abs/"), F.translate(value, "_", "."))


def collection_name(value: Column) -> Column:
    kept = F.regexp_replace(F.lower(strip(value)), r"[^\p{L}\p{N}\-_.]", "")
    return F.substring(kept, 1, 63)


def metadata_prefix(category: Column, subcategory: Column, date: Column, section: Column) -> Column:
    """``category:… subcategory:… date:… section:…`` with absent parts left out."""
    def part(label: str, value: Column) -> Column:
        return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(label + ":"), value))

    return F.concat_ws(" ", part("category", category), part("subcategory", subcategory),
                       part("date", date), part("section", section))


def has_line_loop(value: Column, shortest: int = 2) -> Column:
    """True when the last K non-empty lines equal the K non-empty lines before them for some K of ``shortest`` or more."""
    lines = F.split(value, r"\r\n|\r|\n")

    def repeated(kept: Column) -> Column:
        n = F.size(kept)
        lengths = F.sequence(F.lit(shortest), F.greatest(F.floor(n / 2).cast("int"), F.lit(shortest)))
        found = F.exists(lengths, lambda k: F.slice(kept, F.greatest(n - k + 1, F.lit(1)), k)
                         == F.slice(kept, F.greatest(n - 2 * k + 1, F.lit(1)), k))
        return (n >= 2 * shortest) & found

    return bind(F.filter(lines, lambda s: strip(s) != ""), repeated)
