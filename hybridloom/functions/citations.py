"""Citation masking, so that sentence splitting does not break inside references."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hybridloom.functions import text as tx

# Citation patterns in the order they are masked.
BRACKETED = r"\[(?:\d+(?:\s*[-–]\s*\d+)?(?:\s*,\s*\d+(?:\s*[-–]\s*\d+)?)*)\]"
_AUTHOR = r"[A-Z][A-Za-z'\-]+(?:\s+(?:et\s+al\.|&\s*[A-Z][A-Za-z'\-]+))?,?\s*\d{4}"
AUTHOR_YEAR = rf"\((?:{_AUTHOR}(?:\s*;\s*{_AUTHOR})*)\)"
# Lookaheads for the first letters pass over most places of a text before an alternative is tried.
NUMBERED = r"(?i)(?=[fetsr][iqae])(?:Fig(?:s)?|Eq(?:s)?|Tab(?:le)?|Sec|Ref)\.\s*\d+\."
ABBREVIATIONS = ["et al.", "i.e.", "e.g.", "cf.", "Figs.", "Fig.", "Eqs.", "Eq.", "Tab.", "Sec.", "Ref.",
                 "Vol.", "No.", "vs."]


def _abbreviation_pattern() -> str:
    longest_first = sorted(ABBREVIATIONS, key=len, reverse=True)
    first = r"(?-iU:(?=[CEFINRSTVcefinrstv\x80-\x{10FFFF}][AEFIOQSTaefioqst.\x80-\x{10FFFF}]))"
    return rf"(?iU){first}(?<!\w)(?:" + "|".join(a.replace(".", r"\.") for a in longest_first) + ")"


PLACEHOLDER = r"__CITE_(\d+)__"
# Stands around a match while a text is masked.
MARK = "\u0002"
PATTERNS = [BRACKETED, AUTHOR_YEAR, NUMBERED, _abbreviation_pattern()]


def _placeholder(i: Column) -> Column:
    return F.concat(F.lit("__CITE_"), i.cast("string"), F.lit("__"))


def mask(value: Column) -> Column:
    """struct<masked, spans>: placeholder i stands for spans[i].

    Each pattern is one pass that marks its matches; the pieces between them are joined by numbered placeholders. A text that holds the mark itself is
    gone through twice, for pieces and for matches.
    """
    def one_pass(pattern: str):
        def step(state: Column) -> Column:
            text, start = state["masked"], F.size(state["spans"])
            found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
            twice = tx.bind(F.split(text, pattern), lambda pieces: F.array_join(
                F.transform(pieces, lambda p, i: F.when(
                    i < F.size(pieces) - 1, F.concat(p, _placeholder(i + start))).otherwise(p)), ""))
            once = tx.bind(F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1), lambda pieces: _state(
                F.array_join(F.transform(pieces, lambda p, i: F.when(i % 2 == 1, _placeholder(F.shiftright(i, 1) + start)).otherwise(p)), ""),
                F.concat(state["spans"], F.filter(pieces, lambda _, i: i % 2 == 1))))
            return F.when(text.contains(MARK), _state(twice, F.concat(state["spans"], found))).otherwise(once)
        return step

    state = _state(value, F.array().cast("array<string>"))
    for pattern in PATTERNS:
        state = tx.bind(state, one_pass(pattern))
    return state


def _state(masked: Column, spans: Column) -> Column:
    return F.struct(masked.alias("masked"), spans.alias("spans"))


def restore(value: Column, spans: Column) -> Column:
    """Put the original citations back in one pass: the pieces between placeholders, each followed by its span; a number without a span stays."""
    numbers = F.regexp_extract_all(value, F.lit(PLACEHOLDER), F.lit(1))
    put = F.transform(numbers, lambda i: F.coalesce(F.get(spans, i.try_cast("int")), _placeholder(i)))
    whole = F.flatten(F.zip_with(F.split(value, PLACEHOLDER, -1), put, lambda piece, span: F.array(piece, F.coalesce(span, F.lit("")))))
    return F.array_join(whole, "")


def sentences(value: Column) -> Column:
    """Sentences of a text with citations kept whole."""
    return tx.bind(mask(value), sentences_of)


def sentences_of(masked: Column) -> Column:
    """Sentences of an already masked struct; only sentences with a placeholder are rewritten."""
    spans = masked["spans"]
    return F.transform(tx.sentences(masked["masked"]),
                       lambda s: F.when(s.contains("__CITE_"), restore(s, spans)).otherwise(s))
