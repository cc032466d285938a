"""Byte-pair token counts by a table of merge ranks, as an expression and as a function."""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from hybridloom.functions.slices import in_slices

# Distinct pieces whose tokens a worker remembers.
REMEMBERED = 100_000
# Longer words are counted again each time.
REMEMBERED_LENGTH = 64
# Pieces of up to this many bytes are merged by the tiktoken library; its time grows with the square of a piece.
LIBRARY_BYTES = 128


class _Counts(dict):
    """Token counts of words that follow ``before``, filled as they are asked for."""

    def __init__(self, before: str, count: Callable[[str], int]):
        super().__init__()
        self.before, self.count = before, count

    def __missing__(self, word: str) -> int:
        found = self.count(self.before + word)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


class RankTokenizer:
    """Byte-pair encoding by ranks: in each piece of a text the adjacent pair of lowest rank is merged first, the leftmost of equal ones.

    ``ranks`` maps byte strings to their rank, single bytes included; ``pattern`` cuts a text into pieces. Ranks come from a file of "base64 rank"
    lines or from a table (token, rank); nothing is trained. ``spaced`` says of the pattern that a single blank between two characters that are
    none always begins a piece, as in GPT-2's; then the count of a text is the sum over its words, each with the blank before it.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, spaced: bool = False):
        import regex  # needed for classes such as \\p{L}

        self.ranks, self.pattern, self.spaced = ranks, pattern, spaced
        cut = regex.compile(pattern)
        self._find, self._found = cut.findall, None if cut.groups else cut.finditer
        self._words = regex.compile(r"(?<=\S) (?=\S)").split
        self._known: dict[str, tuple[int, ...]] = {}
        self._sizes = _Counts("", self._size)
        #: Counts of words at the beginning of a text and after a blank.
        self.first, self.later = _Counts("", self._counted), _Counts(" ", self._counted)

    def __reduce__(self):
        return RankTokenizer, (self.ranks, self.pattern, self.spaced)

    @classmethod
    def from_file(cls, path: str, pattern: str, spaced: bool = False) -> "RankTokenizer":
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}, pattern, spaced)

    @classmethod
    def from_table(cls, table: DataFrame, pattern: str) -> "RankTokenizer":
        """A vocabulary is a model file: its size is fixed by the model, not by the corpus."""
        return cls({bytes(r["token"]): r["rank"] for r in table.select("token", "rank").collect()}, pattern)

    @functools.cached_property
    def _library(self) -> Callable[[bytes], list[int]] | None:
        """The same merges in compiled code, where the library is installed; it wants all single bytes and a rank of its own for each token."""
        ranks = set(self.ranks.values())
        if len(ranks) < len(self.ranks) or not all(isinstance(r, int) and 0 <= r < 2 ** 32 - 1 for r in ranks) or any(bytes([b]) not in self.ranks for b in range(256)):
            return None
        try:
            from tiktoken._tiktoken import CoreBPE
            return CoreBPE(self.ranks, {}, ".").encode_single_piece  # the pattern goes unused: pieces are cut here
        except (ImportError, AttributeError):
            return None

    def _merged(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of a piece. Parts are kept by their first byte with links to both neighbours; a heap holds the pairs that can still merge."""
        n = len(piece)
        if piece in self.ranks:
            return (self.ranks[piece],)
        if 0 < n <= LIBRARY_BYTES and self._library is not None:
            return tuple(self._library(piece))
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins here; -1 for bytes inside a part
        pairs = []

        def offer(at: int) -> None:
            """The pair of the part at ``at`` and the next one."""
            if at >= 0 and end[at] < n:
                rank = self.ranks.get(piece[at:end[end[at]]])
                if rank is not None:
                    heapq.heappush(pairs, (rank, at, end[at], end[end[at]]))

        for at in range(n - 1):
            offer(at)
        while pairs:
            _, at, middle, stop = heapq.heappop(pairs)
            if end[at] != middle or end[middle] != stop:
                continue  # one of the two parts has changed since
            end[at], end[middle] = stop, -1
            if stop < n:
                before[stop] = at
            offer(before[at])
            offer(at)
        out, at = [], 0
        while at < n:
            out.append(self.ranks[piece[at:end[at]]])
            at = end[at]
        return tuple(out)

    def _size(self, piece: str) -> int:
        coded = piece.encode("utf-8")
        if coded in self.ranks:
            return 1
        if 0 < len(coded) <= LIBRARY_BYTES and self._library is not None:
            return len(self._library(coded))
        return len(self._merged(coded))

    def _of(self, piece: str) -> tuple[int, ...]:
        found = self._known.get(piece)
        if found is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            found = self._known[piece] = self._merged(piece.encode("utf-8"))
        return found

    def ids(self, text: str) -> list[int]:
        return [i for piece in self._find(text) for i in self._of(piece)]

    def _counted(self, text: str) -> int:
        return sum(map(self._sizes.__getitem__, self._find(text)))

    def words(self, text: str) -> list[str]:
        """A text cut at single blanks between two characters that are none."""
        words = text.split(" ")
        return words if words == text.split() else self._words(text)  # other white space than single blanks between words

    def count(self, text: str) -> int:
        if not self.spaced:
            return self._counted(text)
        words = self.words(text)
        return self.first[words[0]] + sum(map(self.later.__getitem__, words[1:]))

    def after_blank(self, words: list[str]) -> list[int]:
        """Counts of solid words, each with a blank before it. New ones are cut together: a piece that begins with a blank begins a word."""
        found = list(map(self.later.get, words))
        if None in found:
            new = [word for word, size in zip(words, found) if size is None and len(word) <= REMEMBERED_LENGTH]
            at, counts = -1, [0] * len(new)
            for piece in self._find(" " + " ".join(new)) if new else []:
                at += piece[:1] == " "
                counts[at] += self._sizes[piece]
            if at + 1 != len(new):  # not such a pattern
                counts = [self._counted(" " + word) for word in new]
            if len(self.later) + len(new) > REMEMBERED:
                self.later.clear()
            held = dict(zip(new, counts))
            if len(held) <= REMEMBERED:
                self.later.update(held)
            found = [size if size is not None else held[word] if word in held else self.later[word] for word, size in zip(words, found)]
        return found

    def exceeds(self, text: str, most: int, solid: list[str] | None = None) -> bool:
        """Whether :meth:`count` is above ``most``; with a spaced pattern each word has a token, so that many words need no count. ``solid`` is ``text.split()``."""
        if self.spaced:
            solid = text.split() if solid is None else solid
            other = len(text) - sum(map(len, solid)) - text.count(" ")  # white space that is no blank
            if len(solid) - 1 - other - text.count("  ") > most:
                return True
        return self.count(text) > most

    def fewer(self, text: str, limit: int) -> bool:
        """Whether :meth:`count` is below ``limit``; counts no further than that."""
        if self._found is None:
            return self.count(text) < limit
        for piece in self._found(text):
            limit -= self._sizes[piece[0]]
            if limit <= 0:
                return False
        return limit > 0

    def counts(self, texts: Iterable[str | None]) -> list[int | None]:
        return [None if t is None else self.count(t) for t in texts]

    def column(self) -> Callable[[Column], Column]:
        """The counter as an expression over texts, for :func:`hybridloom.operators.chunking.chunk_sections` beside :meth:`count`."""
        tokenizer = self

        @F.arrow_udf(T.IntegerType())
        @in_slices
        def counted(texts: pa.Array) -> pa.Array:
            return pa.array(tokenizer.counts(texts.to_pylist()), pa.int32())

        return counted

    def wordy(self, value: Column, limit: int) -> Column:
        """True only where :meth:`fewer` is surely false: with a spaced pattern, where the beginning of a text has that many words."""
        blanks = F.regexp_count(F.substring(value, 1, 64 * max(limit, 0)), F.lit(r"(?U)(?<=\S) (?=\S)"))
        return (blanks >= limit) & F.lit(self.spaced)
