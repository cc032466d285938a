"""Byte-level BPE: whole texts to the ids of a rank file, and ids back to bytes."""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from hybridloom.llm.common import by_bytes, free_name, table

# Chunks between safe cuts recur; their ids are kept in up to this many bytes a worker.
CACHE_BYTES = 48 << 20
# Distinct chunks are joined to texts of this many characters before they are encoded.
BLOCK_CHARS = 4096

# A blank between two characters that are surely no white space begins a new match of the pattern, so texts may be cut before it.
_SOLID = r"[^\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]"
_CUT = re.compile(rf" (?<={_SOLID} )(?={_SOLID})")
_ENDS_SOLID = re.compile(rf"{_SOLID}(?:.*{_SOLID})?", re.S)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it shows, else the next one from U+0100 on."""
    shows = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shows else next(spare)) for b in range(256)]


@dataclass(frozen=True)
class ByteBpe:
    """Byte strings by id (empty for unused ids) and the two halves of each merged one, in order of rank. Grows with the vocabulary alone."""
    tokens: tuple[bytes, ...]
    halves: tuple[tuple[bytes, bytes], ...]

    @functools.cached_property
    def name(self) -> str:
        return hashlib.sha256(b"\0".join(self.tokens)).hexdigest()


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The pair whose merge makes ``token``: what the lower ranks leave of its bytes."""
    none = len(ranks) + 256
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        i = found.index(min(found))
        if found[i] >= ranks[token]:
            raise ValueError(f"{token!r} can't be reached by merges of lower rank")
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def read_ranks(path: str) -> ByteBpe:
    """A rank file: base64 of a byte string and its rank on each line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return ByteBpe(tuple(tokens), tuple(_halves(t, ranks) for t in tokens if len(t) > 1))


class _Encoder:
    """A worker's tokenizer, and the ids of chunks it has met."""

    def __init__(self, bpe: ByteBpe):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, models, pre_tokenizers

        shown = byte_characters()
        text = lambda token: "".join(shown[b] for b in token)
        self.tokenizer = Tokenizer(models.BPE(vocab={text(t): i for i, t in enumerate(bpe.tokens) if t}, merges=[(text(a), text(b)) for a, b in bpe.halves]))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.sizes = np.array([len(t) for t in bpe.tokens], np.int64)
        self.heads, self.later, self.held = {}, {}, 0

    def _learn(self, heads: set[str], later: set[str]) -> None:
        """Ids of new chunks. Those that begin and end solid are joined by blanks and cut apart again by the bytes of their tokens."""
        loose = [c for c in later if not _ENDS_SOLID.fullmatch(c)]
        single = [*heads, *(f" {c}" for c in loose)]
        joined, block, chars = [], [], 0
        for c in later.difference(loose):
            block.append(c)
            chars += len(c) + 1
            if chars >= BLOCK_CHARS:
                joined.append(block)
                block, chars = [], 0
        joined += [block] if block else []
        found = self.tokenizer.encode_batch_fast([*single, *("".join(f" {c}" for c in b) for b in joined)], add_special_tokens=False)
        for i, chunk in enumerate([*heads, *loose]):
            ids = np.array(found[i].ids, np.int32).tobytes()
            (self.heads if i < len(heads) else self.later)[chunk] = ids
            self.held += 2 * len(chunk) + len(ids) + 200
        for chunks, encoding in zip(joined, found[len(single):]):
            ids = np.array(encoding.ids, np.int32)
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(c.encode()) + 1 for c in chunks])) + 1
            start = 0
            for chunk, end in zip(chunks, ends.tolist()):
                self.later[chunk] = ids[start:end].tobytes()
                start = end
            self.held += 4 * len(ids) + sum(map(len, chunks)) + 200 * len(chunks)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """int32 ids of each text, as bytes."""
        if self.held > CACHE_BYTES:
            self.heads, self.later, self.held = {}, {}, 0
        cut = [_CUT.split(t) for t in texts]
        heads = {c[0] for c in cut}.difference(self.heads)
        later = set().union(*(c[1:] for c in cut)).difference(self.later)
        if heads or later:
            self._learn(heads, later)
        return [b"".join([self.heads[c[0]], *map(self.later.__getitem__, c[1:])]) for c in cut]


_ENCODERS: dict[str, _Encoder] = {}


def _encoder(bpe: ByteBpe) -> _Encoder:
    if bpe.name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[bpe.name] = _Encoder(bpe)
    return _ENCODERS[bpe.name]


def encode_text(df: DataFrame, bpe: ByteBpe, text: str = "text", ids: str = "ids", offsets: str | None = None, drop_text: bool = False) -> DataFrame:
    """``df`` with ``ids``, the token ids of the whole ``text``, and with ``offsets``, the first byte of each token in the text's UTF-8.

    Null and empty texts have no tokens. Rows are encoded where they are read, without a shuffle; repeated rows give a row each and an empty
    table an empty one. Columns named like ``ids`` or ``offsets`` are replaced. Texts are cut at blanks between solid characters, where the
    pattern starts a new match whatever stands around, and each different chunk is encoded once while a worker remembers it; memory grows
    with the longest stretch that has no such blank.
    """
    made = [n for n in (ids, offsets) if n]
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in made} and not (drop_text and c == text)]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(free_name(df, "text")))
    sizes = np.array([len(t) for t in bpe.tokens], np.int64)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(bpe)
        for batch in by_bytes(batches, len(kept)):
            found = encoder([t or "" for t in batch.column(len(kept)).to_pylist()])
            values = np.frombuffer(b"".join(found), np.int32)
            ends = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32)
            columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(values))]
            if offsets:
                place = np.concatenate([[0], np.cumsum(sizes[values])])
                first = np.repeat(place[ends[:-1]], np.diff(ends))
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array((place[:-1] - first).astype(np.int32))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*kept, *made])

    ints = ArrayType(IntegerType(), False)
    return source.mapInArrow(encoded, StructType([*source.schema.fields[:-1], *[StructField(n, ints) for n in made]]))


def decode_ids(df: DataFrame, bpe: ByteBpe, ids: str = "ids", out: str = "decoded", as_text: bool = False) -> DataFrame:
    """``df`` with ``out``, the bytes of ``ids``: tokens are joined as bytes, so characters split over tokens come whole again.

    Null and empty lists give empty bytes; nulls and ids that the table does not have give none. With ``as_text`` the bytes are read as UTF-8 and
    each ill-formed part, such as a character whose other tokens are missing, becomes U+FFFD. A column named like ``out`` is replaced.
    """
    kept = [c for c in df.columns if c.lower() != out.lower()]
    place = kept.index(ids)
    tokens = np.array([*bpe.tokens, b""], object)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, place):
            texts = []
            for row in batch.column(place):
                known = np.asarray(row.values.fill_null(-1), np.int64) if row.is_valid else np.zeros(0, np.int64)
                known = np.where((known < 0) | (known >= len(bpe.tokens)), len(bpe.tokens), known)
                texts.append(b"".join(tokens[known].tolist()))
            column = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string()) if as_text else pa.array(texts, pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*kept, out])

    plain = df.select(*[F.col(f"`{c}`") for c in kept])
    return plain.mapInArrow(decoded, StructType([*plain.schema.fields, StructField(out, StringType() if as_text else BinaryType())]))


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Every document to ids and back."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    bpe = read_ranks(vocabulary)
    encoded = encode_text(table(spark, sf_dir, "documents").select("doc_id", "text"), bpe, drop_text=True)
    decimal = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    shown = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), "ids")
    return decode_ids(shown, bpe).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
