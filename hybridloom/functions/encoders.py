"""Pluggable encoders with deterministic offline defaults.

An encoder is any column expression: ``text -> array<double>`` (dense) or
``text -> struct<indices, values>`` (sparse). A model-backed deployment passes its own
Arrow UDF; the defaults below need no model and give the same numbers in any engine.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from hybridloom.functions import text as tx
from hybridloom.functions.slices import in_slices
from hybridloom.schema import SPARSE_VECTOR

DENSE_DIMENSIONS = 64


def term_slot(term: str, dimensions: int = DENSE_DIMENSIONS) -> tuple[int, int]:
    """Bucket and sign of a term: signed feature hashing over its md5 digest."""
    digest = hashlib.md5(term.encode("utf-8")).hexdigest()
    return int(digest[:4], 16) % dimensions, 1 - 2 * (int(digest[4], 16) % 2)


def term_slots(terms: pa.Array, dimensions: int = DENSE_DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and signs of many terms, as :func:`term_slot` has them, read from the bytes of their digests."""
    digests = b"".join([hashlib.md5(t).digest() for t in terms.cast(pa.binary()).to_pylist()])
    held = np.frombuffer(digests, dtype=np.uint8).reshape(-1, 16)[:, :3].astype(np.int64)
    return (held[:, 0] * 256 + held[:, 1]) % dimensions, 1 - 2 * ((held[:, 2] >> 4) % 2)


def _as_list_array(column) -> pa.ListArray:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _rows_of(lists: pa.ListArray) -> np.ndarray:
    """Row number of every flattened list element."""
    lengths = np.nan_to_num(np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=float))
    return np.repeat(np.arange(len(lists)), lengths.astype(np.int64))


def hash_terms(lists: pa.ListArray, dimensions: int = DENSE_DIMENSIONS) -> np.ndarray:
    """Signed term counts per row; integers, so every engine agrees to the last bit."""
    coded = lists.flatten().dictionary_encode()
    slots, signs = term_slots(coded.dictionary, dimensions)
    codes = np.asarray(coded.indices, dtype=np.int64)
    flat = _rows_of(lists) * dimensions + slots[codes]
    dense = np.bincount(flat, weights=signs[codes], minlength=len(lists) * dimensions)
    return dense.reshape(len(lists), dimensions)


def count_terms(lists: pa.ListArray) -> pa.StructArray:
    """Distinct terms of every row with log1p(tf), in term order of first appearance in the batch."""
    coded = lists.flatten().dictionary_encode()
    width = max(len(coded.dictionary), 1)
    keys, counts = np.unique(_rows_of(lists) * width + np.asarray(coded.indices, dtype=np.int64), return_counts=True)
    offsets = np.searchsorted(keys, np.arange(len(lists) + 1) * width).astype(np.int32)
    indices = pa.ListArray.from_arrays(pa.array(offsets), coded.dictionary.take(pa.array(keys % width)))
    values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.log1p(counts.astype(float))))
    return pa.StructArray.from_arrays([indices, values], ["indices", "values"])


@F.arrow_udf(T.ArrayType(T.DoubleType()))
@in_slices
def _hashed(lists: pa.Array) -> pa.Array:
    lists = _as_list_array(lists)
    dense = hash_terms(lists)
    offsets = np.arange(len(lists) + 1, dtype=np.int32) * DENSE_DIMENSIONS
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(dense.ravel()))


@F.arrow_udf(SPARSE_VECTOR)
@in_slices
def _counted(lists: pa.Array) -> pa.Array:
    return count_terms(_as_list_array(lists))


def dense_terms(value: Column) -> Column:
    """Default dense encoder: signed hashing of the terms of a text."""
    return _hashed(tx.terms(value))


def sparse_terms(value: Column) -> Column:
    """Default sparse encoder: log1p of the term frequency, the same saturation as log1p(relu(.))."""
    return _counted(tx.terms(value))
