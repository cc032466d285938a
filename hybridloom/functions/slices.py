"""Arrow batches in slices, so that a worker's memory does not follow the size of a batch."""

from __future__ import annotations

import functools
from collections.abc import Callable

import pyarrow as pa

# Bytes of a batch that a function turns into numbers or Python objects at once.
SLICE_BYTES = 4 << 20


def in_slices(convert: Callable[[pa.Array], pa.Array]) -> Callable[[pa.Array], pa.Array]:
    """Apply a function of rows to slices of about SLICE_BYTES, at least a row each."""
    @functools.wraps(convert)
    def over(batch: pa.Array) -> pa.Array:
        rows = max(1, len(batch) * SLICE_BYTES // max(batch.nbytes, 1))
        if rows >= len(batch):
            return convert(batch)
        return pa.concat_arrays([convert(batch.slice(at, rows)) for at in range(0, len(batch), rows)])
    return over
