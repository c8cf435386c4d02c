"""Helpers of stages that handle Arrow batches in Python: bounded slices of text
and memory that is given back."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20      # text handled at once (a longer text is a slice alone)


def tidy() -> None:
    """Give freed memory back: idle workers must not hold what a task needed."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):       # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def lean(run):
    """An Arrow stage whose worker gives its memory back when its task ends."""
    def stage(batches):
        try:
            yield from run(batches)
        finally:
            tidy()
    return stage


def row_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with at most ``limit`` bytes of text, or one longer row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = max(int(np.searchsorted(size, (size[lo - 1] if lo else 0) + limit, side="right")), lo + 1)
        yield batch.slice(lo, hi - lo)
        lo = hi
