"""Texts of Arrow batches as byte arrays, without a Python string per row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with at most ``max_bytes`` of text each; a longer row stands alone."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each text begins; one more entry than rows. Null is empty."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    if len(filled) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = filled.buffers()
    begins = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    if begins[-1] == begins[0]:
        return np.zeros(0, np.uint8), begins - begins[0]
    return np.frombuffer(data, np.uint8)[begins[0] : begins[-1]], begins - begins[0]


def sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; ``begins`` as of :func:`utf8`."""
    running = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=running[1:], dtype=running.dtype)
    return running[begins[1:]] - running[begins[:-1]]
