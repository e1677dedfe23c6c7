"""Helpers for functions that map Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts in ``column`` of each are about ``most_bytes`` at most; a longer text stands alone."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // most_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(size)] if len(size) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(a, b - a)


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """One list per NumPy array, without Python objects for the values."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(x) for x in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))
