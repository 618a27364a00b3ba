"""Array columns of an Arrow batch as NumPy blocks, and back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long arrays, of any rank, as rows x values; ragged or missing ones raise an error."""
    rows = len(column)
    while pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        lengths = column.value_lengths()
        if column.null_count or len(lengths.unique()) > 1:
            raise ValueError("arrays of a batch differ in length or are missing")
        column = column.flatten()
    if column.null_count:
        raise ValueError("values of a batch are missing")
    return column.to_numpy(zero_copy_only=False).astype("f8").reshape(rows, -1)


def nested(block: np.ndarray) -> pa.Array:
    """A block of two or more axes as a column of arrays, one row per first index."""
    column = pa.array(np.ascontiguousarray(block).ravel())
    for axis in range(block.ndim - 1, 0, -1):
        count = int(np.prod(block.shape[:axis]))
        offsets = np.arange(count + 1, dtype=np.int64) * block.shape[axis]
        column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), column)
    return column


def ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A column of lists of equally long vectors: all vectors as one block, and where each row's begin and end."""
    if column.null_count:
        raise ValueError("arrays of a batch are missing")
    ends = np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))).astype("int64")
    inner = column.flatten()
    width = int(inner.value_lengths()[0].as_py()) if len(inner) else 0
    return (matrix(inner) if len(inner) else np.zeros((0, width))), ends
