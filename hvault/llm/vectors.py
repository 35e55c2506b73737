"""Vector columns in Arrow batches: rows as integer matrices, bad rows told apart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def spans(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(values as double, first value of each row, values of each row, usable) of a list column.

    A row is usable when it is not null and holds neither null nor non-finite values."""
    if pa.types.is_large_list(column.type):
        column = column.cast(pa.list_(column.type.value_type))
    values = pc.cast(column.values, pa.float64(), safe=False)
    flat = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False)
    offsets = np.asarray(column.offsets, np.int64)
    first, size = offsets[:-1], np.diff(offsets)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[first])
    return flat, first, np.where(usable, size, 0), usable


def scaled(column: pa.ListArray, length: int, factor: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``length`` usable values as integers ``floor(factor * value)``, and which rows of the column they are.

    Rows with an integer beyond ``bound`` either way are left out, too."""
    flat, first, size, usable = spans(column)
    at = np.flatnonzero(usable & (size == length))
    with np.errstate(over="ignore"):
        x = np.floor(factor * flat[first[at][:, None] + np.arange(length)])
    fits = (np.abs(x) <= bound).all(axis=1)
    return x[fits].astype(np.int64), at[fits]
