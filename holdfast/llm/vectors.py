"""Vectors of Arrow list columns as integer matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: components from here on would let a sum of 64 products or squared differences leave a BIGINT
LARGEST = 1 << 27


def rows_of(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and double components of the rows that are vectors.

    A null row or one with a null or non-finite component is none. With ``width`` only rows
    of so many components count; without it shorter rows end in zeros.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    good = ~np.asarray(column.is_null())
    if width is not None:
        good &= lengths == width
    rows = np.flatnonzero(good)
    most = width if width is not None else int(lengths[rows].max(initial=0))
    at = np.arange(most)
    inside = at < lengths[rows, None]
    found = np.where(inside, values[np.where(inside, offsets[rows, None] + at, 0)] if len(values) else 0.0, 0.0)
    finite = np.isfinite(found).all(axis=1)
    rows, found = rows[finite], found[finite]
    return rows, found if width is not None else found[:, : int(lengths[rows].max(initial=0))]


def integers(found: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of each component; too large ones are an error."""
    scaled = np.floor(found * scale)
    if np.abs(scaled).max(initial=0) >= LARGEST:
        raise ValueError(f"a component times {scale} is {LARGEST} or more: products would leave a BIGINT")
    return scaled.astype(np.int64)
