"""Vectors turned into whole numbers, as operators 11 and 12 compare them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SCALE = 1024
#: Squared norms stay below, so that squared distances and inner products fit 64 bits.
NORM_LIMIT = 2.0 ** 60


def whole(column: pa.Array, dim: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, row numbers, floor(1024 x) as int64 matrix) of a list column's usable vectors.

    Null vectors, vectors with a null or non-finite component and those whose
    numbers have a squared norm of 2**60 or more (components about a million)
    are left out; ``dim`` keeps one dimension only.
    """
    column = column.cast(pa.list_(pa.float64()))
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[sizes >= 0]).tolist() if dim is None else [dim]:
        rows = np.flatnonzero(sizes == size)
        flat = column.take(pa.array(rows, pa.int64())).flatten()
        matrix = np.floor(flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), size) * SCALE)  # null components are NaN
        with np.errstate(over="ignore", invalid="ignore"):
            good = np.isfinite(matrix).all(axis=1) & ((matrix * matrix).sum(axis=1) < NORM_LIMIT)
        yield size, rows[good], matrix[good].astype(np.int64)
