"""Distance work in bounded blocks of rows.

Rows are dealt to blocks by a hash of their id, so block sizes depend on counts alone: a hot group
becomes many blocks, never a large one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

BLOCK_VALUES = 16_000_000
MAX_BLOCK_ROWS = 2_000
#: Values of differences that are formed at a time.
NEAR_VALUES = 4_000_000
#: Rows of so few values are as quick to subtract as to multiply.
DIRECT_WIDTH = 8


def block_rows(width: int) -> int:
    """Rows per block, so that a dense block stays near 128 MB."""
    return int(max(64, min(MAX_BLOCK_ROWS, BLOCK_VALUES // max(width, 1))))


def block_of(id_col: str, n_blocks: Column, salt: int = 0) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), F.col(id_col)), n_blocks).cast("int")


def block_count(rows: Column, size: int) -> Column:
    return F.ceil(rows / F.lit(size)).cast("int")


def _squares(rows: np.ndarray) -> np.ndarray:
    """The squared length of each row, some rows at a time."""
    step = max(1, NEAR_VALUES // max(rows.shape[1], 1))
    return np.concatenate([np.zeros(0), *((some * some).sum(1) for some in (rows[at : at + step] for at in range(0, len(rows), step)))])


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact for equal rows: differences are formed where the expanded form would cancel, and of narrow rows throughout."""
    if a.shape[1] <= DIRECT_WIDTH:
        out = np.zeros((len(a), len(b)))
        for x, y in zip(a.T, b.T):
            diff = np.subtract.outer(x, y)
            out += np.multiply(diff, diff, out=diff)
        return out
    scale = _squares(a)[:, None] + _squares(b)[None, :]
    rough = scale - 2 * (a @ b.T)
    rows, cols = np.nonzero(rough <= 1e-7 * scale)
    step = max(1, NEAR_VALUES // max(a.shape[1], 1))
    for at in range(0, len(rows), step):
        i, j = rows[at : at + step], cols[at : at + step]
        diff = a[i] - b[j]
        rough[i, j] = np.einsum("ij,ij->i", diff, diff)
    return np.maximum(rough, 0.0)


def dense_rows(indices, values, width: int) -> np.ndarray:
    block = np.zeros((len(indices), width))
    for r, (i, v) in enumerate(zip(indices, values)):
        block[r, np.asarray(i, dtype=int)] = v
    return block
