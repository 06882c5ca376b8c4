"""Integer vectors out of columns of floating-point arrays.

A component x becomes ``floor(scale * x)``, with x as double. Components of
2**27 or more in absolute value are refused with an error: squared distances of
hundreds of them would leave 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_COMPONENT = 1 << 27
#: Integers up to here are exact as doubles.
EXACT_DOUBLE = 1 << 53


def usable(vector: Column) -> Column:
    """A vector that is not null and holds neither nulls nor non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def with_vector(embeddings: DataFrame, *keep: str, vector: str = "embedding") -> DataFrame:
    """The columns ``keep`` and the vector as array<double>, named ``v``."""
    return embeddings.select(*[F.col(c) for c in keep], F.col(vector).cast("array<double>").alias("v"))


def width_of(rows: DataFrame) -> int:
    """Components of the longest usable vector ``v``."""
    return rows.where(usable(F.col("v"))).agg(F.max(F.size("v"))).first()[0] or 0


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    y = np.floor(x * float(scale))
    if len(y) and np.abs(y).max() >= MAX_COMPONENT:
        raise OverflowError(f"a component of {MAX_COMPONENT} or more after scaling by {scale}")
    return y.astype(np.int64)


def integer_vectors(column: pa.Array, scale: int, width: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the usable vectors, their integers as a matrix of ``width`` columns).

    A shorter vector ends in zeros; with ``exact`` only vectors of ``width``
    components are taken.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    first, last = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    x = column.values.slice(first, last - first).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    offsets = offsets - first
    size = np.diff(offsets)
    bad = np.append(0, np.cumsum(~np.isfinite(x)))  # a null component reads as NaN
    keep = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
    if exact:
        keep &= size == width
    rows = np.flatnonzero(keep)
    own = size[rows]
    out = np.zeros((len(rows), width), np.int64)
    inside = np.arange(width) < own[:, None]
    at = offsets[rows][:, None] + np.arange(width)
    out[inside] = integers(x[at[inside]], scale)
    return rows, out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices, as int64."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = a.shape[1] * int(np.abs(a).max()) * int(np.abs(b).max())
    if most < EXACT_DOUBLE:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    raise OverflowError("inner products leave 64 bits")


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances of the rows of two integer matrices."""
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * products(a, b)


def digest_text(rows: np.ndarray) -> str:
    """Decimal integers of an array in order, joined by commas."""
    return ",".join(map(str, np.asarray(rows).ravel().tolist()))
