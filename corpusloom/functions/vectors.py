"""Vector columns and blocks of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def as_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of an Arrow list column as a float64 matrix; rows of other lengths and non-finite values are errors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    lengths = pc.unique(pc.list_value_length(column))
    if len(lengths) != 1 or not lengths[0].is_valid:
        raise ValueError(f"vectors of one length are needed, found {sorted(map(str, lengths.to_pylist()))}")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if not np.isfinite(values).all():
        raise ValueError("vectors with NaN, infinite or missing values")
    return values.reshape(len(column), -1)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True) if matrix.size else np.ones((len(matrix), 1))
    return matrix / np.where(lengths == 0, 1.0, lengths)


def scale_rows(matrix: np.ndarray, rows: int = 4096) -> np.ndarray:
    """:func:`unit_rows` in place, without a second matrix."""
    for start in range(0, len(matrix), rows):
        matrix[start : start + rows] = unit_rows(matrix[start : start + rows])
    return matrix
