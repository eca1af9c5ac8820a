"""Integer vectors: what the vector operators of this folder share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def integer_vectors(rows: DataFrame, vector: str, scale: float, dims: int | None = None) -> tuple[Column, Column]:
    """``(kept, ints)``: whether a row's vector takes part, and its components as ``floor(scale * x)``.

    Null vectors and vectors with a null or non-finite component take no part, nor, with ``dims``,
    those of another length.
    """
    parts = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = F.col(vector).isNotNull() & finite
    if dims is not None:
        kept &= F.size(vector) == dims
    return F.coalesce(kept, F.lit(False)), F.transform(parts, lambda x: F.floor(x * F.lit(float(scale))))


def matrix(column: pa.Array, width: int, dtype="f8") -> tuple[np.ndarray, np.ndarray]:
    """The vectors of a list column as rows of ``width`` numbers, missing ones zero, and the squared
    lengths of the whole vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    if (lengths == width).all():
        out = flat.reshape(len(lengths), width).astype(dtype)
        return out, (out.astype("f8") ** 2).sum(axis=1)
    of = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], lengths)
    out = np.zeros((len(lengths), width), dtype)
    out[of[at < width], at[at < width]] = flat[at < width]
    return out, np.bincount(of, flat.astype("f8") ** 2, len(lengths)).astype("f8")
