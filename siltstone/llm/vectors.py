"""What the operators on vectors share: rows that take part, and whole-number components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Vectors become whole numbers by floor(SCALE * x).
SCALE = 256


def sound(vector: str) -> Column:
    """Neither the vector nor a component is null, and all components are finite."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))


def scaled(vector: str) -> Column:
    """floor(SCALE * x) of every component, worked out in doubles."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def extent(vectors: DataFrame, column: str) -> tuple[int, int]:
    """The longest vector's length and the largest absolute component, 0 and 0 of no rows."""
    largest = F.aggregate(column, F.lit(0).cast("long"), lambda most, x: F.greatest(most, F.abs(x)))
    found = vectors.agg(F.max(F.size(column)).alias("width"), F.max(largest).alias("most")).first()
    return found["width"] or 0, found["most"] or 0


def matrix(lists: pa.Array, width: int, kind=np.int64) -> np.ndarray:
    """The vectors as rows of a matrix; shorter ones are filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    filled = np.zeros((len(lengths), width), kind)
    filled[np.arange(width) < lengths[:, None]] = flat
    return filled
