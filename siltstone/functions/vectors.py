"""Cosine similarity on ``array<float>`` columns.

Scores are accumulated in double precision; a zero vector gives NULL.  The
Arrow form reads the list column's flat value buffer once per batch, so one
matrix product scores the whole batch.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import as_col


# Scores are rounded here, so that equal vectors tie whatever batch they come in.
SCORE_DECIMALS = 12


def as_matrix(vectors: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list array as a matrix, and the mask of rows that hold a vector.

    NULL and empty lists are left out of the matrix; vectors of different
    length are an error.
    """
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    present = lengths > 0
    sizes = np.unique(lengths[present])
    if sizes.size == 0:
        return np.zeros((0, dim or 0)), present
    if sizes.size > 1 or (dim is not None and int(sizes[0]) != dim):
        raise ValueError(f"vectors of unequal length: expected {dim or int(sizes[0])}, found {sizes.tolist()}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, int(sizes[0])).astype(np.float64), present


def _spread(values: np.ndarray, present: np.ndarray, undefined: np.ndarray) -> pa.Array:
    out = np.zeros(present.shape[0])
    out[present] = np.where(undefined, 0.0, np.round(values, SCORE_DECIMALS))
    missing = ~present
    missing[np.flatnonzero(present)[undefined]] = True
    return pa.array(out, mask=missing)


def cosine_to(c: Column | str, query: Sequence[float]) -> Column:
    """Cosine similarity of a vector column to one fixed query vector."""
    fixed = np.asarray(query, dtype=np.float64)
    norm = float(np.sqrt(fixed @ fixed))

    @F.arrow_udf("double")
    def score(v: pa.Array) -> pa.Array:
        rows, present = as_matrix(v, fixed.shape[0])
        norms = np.sqrt(np.einsum("ij,ij->i", rows, rows)) * norm
        zero = norms == 0
        return _spread((rows @ fixed) / np.where(zero, 1.0, norms), present, zero)

    return score(as_col(c))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity of two vector columns, row by row."""

    @F.arrow_udf("double")
    def score(left: pa.Array, right: pa.Array) -> pa.Array:
        sizes = [x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for x in (left, right)]
        both = (sizes[0] > 0) & (sizes[1] > 0)
        keep = pa.array(both)
        x, _ = as_matrix(left.filter(keep))
        y, _ = as_matrix(right.filter(keep))
        if x.shape != y.shape:
            raise ValueError(f"vectors of unequal length: {x.shape[1]} and {y.shape[1]}")
        norms = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
        zero = norms == 0
        dots = np.einsum("ij,ij->i", x, y)
        return _spread(dots / np.where(zero, 1.0, norms), both, zero)

    return score(as_col(a), as_col(b))


def cosine_expression(a: Column | str, b: Column | str) -> Column:
    """The same score written with array functions only, for use where Python is not wanted."""
    a, b = as_col(a), as_col(b)

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)

    def squares(x: Column) -> Column:
        return total(F.transform(x, lambda v: v.cast("double") * v.cast("double")))

    dot = total(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")))
    return F.try_divide(dot, F.sqrt(squares(a)) * F.sqrt(squares(b)))


def has_vector(c: Column | str) -> Column:
    """True when the vector is neither NULL nor empty."""
    return F.coalesce(F.size(as_col(c)) > 0, F.lit(False))
