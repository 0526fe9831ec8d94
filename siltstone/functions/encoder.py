"""Text to vector: a deterministic hashed bag of words, or any batch encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import as_col

Encoder = Callable[[list[str]], np.ndarray]

# Vector length and batch size the search tables were built with.
EMBEDDING_DIM = 384
ENCODE_BATCH = 32

# Rows counted and bytes of text split at a time.
SLICE_ROWS = 1024
PART_BYTES = 32 * 1024 * 1024


def _once(encode):
    """Keep the optimizer from repeating an encoder, as it does when a later filter reads its result."""
    return encode.asNondeterministic()


def bucket_of(word: str, dim: int) -> int:
    """Bucket number of a word: the first 32 bits of its md5."""
    return int.from_bytes(hashlib.md5(word.encode()).digest()[:4], "big") % dim


def _as_list_array(matrix: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(matrix, dtype=np.float32).reshape(-1))
    offsets = pa.array(np.arange(matrix.shape[0] + 1, dtype=np.int32) * matrix.shape[1])
    return pa.ListArray.from_arrays(offsets, flat)


def _word_buckets(texts: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word of the batch in order, and the number of words per row.

    Each distinct word is hashed once. Empty pieces at the ends of a text go to
    bucket ``dim``, which is cut off later.
    """
    pieces = pc.ascii_split_whitespace(texts)
    sizes = pieces.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    words = pieces.flatten().dictionary_encode()
    known = words.dictionary.to_pylist()
    buckets = np.fromiter((bucket_of(w, dim) if w else dim for w in known), np.int64, len(known))
    return buckets[words.indices.to_numpy()], sizes


def hashed_embedding(c: Column | str, dim: int = EMBEDDING_DIM) -> Column:
    """Counts of the white-space separated, lower-cased words per bucket, scaled to length one.

    Words are split and hashed for a large part of a batch at once, then counted
    a slice of rows at a time, so that neither long texts nor the table of
    counts of wide vectors take much memory.
    """

    @F.arrow_udf("array<float>")
    def count(texts: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.list_(pa.float32()))]
        for first, last in _parts_by_size(texts):
            buckets, sizes = _word_buckets(texts.slice(first, last - first), dim)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            for start in range(0, last - first, SLICE_ROWS):
                n = min(SLICE_ROWS, last - first - start)
                rows = np.repeat(np.arange(n), sizes[start : start + n])
                flat = rows * (dim + 1) + buckets[ends[start] : ends[start + n]]
                counts = np.bincount(flat, minlength=n * (dim + 1)).reshape(n, dim + 1)[:, :dim]
                norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
                parts.append(_as_list_array(counts / np.where(norms == 0, 1, norms)))
        return pa.concat_arrays(parts)

    return F.when(as_col(c).isNotNull(), _once(count)(F.lower(as_col(c))))


def parts_by_size(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges that hold at most ``limit`` bytes of text, or a single row."""
    total = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + limit, side="right")))
        yield first, last
        first = last


def _parts_by_size(texts: pa.Array) -> Iterator[tuple[int, int]]:
    return parts_by_size(texts, PART_BYTES)


@dataclass(frozen=True)
class EncoderFactory:
    """Makes an encoder in the Python worker that needs it, such as a model read from files.

    Only the function and its arguments travel to the workers. A worker keeps
    what it has made, so a model is loaded once and not for every task.
    """

    make: Callable[..., Encoder]
    arguments: tuple = ()

    def __call__(self, texts: list[str]) -> np.ndarray:
        return made_encoder(self.make, self.arguments)(texts)


@lru_cache(maxsize=4)
def made_encoder(make: Callable[..., Encoder], arguments: tuple) -> Encoder:
    return make(*arguments)


def encode_with(c: Column | str, encoder: Encoder, batch: int = ENCODE_BATCH) -> Column:
    """Vectors from any encoder that turns a list of texts into a matrix.

    An ``EncoderFactory`` of an importable function loads its model once per worker.
    """

    @F.arrow_udf("array<float>")
    def run(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        known = [i for i, v in enumerate(values) if v is not None]
        out: list = [None] * len(values)
        for start in range(0, len(known), batch):
            chosen = known[start : start + batch]
            rows = np.asarray(encoder([values[i] for i in chosen]), dtype=np.float32)
            for i, row in zip(chosen, rows, strict=True):
                out[i] = row
        return pa.array(out, pa.list_(pa.float32()))

    return _once(run)(as_col(c))


def embed_text(c: Column | str, encoder: Encoder | None = None, dim: int = EMBEDDING_DIM) -> Column:
    return hashed_embedding(c, dim) if encoder is None else encode_with(c, encoder)
