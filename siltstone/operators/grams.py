"""Substring search by an index of trigrams instead of a scan of all texts.

The index has a row per distinct trigram and text, in lower case, in folders by
the trigram's bucket and sorted by the trigram. A pattern's fixed pieces are cut
into trigrams too; only the posting lists of these are read, and texts that are
on all of them are checked against the pattern itself, so the rows are those of
a scan. A pattern without a piece of three characters is scanned.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.encoder import parts_by_size
from siltstone.functions.text import as_col, escape_like
from siltstone.session import ship_package
from siltstone.sources.tables import folders_open

LENGTH, BUCKETS = 3, 64

# Bytes of text whose trigrams are held at a time.
PART_BYTES = 4 * 1024 * 1024


def grams_of(text: str) -> np.ndarray:
    """Numbers of the distinct trigrams of a text, rising: 21 bits per sign, mixed, so that no two share a number."""
    signs = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = max(0, len(signs) - LENGTH + 1)
    codes = np.zeros(n, np.uint64)
    for back in range(LENGTH):
        codes |= signs[back : back + n] << np.uint64(21 * back)
    codes *= np.uint64(0x9E3779B97F4A7C15)
    return np.unique((codes ^ (codes >> np.uint64(32))).view(np.int64))


def bucket_of(gram: np.ndarray) -> np.ndarray:
    return (gram % BUCKETS).astype(np.int32)


def build_postings(df: DataFrame, key: str = "id", text: str = "content") -> DataFrame:
    """(bucket, gram, key): a row per distinct trigram of every text in lower case; none of a NULL."""
    rows = df.select(key, F.lower(as_col(text)).alias("_text")).where("_text is not null")
    schema = T.StructType([*T.StructType.fromDDL("bucket int, gram bigint").fields, rows.schema[0]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.columns
            for first, last in parts_by_size(texts, PART_BYTES):
                found = [grams_of(t) for t in texts.slice(first, last - first).to_pylist()]
                grams = np.concatenate(found)
                place = np.repeat(np.arange(first, last), [len(g) for g in found])
                yield pa.RecordBatch.from_arrays([pa.array(bucket_of(grams)), pa.array(grams), keys.take(pa.array(place))], names=schema.names)

    ship_package(df.sparkSession)
    return rows.mapInArrow(run, schema)


def write_postings(postings: DataFrame, path: str) -> None:
    """One folder per bucket, in as many files as its size asks for, each sorted by trigram.

    A task's buckets are open together, so that its rows are sorted by one number.
    """
    with folders_open(postings.sparkSession, BUCKETS):
        postings.hint("rebalance", F.col("bucket")).sortWithinPartitions("gram").write.partitionBy("bucket").parquet(path)


def fixed_pieces(pattern: str, escape: str = "\\") -> list[str]:
    """What a LIKE pattern asks for between its wildcards."""
    pieces, piece, signs = [], [], iter(pattern)
    for c in signs:
        if c == escape:
            piece.append(next(signs, ""))
        elif c in "%_":
            pieces.append("".join(piece))
            piece = []
        else:
            piece.append(c)
    return [p for p in [*pieces, "".join(piece)] if p]


def pattern_grams(df: DataFrame, pattern: str) -> list[tuple[int, int]]:
    """(bucket, trigram) of the fixed pieces, lowered as Spark lowers the texts."""
    pieces = df.sparkSession.createDataFrame([(p,) for p in fixed_pieces(pattern)], "piece string")
    found = {int(g) for r in pieces.select(F.lower("piece").alias("piece")).collect() for g in grams_of(r["piece"])}
    return sorted((g % BUCKETS, g) for g in found)


def candidates(postings: DataFrame, grams: Sequence[tuple[int, int]], key: str = "id") -> DataFrame:
    """Keys of the texts that are on the posting lists of all trigrams."""
    buckets = sorted({b for b, _ in grams})
    lists = postings.where(F.col("bucket").isin(buckets) & F.col("gram").isin([g for _, g in grams]))
    return lists.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(grams)).select(key)


def search_like(
    df: DataFrame, postings: DataFrame, pattern: str, key: str = "id", text: str = "content", ignore_case: bool = True,
) -> DataFrame:
    """Rows whose text is LIKE the pattern, as a scan would give them; keys are unique."""
    fits = F.col(text).ilike(pattern) if ignore_case else F.col(text).like(pattern)
    grams = pattern_grams(df, pattern)
    if not grams:
        return df.where(fits)
    return df.join(candidates(postings, grams, key), key, "left_semi").where(fits).select(df.columns)


def text_search_indexed(
    df: DataFrame, postings: DataFrame, query: str, k: int | None = 10, text: str = "content", key: str = "id",
    columns: Sequence[str] = (), literal: bool = False,
) -> DataFrame:
    """What ``text_search`` gives, by way of the index."""
    hits = search_like(df, postings, f"%{escape_like(query) if literal else query}%", key, text)
    hits = hits.select(key, *columns, F.lit(1.0).alias("score"))
    return hits.orderBy(key).limit(k) if k is not None else hits
