"""Raw text to clean documents to scored chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as X
from siltstone.functions.encoder import Encoder, embed_text
from siltstone.functions.vectors import has_vector
from siltstone.operators.project import filter_length_band, quality_score
from siltstone.operators.windows import deduplicate

# Limits of the reference transforms.
MIN_LENGTH = 50
MAX_LENGTH = 10000
MIN_QUALITY = 0.5
CHUNK_SIZE = 1000


def newest_per_content(bronze: DataFrame) -> DataFrame:
    """Raw rows reduced to the newest per content hash (ties by id)."""
    hashed = bronze.withColumn("content_hash", X.content_hash("content"))
    return deduplicate(hashed, ["content_hash"], [F.desc("ingested_at"), F.desc("id")])


def clean_rows(newest: DataFrame, as_of: Column, min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH) -> DataFrame:
    """Length band and column order of the silver table. Runs after the choice of the newest row."""
    return filter_length_band(newest, "content", min_len, max_len).select(
        "id", "content", "content_hash", "source", F.col("raw_metadata").alias("metadata"),
        as_of.alias("processed_at"),
    )


def silver_documents(
    bronze: DataFrame, as_of: Column, min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH
) -> DataFrame:
    """Clean documents: one shuffle, on the content hash, of one row per hash and map task."""
    return clean_rows(newest_per_content(bronze), as_of, min_len, max_len)


def chunk_text(
    df: DataFrame, size: int = CHUNK_SIZE, overlap: int = 0, key: str = "id", text: str = "content",
    extra: dict[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """One row per chunk: total_chunks, chunk_index, chunk_content and chunk_id beside the input columns.

    ``extra`` names further columns computed from the chunk.  Pieces and extras
    are made inside the generator, once each; filters on them read the result
    instead of repeating the work.
    """
    counted = df.withColumn("total_chunks", X.chunk_count(text, size, overlap))
    numbers = F.sequence(F.lit(1), F.col("total_chunks"))
    whole = F.col("total_chunks") == 1
    pieces = F.transform(numbers, lambda i: F.when(whole, F.col(text)).otherwise(X.chunk_at(text, i, size, overlap)))
    shaped = F.transform(pieces, lambda piece, i: F.struct(
        (i + 1).alias("chunk_index"), piece.alias("chunk_content"),
        *[make(piece).alias(name) for name, make in (extra or {}).items()],
    ))
    rows = counted.select("*", F.inline(shaped))
    return rows.withColumn("chunk_id", F.concat_ws("-", F.col(key), F.col("chunk_index").cast("string")))


def scored_chunks(df: DataFrame, size: int, min_quality: float, overlap: int = 0) -> DataFrame:
    """Chunks that hold text and reach the quality threshold, with their score."""
    chunks = chunk_text(df.where(F.length("content") > 0), size, overlap, extra={
        "quality_score": quality_score, "is_blank": lambda piece: F.length(X.trim_space(piece)) == 0,
    })
    return chunks.where(~F.col("is_blank") & (F.col("quality_score") >= F.lit(min_quality)))


def gold_documents(
    silver: DataFrame, as_of: Column, chunk: int = CHUNK_SIZE, min_quality: float = MIN_QUALITY, overlap: int = 0
) -> DataFrame:
    """Scored chunks without embedding. A narrow plan: nothing is shuffled."""
    return scored_chunks(silver, chunk, min_quality, overlap).select(
        F.col("chunk_id").alias("id"), F.col("chunk_content").alias("content"),
        F.col("chunk_index").cast("bigint").alias("chunk_index"), "total_chunks", "metadata", "source",
        F.col("content_hash").alias("original_content_hash"),
        F.lit(None).cast("array<float>").alias("embedding"), "quality_score", as_of.alias("ready_at"),
    )


def embed_missing(gold: DataFrame, encoder: Encoder | None = None, dim: int = 384) -> DataFrame:
    """Fill the vectors of rows that have none; other rows keep theirs.

    One pass: only the texts of rows in need are handed to the encoder.
    """
    done = has_vector("embedding")
    encoded = embed_text(F.when(~done, F.col("content")), encoder, dim)
    return gold.withColumn("embedding", F.when(done, F.col("embedding")).otherwise(encoded))


def transform_partitions(
    silver: DataFrame, as_of: Column, days: list | None = None, worker: str = "spark",
    size: int = CHUNK_SIZE, min_quality: float = MIN_QUALITY,
) -> DataFrame:
    """Scored chunks in the day-partitioned layout; all days in one job, or only some."""
    rows = silver if days is None else silver.where(F.col("ingest_day").isin(days))
    return scored_chunks(rows, size, min_quality).select(
        "chunk_id", F.col("id").alias("source_document_id"), "chunk_content",
        F.col("chunk_index").alias("chunk_idx"), F.length("content").alias("original_length"),
        "source", "ingested_at", "content_hash", F.col("quality_score").cast("double").alias("quality_score"),
        as_of.cast("string").alias("processed_at"), F.lit(worker).alias("worker_version"), "ingest_day",
    )
