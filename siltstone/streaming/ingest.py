"""Incremental cleaning: each batch adds its newest rows per content hash to a state.

The state is append-only, one folder per batch, so a batch that is run again
after a failure replaces its own folder and nothing is counted twice.  The clean
table is the newest row per hash over the state: the same rows a full refresh
gives, whatever the order of the batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.encoder import Encoder, embed_text
from siltstone.functions.text import content_hash
from siltstone.functions.vectors import has_vector
from siltstone.operators.windows import deduplicate
from siltstone.plans.documents import MAX_LENGTH, MIN_LENGTH, clean_rows, newest_per_content
from siltstone.session import scratch_path
from siltstone.sources.tables import upsert_documents
from siltstone.sources.versions import remove_folders


def rows_beyond(bronze: DataFrame, state: DataFrame) -> DataFrame:
    """Newest raw rows per hash that the state does not hold in the same or a newer version.

    Rows are compared with the state's row of their own hash, not with its
    newest time, so rows that come late or at an equal time are not lost.
    """
    known = state.select(
        F.col("content_hash").alias("_hash"), F.col("ingested_at").alias("_at"), F.col("id").alias("_id"))
    not_newer = (F.col("_at") > F.col("ingested_at")) | ((F.col("_at") == F.col("ingested_at")) & (F.col("_id") >= F.col("id")))
    fresh = newest_per_content(bronze)
    return fresh.join(known, (F.col("content_hash") == F.col("_hash")) & not_newer, "left_anti")


def add_batch(bronze: DataFrame, state_path: str, batch: int) -> None:
    """Write the newest rows per hash of one batch."""
    newest_per_content(bronze).write.mode("overwrite").parquet(f"{state_path}/batch={batch}")


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    return spark.read.parquet(state_path).drop("batch")


def compact_state(spark: SparkSession, state_path: str, target_path: str) -> None:
    """Start a new state that holds only the newest row per hash of an old one.

    It stands before every later batch, so batches go on being added to it.
    """
    newest = deduplicate(read_state(spark, state_path), ["content_hash"], [F.desc("ingested_at"), F.desc("id")])
    newest.write.mode("error").parquet(f"{target_path}/batch=-1")


def silver_from_state(
    state: DataFrame, as_of: Column, min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH
) -> DataFrame:
    """The clean table. Only one row per hash and map task is shuffled."""
    newest = deduplicate(state, ["content_hash"], [F.desc("ingested_at"), F.desc("id")])
    return clean_rows(newest, as_of, min_len, max_len)


def merge_silver(silver: DataFrame, fresh: DataFrame, as_of: Column) -> DataFrame:
    """The clean table with the hashes of a batch replaced: ``fresh`` are the batch's rows in the state.

    Only rows of the batch are cleaned; a hash whose newest row is out of the length band leaves the table.
    """
    kept = silver.join(fresh.select("content_hash"), "content_hash", "left_anti").select(silver.columns)
    return kept.unionByName(clean_rows(fresh, as_of))


def silver_incremental(
    bronze: DataFrame, state_path: str, batch: int, as_of: Column, first: bool = False, silver: DataFrame | None = None,
) -> DataFrame:
    """Process the raw rows that the state does not hold yet as one batch and return the clean table.

    With the clean table before the batch only the batch's hashes are merged
    into it; without it the table is made from the whole state. A batch that
    runs again must leave its own folder out of what it compares with, so the
    state is read without it.
    """
    spark = bronze.sparkSession
    if first:
        add_batch(bronze, state_path, batch)
    else:
        before = spark.read.parquet(state_path).where(F.col("batch") != batch).drop("batch")
        fresh = rows_beyond(bronze, before)
        path = scratch_path(spark, "batch")
        fresh.write.parquet(path)  # the state's folder may not be replaced while it is read
        spark.read.parquet(path).write.mode("overwrite").parquet(f"{state_path}/batch={batch}")
        remove_folders(spark, [path])
    if silver is None or first:
        return silver_from_state(read_state(spark, state_path), as_of)
    return merge_silver(silver, spark.read.parquet(f"{state_path}/batch={batch}"), as_of)


def run_silver_stream(
    spark: SparkSession, bronze_path: str, schema: T.StructType, state_path: str, checkpoint: str,
    files_per_batch: int = 1000,
) -> None:
    """Read new raw files as a stream until none is left, batch by batch."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(bronze_path)
    query = (
        stream.writeStream.foreachBatch(lambda rows, batch: add_batch(rows, state_path, batch))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def dedup_stream(stream: DataFrame) -> DataFrame:
    """First row per content hash of a stream, however late it comes.

    No watermark: it would drop late rows that are no copies. The state holds
    one hash per distinct text; use a state store on disk for large feeds.
    """
    return stream.withColumn("content_hash", content_hash("content")).dropDuplicates(["content_hash"])


def embed_incremental(
    table: DataFrame, as_of: Column, encoder: Encoder | None = None, dim: int = 384
) -> DataFrame:
    """The table after encoding every row that lacks a vector, in one pass."""
    todo = table.where(~has_vector("embedding"))
    done = todo.withColumn("embedding", embed_text("content", encoder, dim))
    return upsert_documents(table, done, as_of)
