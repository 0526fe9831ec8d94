"""A clean table kept up to date in buckets of the content hash, by batches or by a stream.

``<root>/log/batch=B/bucket=K`` holds the rows a batch brought: the newest per
hash, and only those that beat what earlier batches brought.  ``<root>/table/bucket=K``
holds the newest row per hash of that bucket.  A batch looks its hashes up in,
and writes again, only the buckets it touches.

The log is only ever added to, and the table follows from it, so a batch that
is run again after a failure replaces its own folder, makes the same buckets
again and changes nothing else.  No rows are kept in a stream's own memory: the
log is the keyed state, and it holds however late a row comes.

Defined results: rows without text never enter; of equal hashes and times the
greatest id wins; a hash whose newest row is out of the length band leaves the
clean table; a batch without rows, or without new ones, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.text import content_hash
from siltstone.operators.windows import deduplicate
from siltstone.plans.documents import MAX_LENGTH, MIN_LENGTH, clean_rows, newest_per_content
from siltstone.session import scratch_path
from siltstone.sources.tables import gathered
from siltstone.sources.versions import remove_folders

# Buckets of a table. More make a small batch read less, and a large one write more files.
BUCKETS = 64


def bucket_of(key: Column | str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def touched(rows: DataFrame) -> list[int]:
    """The buckets that hold a row: as many numbers as there are buckets at most, whatever the rows."""
    return sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())


def stage(rows: DataFrame) -> str:
    """Write a batch's rows once, so that they are hashed and reduced once; the folder is removed after it."""
    path = scratch_path(rows.sparkSession, "batch")
    rows.write.parquet(path)
    return path


def read_log(spark: SparkSession, root: str, buckets: list[int], but: int | None = None) -> DataFrame | None:
    """Rows that batches brought to some buckets, read from these buckets' folders alone."""
    if not exists(spark, f"{root}/log"):
        return None
    rows = spark.read.parquet(f"{root}/log").where(F.col("bucket").isin(buckets))
    return rows if but is None else rows.where(F.col("batch") != but)


def beyond(fresh: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose hash is not known in the same or a newer version."""
    seen = known.select(
        F.col("bucket").alias("_bucket"), F.col("content_hash").alias("_hash"),
        F.col("ingested_at").alias("_at"), F.col("id").alias("_id"))
    not_newer = (F.col("_at") > F.col("ingested_at")) | (
        (F.col("_at") == F.col("ingested_at")) & (F.col("_id") >= F.col("id")))
    same = (F.col("bucket") == F.col("_bucket")) & (F.col("content_hash") == F.col("_hash"))
    return fresh.join(seen, same & not_newer, "left_anti")


def write_batch(rows: DataFrame, root: str, batch: int) -> None:
    gathered(rows, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/log/batch={batch}")


def brought(spark: SparkSession, root: str, batch: int) -> list[int]:
    """The buckets to which a batch brought rows."""
    path = f"{root}/log/batch={batch}"
    if not exists(spark, path):
        return []
    rows = spark.read.option("basePath", f"{root}/log").parquet(f"{root}/log")
    return touched(rows.where(F.col("batch") == batch))


def merge_batch(
    bronze: DataFrame, root: str, batch: int, as_of: Column, buckets: int = BUCKETS,
    min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH,
) -> list[int]:
    """Bring the newest raw rows to the table and return the buckets that were written again.

    ``processed_at`` of a row is the ``as_of`` of the batch that brought it.
    """
    spark = bronze.sparkSession
    fresh = newest_per_content(bronze.where(F.col("content").isNotNull())).withColumns(
        {"processed_at": as_of, "bucket": bucket_of("content_hash", buckets)})
    staged = stage(fresh)
    mine = touched(spark.read.parquet(staged))
    if mine:
        fresh, known = spark.read.parquet(staged), read_log(spark, root, mine, batch)
        write_batch(fresh if known is None else beyond(fresh, known), root, batch)
    remove_folders(spark, [staged])
    changed = brought(spark, root, batch) if mine else []
    if changed:
        rebuild_buckets(spark, root, changed, min_len, max_len)
    return changed


def rebuild_buckets(
    spark: SparkSession, root: str, buckets: list[int], min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH,
) -> None:
    """Make some buckets of the table again from the log.

    The newest row per hash is kept even where it is out of the length band,
    without its text, so that no bucket is ever left without a file to replace it.
    """
    newest = deduplicate(
        read_log(spark, root, buckets).drop("batch"), ["content_hash"], [F.desc("ingested_at"), F.desc("id")])
    inside = F.length("content").between(min_len, max_len)
    table = newest.withColumn("in_band", inside).withColumn("content", F.when(inside, F.col("content")))
    writer = gathered(table, "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(f"{root}/table")


def read_table(
    spark: SparkSession, root: str, min_len: int = MIN_LENGTH, max_len: int = MAX_LENGTH,
) -> DataFrame:
    """The clean table: a scan, without a shuffle."""
    rows = spark.read.parquet(f"{root}/table").where("in_band")
    return clean_rows(rows, F.col("processed_at"), min_len, max_len)


def compact_log(spark: SparkSession, root: str, target: str) -> None:
    """Start a new root whose log holds only the newest row per hash, before every later batch."""
    rows = spark.read.parquet(f"{root}/log").drop("batch")
    newest = deduplicate(rows, ["content_hash"], [F.desc("ingested_at"), F.desc("id")])
    write_batch(newest, target, -1)
    rebuild_buckets(spark, target, brought(spark, target, -1))


def run_table_stream(
    spark: SparkSession, bronze_path: str, schema: T.StructType, root: str, checkpoint: str, as_of: Column,
    files_per_batch: int = 1000, buckets: int = BUCKETS,
) -> None:
    """Read new raw files as a stream until none is left; each batch runs :func:`merge_batch`."""
    def merge(rows: DataFrame, batch: int) -> None:
        merge_batch(rows, root, batch, as_of, buckets)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(bronze_path)
    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def add_first(rows: DataFrame, root: str, batch: int, buckets: int = BUCKETS) -> None:
    """Write the rows of a batch whose hash no other batch has written, one per hash.

    The first by time, then id. Only the batch's own buckets are read.
    """
    hashed = rows.where(F.col("content").isNotNull()).withColumn("content_hash", content_hash("content"))
    first = deduplicate(hashed, ["content_hash"], [F.asc("ingested_at"), F.asc("id")])
    spark = rows.sparkSession
    staged = stage(first.withColumn("bucket", bucket_of("content_hash", buckets)))
    first = spark.read.parquet(staged)
    mine = touched(first)
    if mine:
        known = read_log(spark, root, mine, batch)
        if known is not None:
            first = first.join(known.select("bucket", "content_hash"), ["bucket", "content_hash"], "left_anti")
        write_batch(first, root, batch)
    remove_folders(spark, [staged])


def run_first_stream(stream: DataFrame, root: str, checkpoint: str, buckets: int = BUCKETS) -> None:
    """De-duplicate a stream against everything written before, with no state in memory."""
    query = (
        stream.writeStream.foreachBatch(lambda rows, batch: add_first(rows, root, batch, buckets))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
