"""Document tables on Parquet: raw input, scans, partition-wise writes, seeds."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.text import normalise_metadata
from siltstone.functions.vectors import has_vector
from siltstone.operators.windows import deduplicate

# Source names given to rows that carry none.
GOLD_SOURCE = "iceberg_gold"
SYNC_SOURCE = "duckdb_sync"
SYNC_SCORE = 9.5


class Tables:
    """Parquet tables of one folder, by attribute: ``Tables(spark, path).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def bronze_from_documents(documents: DataFrame, start: str = "2024-01-01 00:00:00") -> DataFrame:
    """Raw document rows; the ingestion time is derived from the id, one minute apart."""
    stamp = F.lit(start).cast("timestamp_ntz") + F.col("doc_id") * F.expr("interval '1' minute")
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("content"),
        "source",
        stamp.cast("timestamp_ntz").alias("ingested_at"),
        F.to_json(F.struct("lang", "n_chars")).alias("raw_metadata"),
    )


def gathered(rows: DataFrame, *by: str) -> DataFrame:
    """Rows of a folder in as many tasks, and so files, as their size asks for.

    Spark measures the shuffled rows: small folders share a task, and a folder
    larger than ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` is split.
    """
    return rows.hint("rebalance", *[F.col(c) for c in by])


# Folders that a task writes at a time; with more of them its rows are sorted by folder.
OPEN_FOLDERS = 8


@contextmanager
def folders_open(spark: SparkSession, limit: int = OPEN_FOLDERS) -> Iterator[None]:
    """Writes of folders inside keep files of several open instead of sorting a task's rows by folder.

    Rows with vectors are many times larger in a sort than in the shuffle that Spark sizes tasks by.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, limit)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_by(rows: DataFrame, path: str, mode: str, *by: str) -> None:
    """Write one folder per value of the columns, with files by size."""
    with folders_open(rows.sparkSession):
        gathered(rows, *by).write.mode(mode).partitionBy(*by).parquet(path)


def append_bronze(rows: DataFrame, path: str) -> None:
    """Append raw rows to the day-partitioned table."""
    write_by(rows.withColumn("ingest_day", F.to_date("ingested_at")), path, "append", "ingest_day")


def create_bronze(rows: DataFrame, path: str) -> None:
    """Start the day-partitioned table; fails when it exists."""
    write_by(rows.withColumn("ingest_day", F.to_date("ingested_at")), path, "error", "ingest_day")


def folders_named(spark: SparkSession, path: str, pattern: str) -> dict[str, str]:
    """Folders directly below a path whose names fit, each with its path as file names show it; hidden ones are passed over."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop.Path(root, pattern))
    places = [status.getPath() for status in found or [] if status.isDirectory()]
    return {str(p.toString()): str(p.toUri().getRawPath()) for p in places if str(p.getName())[0] not in "_."}


def scan_parquet_glob(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, pattern: str = "*.parquet"
) -> DataFrame:
    """All Parquet files below a folder whose names fit; an empty result is an error.

    A table of many files is a folder: where a folder directly below the path
    fits, its Parquet files are read whatever their own names, and once.
    Whether there is a row is answered from one file, not by counting the rows.
    """
    def read(names: str, kind: T.StructType | str | None, *paths: str) -> DataFrame:
        reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", names)
        return (reader.schema(kind) if kind else reader).parquet(*paths)

    folders = folders_named(spark, path, pattern)
    if folders:
        inside = read("*.parquet", schema, *folders)
        place = F.regexp_replace("_metadata.file_path", "^[^:/]+:(//[^/]*)?", "")
        elsewhere = [~F.startswith(place, F.lit(f"{root}/")) for root in folders.values()]
        df = inside.unionByName(read(pattern, inside.schema, path).where(reduce(Column.__and__, elsewhere)))
    else:
        df = read(pattern, schema, path)
    if df.isEmpty():
        raise FileNotFoundError(f"no rows below {path}")
    return df


def preview_documents(df: DataFrame, limit: int = 20, key: str = "id") -> DataFrame:
    """First rows by key with the start of their text."""
    shown = df.orderBy(key).limit(limit)
    return shown.select(key, F.left("content", F.lit(100)).alias("content_preview"), "metadata")


def as_replica(df: DataFrame, as_of: Column) -> DataFrame:
    """Chunks in the search replica's columns; rows without text are dropped."""
    return df.where(F.col("content").isNotNull()).select(
        "id", "content", F.col("embedding").cast("array<float>").alias("embedding"), "metadata",
        F.coalesce("source", F.lit(GOLD_SOURCE)).alias("source_file"),
        F.coalesce(F.col("ready_at"), as_of).alias("created_at"),
    )


def ingest_by_priority(sources: Sequence[DataFrame], key: str = "id") -> DataFrame:
    """One row per key, taken from the first source that has it."""
    ranked = None
    for rank, source in enumerate(sources):
        tagged = source.withColumn("_rank", F.lit(rank))
        ranked = tagged if ranked is None else ranked.unionByName(tagged, allowMissingColumns=True)
    return deduplicate(ranked, [key], ["_rank"]).drop("_rank")


def read_seed_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV with header; the schema is given, so the file is read once."""
    return spark.read.option("header", True).schema(schema).csv(path)


def last_per_key(batch: DataFrame, key: str = "id", order: Sequence[Column | str] = ()) -> DataFrame:
    """The row of every key that comes last in the given order; without one, in the order of all other columns."""
    rising = list(order) or [c for c in batch.columns if c != key]
    falling = [F.desc_nulls_last(c) if isinstance(c, str) else c for c in rising]
    return deduplicate(batch, [key], falling) if falling else batch.dropDuplicates([key])


def upsert_documents(
    current: DataFrame, batch: DataFrame, as_of: Column, key: str = "id", order: Sequence[Column | str] = (),
) -> DataFrame:
    """The table after inserting new rows and replacing rows of known keys.

    Of several batch rows with one key the last wins: ``order`` names the columns
    by which it is the greatest. ``updated_at`` is set on replaced rows only and
    their ``created_at`` stays. The large table is filtered by the keys of the
    batch, which Spark sends to every task when they are few; it is not shuffled
    then.
    """
    batch = last_per_key(batch, key, order)
    known = current.select(key, F.col("created_at").alias("_created")).join(batch.select(key), key, "left_semi")
    merged = batch.drop("created_at", "updated_at").join(known, key, "left")
    is_update = F.col("_created").isNotNull()
    fresh = merged.withColumns({
        "created_at": F.coalesce("_created", as_of),
        "updated_at": F.when(is_update, as_of),
    }).drop("_created")
    kept = current.join(batch.select(key), key, "left_anti")
    if "updated_at" not in kept.columns:
        kept = kept.withColumn("updated_at", F.lit(None).cast(fresh.schema["updated_at"].dataType))
    return kept.unionByName(fresh.select(kept.columns))


def delete_documents(current: DataFrame, ids: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """The table without the given keys, and the keys with a flag whether each was there."""
    wanted = ids.select(key).distinct()
    found = current.select(key).join(wanted, key, "left_semi").distinct().withColumn("_found", F.lit(True))
    report = wanted.join(found, key, "left").select(key, F.coalesce("_found", F.lit(False)).alias("deleted"))
    return current.join(wanted, key, "left_anti"), report


def delete_like_then_insert(current: DataFrame, pattern: str, rows: DataFrame, key: str = "id") -> DataFrame:
    return current.where(~F.col(key).like(pattern)).unionByName(rows, allowMissingColumns=True)


def backup_partitioned(df: DataFrame, path: str, day: Column) -> None:
    """Copy into year/month/day folders, replacing only the day that is written."""
    dated = df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})
    days = ("year", "month", "day")
    writer = gathered(dated, *days).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with folders_open(df.sparkSession):
        writer.partitionBy(*days).parquet(path)


def discover_partitions(spark: SparkSession, path: str, column: str = "ingest_day") -> DataFrame:
    """Partition values found in the names of the folders below a path, newest first; no file is listed."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop.Path(root, f"{column}=*"))
    keys = {str(status.getPath().getName()).partition("=")[2] for status in found or []}
    return spark.createDataFrame([(k,) for k in sorted(keys)], "partition_key string").orderBy(F.desc("partition_key"))


def merge_staging(target: DataFrame, staging: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Staged rows whose key the target does not hold yet, one per key."""
    newest = deduplicate(staging, [key], staging.columns)
    return newest.join(target.select(key), key, "left_anti")


def sync_rows(replica: DataFrame, as_of: Column) -> DataFrame:
    """Replica rows as one-chunk gold rows."""
    return replica.select(
        "id", "content", F.lit(1).cast("bigint").alias("chunk_index"), F.lit(1).alias("total_chunks"),
        normalise_metadata("metadata").alias("metadata"), F.lit(SYNC_SOURCE).alias("source"),
        F.col("id").alias("original_content_hash"), "embedding",
        F.lit(SYNC_SCORE).cast("decimal(4,1)").alias("quality_score"), as_of.alias("ready_at"),
    )


def sync_replica_to_lake(
    gold: DataFrame, replica: DataFrame, as_of: Column, order: Sequence[Column | str] = (),
) -> DataFrame:
    """Gold with the replica's rows in place of gold rows of the same id; of rows with one id the last wins."""
    order = order or [c for c in ("created_at", "content") if c in replica.columns]
    # Looked at before the rows are shuffled, so that a reader without vectors does not sort them.
    last = last_per_key(replica.withColumn("_has_vector", has_vector("embedding")), "id", order)
    rows = sync_rows(last.where("_has_vector"), as_of)
    return gold.join(rows.select("id"), "id", "left_anti").unionByName(rows)

