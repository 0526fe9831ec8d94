"""File statistics, compaction and orphan search from the file listing alone."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources.tables import write_by

# Sizes and limits of the maintenance job.
MEGABYTE = 1024 * 1024
TARGET_MB = 128
MIN_FILES = 5
GOOD_ENOUGH = 0.8
ORPHAN_DAYS = 3


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file (path, length, modificationTime); contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return files.load(path).select("path", "length", "modificationTime")


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """File count and total, mean, smallest and largest size in MB."""
    size = F.col("length") / F.lit(MEGABYTE)
    return list_files(spark, path).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.round(F.sum(size), 2), F.lit(0.0)).alias("total_size_mb"),
        F.coalesce(F.round(F.avg(size), 2), F.lit(0.0)).alias("avg_size_mb"),
        F.coalesce(F.round(F.min(size), 2), F.lit(0.0)).alias("min_size_mb"),
        F.coalesce(F.round(F.max(size), 2), F.lit(0.0)).alias("max_size_mb"),
    )


def needs_compaction(
    spark: SparkSession, path: str, target_mb: float = TARGET_MB, min_files: int = MIN_FILES,
    good_enough: float = GOOD_ENOUGH,
) -> bool:
    stats = file_stats(spark, path).first()
    return stats["file_count"] >= min_files and stats["avg_size_mb"] < target_mb * good_enough


def compact(
    spark: SparkSession, path: str, target_path: str, target_mb: float = TARGET_MB, min_files: int = MIN_FILES,
) -> bool:
    """Rewrite small files into files near the target size, in a new folder.

    Partition folders stay, each with files by its size. Without them
    neighbouring input splits are read by one task and rows are not shuffled.
    """
    if not needs_compaction(spark, path, target_mb, min_files):
        return False
    folders = partition_columns(spark, path)
    if folders:
        write_by(spark.read.parquet(path), target_path, "error", *folders)
    else:
        compacted(spark, path, target_mb).write.mode("error").parquet(target_path)
    return True


def compacted(spark: SparkSession, path: str, target_mb: float = TARGET_MB) -> DataFrame:
    """The rows of a folder in as many tasks as files of the target size hold them."""
    total = list_files(spark, path).agg(F.sum("length")).first()[0]
    return spark.read.parquet(path).coalesce(max(1, math.ceil(total / (target_mb * MEGABYTE))))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the folder columns below a path, outermost first, taken from one file's name."""
    inside = F.regexp_replace("path", ".*" + re.escape(path.rstrip("/").rpartition("/")[2]) + "/", "")
    one = list_files(spark, path).select(inside.alias("inside")).first()
    return [] if one is None else [part.partition("=")[0] for part in one["inside"].split("/")[:-1] if "=" in part]


def find_orphan_files(
    listed: DataFrame, referenced: DataFrame, as_of: Column, older_than_days: int = ORPHAN_DAYS
) -> DataFrame:
    """Listed files that nothing refers to and that are old enough to be safe to remove."""
    limit = F.timestamp_add("DAY", F.lit(-older_than_days), as_of.cast("timestamp"))
    return listed.where(F.col("modificationTime") < limit).join(referenced.select("path"), "path", "left_anti")


def compare_file_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """File count and mean size before and after, with the change."""
    b = before.select(F.col("file_count").alias("files_before"), F.col("avg_size_mb").alias("avg_mb_before"))
    a = after.select(F.col("file_count").alias("files_after"), F.col("avg_size_mb").alias("avg_mb_after"))
    both = b.join(F.broadcast(a), how="inner")  # one row each
    return both.withColumns({
        "file_change": F.col("files_after") - F.col("files_before"),
        "avg_mb_change": F.round(F.col("avg_mb_after") - F.col("avg_mb_before"), 2),
    })
