"""Versioned datasets: every publish writes a new folder, then adds one row to a register.

Readers follow the newest row of the register, so they see a version only when
all of it is written, and older versions stay readable until they are removed.
One publisher at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siltstone.sources.tables import folders_open, gathered

REGISTER_SCHEMA = "version int, folder string, published_at timestamp_ntz"


def parquet_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The Parquet data at a path, or None when the path does not exist."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def register(spark: SparkSession, root: str) -> DataFrame:
    """Published versions whose data has not been removed; without any, an empty frame."""
    rows = parquet_or_none(spark, f"{root}/_published", REGISTER_SCHEMA)
    if rows is None:
        return spark.createDataFrame([], REGISTER_SCHEMA)
    removed = parquet_or_none(spark, f"{root}/_removed", "version int")
    return rows if removed is None else rows.join(removed, "version", "left_anti").select("version", "folder", "published_at")


def current_version(spark: SparkSession, root: str, as_of: Column | None = None) -> tuple[int, str] | None:
    rows = register(spark, root)
    if as_of is not None:
        rows = rows.where(F.col("published_at") <= as_of)
    newest = rows.orderBy(F.desc("version")).first()
    return None if newest is None else (newest["version"], newest["folder"])


def publish_version(
    df: DataFrame, root: str, published_at: Column | None = None, rows_per_file: int | None = None,
    partition_by: Sequence[str] = (), beside: dict[str, DataFrame] | None = None,
) -> int:
    """Write a new version and make it the current one; returns its number.

    ``partition_by`` names folder columns; ``beside`` holds small tables that
    belong to the version, each under its name in the version's folder.
    """
    spark = df.sparkSession
    numbers = parquet_or_none(spark, f"{root}/_published", REGISTER_SCHEMA)
    version = 1 if numbers is None else numbers.agg(F.max("version")).first()[0] + 1
    folder = f"v={version:08d}"
    writer = (gathered(df, *partition_by) if partition_by else df).write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    with folders_open(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{root}/{folder}")
    for name, table in (beside or {}).items():
        table.write.mode("overwrite").parquet(f"{root}/{folder}/_{name}")  # readers of the version pass over such names
    stamp = F.current_timestamp() if published_at is None else published_at
    entry = spark.range(1).select(
        F.lit(version).alias("version"), F.lit(folder).alias("folder"),
        stamp.cast("timestamp_ntz").alias("published_at"),
    )
    entry.coalesce(1).write.mode("append").parquet(f"{root}/_published")
    return version


def read_version(
    spark: SparkSession, root: str, version: int | None = None, as_of: Column | None = None,
    fallback: DataFrame | None = None,
) -> DataFrame:
    """A given version, the newest one, or the newest one published by ``as_of``."""
    if version is not None:
        return spark.read.parquet(f"{root}/v={version:08d}")
    newest = current_version(spark, root, as_of)
    if newest is None:
        if fallback is None:
            raise FileNotFoundError(f"nothing published below {root}")
        return fallback
    return spark.read.parquet(f"{root}/{newest[1]}")


def expired_versions(
    published: DataFrame, as_of: Column, older_than_days: int | None = 7, retain_last: int = 2
) -> DataFrame:
    """Versions that may go: neither among the newest ones nor published recently.

    The register holds one row per version. With ``older_than_days=None`` only
    the number of kept versions counts; the newest version always stays.
    """
    place = F.dense_rank().over(W.orderBy(F.desc("version")))
    old = F.lit(True) if older_than_days is None else (
        F.col("published_at") < F.timestamp_add("DAY", F.lit(-older_than_days), as_of.cast("timestamp_ntz"))
    )
    ranked = published.withColumn("_place", place)
    return ranked.where((F.col("_place") > max(retain_last, 1)) & old).drop("_place")


def expired_files(manifest: DataFrame, published: DataFrame, as_of: Column, **rules) -> DataFrame:
    """Files (version, path) that only expired versions refer to."""
    gone = expired_versions(published, as_of, **rules).select("version")
    dropped = manifest.join(F.broadcast(gone), "version", "left_semi")  # one row per version
    kept = manifest.join(F.broadcast(gone), "version", "left_anti")
    return dropped.select("path").distinct().join(kept.select("path").distinct(), "path", "left_anti")


def remove_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders through the file system the path names."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def expire(spark: SparkSession, root: str, as_of: Column, older_than_days: int | None = 7, retain_last: int = 2) -> int:
    """Remove the data of expired versions; returns how many went."""
    gone = expired_versions(register(spark, root), as_of, older_than_days, retain_last)
    found = gone.select("version", "folder").collect()  # one row per version
    if found:
        # Recorded first: a version is never offered to readers while its data goes.
        spark.createDataFrame([(r["version"],) for r in found], "version int").coalesce(1).write.mode("append").parquet(f"{root}/_removed")
        remove_folders(spark, [f"{root}/{r['folder']}" for r in found])
    return len(found)


def read_beside(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A table that belongs to the current version, or None."""
    newest = current_version(spark, root)
    return None if newest is None else parquet_or_none(spark, f"{root}/{newest[1]}/_{name}")
