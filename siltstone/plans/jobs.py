"""User-level jobs: embedding, reindexing, maintenance, partition-wise transforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.encoder import Encoder
from siltstone.operators.aggregates import embedding_coverage
from siltstone.functions.vectors import has_vector
from siltstone.operators.ann import ann_topk, build_index, centroid_table, read_centroids, train_centroids
from siltstone.operators.search import vector_topk
from siltstone.plans.documents import embed_missing, transform_partitions
from siltstone.session import scratch_path
from siltstone.sources import files, versions
from siltstone.sources.tables import as_replica, backup_partitioned, discover_partitions, ingest_by_priority, merge_staging, write_by

# Name of the table of centroids beside an indexed version.
CENTROIDS = "centroids"


def embed_gold(
    spark: SparkSession, root: str, as_of: Column, encoder: Encoder | None = None, dim: int = 384
) -> DataFrame:
    """Fill missing vectors of the current version, publish the result, compact small files, report the coverage.

    Without a row in need nothing is rewritten.
    """
    current = versions.read_version(spark, root)
    if not current.where(~has_vector("embedding")).isEmpty():
        versions.publish_version(embed_missing(current, encoder, dim), root, as_of)
    compact_version(spark, root, as_of)
    return embedding_coverage(versions.read_version(spark, root))


def compact_version(
    spark: SparkSession, root: str, as_of: Column, target_mb: float = files.TARGET_MB, min_files: int = files.MIN_FILES,
) -> bool:
    """Publish the current version again with files near the target size, when it has many small ones.

    Folder columns and the tables beside the version stay.
    """
    _, folder = versions.current_version(spark, root)
    path = f"{root}/{folder}"
    if not files.needs_compaction(spark, path, target_mb, min_files):
        return False
    by = files.partition_columns(spark, path)
    centroids = versions.read_beside(spark, root, CENTROIDS)
    rows = spark.read.parquet(path) if by else files.compacted(spark, path, target_mb)
    versions.publish_version(
        rows, root, as_of, partition_by=by, beside=None if centroids is None else {CENTROIDS: centroids})
    return True


def reindex(
    spark: SparkSession, gold: DataFrame, root: str, as_of: Column, backup_path: str | None = None,
    legacy: DataFrame | None = None, samples: DataFrame | None = None, encoder: Encoder | None = None,
    dim: int = 384, cells: int = 0, keep: int = 3,
) -> DataFrame:
    """Build and publish a new search replica; returns it.

    Gold rows win over rows of the current replica. The legacy copy is read only
    when gold has no rows, and samples when all of these are empty.  With
    ``cells`` the version is an index: one folder per cell, with the cells'
    centroids beside it, which ``search_replica`` reads back.  Older versions
    beyond ``keep`` are removed.
    """
    found = [as_replica(gold, as_of)]
    if legacy is not None and not found[0].isEmpty():
        legacy = None
    if versions.current_version(spark, root) is not None:
        found.append(versions.read_version(spark, root).drop("cell"))
    if legacy is not None:
        found.append(legacy)
    rows = ingest_by_priority(found)
    if samples is not None and rows.isEmpty():
        rows = samples
    filled = embed_missing(rows, encoder, dim)
    if cells:
        # The vectors are read several times from here on, so they are made once, in columns.
        path = scratch_path(spark, "vectors")
        filled.write.parquet(path)
        filled = spark.read.parquet(path)
        centroids = train_centroids(filled, cells)
        versions.publish_version(
            build_index(filled, centroids), root, as_of, partition_by=["cell"],
            beside={CENTROIDS: centroid_table(spark, centroids)})
        versions.remove_folders(spark, [path])
    else:
        versions.publish_version(filled, root, as_of)
    replica = versions.read_version(spark, root)
    if backup_path:
        backup_partitioned(replica, backup_path, as_of)
    versions.expire(spark, root, as_of, older_than_days=None, retain_last=keep)
    return replica


def search_replica(
    spark: SparkSession, root: str, query: Sequence[float], k: int = 10, probes: int | None = None, columns: Sequence[str] = (),
) -> DataFrame:
    """The k nearest rows of the current version: only the probed cells' folders are read.

    A version without an index is searched whole.
    """
    rows, centroids = versions.read_version(spark, root), versions.read_beside(spark, root, CENTROIDS)
    if centroids is None:
        return vector_topk(rows, query, k, columns=columns)
    return ann_topk(rows, read_centroids(centroids), query, k, probes, columns=columns)


def remove_orphans(spark: SparkSession, root: str, as_of: Column, older_than_days: int = files.ORPHAN_DAYS) -> int:
    """Remove old files of folders that no registered version refers to; returns how many.

    Such folders are left by publishes that did not end.
    """
    folder = F.regexp_extract("path", "/(v=[0-9]+)/", 1)
    listed = files.list_files(spark, root).withColumn("folder", folder).where("folder <> ''")
    kept = listed.join(F.broadcast(versions.register(spark, root).select("folder")), "folder", "left_semi")  # a row per version
    gone = files.find_orphan_files(listed, kept, as_of, older_than_days)
    count = gone.agg(F.count(F.lit(1))).first()[0]
    whole = gone.select("folder").distinct().join(kept.select("folder").distinct(), "folder", "left_anti")
    young = listed.join(gone.select("path"), "path", "left_anti").select("folder").distinct()
    names = [r["folder"] for r in whole.join(young, "folder", "left_anti").collect()]  # folders of unregistered versions
    versions.remove_folders(spark, [f"{root}/{name}" for name in names])
    return count


def maintain_tables(
    spark: SparkSession, roots: Sequence[str], as_of: Column, target_mb: float = files.TARGET_MB,
    min_files: int = files.MIN_FILES, older_than_days: int = 7, retain_last: int = 2,
) -> DataFrame:
    """Per table: analyse, compact into a new version, expire old versions, remove orphans, look again."""
    reports = []
    for root in roots:
        _, folder = versions.current_version(spark, root)
        before = files.file_stats(spark, f"{root}/{folder}")
        compact_version(spark, root, as_of, target_mb, min_files)
        _, folder = versions.current_version(spark, root)
        after = files.file_stats(spark, f"{root}/{folder}")
        # Both sides are settled before old versions go.
        change = spark.createDataFrame(files.compare_file_stats(before, after).toArrow())
        expired = versions.expire(spark, root, as_of, older_than_days, retain_last)
        orphans = remove_orphans(spark, root, as_of)
        reports.append(change.withColumns(
            {"table": F.lit(root), "expired_versions": F.lit(expired), "orphan_files": F.lit(orphans)}))
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def partitioned_gold(
    spark: SparkSession, silver_path: str, staging_path: str, target_path: str, as_of: Column,
    days: Sequence | None = None,
) -> DataFrame:
    """Transform the days found below a path in one job, add the new chunks to the target, drop the staging.

    Running it again adds nothing, as chunks the target holds are left out.
    """
    if discover_partitions(spark, silver_path).isEmpty():
        raise FileNotFoundError(f"no partitions below {silver_path}")
    chunks = transform_partitions(spark.read.parquet(silver_path), as_of, days)
    write_by(chunks, staging_path, "overwrite", "ingest_day")
    staged = spark.read.parquet(staging_path)
    known = versions.parquet_or_none(spark, target_path)
    added = staged if known is None else merge_staging(known, staged)
    write_by(added, target_path, "append", "ingest_day")
    versions.remove_folders(spark, [staging_path])
    return spark.read.parquet(target_path)
