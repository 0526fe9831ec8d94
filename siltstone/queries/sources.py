"""Scans, writes, versions and file maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.queries.common import (
    AS_OF, BRONZE, GOLD, SILVER, bronze, digest, gold, silver,
)
from siltstone.queries.registry import ntz, query
from siltstone.plans.documents import transform_partitions, newest_per_content
from siltstone.session import scratch_path
from siltstone.sources import files as FI
from siltstone.sources import tables as S
from siltstone.sources import versions as V


@query("scan_parquet_glob", "SELECT doc_id, lang, source, n_chars, md5(text) AS content_md5 FROM documents")
def scan_parquet_glob(t):
    found = S.scan_parquet_glob(t.spark, t.folder, pattern="documents.parquet")
    return found.select("doc_id", "lang", "source", "n_chars", digest("text"))


@query("preview_documents", f"""WITH {SILVER}
SELECT id, left(content, 100) AS content_preview, metadata FROM silver ORDER BY id LIMIT 20""")
def preview_documents(t):
    return S.preview_documents(silver(t), 20)


@query("scan_gold", f"""WITH {GOLD}
SELECT id, md5(content) AS content_md5, metadata, coalesce(source, 'iceberg_gold') AS source_file,
       '{AS_OF}' AS created_at FROM gold""")
def scan_gold(t):
    path = scratch_path(t.spark, "gold")
    gold(t).write.parquet(path)
    rows = S.as_replica(t.spark.read.parquet(path), ntz(AS_OF))
    return rows.select("id", digest(), "metadata", "source_file", "created_at")


@query("scan_backup_parquet", f"""WITH {BRONZE}
SELECT id, md5(content) AS content_md5, source, CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS day FROM bronze""")
def scan_backup_parquet(t):
    path = scratch_path(t.spark, "backup")
    bronze(t).withColumn("day", F.to_date("ingested_at")).write.partitionBy("source").parquet(path)
    rows = t.spark.read.parquet(path)
    return rows.select("id", digest(), F.col("source").cast("string"), "day")


@query("scan_current_index", """SELECT doc_id, md5(text) AS content_md5 FROM documents WHERE n_chars >= 100""")
def scan_current_index(t):
    root = scratch_path(t.spark, "index")
    V.publish_version(t.documents, root, ntz("2024-01-01"))
    V.publish_version(t.documents.where("n_chars >= 100"), root, ntz("2024-01-02"))
    return V.read_version(t.spark, root).select("doc_id", digest("text"))


@query("ingest_by_priority", """
SELECT doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'labelled' WHEN n_chars > 500 THEN 'long' ELSE 'all' END AS origin
FROM documents LEFT JOIN labels l USING (doc_id)""")
def ingest_by_priority(t):
    docs = t.documents.select("doc_id", "n_chars")
    labelled = docs.join(t.labels.select("doc_id"), "doc_id", "left_semi").withColumn("origin", F.lit("labelled"))
    long = docs.where("n_chars > 500").withColumn("origin", F.lit("long"))
    rest = docs.withColumn("origin", F.lit("all"))
    return S.ingest_by_priority([labelled, long, rest], "doc_id").select("doc_id", "origin")


@query("create_bronze", f"""WITH {BRONZE}
SELECT CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS ingest_day, count(*) AS n, sum(length(content))::BIGINT AS chars
FROM bronze GROUP BY ALL""")
def create_bronze(t):
    path = scratch_path(t.spark, "bronze")
    S.create_bronze(bronze(t), path)
    rows = t.spark.read.parquet(path).groupBy("ingest_day")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("content")).alias("chars"))


@query("append_bronze", f"""WITH {BRONZE}
SELECT id, 1 + CASE WHEN length(content) > 1000 THEN 1 ELSE 0 END AS copies FROM bronze""")
def append_bronze(t):
    path = scratch_path(t.spark, "bronze")
    rows = bronze(t)
    S.create_bronze(rows, path)
    S.append_bronze(rows.where(F.length("content") > 1000), path)
    return t.spark.read.parquet(path).groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("copies"))


@query("read_seed_csv", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def read_seed_csv(t):
    path = scratch_path(t.spark, "seed")
    t.supplier.write.option("header", True).csv(path)
    return S.read_seed_csv(t.spark, path, t.supplier.schema)


UPSERT = """WITH batch AS (
  SELECT o_custkey AS id, 'buyer' AS content FROM orders GROUP BY ALL
  UNION ALL SELECT -1 - c_custkey, 'new' FROM customer)
SELECT id, content, created_at, updated_at FROM (
  SELECT c_custkey AS id, c_name AS content, '2024-01-01 00:00:00' AS created_at, NULL AS updated_at FROM customer
  WHERE c_custkey NOT IN (SELECT id FROM batch)
  UNION ALL
  SELECT b.id, b.content,
         CASE WHEN c.c_custkey IS NULL THEN '2024-02-01 00:00:00' ELSE '2024-01-01 00:00:00' END,
         CASE WHEN c.c_custkey IS NOT NULL THEN '2024-02-01 00:00:00' END
  FROM batch b LEFT JOIN customer c ON b.id = c.c_custkey)"""


@query("upsert_documents", UPSERT)
def upsert_documents(t):
    current = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("content"), ntz("2024-01-01").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )
    buyers = t.orders.select(F.col("o_custkey").alias("id")).distinct().withColumn("content", F.lit("buyer"))
    new = t.customer.select((F.lit(-1) - F.col("c_custkey")).alias("id"), F.lit("new").alias("content"))
    return S.upsert_documents(current, buyers.unionByName(new), ntz(AS_OF))


@query("delete_documents", """WITH asked AS (
  SELECT doc_id FROM labels WHERE toxic = 1 UNION SELECT -1 - doc_id FROM labels WHERE toxic = 1)
SELECT doc_id, 'deleted' AS outcome FROM asked WHERE doc_id IN (SELECT doc_id FROM documents)
UNION ALL SELECT doc_id, 'absent' FROM asked WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT doc_id, 'kept' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM asked)""")
def delete_documents(t):
    toxic = t.labels.where("toxic = 1").select("doc_id")
    asked = toxic.union(toxic.select((F.lit(-1) - F.col("doc_id")).alias("doc_id")))
    left, report = S.delete_documents(t.documents.select("doc_id"), asked, "doc_id")
    outcome = F.when(F.col("deleted"), "deleted").otherwise("absent").alias("outcome")
    return report.select("doc_id", outcome).union(left.select("doc_id", F.lit("kept")))


@query("delete_like_then_insert", """SELECT p_name AS id, p_brand AS note FROM part WHERE p_name NOT LIKE 'red %'
UNION ALL SELECT s_name, 'supplier' FROM supplier""")
def delete_like_then_insert(t):
    current = t.part.select(F.col("p_name").alias("id"), F.col("p_brand").alias("note"))
    new = t.supplier.select(F.col("s_name").alias("id"), F.lit("supplier").alias("note"))
    return S.delete_like_then_insert(current, "red %", new)


@query("backup_partitioned", """SELECT year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day,
  count(*) AS n, round(sum(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN 2 * value ELSE value END), 4) AS total
FROM events GROUP BY ALL""")
def backup_partitioned(t):
    path = scratch_path(t.spark, "backup")
    events = t.events.select("event_id", "ts", "value")
    S.backup_partitioned(events, path, F.col("ts"))
    again = events.where(F.to_date("ts") == F.lit("2024-01-05").cast("date"))
    S.backup_partitioned(again.withColumn("value", F.col("value") * 2), path, F.col("ts"))
    rows = t.spark.read.parquet(path).groupBy("year", "month", "day")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


VERSIONS = """SELECT {v} AS version, o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus {c} GROUP BY ALL"""


def _order_versions(t):
    root = scratch_path(t.spark, "orders")
    for day, status in enumerate(("F", "O", "P"), 1):
        V.publish_version(t.orders.where(F.col("o_orderstatus") == status), root, ntz(f"2024-01-0{day}"))
    V.publish_version(t.orders, root, ntz("2024-01-20"))
    return root


@query("publish_version", VERSIONS.format(v=4, c="IS NOT NULL"))
def publish_version(t):
    root = _order_versions(t)
    version, _ = V.current_version(t.spark, root)
    counts = V.read_version(t.spark, root).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("version", F.lit(version))


@query("read_version", " UNION ALL ".join([
    VERSIONS.format(v=1, c="= 'F'"), VERSIONS.format(v=3, c="= 'P'"), VERSIONS.format(v=4, c="IS NOT NULL")]))
def read_version(t):
    root = _order_versions(t)
    parts = {
        1: V.read_version(t.spark, root, version=1),
        3: V.read_version(t.spark, root, as_of=ntz("2024-01-10")),
        4: V.read_version(t.spark, root),
    }
    rows = None
    for version, df in parts.items():
        counts = df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).withColumn("version", F.lit(version))
        rows = counts if rows is None else rows.unionByName(counts)
    return rows


@query("expire_versions", """SELECT 3 AS version, count(*) AS n FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 4, count(*) FROM orders""")
def expire_versions(t):
    root = _order_versions(t)
    V.expire(t.spark, root, ntz("2024-02-01"), older_than_days=7, retain_last=2)
    left = t.spark.read.option("basePath", root).parquet(f"{root}/v=*")
    return left.groupBy(F.col("v").cast("int").alias("version")).agg(F.count(F.lit(1)).alias("n"))


@query("discover_partitions", f"""WITH {BRONZE}
SELECT DISTINCT CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS partition_key FROM bronze""")
def discover_partitions(t):
    path = scratch_path(t.spark, "silver")
    S.create_bronze(bronze(t), path)
    return S.discover_partitions(t.spark, path)


GOLD_V2 = """SELECT id AS chunk_id, doc AS source_document_id, md5(content) AS content_md5,
  CAST(chunk_index AS INTEGER) AS chunk_idx, CAST(original_length AS INTEGER) AS original_length, source,
  CAST(ingested_at AS VARCHAR) AS ingested_at, original_content_hash AS content_hash,
  CAST(quality_score AS DOUBLE) AS quality_score, CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS ingest_day FROM gold"""


def _day_partitioned_silver(t):
    path = scratch_path(t.spark, "silver")
    rows = newest_per_content(bronze(t)).where(F.length("content").between(50, 10000))
    S.create_bronze(rows, path)
    return path


def _show_v2(df):
    return df.drop("processed_at", "worker_version").withColumn("content_md5", F.md5("chunk_content")).drop("chunk_content")


@query("transform_partitions", f"WITH {GOLD} {GOLD_V2}")
def transform_partitions_query(t):
    rows = t.spark.read.parquet(_day_partitioned_silver(t))
    return _show_v2(transform_partitions(rows, ntz(AS_OF)))


@query("merge_staging", f"""WITH {GOLD}, v2 AS ({GOLD_V2})
SELECT chunk_id, content_md5, 'target' AS side FROM v2 WHERE chunk_idx = 1
UNION ALL SELECT chunk_id, content_md5, 'staged' FROM v2 WHERE chunk_idx > 1""")
def merge_staging(t):
    staged = transform_partitions(t.spark.read.parquet(_day_partitioned_silver(t)), ntz(AS_OF))
    target = staged.where("chunk_idx = 1")
    added = S.merge_staging(target, staged).withColumn("side", F.lit("staged"))
    both = target.withColumn("side", F.lit("target")).unionByName(added)
    return both.select("chunk_id", digest("chunk_content"), "side")


def _six_files(rows, path):
    """Six files of a table. Neighbouring splits of a large one are joined, which reads Parquet and not shuffled rows."""
    if rows.rdd.getNumPartitions() >= 6:
        rows.coalesce(6).write.parquet(path)
        if FI.list_files(rows.sparkSession, path).count() == 6:  # a task without a row leaves no file
            return
    rows.repartition(6).write.mode("overwrite").parquet(path)


@query("file_stats", """SELECT 6::BIGINT AS file_count, true AS sizes_agree, count(*) AS n FROM lineitem""")
def file_stats(t):
    """Sizes differ from run to run; that they agree with each other does not."""
    path = scratch_path(t.spark, "files")
    _six_files(t.lineitem, path)
    low, mean, high, total = (F.col(f"{k}_size_mb") for k in ("min", "avg", "max", "total"))
    agree = (low > 0) & (low <= mean) & (mean <= high) & (F.abs(total - mean * F.col("file_count")) < 0.05)
    rows = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))  # one row
    return FI.file_stats(t.spark, path).select("file_count", agree.alias("sizes_agree")).join(F.broadcast(rows), how="inner")


@query("compact", "SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity, 1 AS files FROM lineitem GROUP BY ALL")
def compact(t):
    """Files that are near the target size already stay, and are counted, as they are."""
    path, target = scratch_path(t.spark, "small"), scratch_path(t.spark, "compacted")
    _six_files(t.lineitem, path)
    if not FI.compact(t.spark, path, target):
        target = path
    counts = t.spark.read.parquet(target).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )
    files = FI.file_stats(t.spark, target).select(F.col("file_count").cast("int").alias("files"))
    return counts.join(F.broadcast(files), how="inner")


@query("find_orphan_files", """SELECT o_orderstatus AS folder, count(*) > 0 AS has_rows, true AS has_bytes FROM orders
WHERE o_orderstatus IN ('O', 'P') GROUP BY ALL""")
def find_orphan_files(t):
    path = scratch_path(t.spark, "orphans")
    for status in ("F", "O", "P"):
        t.orders.where(F.col("o_orderstatus") == status).coalesce(1).write.parquet(f"{path}/{status}")
    kept = FI.list_files(t.spark, f"{path}/F")
    orphans = FI.find_orphan_files(FI.list_files(t.spark, path), kept, F.timestamp_add("DAY", F.lit(4), F.current_timestamp()))
    folder = F.regexp_extract("path", "/([FOP])/[^/]+$", 1).alias("folder")
    rows = t.orders.groupBy(F.col("o_orderstatus").alias("folder")).agg((F.count(F.lit(1)) > 0).alias("has_rows"))
    return orphans.select(folder, (F.col("length") > 0).alias("has_bytes")).join(rows, "folder")


@query("compare_file_stats", """SELECT 6::BIGINT AS files_before, 1::BIGINT AS files_after, -5::BIGINT AS file_change, true AS mean_grew, count(*) AS n FROM orders""")
def compare_file_stats(t):
    path, target = scratch_path(t.spark, "small"), scratch_path(t.spark, "compacted")
    _six_files(t.orders, path)
    if not FI.compact(t.spark, path, target):
        target = path
    change = FI.compare_file_stats(FI.file_stats(t.spark, path), FI.file_stats(t.spark, target))
    rows = t.spark.read.parquet(target).agg(F.count(F.lit(1)).alias("n"))  # one row
    return change.select("files_before", "files_after", "file_change", (F.col("avg_mb_change") >= 0).alias("mean_grew")).join(
        F.broadcast(rows), how="inner")
