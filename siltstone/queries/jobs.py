"""Whole jobs: clean, chunk, embed, reindex, maintain, compare; batch and streaming."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from siltstone.functions.encoder import embed_text
from siltstone.operators.search import compare_lanes as compare
from siltstone.plans import jobs as J
from siltstone.queries.common import (
    AS_OF, BRONZE, DIM, GOLD, SILVER, bronze, digest, gold, hashed_text, silver, vectors_sql,
)
from siltstone.queries.registry import ntz, query, rounded
from siltstone.queries.search import KNN, knn
from siltstone.queries.sources import GOLD_V2, _day_partitioned_silver, _show_v2
from siltstone.session import scratch_path, written
from siltstone.sources import files
from siltstone.sources import tables as S
from siltstone.sources import versions as V
from siltstone.streaming import ingest as I
from siltstone.streaming import keyed

SILVER_ROWS = f"WITH {SILVER} SELECT id, md5(content) AS content_md5, content_hash, source, metadata FROM silver"


def _silver_rows(df):
    return df.select("id", digest(), "content_hash", "source", "metadata")


@query("silver_documents", SILVER_ROWS)
def silver_documents(t):
    return _silver_rows(silver(t))


@query("gold_documents", f"""WITH {GOLD}
SELECT id, md5(content) AS content_md5, chunk_index, total_chunks, metadata, source, original_content_hash,
  CAST(quality_score AS DOUBLE) AS quality_score FROM gold""")
def gold_documents(t):
    return gold(t).select(
        "id", digest(), "chunk_index", "total_chunks", "metadata", "source", "original_content_hash", "quality_score"
    )


@query("gold_by_source", f"""WITH {GOLD}
SELECT source, count(*) AS chunks, count(DISTINCT doc) AS documents, CAST(min(quality_score) AS DOUBLE) AS low, round(avg(quality_score::DOUBLE), 6) AS mean
FROM gold GROUP BY ALL""")
def gold_by_source(t):
    return gold(t).groupBy("source").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_distinct(F.regexp_extract("id", "^(.*)-[0-9]+$", 1)).alias("documents"),
        F.min("quality_score").alias("low"), F.round(F.avg(F.col("quality_score").cast("double")), 6).alias("mean"),
    )


@query("silver_incremental", SILVER_ROWS)
def silver_incremental(t):
    root, rows = scratch_path(t.spark, "table"), bronze(t)
    middle = rows.agg(F.percentile_approx(F.col("ingested_at").cast("timestamp"), 0.5)).first()[0]
    # The first batch holds the later half, so the second one brings older and equal times.
    late = rows.where(F.col("ingested_at") > ntz(str(middle)))
    keyed.merge_batch(late, root, 0, ntz(AS_OF), buckets=8)
    keyed.merge_batch(rows, root, 1, ntz(AS_OF), buckets=8)
    return _silver_rows(keyed.read_table(t.spark, root))


BATCHES, SOURCE_MB = 3, 64


def _bronze_files(t, path):
    """Raw rows for a stream of three batches, in files by the table's size; returns their schema and the files of a batch."""
    rows = bronze(t)
    size = files.list_files(t.spark, f"{t.folder}/documents.parquet").agg(F.sum("length")).first()[0]
    per_batch = max(1, math.ceil(size / (BATCHES * SOURCE_MB * files.MEGABYTE)))
    rows.repartition(BATCHES * per_batch, "id").write.parquet(path)
    return rows.schema, per_batch


@query("silver_stream", SILVER_ROWS)
def silver_stream(t):
    source, root, marks = (scratch_path(t.spark, n) for n in ("bronze", "table", "marks"))
    schema, per_batch = _bronze_files(t, source)
    keyed.run_table_stream(t.spark, source, schema, root, marks, ntz(AS_OF), files_per_batch=per_batch, buckets=8)
    return _silver_rows(keyed.read_table(t.spark, root))


@query("first_rows_stream", rf"""WITH {BRONZE}, hashed AS (
  SELECT *, upper(sha256(lower(regexp_replace(content, '^\s+|\s+$', '', 'g')))) AS content_hash FROM bronze WHERE content IS NOT NULL)
SELECT content_hash, count(DISTINCT content_hash) AS copies FROM hashed GROUP BY ALL""")
def first_rows_stream(t):
    source, root, marks = (scratch_path(t.spark, n) for n in ("bronze", "first", "marks"))
    schema, per_batch = _bronze_files(t, source)
    stream = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(source)
    keyed.run_first_stream(stream, root, marks, buckets=8)
    written = t.spark.read.parquet(f"{root}/log")
    return written.groupBy("content_hash").agg(F.count(F.lit(1)).alias("copies"))


COVERED = f"""SELECT count(*) AS total_documents, count(*) AS documents_with_embeddings, '100.0%' AS embedding_coverage, 'ready' AS status FROM gold"""


@query("embed_gold", f"WITH {GOLD} {COVERED}")
def embed_gold(t):
    root = scratch_path(t.spark, "gold")
    V.publish_version(gold(t), root, ntz("2024-01-01"))
    return J.embed_gold(t.spark, root, ntz(AS_OF), dim=DIM)


@query("embed_incremental", f"""WITH {GOLD}, {vectors_sql('d', 'gold', 'id', 'content')}
SELECT id, round(sum(w), 6) AS total, count(*) AS entries FROM d GROUP BY ALL""")
def embed_incremental(t):
    rows = S.as_replica(gold(t), ntz("2024-01-01")).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    half = rows.withColumn(
        "embedding", F.when(F.length("content") > 500, embed_text("content", dim=DIM))
    )
    path = scratch_path(t.spark, "replica")
    half.write.parquet(path)
    done = I.embed_incremental(t.spark.read.parquet(path), ntz(AS_OF), dim=DIM)
    entries = done.select("id", F.explode("embedding").alias("w")).where("w <> 0")
    return entries.groupBy("id").agg(
        F.round(F.sum(F.col("w").cast("double")), 6).alias("total"), F.count(F.lit(1)).alias("entries")
    )


@query("reindex", f"""WITH {GOLD}, old AS (
  SELECT id, 'old ' || id AS content FROM gold WHERE chunk_index = 1 UNION ALL SELECT 'ui-' || conv_id || '-' || turn, text FROM conversations),
rows AS (SELECT id, content, 'gold' AS origin FROM gold UNION ALL SELECT id, content, 'index' FROM old WHERE id NOT IN (SELECT id FROM gold))
SELECT id, md5(content) AS content_md5, origin FROM rows""")
def reindex(t):
    root, backup = _reindexed(t)
    return t.spark.read.parquet(backup).where("cell is not null").select("id", digest(), F.col("source_file").alias("origin"))


def _reindexed(t, gold_rows=None):
    """A published index over gold, an older index and, where gold is empty, a legacy copy; and its backup."""
    root, backup = scratch_path(t.spark, "replica"), scratch_path(t.spark, "backup")
    stamp = ntz("2024-01-01")

    def replica(df):
        return df.select(
            "id", "content", F.lit(None).cast("array<float>").alias("embedding"), F.lit("{}").alias("metadata"),
            "source_file", stamp.alias("created_at"),
        )

    chunks = written(gold(t), "chunks")  # read four times
    stale = chunks.where("chunk_index = 1").select("id", F.concat(F.lit("old "), "id").alias("content"), F.lit("index").alias("source_file"))
    added = t.conversations.select(
        F.concat_ws("-", F.lit("ui"), "conv_id", "turn").alias("id"), F.col("text").alias("content"), F.lit("index").alias("source_file")
    )
    V.publish_version(replica(stale.unionByName(added)), root, stamp)
    legacy = replica(t.benchmark.select(F.concat(F.lit("legacy-"), "item_id").alias("id"), F.col("text").alias("content"), F.lit("legacy").alias("source_file")))
    fresh = (chunks if gold_rows is None else gold_rows(chunks)).withColumn("source", F.lit("gold"))
    J.reindex(t.spark, fresh, root, ntz(AS_OF), backup, legacy, dim=DIM, cells=8)
    return root, backup


@query("reindex_legacy", f"""WITH {GOLD}
SELECT id, md5('old ' || id) AS content_md5, 'index' AS origin FROM gold WHERE chunk_index = 1
UNION ALL SELECT 'ui-' || conv_id || '-' || turn, md5(text), 'index' FROM conversations
UNION ALL SELECT 'legacy-' || item_id, md5(text), 'legacy' FROM benchmark""")
def reindex_legacy(t):
    """Without fresh chunks the legacy copy is read beside the older index."""
    root, _ = _reindexed(t, lambda chunks: chunks.where("false"))
    return V.read_version(t.spark, root).select("id", digest(), F.col("source_file").alias("origin"))


@query("search_replica", f"""WITH {GOLD}, q AS (SELECT id, content FROM gold ORDER BY id LIMIT 1),
old AS (SELECT 'ui-' || conv_id || '-' || turn AS id, text AS content FROM conversations),
rows AS (SELECT id, content FROM gold UNION ALL SELECT id, content FROM old),
{vectors_sql('d', 'rows', 'id', 'content')},
dots AS (SELECT d.id, sum(d.w * e.w) AS dot FROM d JOIN d e ON d.bucket = e.bucket AND e.id = (SELECT id FROM q) GROUP BY ALL),
lengths AS (SELECT id, sqrt(sum(w * w)) AS n FROM d GROUP BY ALL),
own AS (SELECT n FROM lengths WHERE id = (SELECT id FROM q)),
near AS (SELECT dots.id, round(dot / (lengths.n * own.n), 12) AS s FROM dots JOIN lengths USING (id), own)
SELECT id, round(s, 6) AS score FROM near ORDER BY s DESC, id LIMIT 1""")
def search_replica(t):
    """The published index finds the row whose vector is asked for, reading a few cells."""
    root, _ = _reindexed(t)
    fresh = V.read_version(t.spark, root).where("source_file = 'gold'")
    first = fresh.agg(F.min("id")).first()[0]  # without reading the vectors of all rows
    wanted = fresh.where(F.col("id") == first).select("embedding").first()["embedding"]
    return rounded(J.search_replica(t.spark, root, wanted, 1, 3), 6, "score")


@query("maintain_tables", """SELECT 6::BIGINT AS files_before, 1::BIGINT AS files_after, -5::BIGINT AS file_change, 1 AS expired_versions, 0 AS orphan_files, count(*) AS n FROM orders""")
def maintain_tables(t):
    root = scratch_path(t.spark, "orders")
    for day in ("2023-12-01", "2023-12-02"):
        V.publish_version(t.orders.repartition(6), root, ntz(day))
    report = J.maintain_tables(t.spark, [root], ntz(AS_OF))
    rows = V.read_version(t.spark, root).agg(F.count(F.lit(1)).alias("n"))
    shown = report.select("files_before", "files_after", "file_change", "expired_versions", "orphan_files")
    return shown.join(F.broadcast(rows), how="inner")


@query("partitioned_gold", f"WITH {GOLD} {GOLD_V2}")
def partitioned_gold(t):
    silver_path, target = _day_partitioned_silver(t), scratch_path(t.spark, "gold")
    for staging in (scratch_path(t.spark, "staging"), scratch_path(t.spark, "staging")):
        found = J.partitioned_gold(t.spark, silver_path, staging, target, ntz(AS_OF))
    return _show_v2(found)


@query("compare_lanes", KNN + """, a AS (SELECT item_id, doc_id, rank, s FROM ranked WHERE rank <= 5),
b AS (SELECT item_id, doc_id, round(s, 4) AS s4, row_number() OVER (PARTITION BY item_id ORDER BY round(s, 4) DESC, doc_id)::INTEGER AS rank
  FROM near QUALIFY rank <= 5),
j AS (SELECT coalesce(a.item_id, b.item_id) AS item_id, a.rank AS ra, b.rank AS rb, round(abs(a.s - b.s4), 6) AS gap FROM a FULL JOIN b ON a.item_id = b.item_id AND a.doc_id = b.doc_id)
SELECT item_id, count(*) FILTER (WHERE ra IS NOT NULL AND rb IS NOT NULL) AS common_count, count(*) FILTER (WHERE rb IS NULL) AS only_in_a,
  count(*) FILTER (WHERE ra IS NULL) AS only_in_b, count(*) FILTER (WHERE ra = rb) AS same_rank_count, bool_and(coalesce(ra = rb, false)) AS exact_order_match,
  coalesce(max(gap), 0) AS max_score_diff, round(coalesce(avg(gap), 0), 9) AS avg_score_diff,
  CASE WHEN coalesce(max(gap), 0) < 0.0001 THEN 'perfect' WHEN coalesce(max(gap), 0) < 0.001 THEN 'excellent' WHEN coalesce(max(gap), 0) < 0.01 THEN 'acceptable' ELSE 'different' END AS verdict
FROM j GROUP BY ALL""")
def compare_lanes(t):
    """The whole table in both lanes; the second knows scores to four decimals only, and so ranks differently."""
    found = compare(knn(t, 5), knn(t, 5, decimals=4), "doc_id", "item_id")
    return found.withColumn("avg_score_diff", F.round("avg_score_diff", 9))


@query("sync_replica_to_lake", f"""WITH {GOLD}, replica AS (
  SELECT id, 'edited ' || id AS content FROM gold WHERE total_chunks > 1 UNION ALL SELECT 'new-' || item_id, text FROM benchmark)
SELECT id, md5(content) AS content_md5, total_chunks, source, CAST(quality_score AS DOUBLE) AS quality_score FROM gold WHERE id NOT IN (SELECT id FROM replica)
UNION ALL SELECT id, md5(content), 1, 'duckdb_sync', 9.5 FROM replica""")
def sync_replica_to_lake(t):
    chunks = gold(t)
    edited = chunks.where("total_chunks > 1").select("id", F.concat(F.lit("edited "), "id").alias("content"))
    new = t.benchmark.select(F.concat(F.lit("new-"), "item_id").alias("id"), F.col("text").alias("content"))
    replica = hashed_text(edited.unionByName(new)).withColumn("metadata", F.lit("not json"))
    merged = S.sync_replica_to_lake(chunks, replica, ntz(AS_OF))
    return merged.select("id", digest(), "total_chunks", "source", "quality_score")
