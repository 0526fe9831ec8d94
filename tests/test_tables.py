"""Tables, versions, files, jobs and streams."""

import pytest
from pyspark.sql import functions as F

from siltstone.plans import documents as P
from siltstone.plans import jobs as J
from siltstone.queries import load
from siltstone.session import scratch_path
from siltstone.sources import files as FI
from siltstone.sources import tables as S
from siltstone.sources import versions as V
from siltstone.streaming import ingest as I


def ntz(v):
    return F.lit(v).cast("timestamp_ntz")


AS_OF = "2024-06-01"
QUERIES = load()[0]


@pytest.fixture
def replica(spark):
    def make(docs, vector=None):
        rows = [(i, c, vector, "{}", "index") for i, c in docs]
        schema = "id string, content string, embedding array<float>, metadata string, source_file string"
        return spark.createDataFrame(rows, schema).withColumn("created_at", ntz("2024-01-01"))

    return make


@pytest.fixture
def raw(spark):
    rows = [
        ("1", "Hello World, this is a long enough text to pass the band.", "a", "2024-01-01 00:00:00"),
        ("2", "  HELLO world, this is a long enough text to pass the band.\n", "a", "2024-01-02 00:00:00"),
        ("3", "short", "b", "2024-01-03 00:00:00"),
        ("4", "x" * 10001, "b", "2024-01-03 00:00:00"),
        ("5", "Words " * 400, "c", "2024-01-04 00:00:00"),
    ]
    df = spark.createDataFrame(rows, "id string, content string, source string, t string")
    return df.select("id", "content", "source", F.col("t").cast("timestamp_ntz").alias("ingested_at"), F.lit("{}").alias("raw_metadata"))


def test_silver_keeps_the_newest_copy_and_the_length_band(raw):
    found = {r.id: r for r in P.silver_documents(raw, ntz(AS_OF)).collect()}
    assert set(found) == {"2", "5"}


def test_length_band_is_applied_after_the_choice_of_copy(spark):
    text = "y" * 49
    rows = [("1", text + "  ", "2024-01-01"), ("2", text, "2024-01-02")]
    df = spark.createDataFrame(rows, "id string, content string, t string").select(
        "id", "content", F.lit("s").alias("source"), F.col("t").cast("timestamp_ntz").alias("ingested_at"), F.lit("{}").alias("raw_metadata")
    )
    assert P.silver_documents(df, ntz(AS_OF)).isEmpty()


def test_gold_chunks_and_scores(raw, rows):
    gold = P.gold_documents(P.silver_documents(raw, ntz(AS_OF)), ntz(AS_OF))
    found = {r.id: r for r in gold.collect()}
    assert set(found) == {"2-1", "5-1", "5-2", "5-3"}
    assert [len(found[f"5-{i}"].content) for i in (1, 2, 3)] == [1000, 1000, 400]
    assert found["5-1"].total_chunks == 3 and float(found["5-1"].quality_score) == 1.0
    assert float(found["2-1"].quality_score) == 0.7
    assert gold.schema["quality_score"].dataType.simpleString() == "decimal(4,1)"
    assert gold.schema["embedding"].dataType.simpleString() == "array<float>"


def test_upsert_replaces_and_inserts(replica, spark):
    current = replica([("doc-001", "original"), ("doc-002", "other")])
    batch = replica([("doc-001", "updated"), ("doc-003", "new")]).drop("created_at")
    found = {r.id: r for r in S.upsert_documents(current, batch, ntz(AS_OF)).collect()}
    assert {i: r.content for i, r in found.items()} == {"doc-001": "updated", "doc-002": "other", "doc-003": "new"}
    assert str(found["doc-001"].created_at)[:10] == "2024-01-01" and str(found["doc-001"].updated_at)[:10] == AS_OF
    assert found["doc-002"].updated_at is None
    assert str(found["doc-003"].created_at)[:10] == AS_OF and found["doc-003"].updated_at is None


def test_delete_reports_absent_keys(replica, spark, rows):
    left, report = S.delete_documents(replica([("a", "1"), ("b", "2")]), spark.createDataFrame([("a",), ("z",)], "id string"))
    assert rows(left, "id") == [("b",)] and rows(report) == [("a", True), ("z", False)]


def test_priority_prefers_gold_and_keeps_the_rest(spark, replica, rows):
    root = scratch_path(spark, "t")
    V.publish_version(replica([("a", "old"), ("ui", "kept")], [0.5, 0.5]), root, ntz("2024-01-01"))
    gold = spark.createDataFrame([("a", "fresh"), ("b", None)], "id string, content string").select(
        "id", "content", F.lit(None).cast("array<float>").alias("embedding"), F.lit("{}").alias("metadata"),
        F.lit(None).cast("string").alias("source"), F.lit(None).cast("timestamp_ntz").alias("ready_at"),
    )
    found = J.reindex(spark, gold, root, ntz(AS_OF), dim=4)
    assert rows(found, "id", "content", "source_file") == [("a", "fresh", "iceberg_gold"), ("ui", "kept", "index")]
    vectors = {r.id: r.embedding for r in found.collect()}
    assert vectors["ui"] == [0.5, 0.5] and len(vectors["a"]) == 4


def test_empty_sources_fall_back_to_samples(spark, replica, rows):
    gold = spark.createDataFrame([], "id string, content string, embedding array<float>, metadata string, source string, ready_at timestamp_ntz")
    found = J.reindex(spark, gold, scratch_path(spark, "t"), ntz(AS_OF), samples=replica([("doc-001", "sample")]), dim=4)
    assert rows(found, "id") == [("doc-001",)]


def test_versions(spark, replica, rows):
    root = scratch_path(spark, "v")
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, root)
    assert rows(V.read_version(spark, root, fallback=replica([("f", "x")])), "id") == [("f",)]
    for day, name in enumerate("abcd", 1):
        assert V.publish_version(replica([(name, "x")]), root, ntz(f"2024-01-0{day}")) == day
    assert rows(V.read_version(spark, root), "id") == [("d",)]
    assert rows(V.read_version(spark, root, as_of=ntz("2024-01-02 12:00:00")), "id") == [("b",)]
    assert rows(V.read_version(spark, root, version=1), "id") == [("a",)]
    published = V.register(spark, root)
    assert rows(V.expired_versions(published, ntz("2024-01-09"), 7, 2), "version") == [(1,)]
    assert V.expired_versions(published.where("version = 1"), ntz("2030-01-01"), 7, 0).isEmpty()
    assert V.expire(spark, root, ntz(AS_OF), None, 3) == 1
    assert rows(V.read_version(spark, root), "id") == [("d",)]


def test_expired_files_spare_shared_ones(spark, rows):
    published = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")], "version int, t string").select(
        "version", F.col("t").cast("timestamp_ntz").alias("published_at")
    )
    manifest = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "c"), (3, "c")], "version int, path string")
    assert rows(V.expired_files(manifest, published, ntz(AS_OF), retain_last=2)) == [("a",)]


def test_file_stats_and_compaction(spark):
    path, target = scratch_path(spark, "small"), scratch_path(spark, "big")
    df = spark.range(6000).withColumn("t", F.md5(F.col("id").cast("string")))
    df.repartition(6).write.parquet(path)
    stats = FI.file_stats(spark, path).first()
    sizes = [r.length for r in FI.list_files(spark, path).collect()]
    assert stats.file_count == 6 == len(sizes)
    assert stats.total_size_mb == round(sum(sizes) / FI.MEGABYTE, 2)
    assert (stats.min_size_mb, stats.max_size_mb) == (round(min(sizes) / FI.MEGABYTE, 2), round(max(sizes) / FI.MEGABYTE, 2))
    assert FI.compact(spark, path, target)
    assert FI.list_files(spark, target).count() == 1
    assert spark.read.parquet(target).exceptAll(df).isEmpty() and spark.read.parquet(target).count() == 6000
    assert not FI.compact(spark, target, scratch_path(spark, "again"))
    change = FI.compare_file_stats(FI.file_stats(spark, path), FI.file_stats(spark, target)).first()
    assert (change.files_before, change.files_after, change.file_change) == (6, 1, -5)


def test_compaction_keeps_several_files_for_large_tables(spark):
    path, target = scratch_path(spark, "small"), scratch_path(spark, "big")
    spark.range(60000).withColumn("t", F.sha2(F.col("id").cast("string"), 256)).repartition(8).write.parquet(path)
    total = sum(r.length for r in FI.list_files(spark, path).collect()) / FI.MEGABYTE
    assert FI.compact(spark, path, target, target_mb=total / 3.5)
    assert 1 < FI.list_files(spark, target).count() <= 4


def test_orphans(spark, rows):
    path = scratch_path(spark, "o")
    spark.range(3).coalesce(1).write.parquet(f"{path}/kept")
    spark.range(3).coalesce(1).write.parquet(f"{path}/lost")
    listed, kept = FI.list_files(spark, path), FI.list_files(spark, f"{path}/kept")
    later = F.current_timestamp() + F.expr("interval 4 days")
    assert ["/lost/" in r.path for r in FI.find_orphan_files(listed, kept, later).collect()] == [True]
    assert FI.find_orphan_files(listed, kept, F.current_timestamp()).isEmpty()


def test_maintenance_compacts_and_expires(spark, replica):
    root = scratch_path(spark, "m")
    df = spark.range(1000)
    V.publish_version(df.repartition(6), root, ntz("2024-01-01"))
    V.publish_version(df.repartition(7), root, ntz("2024-01-02"))
    r = J.maintain_tables(spark, [root], ntz(AS_OF)).first()
    assert (r.files_before, r.files_after, r.expired_versions) == (7, 1, 1)
    assert V.read_version(spark, root).count() == 1000


def test_scan_of_nothing_is_an_error(spark):
    path = scratch_path(spark, "e")
    spark.range(0).write.parquet(path)
    with pytest.raises(FileNotFoundError):
        S.scan_parquet_glob(spark, path)


def test_backup_replaces_only_its_day(spark, rows):
    path = scratch_path(spark, "b")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, t string").withColumn("t", F.to_date("t"))
    S.backup_partitioned(df, path, F.col("t"))
    S.backup_partitioned(df.where("id = 2").withColumn("id", F.lit(3)), path, F.col("t"))
    assert rows(spark.read.parquet(path), "id", "day") == [(1, 1), (3, 2)]


def test_merge_adds_only_new_chunks_once(spark, rows):
    staged = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "y")], "chunk_id string, t string")
    assert rows(S.merge_staging(staged.where("chunk_id = 'a'"), staged)) == [("b", "y")]


def test_incremental_equals_full_refresh_and_replay_changes_nothing(spark, raw, rows):
    path = scratch_path(spark, "s")
    full = rows(P.silver_documents(raw, ntz(AS_OF)))
    early = raw.where("ingested_at < '2024-01-02'")
    I.silver_incremental(early, path, 0, ntz(AS_OF), first=True)
    assert rows(I.silver_incremental(raw, path, 1, ntz(AS_OF))) == full
    I.silver_incremental(raw, path, 1, ntz(AS_OF))
    assert rows(I.silver_from_state(I.read_state(spark, path), ntz(AS_OF))) == full


def test_stream_resumes_where_it_stopped(spark, raw, rows):
    source, state, marks = (scratch_path(spark, n) for n in ("src", "state", "marks"))
    raw.where("id < '3'").coalesce(1).write.parquet(source)
    I.run_silver_stream(spark, source, raw.schema, state, marks)
    raw.where("id >= '3'").coalesce(1).write.mode("append").parquet(source)
    I.run_silver_stream(spark, source, raw.schema, state, marks)
    assert I.read_state(spark, state).count() == 4
    assert rows(I.silver_from_state(I.read_state(spark, state), ntz(AS_OF))) == rows(P.silver_documents(raw, ntz(AS_OF)))


def test_stream_dedup_within_watermark(spark, raw):
    source, out, marks = (scratch_path(spark, n) for n in ("src", "out", "marks"))
    raw.write.parquet(source)
    stream = I.dedup_stream(spark.readStream.schema(raw.schema).parquet(source).withColumn("ingested_at", F.col("ingested_at").cast("timestamp")))
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 4


def test_embed_missing_keeps_known_vectors(replica):
    both = replica([("a", "one two")]).unionByName(replica([("b", "three")], [1.0, 2.0, 3.0]))
    found = {r.id: r.embedding for r in P.embed_missing(both, dim=8).collect()}
    assert found["b"] == [1.0, 2.0, 3.0] and len(found["a"]) == 8


def test_sync_replica_to_lake(spark, raw, replica):
    gold = P.gold_documents(P.silver_documents(raw, ntz(AS_OF)), ntz(AS_OF))
    merged = S.sync_replica_to_lake(gold, replica([("5-1", "edited"), ("new", "x")], [1.0]), ntz(AS_OF))
    found = {r.id: r for r in merged.collect()}
    assert set(found) == {"2-1", "5-1", "5-2", "5-3", "new"}
    assert found["5-1"].content == "edited" and float(found["5-1"].quality_score) == 9.5 and found["5-1"].source == "duckdb_sync"
    assert merged.schema == gold.schema or merged.columns == gold.columns


def test_files_of_a_day_follow_its_size(spark, raw):
    path = scratch_path(spark, "days")
    stamps = F.when(F.col("n") == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("timestamp_ntz")
    many = spark.range(60_000).withColumn("n", F.col("id") % 50).select(
        F.col("id").cast("string").alias("id"), F.sha2(F.col("id").cast("string"), 512).alias("content"), stamps.alias("ingested_at"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        S.create_bronze(many.repartition(40), path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    per_day = {r[0]: r["count"] for r in FI.list_files(spark, path).groupBy(F.regexp_extract("path", "ingest_day=([^/]+)", 1)).count().collect()}
    assert per_day["2024-01-01"] == 1 and 3 <= per_day["2024-01-02"] <= 20, per_day
    assert spark.read.parquet(path).count() == 60_000


def test_partitioned_gold_stages_merges_and_cleans(spark, raw):
    silver, staging, target = (scratch_path(spark, n) for n in ("silver", "staging", "gold"))
    clean = P.newest_per_content(raw).where(F.length("content").between(50, 10000))
    S.create_bronze(clean, silver)
    first = J.partitioned_gold(spark, silver, staging, target, ntz(AS_OF), days=["2024-01-04"])
    assert sorted(r.chunk_id for r in first.collect()) == ["5-1", "5-2", "5-3"]
    assert V.parquet_or_none(spark, staging) is None
    both = J.partitioned_gold(spark, silver, staging, target, ntz(AS_OF))
    assert sorted(r.chunk_id for r in both.collect()) == ["2-1", "5-1", "5-2", "5-3"]
    with pytest.raises(FileNotFoundError, match="no partitions"):
        J.partitioned_gold(spark, scratch_path(spark, "none"), staging, target, ntz(AS_OF))


def test_compacted_state_gives_the_same_table_and_takes_batches(spark, raw, rows):
    old, new = scratch_path(spark, "old"), scratch_path(spark, "new")
    I.add_batch(raw.where("id < '2'"), old, 0)
    I.add_batch(raw.where("id in ('2', '3')"), old, 1)
    I.compact_state(spark, old, new)
    assert I.read_state(spark, old).count() == 3 and I.read_state(spark, new).count() == 2
    I.add_batch(raw.where("id > '3'"), new, 2)
    assert rows(I.silver_from_state(I.read_state(spark, new), ntz(AS_OF))) == rows(P.silver_documents(raw, ntz(AS_OF)))


def test_late_and_equal_times_survive_in_any_batch_order(spark, raw, rows):
    full = rows(P.silver_documents(raw, ntz(AS_OF)))
    ids = sorted(r.id for r in raw.collect())
    for order in (ids, ids[::-1], ids[2:] + ids[:2]):
        path, silver = scratch_path(spark, "state"), None
        for batch, i in enumerate(order):
            silver = I.silver_incremental(raw.where(F.col("id") == i), path, batch, ntz(AS_OF), first=batch == 0, silver=silver)
        assert rows(silver) == full
        again = I.silver_incremental(raw, path, len(order) - 1, ntz(AS_OF))
        assert rows(again) == full


def test_the_last_of_equal_keys_in_a_batch_wins(spark):
    current = spark.createDataFrame([("a", "old")], "id string, content string").withColumns(
        {"created_at": ntz("2024-01-01"), "updated_at": F.lit(None).cast("timestamp_ntz")})
    batch = spark.createDataFrame([("a", "first", 1), ("a", "last", 2), ("b", "x", 1), ("b", "x", 1)], "id string, content string, n int")
    merged = S.upsert_documents(current, batch.drop("n"), ntz(AS_OF)).collect()
    assert sorted((r.id, r.content) for r in merged) == [("a", "last"), ("b", "x")]
    by_n = S.upsert_documents(current.withColumn("n", F.lit(0)), batch, ntz(AS_OF), order=[F.asc("n")]).collect()
    assert {r.id: r.content for r in by_n}["a"] == "first"


def test_expired_versions_stay_expired(spark):
    root = scratch_path(spark, "versions")
    for day in range(1, 5):
        V.publish_version(spark.range(day), root, ntz(f"2024-01-0{day}"))
    assert V.expire(spark, root, ntz("2024-02-01"), 7, 2) == 2
    assert V.expire(spark, root, ntz("2024-02-01"), 7, 2) == 0
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, root, as_of=ntz("2024-01-02"))
    assert V.read_version(spark, root, as_of=ntz("2024-01-03")).count() == 3


def test_scan_reads_tables_that_are_folders_once(spark, rows):
    path = scratch_path(spark, "lake")
    spark.range(3).repartition(2).write.parquet(f"{path}/docs.parquet")  # part files have other names than the table
    spark.range(3, 5).write.parquet(f"{path}/other.parquet")
    spark.range(5, 6).coalesce(1).write.parquet(f"{path}/deep/docs.parquet")
    assert rows(S.scan_parquet_glob(spark, path, pattern="docs.parquet")) == [(0,), (1,), (2,)]
    assert rows(S.scan_parquet_glob(spark, path)) == [(n,) for n in range(6)]
    assert rows(S.scan_parquet_glob(spark, path, "id bigint", "part-*")) == [(n,) for n in range(6)]
    with pytest.raises(FileNotFoundError):
        spark.range(0).write.parquet(f"{path}/none.parquet")
        S.scan_parquet_glob(spark, path, pattern="none.parquet")


def lake(spark, **tables):
    """A folder of tables for a query; each is a folder of files."""
    path = scratch_path(spark, "tables")
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return path


def test_scans_of_queries_read_folders(spark):
    docs = spark.createDataFrame([(1, "a text", "en", "web", 6), (2, None, "de", "web", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    vectors = spark.createDataFrame([(i, i % 2, [1.0, float(i)]) for i in range(1, 30)], "vec_id long, label int, embedding array<float>")
    path = lake(spark, documents=docs.repartition(2), embeddings=vectors.repartition(3))
    assert sorted(r.doc_id for r in QUERIES["scan_parquet_glob"](spark, path).collect()) == [1, 2]
    found = QUERIES["vector_topk_files"](spark, path).collect()
    assert len(found) == 15 and found[0].vec_id == 7


def test_queries_of_file_sizes_on_files_that_need_no_compaction(spark, monkeypatch):
    monkeypatch.setattr(FI, "needs_compaction", lambda *_: False)
    lines = spark.createDataFrame([("A", 1.0)] * 40 + [("R", 2.0)] * 20, "l_returnflag string, l_quantity double")
    orders = spark.range(60).withColumnRenamed("id", "o_orderkey")
    path = lake(spark, lineitem=lines.repartition(9), orders=orders.repartition(9))
    assert sorted(tuple(r) for r in QUERIES["compact"](spark, path).collect()) == [("A", 40, 40.0, 6), ("R", 20, 40.0, 6)]
    assert tuple(QUERIES["compare_file_stats"](spark, path).first()) == (6, 6, 0, True, 60)


@pytest.mark.parametrize("parts", [1, 9, 40])
def test_file_stats_has_six_files_however_the_table_lies(spark, parts):
    path = lake(spark, lineitem=spark.range(100).repartition(parts))
    stats = QUERIES["file_stats"](spark, path).first()
    assert (stats.file_count, stats.n) == (6, 100)


def test_streams_of_a_large_table_have_more_files_and_as_many_batches(spark, monkeypatch):
    from siltstone.queries import jobs as Q

    docs = spark.range(90).select(F.col("id").alias("doc_id"), F.concat(F.lit("x" * 60), F.col("id") % 40).alias("text"), F.lit("en").alias("lang"),
                                  F.lit("web").alias("source"), F.lit(62).alias("n_chars"))
    path = lake(spark, documents=docs)
    size = FI.list_files(spark, f"{path}/documents.parquet").agg(F.sum("length")).first()[0] / FI.MEGABYTE
    monkeypatch.setattr(Q, "SOURCE_MB", size / 12)
    source = scratch_path(spark, "source")
    assert Q._bronze_files(S.Tables(spark, path), source)[1] == 4
    assert FI.list_files(spark, source).count() == 12
    first = QUERIES["first_rows_stream"](spark, path).collect()
    assert len(first) == 40 and all(r.copies == 1 for r in first)
    assert QUERIES["silver_stream"](spark, path).count() == 40


def shown(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_vectors_are_not_shuffled_for_readers_without_them(spark, raw, replica):
    gold = P.gold_documents(P.silver_documents(raw, ntz(AS_OF)), ntz(AS_OF))
    path = scratch_path(spark, "replica")
    replica([("new", "x"), ("new", "y")], [1.0]).unionByName(replica([("none", "z")])).write.parquet(path)
    merged = S.sync_replica_to_lake(gold, spark.read.parquet(path), ntz(AS_OF)).select("id", "content")
    inputs = [line for line in shown(merged).splitlines() if "hashpartitioning(id" in line or line.startswith("Input") and "embedding" in line]
    sorts = shown(merged).split("Window")
    assert "embedding" not in "".join(part.splitlines()[0] + part.split("Input")[1].splitlines()[0] for part in sorts[1:] if "Input" in part), inputs
    assert {(r.id, r.content) for r in merged.collect()} >= {("new", "y")} and "none" not in {r.id for r in merged.collect()}


def test_folders_are_written_without_sorting_the_rows(spark, rows):
    path, size = scratch_path(spark, "folders"), "spark.sql.maxConcurrentOutputFileWriters"
    with S.folders_open(spark):
        assert spark.conf.get(size) == str(S.OPEN_FOLDERS)
    assert spark.conf.get(size) == "0"
    df = spark.range(500).withColumn("cell", F.col("id") % 23)
    S.write_by(df, path, "error", "cell")  # more folders than are open
    assert rows(spark.read.parquet(path).select("id", F.col("cell").cast("long"))) == rows(df)
    assert spark.conf.get(size) == "0"
