"""The clean table kept in buckets, by batches and by a stream."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.plans import documents as P
from siltstone.session import scratch_path
from siltstone.streaming import keyed as K

SCHEMA = "id string, content string, source string, t string"


def ntz(v):
    return F.lit(v).cast("timestamp_ntz")


AS_OF = "2024-06-01"


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).select(
        "id", "content", "source", F.col("t").cast("timestamp_ntz").alias("ingested_at"), F.lit("{}").alias("raw_metadata"))


@pytest.fixture(scope="module")
def raw(spark):
    """300 rows over 60 texts, one of which a third of the rows share; copies in and out of the band, NULLs."""
    random.seed(5)
    rows = []
    for i in range(300):
        n = 0 if i % 3 == 0 else random.randrange(1, 60)
        text = None if n == 7 else ("w%d " % n) * (20 if n % 5 else 3)
        if n % 10 == 4:  # the same hash within the band or not, by the white space around it
            text = "v%d" % n + "y" * 46 + " " * random.randrange(0, 4)
        rows.append((str(i), text, "s", f"2024-01-{random.randrange(1, 9):02d} 00:00:00"))
    return raw_rows(spark, rows).cache()


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_table_equals_a_full_refresh_after_every_batch(spark, raw, rows, order):
    root, seen = scratch_path(spark, "k"), None
    for batch, part in enumerate(order):
        mine = raw.where(F.pmod(F.col("id").cast("int"), F.lit(3)) == part)
        seen = mine if seen is None else seen.unionByName(mine)
        K.merge_batch(mine, root, batch, ntz(AS_OF), buckets=8)
        assert rows(K.read_table(spark, root)) == rows(P.silver_documents(seen, ntz(AS_OF)))
    again = K.merge_batch(mine, root, batch, ntz(AS_OF), buckets=8)
    assert rows(K.read_table(spark, root)) == rows(P.silver_documents(seen, ntz(AS_OF)))
    assert K.merge_batch(seen, root, batch + 1, ntz("2025-01-01"), buckets=8) == []
    assert rows(K.read_table(spark, root)) == rows(P.silver_documents(seen, ntz(AS_OF))) and again is not None


def test_small_batch_reads_and_writes_its_buckets_alone(spark, raw, rows, capsys):
    root = scratch_path(spark, "k")
    K.merge_batch(raw, root, 0, ntz(AS_OF), buckets=16)
    before = dict(rows(spark.read.parquet(f"{root}/table").select(F.col("bucket"), F.input_file_name())))
    late = raw_rows(spark, [("x1", "a text that is new and stays within the band of lengths", "s", "2020-01-01 00:00:00")])
    changed = K.merge_batch(late, root, 1, ntz(AS_OF), buckets=16)
    assert len(changed) == 1
    after = dict(rows(spark.read.parquet(f"{root}/table").select(F.col("bucket"), F.input_file_name())))
    assert {b for b in after if after[b] != before.get(b)} == set(changed)
    K.read_log(spark, root, changed, 2).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters" in plan and f"(bucket#" in plan and "Exchange" not in plan
    assert len(K.read_log(spark, root, changed).inputFiles()) > 0
    read = K.read_log(spark, root, changed).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("bucket=")[1].split("/")[0] for r in read} == {str(b) for b in changed}


def test_hash_out_of_the_band_leaves_the_table_though_its_bucket_is_empty_then(spark, rows):
    root, text = scratch_path(spark, "k"), "z" * 49
    K.merge_batch(raw_rows(spark, [("1", text + " ", "s", "2024-01-01")]), root, 0, ntz(AS_OF))
    assert K.read_table(spark, root).count() == 1
    K.merge_batch(raw_rows(spark, [("2", text, "s", "2024-01-02")]), root, 1, ntz(AS_OF))
    assert K.read_table(spark, root).count() == 0
    # A late older copy does not bring it back; a newer one does.
    assert K.merge_batch(raw_rows(spark, [("3", text + " ", "s", "2024-01-01")]), root, 2, ntz(AS_OF)) == []
    K.merge_batch(raw_rows(spark, [("3", text + " ", "s", "2024-01-03")]), root, 3, ntz(AS_OF))
    assert [r[0] for r in rows(K.read_table(spark, root))] == ["3"]


def test_empty_batches_and_unchanged_stamps(spark, raw, rows):
    root = scratch_path(spark, "k")
    assert K.merge_batch(raw.where("false"), root, 0, ntz(AS_OF)) == []
    K.merge_batch(raw, root, 1, ntz(AS_OF))
    assert K.merge_batch(raw.where("false"), root, 2, ntz("2025-01-01")) == []
    assert rows(K.read_table(spark, root).select("processed_at").distinct()) == rows(spark.range(1).select(ntz(AS_OF)))


def test_compacted_log_gives_the_same_table_and_takes_batches(spark, raw, rows):
    old, new = scratch_path(spark, "k"), scratch_path(spark, "k")
    K.merge_batch(raw.where("ingested_at < '2024-01-04'"), old, 0, ntz(AS_OF), buckets=4)
    K.merge_batch(raw.where("ingested_at < '2024-01-06'"), old, 1, ntz(AS_OF), buckets=4)
    K.compact_log(spark, old, new)
    assert rows(K.read_table(spark, new)) == rows(K.read_table(spark, old))
    K.merge_batch(raw, new, 2, ntz(AS_OF), buckets=4)
    assert rows(K.read_table(spark, new)) == rows(P.silver_documents(raw, ntz(AS_OF)))
    log = spark.read.parquet(f"{new}/log").where("batch = -1")
    assert log.count() == log.select("content_hash").distinct().count()


def test_stream_merges_like_batches_and_resumes(spark, raw, rows):
    source, root, marks = (scratch_path(spark, n) for n in ("src", "k", "marks"))
    raw.where("id >= '2'").repartition(2).write.parquet(source)
    K.run_table_stream(spark, source, raw.schema, root, marks, ntz(AS_OF), files_per_batch=1, buckets=4)
    assert rows(K.read_table(spark, root)) == rows(P.silver_documents(raw.where("id >= '2'"), ntz(AS_OF)))
    raw.where("id < '2'").coalesce(1).write.mode("append").parquet(source)
    K.run_table_stream(spark, source, raw.schema, root, marks, ntz(AS_OF), files_per_batch=1, buckets=4)
    assert rows(K.read_table(spark, root)) == rows(P.silver_documents(raw, ntz(AS_OF)))


def test_first_rows_of_a_stream_over_several_batches(spark, raw):
    source, root, marks = (scratch_path(spark, n) for n in ("src", "f", "marks"))
    raw.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(source)
    K.run_first_stream(stream, root, marks, buckets=4)
    out = spark.read.parquet(f"{root}/log")
    distinct = P.newest_per_content(raw.where("content is not null")).count()
    assert out.count() == out.select("content_hash").distinct().count() == distinct
    assert out.select("batch").distinct().count() > 1
