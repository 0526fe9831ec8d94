"""Searches that read less than the table, against searches that read it all."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.operators import ann, exact
from siltstone.operators import grams as G
from siltstone.operators import search as S


def clustered(n, spread, seed=1, dim=8):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, dim))
    rows = middles[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * spread
    rows[3] = 0.0
    rows[5:25] = rows[4]
    return [(i, [float(x) for x in r]) for i, r in enumerate(rows)] + [(n, None), (n + 1, [])]


def bounded(spark, rows, cells, path):
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    centroids = ann.train_centroids(df, cells)
    exact.write_bounded(exact.build_bounded(df, centroids), path)
    index = spark.read.parquet(path)
    return df, index, exact.cells_of(index, centroids)


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_topk_is_that_of_a_full_search_and_reads_less_of_clustered_rows(spark, tmp_path, spread):
    rows = clustered(900, spread)
    df, index, cells = bounded(spark, rows, 6, str(tmp_path / "index"))
    for i in (0, 4, 400):
        for k in (1, 10):
            want = [(r.id, round(r.score, 9)) for r in S.vector_topk(df, rows[i][1], k).collect()]
            assert [(r.id, round(r.score, 9)) for r in exact.exact_topk(index, cells, rows[i][1], k).collect()] == want
    assert [r.id for r in exact.exact_topk(index, cells, [0.0] * 8, 3).collect()] == [r.id for r in S.vector_topk(df, [0.0] * 8, 3).collect()]
    assert [r.id for r in exact.exact_topk(index, cells, rows[7][1], 2000).collect()] == [r.id for r in S.vector_topk(df, rows[7][1], 2000).collect()]
    share = exact.share_read(index, cells, rows[400][1])
    assert share < 0.4 if spread < 1 else share <= 1.0


def test_angles_and_cells_reach_the_scan(spark, tmp_path):
    rows = clustered(300, 0.05)
    _, index, cells = bounded(spark, rows, 6, str(tmp_path / "index"))
    plan = exact.exact_topk(index, cells, rows[100][1], 5)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [" in plan and "PushedFilters: [" in plan and "GreaterThanOrEqual(angle" in plan


@pytest.mark.parametrize("part_rows,queries", [(1 << 16, 1 << 14), (40, 9)])
def test_routed_join_is_that_of_all_rows(spark, tmp_path, monkeypatch, part_rows, queries):
    monkeypatch.setattr(exact, "PART_ROWS", part_rows)
    monkeypatch.setattr(exact, "MOST_QUERIES", queries)
    rows = clustered(500, 0.4, seed=2)
    df, index, cells = bounded(spark, rows, 5, str(tmp_path / "index"))
    asked = df.where("id % 20 = 0 or id in (3, 4)").select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    shown = lambda d: sorted((r.query_id, r.rank, r.id, round(r.score, 9)) for r in d.collect())
    assert shown(exact.exact_knn(index, cells, asked, 7)) == shown(S.knn_join(asked, df, 7))


def test_coarse_scores_are_ranked_over_all_rows(spark):
    """Many rows share the rounded score; the smallest keys win, however many better exact scores there are."""
    rng = random.Random(3)
    rows = [(i, [1.0, (200 - i) * 1e-6]) for i in range(200)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(5)
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, query_vector array<double>")
    assert [r.id for r in S.knn_join(asked, df, 5, decimals=4).orderBy("rank").collect()] == [0, 1, 2, 3, 4]


TEXTS = [(1, "The Quick brown fox"), (2, None), (3, ""), (4, "quick"), (5, "QUICKSAND and ducks"), (6, "ÉTÉ à la plage"), (7, "a_b%c"), (8, "axbyc"),
         (9, "qui ck uic"), (10, "été à la mer"), (11, "x" * 5000 + "needle" + "y" * 5000)]


@pytest.mark.parametrize("pattern,ignore_case", [
    ("%quick%", True), ("%QUICK%", False), ("%été%", True), ("%Été à la m%", True), ("%a\\_b\\%c%", True), ("%a_b%c%", True), ("qu%ck", True), ("%ui%", True),
    ("%needle%", True), ("%", True), ("nothing like it", True), ("%quick%and%", True)])
def test_rows_of_the_index_are_those_of_a_scan(spark, tmp_path, pattern, ignore_case):
    df = spark.createDataFrame(TEXTS, "id long, content string")
    G.write_postings(G.build_postings(df), str(tmp_path / "grams"))
    postings = spark.read.parquet(str(tmp_path / "grams"))
    fits = F.col("content").ilike(pattern) if ignore_case else F.col("content").like(pattern)
    found = sorted(r.id for r in G.search_like(df, postings, pattern, ignore_case=ignore_case).collect())
    assert found == sorted(r.id for r in df.where(fits).collect())


def test_only_the_lists_of_a_pattern_are_read(spark, tmp_path):
    df = spark.createDataFrame(TEXTS, "id long, content string")
    G.write_postings(G.build_postings(df), str(tmp_path / "grams"))
    postings = spark.read.parquet(str(tmp_path / "grams"))
    grams = G.pattern_grams(df, "%needle%")
    plan = G.candidates(postings, grams)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert len(grams) == 4 and "PartitionFilters: [isnotnull(bucket" in plan.replace("PartitionFilters: [bucket", "PartitionFilters: [isnotnull(bucket")
    assert "PushedFilters: [" in plan and "In(gram" in plan


def test_trigrams_are_told_apart_and_sorted_within_files(spark, tmp_path):
    """Every trigram has a number of its own; a bucket's file rises though its task holds several buckets."""
    texts = [f"{a}{b}{c}" for a in "aqé" for b in "bQ\U0001f600" for c in " c\U0010ffff"]
    numbers = {int(g) for t in texts for g in G.grams_of(t)}
    assert len(numbers) == len(texts) and len(G.grams_of("ab")) == len(G.grams_of("")) == 0 and len(G.grams_of("aaaaa")) == 1
    df = spark.createDataFrame([(i, f"{i} words of text {i * i}") for i in range(200)], "id long, content string")
    G.write_postings(G.build_postings(df), str(tmp_path / "grams"))
    postings = spark.read.parquet(str(tmp_path / "grams"))
    assert postings.count() == sum(len(G.grams_of(r.content)) for r in df.collect())
    files = postings.select(F.input_file_name().alias("file"), "gram", F.monotonically_increasing_id().alias("at"))
    seen = {}
    for r in files.orderBy("at").collect():
        assert seen.get(r.file, r.gram) <= r.gram
        seen[r.file] = r.gram
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
