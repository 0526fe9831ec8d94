"""Vector and text search against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.functions import encoder as EN
from siltstone.functions import vectors as V
from siltstone.operators import ann
from siltstone.operators import search as S
from siltstone.session import scratch_path

DIM = 8


def points(n, seed=1):
    r = np.random.default_rng(seed)
    return r.normal(size=(n, DIM)).astype(np.float32)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points(200))]
    rows += [(1000 + i, rows[i][1]) for i in range(50)]  # exact copies: ties
    rows += [(2000, [0.0] * DIM), (2001, None), (2002, [])]
    return spark.createDataFrame(rows, "id long, embedding array<float>").repartition(5)


def brute(docs, query, k):
    q = np.asarray(query, dtype=np.float64)
    out = []
    for r in docs.collect():
        if r.embedding:
            v = np.asarray(r.embedding, dtype=np.float64)
            norm = np.sqrt(v @ v) * np.sqrt(q @ q)
            out.append((-round(float(v @ q / norm), 12) if norm else 9.0, r.id))
    return [i for _, i in sorted(out)[:k]]


@pytest.mark.parametrize("k", [1, 7, 300])
def test_topk(docs, k):
    query = points(1, 9)[0].tolist()
    found = S.vector_topk(docs, query, k).collect()
    assert [r.id for r in found] == brute(docs, query, k)
    distance = S.cosine_distance_topk(docs, query, k).collect()
    assert [r.id for r in distance] == [r.id for r in found]


def test_zero_vector_scores_zero_and_comes_last(docs):
    found = S.vector_topk(docs, [1.0] * DIM, 1000).collect()
    assert found[-1].id == 2000 and found[-1].score == 0.0
    assert len(found) == 251


def test_lanes_of_cosine_agree(docs):
    pair = docs.where("size(embedding) > 0").withColumn("other", F.reverse("embedding"))
    rows = pair.select(V.cosine_similarity("embedding", "other").alias("a"), V.cosine_expression("embedding", "other").alias("b")).collect()
    assert all((r.a is None and r.b is None) or abs(r.a - r.b) < 1e-9 for r in rows)
    assert sum(r.a is None for r in rows) == 1


def test_uneven_vectors_are_refused(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id int, embedding array<float>").coalesce(1)
    with pytest.raises(Exception, match="unequal length"):
        S.vector_topk(df, [1.0, 1.0], 2).collect()


@pytest.mark.parametrize("block_bytes", [10**9, 3 * DIM * 8])
def test_knn_join(spark, docs, block_bytes):
    queries = [(f"q{i}", [float(x) for x in p]) for i, p in enumerate(points(9, 4))]
    asked = spark.createDataFrame([*queries, ("none", None)], "query_id string, query_vector array<float>")
    found = S.knn_join(asked, docs, 6, block_bytes=block_bytes).collect()
    assert len(found) == 54
    for name, vector in queries:
        mine = sorted((r.rank, r.id) for r in found if r.query_id == name)
        assert [i for _, i in mine] == brute(docs, vector, 6)


def test_knn_join_with_many_small_slices(spark, docs, monkeypatch):
    monkeypatch.setattr(S._Nearest, "SLICE_CELLS", 30)
    best = S._Nearest(V.as_matrix(__import__("pyarrow").array(points(4, 2).tolist()))[0], 5)
    x = points(64, 8).astype(np.float64)
    for start in range(0, 64, 10):
        best.add(np.arange(start, min(start + 10, 64)), x[start : start + 10])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    scores = np.round(best.queries @ unit.T, 12)
    for q in range(4):
        assert list(best.key[best.query == q]) == list(np.lexsort((np.arange(64), -scores[q]))[:5])


def test_knn_join_with_text_keys_and_without_queries(spark, docs):
    named = docs.withColumn("id", F.concat(F.lit("d"), "id"))
    asked = spark.createDataFrame([(1, [1.0] * DIM)], "query_id int, query_vector array<float>")
    found = S.knn_join(asked, named, 3).orderBy("rank").collect()
    assert [r.id for r in found] == brute(named, [1.0] * DIM, 3)
    assert S.knn_join(asked.where("false"), named, 3).isEmpty()


def test_ann_recall_and_full_probe(spark, docs):
    query = points(1, 5)[0].tolist()
    centroids = ann.train_centroids(docs, 6, rounds=2)
    index = ann.build_index(docs, centroids).cache()
    every = ann.ann_topk(index, centroids, query, 10, probes=6)
    assert [r.id for r in every.collect()] == brute(docs, query, 10)
    some = ann.ann_topk(index, centroids, query, 10, probes=3)
    assert ann.recall_at_k(some, every).first().recall >= 0.5
    with pytest.raises(ValueError):
        ann.ann_topk(docs, centroids, query)


def test_refined_centroids_are_cell_means(spark, docs):
    seeds = ann.seed_centroids(docs, 4)
    moved = ann.refine_centroids(docs, seeds, rounds=1)
    rows = np.array([r.embedding for r in docs.collect() if r.embedding and any(r.embedding)], dtype=np.float64)
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    cell = np.argmax(unit @ seeds.T, axis=1)
    for c in range(4):
        if c == 0:
            continue  # the zero vector is placed in the first cell and adds nothing
        mean = unit[cell == c].sum(axis=0)
        assert moved[c] == pytest.approx(mean / np.linalg.norm(mean))


def test_text_search(spark, rows):
    df = spark.createDataFrame([("1", "100% wool"), ("2", "100 percent WOOL"), ("3", "silk"), ("4", None)], "id string, content string")
    assert rows(S.text_search(df, "wool")) == [("1", 1.0), ("2", 1.0)]
    assert rows(S.text_search(df, "100%w")) == [("1", 1.0), ("2", 1.0)]
    assert rows(S.text_search(df, "100%", literal=True)) == [("1", 1.0)]


def test_compare_lanes(spark):
    a = spark.createDataFrame([("q", "x", 1, 0.9), ("q", "y", 2, 0.8)], "query_id string, id string, rank int, score double")
    b = spark.createDataFrame([("q", "x", 1, 0.9002), ("q", "z", 2, 0.7)], "query_id string, id string, rank int, score double")
    same = S.compare_lanes(a, a).first()
    assert same.exact_order_match and same.max_score_diff == 0 and same.verdict == "perfect"
    r = S.compare_lanes(a, b).first()
    assert (r.common_count, r.only_in_a, r.only_in_b, r.same_rank_count, r.exact_order_match) == (1, 1, 1, 1, False)
    assert r.max_score_diff == 0.0002 and r.verdict == "excellent"


def test_hashed_embedding(spark):
    df = spark.createDataFrame([("a b  A",), ("",), (None,), ("\t c\n",)], "t string")
    found = [r.v for r in df.select(EN.hashed_embedding("t", 16).alias("v")).collect()]
    expected = np.zeros(16)
    for w in ("a", "b", "a"):
        expected[EN.bucket_of(w, 16)] += 1
    assert found[0] == pytest.approx(list((expected / np.linalg.norm(expected)).astype(np.float32)))
    assert found[1] == [0.0] * 16 and found[2] is None
    assert sum(found[3]) == 1.0 and found[3][EN.bucket_of("c", 16)] == 1.0


def test_pluggable_encoder_gets_batches_and_no_nulls(spark):
    def lengths(texts):
        assert 0 < len(texts) <= 2 and None not in texts
        return np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("a",), (None,), ("bbb",), ("cc",), ("",)], "t string").coalesce(1)
    found = [r.v for r in df.select(EN.encode_with("t", lengths, batch=2).alias("v")).collect()]
    assert found == [[1.0, 1.0], None, [3.0, 1.0], [2.0, 1.0], [0.0, 1.0]]


def test_parts_hold_all_rows_once():
    import pyarrow as pa

    texts = pa.array(["a" * n for n in (5, 3, 20, 1, 1, 0)] + [None, "zz"])
    EN_bytes, EN.PART_BYTES = EN.PART_BYTES, 8
    try:
        assert list(EN._parts_by_size(texts)) == [(0, 2), (2, 3), (3, 8)]
    finally:
        EN.PART_BYTES = EN_bytes


def test_a_published_index_is_searched_by_its_cells(spark):
    from siltstone.plans import jobs as J
    from siltstone.sources import versions as V

    r = np.random.default_rng(4)
    rows = [(str(i), f"text {i}", [float(x) for x in r.normal(size=DIM)]) for i in range(600)]
    chunks = spark.createDataFrame(rows, "id string, content string, embedding array<float>").withColumns({
        "metadata": F.lit("{}"), "source": F.lit("s"), "ready_at": F.lit("2024-01-01").cast("timestamp_ntz")})
    root = scratch_path(spark, "replica")
    J.reindex(spark, chunks, root, F.lit("2024-01-02").cast("timestamp_ntz"), dim=DIM, cells=6)
    assert V.read_beside(spark, root, J.CENTROIDS).count() == 6
    found = J.search_replica(spark, root, rows[7][2], 5, probes=2)
    assert [r.id for r in found.collect()][0] == "7"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell", plan), plan
    every = J.search_replica(spark, root, rows[7][2], 5, probes=6).collect()
    assert [r.id for r in every] == [r.id for r in S.vector_topk(chunks, rows[7][2], 5).collect()]
    assert J.compact_version(spark, root, F.lit("2024-01-03").cast("timestamp_ntz"), min_files=1)
    assert V.read_beside(spark, root, J.CENTROIDS).count() == 6 and V.read_version(spark, root).count() == 600
    again = J.search_replica(spark, root, rows[7][2], 5, probes=2)
    assert [r.id for r in again.collect()] == [r.id for r in found.collect()]


def test_legacy_copy_is_read_only_without_fresh_chunks(spark):
    from siltstone.plans import jobs as J

    schema = "id string, content string, embedding array<float>, metadata string, source string, ready_at timestamp_ntz"
    legacy = spark.createDataFrame([("old", "x", None, "{}", "l", None)], "id string, content string, embedding array<float>, metadata string, source_file string, created_at timestamp_ntz")
    stamp = F.lit("2024-01-02").cast("timestamp_ntz")
    for rows, expected in (([("new", "y", None, "{}", "s", None)], ["new"]), ([], ["old"])):
        out = J.reindex(spark, spark.createDataFrame(rows, schema), scratch_path(spark, "replica"), stamp, legacy=legacy, dim=DIM)
        assert [r.id for r in out.collect()] == expected


def test_zero_and_undefined_vectors_come_last_in_both_lanes(spark):
    docs = spark.createDataFrame([(1, [0.0] * DIM), (2, [1.0] * DIM), (3, [-1.0] * DIM)], "id int, embedding array<float>")
    asked = spark.createDataFrame([(1, [1.0] * DIM)], "query_id int, query_vector array<float>")
    for k in (2, 3):
        single = [(r.id, r.score) for r in S.vector_topk(docs, [1.0] * DIM, k).collect()]
        joined = [(r.id, r.score) for r in S.knn_join(asked, docs, k).orderBy("rank").collect()]
        assert single == joined == [(2, 1.0), (3, -1.0), (1, 0.0)][:k]
    odd = docs.unionByName(spark.createDataFrame([(4, [float("nan")] * DIM)], "id int, embedding array<float>"))
    assert S.knn_join(asked, odd, 4).count() == 4


def test_centroids_beyond_the_bound_never_come_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(ann, "MAX_CENTROID_BYTES", 100)
    docs = spark.createDataFrame([(i, [1.0] * DIM) for i in range(20)], "id int, embedding array<float>")
    with pytest.raises(ValueError, match="fewer cells"):
        ann.seed_centroids(docs, 10)


COUNTING = """
import numpy as np


def make(path):
    with open(path, "a") as f:
        f.write("made\\n")
    return lambda texts: np.array([[float(len(t)), 1.0] for t in texts])
"""


def test_an_encoder_is_made_once_per_worker(spark, tmp_path, monkeypatch):
    from siltstone.functions.encoder import EncoderFactory, embed_text

    (tmp_path / "counting_encoder.py").write_text(COUNTING)
    spark.sparkContext.addPyFile(str(tmp_path / "counting_encoder.py"))  # as a package is shipped
    monkeypatch.syspath_prepend(tmp_path)
    import counting_encoder

    path = str(tmp_path / "made")
    factory = EncoderFactory(counting_encoder.make, (path,))
    for _ in range(3):
        df = spark.range(400).repartition(32).select(embed_text(F.col("id").cast("string"), factory).alias("v"))
        assert df.where("v[1] = 1").count() == 400
    workers = len(open(path).read().split())
    assert workers <= 24, workers  # 96 tasks


def test_default_probes_find_nine_tenths(spark):
    """Vectors without clusters, each of every twentieth id asked for; the recall is that of the searches themselves."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    centroids = ann.train_centroids(df, 12, "vec_id")
    index = ann.build_index(df, centroids).cache()
    asked = df.where("vec_id % 20 = 0")
    assert ann.mean_recall(index, centroids, asked, key="vec_id").first().recall >= 0.9
    few = asked.where("vec_id < 80")
    shares = []
    for row in few.collect():
        found = ann.ann_topk(index, centroids, row.embedding, key="vec_id")
        shares.append(ann.recall_at_k(found, S.vector_topk(df, row.embedding, 10, "vec_id"), "vec_id").first().recall)
    assert abs(ann.mean_recall(index, centroids, few, key="vec_id").first().recall - sum(shares) / len(shares)) < 1e-9
    assert sum(shares) / len(shares) >= 0.9
