"""Ordering, top-k and vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions.sql import register_sql_functions
from siltstone.functions.vectors import cosine_similarity
from siltstone.operators import ann, exact
from siltstone.operators import search as S
from siltstone.queries.common import COSINE, QUERY_SQL, hashed_text, query_vector, vectors_sql
from siltstone.queries.registry import query, rounded
from siltstone.session import scratch_path
from siltstone.sources.tables import scan_parquet_glob

TOP = """SELECT vec_id, label, round(s, 6) AS score FROM
  (SELECT vec_id, label, {cos} AS s FROM embeddings WHERE len(embedding) > 0 {where}) ORDER BY s DESC, vec_id LIMIT {k}"""


def _top(k: int, where: str = "") -> str:
    return TOP.format(cos=COSINE.format(q=QUERY_SQL), k=k, where=where)


@query("cosine_similarity", """SELECT e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS score
FROM embeddings e JOIN (SELECT label, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY ALL) c USING (label)""")
def cosine(t):
    first = t.embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("centre"))
    pairs = t.embeddings.join(first, "label")
    return rounded(pairs.select("vec_id", cosine_similarity("embedding", "centre").alias("score")), 6, "score")


@query("cosine_similarity_sql", """SELECT e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS score
FROM embeddings e JOIN (SELECT label, arg_max(embedding, vec_id) AS embedding FROM embeddings GROUP BY ALL) c USING (label)""")
def cosine_sql(t):
    register_sql_functions(t.spark)
    last = t.embeddings.groupBy("label").agg(F.max_by("embedding", "vec_id").alias("centre"))
    pairs = t.embeddings.join(last, "label")
    return rounded(pairs.selectExpr("vec_id", "cosine_similarity(embedding, centre) as score"), 6, "score")


@query("vector_topk", _top(10))
def vector_topk(t):
    return rounded(S.vector_topk(t.embeddings, query_vector(t), 10, "vec_id", columns=["label"]), 6, "score")


@query("vector_topk_lake", _top(20))
def vector_topk_lake(t):
    path = scratch_path(t.spark, "lake")
    t.embeddings.write.partitionBy("label").parquet(path)
    lake = t.spark.read.parquet(path)
    return rounded(S.vector_topk(lake, query_vector(t), 20, "vec_id", columns=["label"]), 6, "score")


@query("vector_topk_files", _top(15))
def vector_topk_files(t):
    found = scan_parquet_glob(t.spark, t.folder, pattern="embeddings.parquet")
    return rounded(S.vector_topk(found, query_vector(t), 15, "vec_id", columns=["label"]), 6, "score")


@query("cosine_distance_topk", f"""SELECT vec_id, round(d, 6) AS distance, round(1 - d, 6) AS score FROM
  (SELECT vec_id, 1 - {COSINE.format(q=QUERY_SQL)} AS d FROM embeddings) ORDER BY d, vec_id LIMIT 10""")
def cosine_distance_topk(t):
    return rounded(S.cosine_distance_topk(t.embeddings, query_vector(t), 10, "vec_id"), 6, "distance", "score")


def bounded_index(t, cells: int):
    """Written cells with angles, and their bounds."""
    path = scratch_path(t.spark, "cells")
    centroids = ann.seed_centroids(t.embeddings, cells, "vec_id")
    exact.write_bounded(exact.build_bounded(t.embeddings, centroids), path)
    index = t.spark.read.parquet(path)
    return index, exact.cells_of(index, centroids)


@query("ann_topk", _top(10))
def ann_topk(t):
    """From the cells and angles that can hold the ten best: the rows of a full search."""
    index, cells = bounded_index(t, 12)
    return rounded(exact.exact_topk(index, cells, query_vector(t), 10, "vec_id", columns=["label"]), 6, "score")


@query("routed_knn_join", """SELECT query_id, vec_id, rank, round(s, 6) AS score FROM (
  SELECT q.vec_id AS query_id, e.vec_id, s, row_number() OVER (PARTITION BY q.vec_id ORDER BY s DESC, e.vec_id)::INTEGER AS rank FROM (
    SELECT vec_id, embedding AS asked FROM embeddings WHERE vec_id % 20 = 0) q, embeddings e,
    LATERAL (SELECT round(list_cosine_similarity(e.embedding::DOUBLE[], q.asked::DOUBLE[]), 12) AS s)) WHERE rank <= 10""")
def routed_knn_join(t):
    """The ten nearest of all vectors whose id is divisible by 20, each sent to the cells that can hold them."""
    index, cells = bounded_index(t, 12)
    asked = t.embeddings.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return rounded(exact.exact_knn(index, cells, asked, 10, key="vec_id"), 6, "score")


@query("ann_recall", "SELECT true AS recall_at_least_nine_tenths, count(*) AS vectors FROM embeddings WHERE len(embedding) > 0")
def ann_recall(t):
    """Whether nine tenths of the exact top ten are found by default, over all vectors whose id is divisible by 20."""
    centroids = ann.train_centroids(t.embeddings, 12, "vec_id")
    index = ann.build_index(t.embeddings, centroids)
    recall = ann.mean_recall(index, centroids, t.embeddings.where("vec_id % 20 = 0"), 10, key="vec_id")
    rows = index.agg(F.count(F.lit(1)).alias("vectors"))  # one row
    return recall.select((F.col("recall") >= 0.9).alias("recall_at_least_nine_tenths")).join(F.broadcast(rows), how="inner")


KNN = f"""WITH {vectors_sql('d', 'documents', 'doc_id', 'text')}, {vectors_sql('q', 'benchmark', 'item_id', 'text')},
ln AS (SELECT doc_id, sqrt(sum(w * w)) AS n FROM d GROUP BY ALL), qn AS (SELECT item_id, sqrt(sum(w * w)) AS n FROM q GROUP BY ALL),
dots AS (SELECT item_id, doc_id, sum(q.w * d.w) AS dot FROM q JOIN d USING (bucket) GROUP BY ALL),
near AS (SELECT item_id, doc_id, round(dot / (ln.n * qn.n), 12) AS s FROM dots JOIN ln USING (doc_id) JOIN qn USING (item_id)),
ranked AS (SELECT item_id, doc_id, s, row_number() OVER (PARTITION BY item_id ORDER BY s DESC, doc_id)::INTEGER AS rank FROM near)"""


def knn(t, k: int, **more):
    docs = hashed_text(t.documents, "text").select("doc_id", "embedding")
    asked = hashed_text(t.benchmark, "text").select("item_id", F.col("embedding").alias("query_vector"))
    return S.knn_join(asked, docs, k, "item_id", key="doc_id", **more)


@query("vector_knn_join", KNN + " SELECT item_id, doc_id, rank, round(s, 6) AS score FROM ranked WHERE rank <= 5")
def vector_knn_join(t):
    return rounded(knn(t, 5), 6, "score")


@query("sharded_topk_merge", _top(10))
def sharded_topk_merge(t):
    wanted = query_vector(t)
    shards = [
        S.vector_topk(t.embeddings.where(F.pmod(F.xxhash64("vec_id"), F.lit(3)) == i), wanted, 10, "vec_id", columns=["label"])
        for i in range(3)
    ]
    return rounded(S.merge_shard_topk(shards, 10, "vec_id"), 6, "score")


@query("order_by_final", """SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey""")
def order_by_final(t):
    return t.customer.select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey")
