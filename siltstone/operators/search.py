"""Text search and cosine top-k over vector columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema

from siltstone.functions.text import as_col, escape_like
from siltstone.functions.vectors import SCORE_DECIMALS, as_matrix, cosine_to, has_vector

# Query vectors are handed to the tasks in blocks of at most this many bytes.
QUERY_BLOCK_BYTES = 64 * 1024 * 1024

# Stands for an undefined score while rows are ranked: below every cosine. It is reported as 0.0.
UNDEFINED = -2.0


def text_search(
    df: DataFrame, query: str, k: int | None = 10, text: str = "content", key: str = "id",
    columns: Sequence[str] = (), literal: bool = False,
) -> DataFrame:
    """Rows whose text contains the query, letter case ignored; score 1.0, ordered by key."""
    pattern = f"%{escape_like(query) if literal else query}%"
    hits = df.where(F.col(text).ilike(pattern)).select(key, *columns, F.lit(1.0).alias("score"))
    return hits.orderBy(key).limit(k) if k is not None else hits


def vector_topk(
    df: DataFrame, query: Sequence[float], k: int = 10, key: str = "id",
    vector: str = "embedding", columns: Sequence[str] = (),
) -> DataFrame:
    """The k most similar rows. Each task keeps its own k best before anything moves."""
    scored = df.where(has_vector(vector)).select(key, *columns, cosine_to(vector, query).alias("_score"))
    # An undefined score (zero vector) is reported as 0.0, and ranked last, as in the join.
    best = scored.orderBy(F.desc_nulls_last("_score"), F.asc(key)).limit(k)
    return best.select(key, *columns, F.coalesce("_score", F.lit(0.0)).alias("score"))


def cosine_distance_topk(
    df: DataFrame, query: Sequence[float], k: int = 10, key: str = "id",
    vector: str = "embedding", columns: Sequence[str] = (),
) -> DataFrame:
    """The k nearest rows by cosine distance, reported as 1 - distance."""
    distance = (F.lit(1.0) - cosine_to(vector, query)).alias("distance")
    near = df.where(has_vector(vector)).select(key, *columns, distance)
    best = near.orderBy(F.asc_nulls_last("distance"), F.asc(key)).limit(k)
    return best.select(key, *columns, "distance", F.coalesce(1.0 - F.col("distance"), F.lit(0.0)).alias("score"))


def _blocks(queries: DataFrame, key: str, vector: str, limit: int) -> Iterator[tuple[list, np.ndarray]]:
    """Query vectors in blocks whose size is checked before they come to the driver."""
    usable = queries.where(has_vector(vector)).select(key, vector)
    size = usable.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("dim")).first()
    if not size["n"]:
        return
    blocks = -(-size["n"] * size["dim"] * 8 // limit)
    for block in range(blocks):
        chosen = usable if blocks == 1 else usable.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == block)
        table = chosen.toArrow()
        ids = table.column(key).to_pylist()
        if ids:
            rows, _ = as_matrix(table.column(vector).combine_chunks())
            yield ids, rows


class _Nearest:
    """The k best (score, key) pairs of every query seen so far in one task.

    Scores below a query's k-th best are dropped at once; among equal scores the
    smallest keys stay. A slice of queries is scored at a time, so the score
    table stays small whatever the number of queries.
    """

    SLICE_CELLS = 4_000_000

    def __init__(self, unit_queries: np.ndarray, k: int, decimals: int = SCORE_DECIMALS):
        self.queries, self.k, self.decimals = unit_queries, k, decimals
        self.bound = np.full(unit_queries.shape[0], -np.inf)
        self.query = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)
        self.key: np.ndarray | None = None

    def add(self, keys: np.ndarray, rows: np.ndarray) -> None:
        lengths = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        unit = (rows / np.where(lengths == 0, 1.0, lengths)[:, None]).T
        undefined = (lengths == 0) | ~np.isfinite(lengths)
        n = keys.shape[0]
        found = [(self.query, self.score, self.key if self.key is not None else keys[:0])]
        step = max(1, self.SLICE_CELLS // n)
        for start in range(0, self.queries.shape[0], step):
            scores = np.round(self.queries[start : start + step] @ unit, self.decimals)
            scores[:, undefined] = UNDEFINED
            bound = self.bound[start : start + step]
            if n > self.k and np.isneginf(bound).any():
                bound = np.maximum(bound, np.partition(scores, n - self.k, axis=1)[:, n - self.k])
            q, column = np.nonzero(scores >= bound[:, None])
            found.append((q + start, scores[q, column], keys[column]))
        self._keep(*(np.concatenate(part) for part in zip(*found, strict=True)))

    def _keep(self, query: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        order = np.lexsort((key, -score, query))
        query, score, key = query[order], score[order], key[order]
        place = np.arange(query.shape[0]) - np.searchsorted(query, query)
        last = place == self.k - 1
        self.bound[query[last]] = score[last]
        best = place < self.k
        self.query, self.score, self.key = query[best], score[best], key[best]


def knn_join(
    queries: DataFrame, docs: DataFrame, k: int = 10, query_key: str = "query_id",
    query_vector: str = "query_vector", key: str = "id", vector: str = "embedding",
    block_bytes: int = QUERY_BLOCK_BYTES, decimals: int = SCORE_DECIMALS,
) -> DataFrame:
    """The k nearest documents of every query, with rank and score, ranked by scores of so many decimals.

    Documents never move: each task multiplies its batches with a block of query
    vectors and keeps k candidates per query, so only tasks x queries x k rows
    are shuffled.  Query sets beyond the block size take several passes.
    """
    spark = docs.sparkSession
    parts = [
        _local_nearest(spark, docs, ids, rows, k, queries.schema[query_key].dataType, query_key, key, vector, decimals)
        for ids, rows in _blocks(queries, query_key, query_vector, block_bytes)
    ]
    if not parts:
        empty = T.StructType([
            T.StructField(query_key, queries.schema[query_key].dataType),
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType()),
        ])
        return spark.createDataFrame([], empty)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = W.partitionBy(query_key).orderBy(F.desc("score"), F.asc(key))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumn("score", F.when(F.col("score") == UNDEFINED, 0.0).otherwise(F.col("score")))


def _local_nearest(
    spark: SparkSession, docs: DataFrame, ids: list, rows: np.ndarray, k: int,
    query_type: T.DataType, query_key: str, key: str, vector: str, decimals: int,
) -> DataFrame:
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    block = spark.sparkContext.broadcast((ids, rows / np.where(norms == 0, 1.0, norms)[:, None]))
    schema = T.StructType([
        T.StructField(query_key, query_type),
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("score", T.DoubleType()),
    ])
    target = to_arrow_schema(schema)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, unit_queries = block.value
        best = _Nearest(unit_queries, k, decimals)
        for batch in batches:
            x, present = as_matrix(batch.column(1), unit_queries.shape[1])
            if x.shape[0]:
                keys = batch.column(0).filter(pa.array(present)).to_numpy(zero_copy_only=False)
                best.add(keys.astype(str) if keys.dtype == object else keys, x)
        if best.key is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(query_ids, target.field(0).type).take(pa.array(best.query)),
                    pa.array(best.key, target.field(1).type),
                    pa.array(best.score),
                ],
                schema=target,
            )

    return docs.where(has_vector(vector)).select(key, vector).mapInArrow(nearest, schema)


def merge_shard_topk(shards: Sequence[DataFrame], k: int, key: str = "id") -> DataFrame:
    """Merge the top-k lists of several shards into one."""
    merged = shards[0]
    for shard in shards[1:]:
        merged = merged.unionByName(shard)
    return merged.orderBy(F.desc("score"), F.asc(key)).limit(k)


def compare_lanes(a: DataFrame, b: DataFrame, key: str = "id", query_key: str = "query_id") -> DataFrame:
    """How far two ranked result lists (query, key, rank, score) agree, per query."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(query_key, key, F.col("rank").alias(f"rank_{tag}"), F.col("score").alias(f"score_{tag}"))

    both = side(a, "a").join(side(b, "b"), [query_key, key], "full")
    common = F.col("rank_a").isNotNull() & F.col("rank_b").isNotNull()
    gap = F.round(F.abs(F.col("score_a") - F.col("score_b")), 6)
    same_rank = F.coalesce(F.col("rank_a") == F.col("rank_b"), F.lit(False))
    summed = both.groupBy(query_key).agg(
        F.count_if(common).alias("common_count"),
        F.count_if(F.col("rank_b").isNull()).alias("only_in_a"),
        F.count_if(F.col("rank_a").isNull()).alias("only_in_b"),
        F.count_if(same_rank).alias("same_rank_count"),
        F.bool_and(same_rank).alias("exact_order_match"),
        F.coalesce(F.max(gap), F.lit(0.0)).alias("max_score_diff"),
        F.coalesce(F.avg(gap), F.lit(0.0)).alias("avg_score_diff"),
    )
    return summed.withColumn("verdict", lane_verdict(F.col("max_score_diff")))


def lane_verdict(gap: Column | str) -> Column:
    # The agreed bounds for the score difference between two lanes.
    worst = as_col(gap)
    return (
        F.when(worst < 0.0001, "perfect").when(worst < 0.001, "excellent")
        .when(worst < 0.01, "acceptable").otherwise("different")
    )
