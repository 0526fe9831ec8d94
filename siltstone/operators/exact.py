"""Exact nearest neighbours that read a part of the rows: cells, and angles to their centroids.

Every row is stored with its cell and its angle to the cell's centroid, sorted
by it. Angles between vectors obey the triangle inequality, so a row whose
angle to its centroid differs from the query's by more than the angle of the
k-th best row so far cannot be among the k best: whole cells, and row groups
within cells, are skipped, and the result is that of a full search. How much is
read falls with how well the vectors cluster.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema

from siltstone.functions.text import as_col
from siltstone.functions.vectors import as_matrix, has_vector
from siltstone.operators.ann import _unit, build_index, cell_of
from siltstone.operators.search import UNDEFINED, _Nearest, vector_topk
from siltstone.session import settle, ship_package

# Added to every angle that decides what is skipped: more than rounding of scores and angles can make up.
SLACK = 1e-5
# Rows of a cell that meet its queries in one group, and queries of a group.
PART_ROWS, MOST_QUERIES = 1 << 16, 1 << 14


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def angle_to_cell(vector: Column | str, cell: Column | str, centroids: np.ndarray) -> Column:
    """Angle between a vector and the centroid of its cell; NULL for a zero vector, which has none."""
    fixed = centroids

    @F.arrow_udf("double")
    def angle(v: pa.Array, c: pa.Array) -> pa.Array:
        rows, present = as_matrix(v, fixed.shape[1])
        out, missing = np.zeros(len(v)), ~present
        if rows.shape[0]:
            own = c.filter(pa.array(present)).to_numpy(zero_copy_only=False)
            units = _unit(rows)
            out[present] = _angles(np.einsum("ij,ij->i", units, fixed[own]))
            missing[np.flatnonzero(present)[~np.isfinite(rows).all(axis=1) | ~rows.any(axis=1)]] = True
        return pa.array(out, mask=missing)

    return angle(as_col(vector), as_col(cell))


def build_bounded(df: DataFrame, centroids: np.ndarray, vector: str = "embedding") -> DataFrame:
    """Rows that hold a vector, with their cell and their angle to its centroid."""
    indexed = build_index(df, centroids, vector)
    return indexed.withColumn("angle", angle_to_cell(vector, "cell", centroids))


def write_bounded(index: DataFrame, path: str) -> None:
    """One folder per cell, in as many files as its size asks for, each sorted by angle."""
    index.hint("rebalance", F.col("cell")).sortWithinPartitions("cell", "angle").write.partitionBy("cell").parquet(path)


@dataclass
class Cells:
    """Centroids and, by cell, the rows and their least and greatest angle. Of the size of the centroids, which was checked."""

    centroids: np.ndarray
    rows: np.ndarray
    least: np.ndarray
    greatest: np.ndarray

    def nearest_possible(self, thetas: np.ndarray) -> np.ndarray:
        """Per cell, the smallest angle that a row can have to queries at these angles to the centroids."""
        gap = np.maximum(np.maximum(thetas - self.greatest, self.least - thetas), 0.0)
        return np.where(self.rows > 0, gap, np.inf)


def cells_of(index: DataFrame, centroids: np.ndarray) -> Cells:
    n = len(centroids)
    cells = Cells(centroids, np.zeros(n, np.int64), np.zeros(n), np.full(n, math.pi))
    # A cell with a row without angle keeps bounds that admit everything.
    bounds = index.groupBy("cell").agg(
        F.count(F.lit(1)).alias("rows"), F.min("angle").alias("least"), F.max("angle").alias("greatest"), F.count("angle").alias("known"))
    for r in bounds.collect():
        cells.rows[r["cell"]] = r["rows"]
        if r["known"]:
            cells.least[r["cell"]], cells.greatest[r["cell"]] = r["least"], r["greatest"]
    return cells


def exact_topk(
    index: DataFrame, cells: Cells, query: Sequence[float], k: int = 10, key: str = "id", vector: str = "embedding",
    columns: Sequence[str] = (),
) -> DataFrame:
    """The rows that ``vector_topk`` gives, from the cells and angles that can hold them.

    The nearest cells with k rows are searched first; the k-th score found there
    bounds what the second search reads.
    """
    wanted = np.asarray(query, dtype=np.float64)
    if not wanted.any():
        return vector_topk(index, query, k, key, vector, columns)
    thetas = _angles(cells.centroids @ (wanted / np.sqrt(wanted @ wanted)))
    order = np.lexsort((thetas, cells.nearest_possible(thetas)))
    enough = int(np.searchsorted(np.cumsum(cells.rows[order]), k)) + 1
    first = index.where(F.col("cell").isin([int(c) for c in order[:enough]]) & F.col("angle").isNotNull())
    found = vector_topk(first, query, k, key, vector).agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).first()
    if found["n"] < k:
        return vector_topk(index, query, k, key, vector, columns)
    return vector_topk(index.where(admitted(cells, thetas, math.acos(min(1.0, max(-1.0, found["least"]))))), query, k, key, vector, columns)


def admitted(cells: Cells, thetas: np.ndarray, reach: float) -> Column:
    """Rows that may be within ``reach`` of a query at these angles to the centroids: cells, and angles in them."""
    reach += SLACK
    near = F.lit(False)
    for c in np.flatnonzero(cells.nearest_possible(thetas) <= reach).tolist():
        near = near | ((F.col("cell") == c) & F.col("angle").between(float(thetas[c]) - reach, float(thetas[c]) + reach))
    return near


def _met(docs: DataFrame, asked: DataFrame, cells: Cells, waves: int, k: int, key: str, schema: T.StructType) -> DataFrame:
    """The k best rows of each cell's part for every query sent to the cell.

    docs: cell, angle, key and vector; asked: cell, query, asked_vector, theta and reach.
    """
    spark = docs.sparkSession
    parts = spark.createDataFrame(
        [(c, -(-int(n) // PART_ROWS)) for c, n in enumerate(cells.rows) if n], "cell int, parts int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    wave = F.pmod(F.xxhash64("query"), F.lit(waves)).cast("int")
    left = (
        docs.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64(F.col("doc")), F.col("parts")).cast("int"))
        .select("cell", "part", "doc", "vector", "angle", numbers(F.lit(waves)).alias("wave"))
    )
    right = asked.join(F.broadcast(parts), "cell").withColumn("wave", wave).select(
        F.col("cell").alias("to_cell"), F.col("wave").alias("to_wave"), numbers(F.col("parts")).alias("to_part"), "query", "asked_vector", "theta", "reach")
    target = to_arrow_schema(schema)

    def search(mine: pa.Table, queries: pa.Table) -> pa.Table:
        none = target.empty_table()
        if not mine.num_rows or not queries.num_rows:
            return none
        wanted, _ = as_matrix(queries["asked_vector"].combine_chunks())
        theta, reach = (queries[c].to_numpy() for c in ("theta", "reach"))
        rows, present = as_matrix(mine["vector"].combine_chunks(), wanted.shape[1])
        angle = mine["angle"].to_numpy()
        kept = np.isnan(angle) | ((angle >= (theta - reach).min()) & (angle <= (theta + reach).max()))
        keys = mine["doc"].to_numpy()
        if not kept.any():
            return none
        best = _Nearest(_unit(wanted), k)
        step = max(1, _Nearest.SLICE_CELLS // len(wanted))
        places = np.flatnonzero(kept)
        for at in range(0, len(places), step):
            some = places[at : at + step]
            best.add(keys[some].astype(str) if keys.dtype == object else keys[some], rows[some])
        return pa.Table.from_arrays(
            [queries["query"].combine_chunks().take(pa.array(best.query)), pa.array(best.key, target.field(1).type), pa.array(best.score)], schema=target)

    return left.groupBy("cell", "part", "wave").cogroup(right.groupBy("to_cell", "to_part", "to_wave")).applyInArrow(search, schema)


def exact_knn(
    index: DataFrame, cells: Cells, queries: DataFrame, k: int = 10, query_key: str = "query_id", query_vector: str = "query_vector",
    key: str = "id", vector: str = "embedding",
) -> DataFrame:
    """The k nearest rows of every query, with score and rank, as ``knn_join`` gives them.

    Every query first meets its own cell; the k-th score there bounds the cells
    it is sent to next. Queries and rows meet in groups of a part of a cell and
    a share of the queries, so neither a large cell nor a large set of queries
    is one task's, and no query comes to the driver.
    """
    spark = index.sparkSession
    ship_package(spark)
    docs = index.where(has_vector(vector)).select("cell", "angle", F.col(key).alias("doc"), F.col(vector).alias("vector"))
    usable = queries.where(has_vector(query_vector)).select(F.col(query_key).alias("query"), F.col(query_vector).alias("asked_vector"))
    asked = settle(usable.withColumn("cell", cell_of("asked_vector", cells.centroids)))
    waves = max(1, -(-asked.count() // MOST_QUERIES))
    schema = T.StructType([
        T.StructField("query", queries.schema[query_key].dataType), T.StructField("doc", index.schema[key].dataType), T.StructField("score", T.DoubleType())])
    everywhere = [F.lit(0.0).alias("theta"), F.lit(10.0).alias("reach")]
    home = settle(_met(docs, asked.select("*", *everywhere), cells, waves, k, key, schema))
    nearest = W.partitionBy("query").orderBy(F.desc("score"), F.asc("doc"))
    best = home.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k)
    # A query without k defined scores in its own cell goes everywhere.
    reached = best.groupBy("query").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).select(
        "query", F.when((F.col("n") == k) & (F.col("least") > UNDEFINED), F.col("least")).alias("least"))
    fixed = cells
    sent = T.StructType([
        schema["query"], T.StructField("asked_vector", queries.schema[query_vector].dataType), T.StructField("cell", T.IntegerType()),
        T.StructField("theta", T.DoubleType()), T.StructField("reach", T.DoubleType())])
    kinds = to_arrow_schema(sent)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            wanted, _ = as_matrix(batch.column("asked_vector"), fixed.centroids.shape[1])
            least = batch.column("least").to_numpy(zero_copy_only=False).astype(np.float64)
            thetas = _angles(_unit(wanted) @ fixed.centroids.T)
            reach = np.where(np.isnan(least) | ~wanted.any(axis=1), 10.0, _angles(np.nan_to_num(least)) + SLACK)
            near = fixed.nearest_possible(thetas) <= reach[:, None]
            near[:, :] &= fixed.rows > 0
            near[np.arange(len(near)), batch.column("cell").to_numpy()] = False
            row, cell = np.nonzero(near)
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [taken.column("query"), taken.column("asked_vector"), pa.array(cell, pa.int32()), pa.array(thetas[row, cell]), pa.array(reach[row])], schema=kinds)

    routed = asked.join(reached, "query", "left").select("query", "asked_vector", "cell", "least").mapInArrow(route, sent)
    found = home.unionByName(_met(docs, routed, cells, waves, k, key, schema))
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select(
        F.col("query").alias(query_key), F.col("doc").alias(key), F.when(F.col("score") == UNDEFINED, 0.0).otherwise(F.col("score")).alias("score"), "rank")


def share_read(index: DataFrame, cells: Cells, query: Sequence[float], k: int = 10, key: str = "id", vector: str = "embedding") -> float:
    """The share of the rows that the second search of ``exact_topk`` reads."""
    wanted = np.asarray(query, dtype=np.float64)
    thetas = _angles(cells.centroids @ (wanted / np.sqrt(wanted @ wanted)))
    least = exact_topk(index, cells, query, k, key, vector).agg(F.min("score").alias("least")).first()["least"]
    return index.where(admitted(cells, thetas, math.acos(min(1.0, max(-1.0, least))))).count() / int(cells.rows.sum())
