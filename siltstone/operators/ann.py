"""Approximate nearest neighbours: vectors grouped into cells, a few cells probed, exact re-rank.

The cell is a partition column, so probing p of n cells reads about p/n of the
files.  Centroids are few and their number is set by the caller, which bounds
what is handed to the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import as_col
from siltstone.functions.vectors import as_matrix, has_vector
from siltstone.operators.search import knn_join, vector_topk
from siltstone.sources.tables import write_by

MAX_CENTROID_BYTES = 64 * 1024 * 1024
# Share of the cells probed by default: what nine tenths of the true neighbours take even where vectors have no clusters.
PROBED_SHARE = 0.75


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.where(norms == 0, 1.0, norms)[:, None]


# Scores held at a time while rows are given their cell.
SLICE_CELLS = 4_000_000


def nearest_rows(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Number of the most similar centroid of every row, a slice of rows at a time."""
    step = max(1, SLICE_CELLS // max(1, len(centroids)))
    parts = [np.argmax(rows[at : at + step] @ centroids.T, axis=1) for at in range(0, len(rows), step)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def seed_centroids(df: DataFrame, cells: int, key: str = "id", vector: str = "embedding") -> np.ndarray:
    """Vectors of the rows with the smallest key hashes: a fixed pseudo-random choice.

    Their size is known from one row and checked before any of them come to the driver.
    """
    one = df.where(has_vector(vector)).select(F.size(vector).alias("dim")).first()
    if one is not None and cells * one["dim"] * 8 > MAX_CENTROID_BYTES:
        raise ValueError(f"{cells} centroids take more than {MAX_CENTROID_BYTES} bytes; use fewer cells")
    chosen = (
        df.where(has_vector(vector)).orderBy(F.md5(F.col(key).cast("string")), key).limit(cells)
        .select(key, vector).toArrow()
    )
    rows, _ = as_matrix(chosen.column(vector).combine_chunks())
    return _unit(rows)


def refine_centroids(df: DataFrame, centroids: np.ndarray, vector: str = "embedding", rounds: int = 1) -> np.ndarray:
    """Move every centroid to the mean of its cell, ``rounds`` times.

    A task sums the vectors of each cell it sees and sends one partial sum per
    cell, so the size of a cell does not matter; partial sums are added batch by
    batch, and one row per cell comes back.
    """
    cells, dim = centroids.shape

    def emit(sums: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
        used = np.flatnonzero(seen)
        totals = pa.array(list(sums[used]), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), totals], names=["cell", "total"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = np.zeros((cells, dim)), np.zeros(cells, dtype=bool)
        for batch in batches:
            rows, _ = as_matrix(batch.column(1), dim)
            if rows.shape[0]:
                cell = batch.column(0).to_numpy()
                np.add.at(sums, cell, rows)
                seen[cell] = True
        yield emit(sums, seen)

    vectors = df.where(has_vector(vector)).select(vector)
    for _ in range(rounds):
        fixed = centroids

        def partial(batches: Iterator[pa.RecordBatch], fixed: np.ndarray = fixed) -> Iterator[pa.RecordBatch]:
            sums, seen = np.zeros((cells, dim)), np.zeros(cells, dtype=bool)
            for batch in batches:
                rows, _ = as_matrix(batch.column(0), dim)
                if rows.shape[0]:
                    rows = _unit(rows)
                    cell = nearest_rows(rows, fixed)
                    np.add.at(sums, cell, rows)
                    seen[cell] = True
            yield emit(sums, seen)

        schema = "cell int, total array<double>"
        parts = vectors.mapInArrow(partial, schema).repartition("cell").mapInArrow(add_up, schema)
        table = parts.toArrow()
        moved = centroids.copy()
        moved[table.column("cell").to_numpy()] = as_matrix(table.column("total").combine_chunks(), dim)[0]
        centroids = _unit(moved)
    return centroids


def train_centroids(
    df: DataFrame, cells: int, key: str = "id", vector: str = "embedding", rounds: int = 2
) -> np.ndarray:
    return refine_centroids(df, seed_centroids(df, cells, key, vector), vector, rounds)


def cell_of(vector: Column | str, centroids: np.ndarray) -> Column:
    """Number of the most similar centroid."""
    fixed = centroids

    @F.arrow_udf("int")
    def nearest(v: pa.Array) -> pa.Array:
        rows, present = as_matrix(v, fixed.shape[1])
        out = np.full(len(v), -1, dtype=np.int32)
        if rows.shape[0]:
            out[present] = nearest_rows(_unit(rows), fixed)
        return pa.array(out, pa.int32(), mask=~present)

    return nearest(as_col(vector))


def build_index(df: DataFrame, centroids: np.ndarray, vector: str = "embedding") -> DataFrame:
    """Rows that hold a vector, with their cell."""
    return df.where(has_vector(vector)).withColumn("cell", cell_of(vector, centroids))


def centroid_table(spark: SparkSession, centroids: np.ndarray) -> DataFrame:
    """Centroids as rows, to be stored with an index; their size was checked when they were made."""
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(centroids)], "cell int, centroid array<double>").coalesce(1)


def read_centroids(table: DataFrame) -> np.ndarray:
    """Centroids from their table, as many as the index has cells."""
    return np.array([r["centroid"] for r in table.orderBy("cell").collect()])


def write_index(index: DataFrame, path: str) -> None:
    """One directory per cell; a cell is written by as many tasks as its size asks for."""
    write_by(index, path, "overwrite", "cell")


def probe_cells(query: Sequence[float], centroids: np.ndarray, probes: int) -> list[int]:
    """The cells whose centroids are most similar to the query."""
    scores = centroids @ np.asarray(query, dtype=np.float64)
    return [int(i) for i in np.argsort(-scores, kind="stable")[:probes]]


def default_probes(cells: int) -> int:
    return math.ceil(cells * PROBED_SHARE)


def probed_cells(vector: Column | str, centroids: np.ndarray, probes: int) -> Column:
    """The cells that ``probe_cells`` gives for every vector."""
    fixed = centroids

    @F.arrow_udf("array<int>")
    def probed(v: pa.Array) -> pa.Array:
        rows, present = as_matrix(v, fixed.shape[1])
        found = iter([probe_cells(row, fixed, probes) for row in rows])
        return pa.array([next(found) if p else None for p in present], pa.list_(pa.int32()))

    return probed(as_col(vector))


def ann_topk(
    index: DataFrame, centroids: np.ndarray, query: Sequence[float], k: int = 10, probes: int | None = None,
    key: str = "id", vector: str = "embedding", columns: Sequence[str] = (),
) -> DataFrame:
    """Exact top-k within the probed cells, by default ``default_probes`` of them."""
    if "cell" not in index.columns:
        raise ValueError("no index found: build one first, or use vector_topk")
    probed = index.where(F.col("cell").isin(probe_cells(query, centroids, probes or default_probes(len(centroids)))))
    return vector_topk(probed, query, k, key, vector, columns)


def recall_at_k(found: DataFrame, exact: DataFrame, key: str = "id") -> DataFrame:
    """Share of the exact result that was found."""
    marked = exact.select(key).join(found.select(key, F.lit(1).alias("_hit")), key, "left")
    return marked.agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))


def mean_recall(
    index: DataFrame, centroids: np.ndarray, asked: DataFrame, k: int = 10, probes: int | None = None,
    key: str = "id", vector: str = "embedding",
) -> DataFrame:
    """Share of the exact k nearest rows of all ``asked`` rows that ``ann_topk`` finds: those whose cell is probed."""
    asked = asked.select(F.col(key).alias("_asked"), F.col(vector).alias("query_vector"))
    exact = knn_join(asked, index.select(key, vector), k, "_asked", key=key)
    probed = asked.select("_asked", probed_cells("query_vector", centroids, probes or default_probes(len(centroids))).alias("_probed"))
    pairs = exact.select("_asked", key).join(index.select(key, "cell"), key).join(probed, "_asked")
    return pairs.agg(F.avg(F.array_contains("_probed", F.col("cell")).cast("int")).alias("recall"))
