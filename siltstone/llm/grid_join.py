"""Near-duplicate vectors by an epsilon grid order join.

Two vectors link if their cosine is at least a bound; unit vectors of that
cosine are at most epsilon apart. Vectors are turned to their principal axes,
cut into cells of width epsilon on the leading ones, and sorted by their cells;
the sorted sequence is cut into blocks of rows. Intervals of blocks, then
blocks, whose boxes on the leading axes are further apart than epsilon cannot
hold a link and are skipped; every other pair of blocks is joined once, in a
task of one of the two, which goes on halving both sequences and skipping
distant halves until short stretches are multiplied. Products in float32 decide
all but those near the bound, which are worked out again in doubles.

Links are counted where they are found, and of each two stretches only as many
are handed over as connect the same vectors, so no group becomes all its pairs.
Equal vectors are one row of the join, with a weight.

Defined results: vectors that are null, zero or empty, or hold null or
non-finite components, link with nothing; a shorter vector is filled up with
zeros; rows with equal ids are separate rows; a null id loses against any other
as component; an empty table gives an empty result; other columns do not
matter, and there are no texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.components import components
from siltstone.llm.keys import join_facts
from siltstone.llm.vectors import matrix, sound
from siltstone.session import scratch_path, settle, ship_package, shuffle_width

COSINE = 0.9
# Leading principal axes on which cells and boxes are held.
AXES = 8
# Vectors of a block, at most and at least; between them, as many as make BLOCKS blocks.
MOST_ROWS, LEAST_ROWS, BLOCKS = 1 << 14, 1 << 10, 5
# Blocks of an interval; partners of a block in one task; vectors that are multiplied at a time.
INTERVAL, STRIPE, STRETCH = 64, 16, 512


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one. Each is first divided by a power of two, so that no square over- or underflows."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    vectors = np.ldexp(vectors, -exponent[:, None])
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest number that each of n numbers reaches over links (a, b)."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further


class Sequence:
    """A block's vectors in their order, with a box per stretch."""

    def __init__(self, place: np.ndarray, weight: np.ndarray, vectors: np.ndarray, axes: np.ndarray):
        self.place, self.weight = place, weight
        self.units = unit(vectors)
        self.rough = self.units.astype(np.float32)
        lead = self.units @ axes
        starts = np.arange(0, len(place), STRETCH)
        self.starts = np.append(starts, len(place))
        self.low, self.high = np.minimum.reduceat(lead, starts), np.maximum.reduceat(lead, starts)

    def rows(self, stretch: int) -> slice:
        return slice(self.starts[stretch], self.starts[stretch + 1])


def _distant(a: Sequence, i: slice, b: Sequence, j: slice, apart: float) -> bool:
    gap = np.maximum(a.low[i].min(axis=0) - b.high[j].max(axis=0), b.low[j].min(axis=0) - a.high[i].max(axis=0))
    return float((np.maximum(gap, 0) ** 2).sum()) > apart


def near_stretches(a: Sequence, b: Sequence, apart: float) -> Iterator[tuple[int, int]]:
    """Pairs of stretches that may be as near as the square root of ``apart``, by halving the longer side; of a block with itself every pair once."""
    open_pairs = [(0, len(a.low), 0, len(b.low))]
    while open_pairs:
        i, i_end, j, j_end = open_pairs.pop()
        if a is b and i >= j_end or _distant(a, slice(i, i_end), b, slice(j, j_end), apart):
            continue
        if i_end - i == 1 and j_end - j == 1:
            yield i, j
        elif i_end - i >= j_end - j:
            middle = (i + i_end) // 2
            open_pairs += [(middle, i_end, j, j_end), (i, middle, j, j_end)]
        else:
            middle = (j + j_end) // 2
            open_pairs += [(i, i_end, middle, j_end), (i, i_end, j, middle)]


def linked(a: Sequence, b: Sequence, cosine: float, apart: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weights linked to each row of a and of b, and links (row of a, row of b) that connect the same rows as all links do."""
    of_a, of_b = np.zeros(len(a.place)), np.zeros(len(b.place))
    ends = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    # Units are rounded to float32 and their products added up with a relative error of half a unit in the last place each.
    error = (a.rough.shape[1] + 4) * 2.0**-23
    for i, j in near_stretches(a, b, apart):
        rows, columns = a.rows(i), b.rows(j)
        rough = a.rough[rows] @ b.rough[columns].T
        r, c = np.nonzero(rough >= cosine - error)
        if a is b and i == j:
            r, c = r[r < c], c[r < c]
        if not len(r):
            continue
        close = rough[r, c] < cosine + error
        if close.any():
            sure = ~close
            at = np.flatnonzero(close)
            for part in range(0, len(at), 1 << 14):
                k = at[part : part + (1 << 14)]
                sure[k] = np.einsum("ij,ij->i", a.units[rows][r[k]], b.units[columns][c[k]]) >= cosine
            r, c = r[sure], c[sure]
        r, c = r + rows.start, c + columns.start
        of_a += np.bincount(r, b.weight[c], len(of_a))
        of_b += np.bincount(c, a.weight[r], len(of_b))
        # Of many links, those to the smallest row that is reached.
        n, first = STRETCH, min(rows.start, columns.start)
        if len(r) > 2 * n:
            shift = 0 if a is b else n
            left, right = (r - rows.start, c - columns.start + shift) if a is not b else (r - first, c - first)
            label = forest(left, right, int(max(left.max(), right.max())) + 1)
            joined = np.unique(np.concatenate([left, right]))
            if a is b:
                node, near = joined + first, label[joined] + first
                moved = node != near
                r, c = node[moved], near[moved]
            else:
                # A component's smallest row is of a; its rows of a are tied to one of its rows of b, and those to it.
                of_first = joined[joined >= n]
                some_b = np.full(n, -1)
                some_b[label[of_first]] = of_first - n
                in_a = joined[joined < n]
                r = np.concatenate([label[of_first], in_a]) + rows.start
                c = np.concatenate([of_first - n, some_b[label[in_a]]]) + columns.start
        ends[0].append(r)
        ends[1].append(c)
    return of_a, of_b, np.concatenate(ends[0]), np.concatenate(ends[1])


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, a table each."""
    held, of = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
        starts = np.append(0, np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1)
        for start, end in zip(starts, np.append(starts[1:], len(values))):
            mine = tuple(values[start])
            if held and mine != of:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            of = mine
    if held:
        yield pa.Table.from_batches(held)


def principal_axes(vectors: DataFrame, width: int, axes: int = AXES) -> np.ndarray:
    """(component, axis): the leading principal axes of the unit vectors. The driver gets width x width sums, however many rows there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total, products = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                units = unit(matrix(batch.column("vector"), width, np.float64))
                rows, total, products = rows + len(units), total + units.sum(axis=0), products + units.T @ units
        if rows:
            values = np.concatenate([[rows], total, products.ravel()])
            yield pa.RecordBatch.from_pydict({"cell": np.arange(len(values)), "value": values})

    sums = vectors.select("vector").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    found = np.zeros(1 + width + width * width)
    for r in sums.toLocalIterator():
        found[r["cell"]] = r["value"]
    rows, mean = max(1.0, found[0]), found[1 : 1 + width]
    spread = found[1 + width :].reshape(width, width) / rows - np.outer(mean, mean) / rows**2
    return np.linalg.eigh(spread)[1][:, ::-1][:, :axes]


def sequence(nodes: DataFrame, axes: np.ndarray, epsilon: float) -> DataFrame:
    """The nodes with their place in grid order and their coordinates on the leading axes; written once."""
    width = axes.shape[0]
    spark = nodes.sparkSession
    keep = [f for f in nodes.schema.fields]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = unit(matrix(batch.column("vector"), width, np.float64)) @ axes if batch.num_rows else np.empty((0, axes.shape[1]))
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), axes.shape[1]) for x in (lead, np.floor(lead / epsilon))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists[0].cast(pa.list_(pa.float64())), lists[1].cast(pa.list_(pa.int32()))],
                names=[*batch.schema.names, "lead", "cells"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, task, np.int32)), pa.array(np.arange(at, at + batch.num_rows))],
                names=[*batch.schema.names, "part", "at"])
            at += batch.num_rows

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep)
    order = ["cells", "h1", "h2"]
    sorted_rows = nodes.mapInArrow(cells, f"{ddl}, lead array<double>, cells array<int>").repartitionByRange(
        shuffle_width(spark), *order).sortWithinPartitions(*order).drop("cells")
    path = scratch_path(spark, "sequence")
    sorted_rows.mapInArrow(number, f"{ddl}, lead array<double>, part int, at long").write.parquet(path)
    rows = spark.read.parquet(path)
    # One row per range partition comes to the driver: a setting, not a share of the data.
    before, starts = 0, []
    for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        starts.append((r["part"], before))
        before += r["n"]
    offsets = spark.createDataFrame(starts, "part int, start long")
    return rows.join(F.broadcast(offsets), "part").withColumn("place", F.col("start") + F.col("at")).drop("part", "at", "start")


def _gap(one: str, other: str, axes: int) -> Column:
    """The square of the distance between two boxes."""
    parts = [F.greatest(F.lit(0.0), F.col(f"{one}.low{k}") - F.col(f"{other}.high{k}"), F.col(f"{other}.low{k}") - F.col(f"{one}.high{k}"))
             for k in range(axes)]
    return sum((p * p for p in parts), F.lit(0.0))


def near_blocks(rows: DataFrame, blocks: int, axes: int, apart: float) -> DataFrame:
    """(one, other): pairs of blocks, one <= other, that may hold a link; first by intervals of blocks, then by blocks."""
    lead = [F.col("lead")[k] for k in range(axes)]
    sides = [F.min(x).alias(f"low{k}") for k, x in enumerate(lead)] + [F.max(x).alias(f"high{k}") for k, x in enumerate(lead)]
    boxes = settle(rows.groupBy("block").agg(*sides).withColumn("interval", F.floor(F.col("block") / INTERVAL)))
    wider = [F.min(f"low{k}").alias(f"low{k}") for k in range(axes)] + [F.max(f"high{k}").alias(f"high{k}") for k in range(axes)]
    intervals = boxes.groupBy("interval").agg(*wider)
    last = (blocks - 1) // INTERVAL
    mine = intervals.withColumn("with", F.explode(F.sequence(F.col("interval"), F.lit(last).cast("long"))))
    met = mine.alias("a").join(intervals.alias("b"), F.col("a.with") == F.col("b.interval")).where(_gap("a", "b", axes) <= apart).select(
        F.col("a.interval").alias("i"), F.col("b.interval").alias("j"))
    of_first = met.join(boxes, F.col("i") == F.col("interval")).drop("i", "interval").alias("a")
    return of_first.join(boxes.alias("b"), F.col("a.j") == F.col("b.interval")).where(
        (F.col("a.block") <= F.col("b.block")) & (_gap("a", "b", axes) <= apart)).select(
        F.col("a.block").alias("one"), F.col("b.block").alias("other"))


def joined(rows: DataFrame, axes: np.ndarray, blocks: int, cosine: float) -> DataFrame:
    """(place, links, near), several rows per place: weights linked to it, and a place that it is connected with; written once.

    A pair of blocks belongs to one of the two, by turns. A task reads its own
    block and then up to STRIPE partners, one after another, and holds two.
    """
    width, n_axes = axes.shape
    spark = rows.sparkSession
    # A little more than the distance of the bound, for rounding.
    apart = 2 - 2 * cosine + 1e-9
    pairs = near_blocks(rows, blocks, n_axes, apart)
    turn = (F.col("one") + F.col("other")) % 2 == 0
    owned = pairs.select(
        F.when(turn, F.col("one")).otherwise(F.col("other")).alias("owner"), F.when(turn, F.col("other")).otherwise(F.col("one")).alias("block"),
    ).withColumn("stripe", F.floor(F.col("block") / STRIPE))
    own = owned.groupBy("owner", "stripe").agg(F.max(F.col("owner") == F.col("block")).alias("whole")).select(
        "owner", "stripe", F.lit(0).alias("role"), "whole", F.col("owner").alias("block"))
    partners = owned.where("owner <> block").select("owner", "stripe", F.lit(1).alias("role"), F.lit(False).alias("whole"), "block")
    path = scratch_path(spark, "blocks")
    own.unionByName(partners).write.parquet(path)
    sent = rows.select("block", "place", "weight", "vector").join(spark.read.parquet(path), "block")
    dealt = sent.repartition("owner", "stripe").sortWithinPartitions("owner", "stripe", "role", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(place: np.ndarray, links: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"place": place, "links": links.astype(np.int64), "near": near})

        mine = None
        for table in _runs(batches, ["owner", "stripe", "block"]):
            other = Sequence(table["place"].to_numpy(), table["weight"].to_numpy(), matrix(table["vector"], width, np.float64), axes)
            if table["role"][0].as_py() == 0:
                mine = other
                if not table["whole"][0].as_py():
                    continue
            of_mine, of_other, r, c = linked(mine, other, cosine, apart)
            totals = [(mine, of_mine + of_other)] if mine is other else [(mine, of_mine), (other, of_other)]
            for side, links in totals:
                some = links > 0
                yield told(side.place[some], links[some], side.place[some])
            # Fewer links still, over all stretches of the two blocks.
            shift = 0 if mine is other else len(mine.place)
            places = mine.place if mine is other else np.concatenate([mine.place, other.place])
            label = forest(r, c + shift, len(places))
            moved = np.flatnonzero(label != np.arange(len(places)))
            yield told(places[moved], np.zeros(len(moved)), places[label[moved]])

    return settle(dealt.mapInArrow(run, "place long, links long, near long"))


def near_vectors(embeddings: DataFrame, vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept; ``cosine`` is above 0."""
    spark = embeddings.sparkSession
    ship_package(spark)
    usable = F.coalesce(sound(vector) & F.exists(vector, lambda x: x != 0), F.lit(False))
    columns = ["vec_id", "n_links", "component_id", "kept"]
    alone = embeddings.where(~usable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    keys = ["h1", "h2"]
    rows = embeddings.where(usable).select(
        "vec_id", F.xxhash64(F.lit(1), vector).alias("h1"), F.xxhash64(F.lit(2), vector).alias("h2"), F.col(vector).alias("vector"))
    # Equal vectors become one node; where there are few of them, the other vectors are not shuffled for it.
    path = scratch_path(spark, "copies")
    rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("weight")).where("weight > 1").select(*keys).write.parquet(path)
    copied = spark.read.parquet(path)
    groups = rows.join(copied, keys, "left_semi").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("vec_id"), F.first("vector").alias("vector"))
    single = rows.join(copied, keys, "left_anti").withColumn("weight", F.lit(1).cast("long"))
    nodes = single.unionByName(groups)
    size = rows.agg(F.max(F.size("vector")).alias("width")).first()["width"]
    if size is None:
        return alone
    axes = principal_axes(nodes, size)
    placed = sequence(nodes, axes, math.sqrt(2 - 2 * cosine))
    total = placed.count()
    per_block = min(MOST_ROWS, max(LEAST_ROWS, -(-total // BLOCKS)))
    placed = placed.withColumn("block", F.floor(F.col("place") / per_block))
    found = joined(placed, axes, -(-total // per_block), cosine)
    sums = found.groupBy("place").agg(F.sum("links").alias("links"))
    labels = components(found.where("near <> place").select(F.col("place").alias("a"), F.col("near").alias("b")))
    labelled = settle(
        placed.select("place", "vec_id", "weight", *keys).join(sums, "place", "left").join(labels.withColumnRenamed("node", "place"), "place", "left")
        .select("vec_id", "weight", *keys, F.coalesce("label", "place").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    heads = labelled.groupBy("label").agg(F.min("vec_id").alias("component_id"), F.count(F.lit(1)).alias("_nodes"))
    told = join_facts(labelled, heads, ["label"], "_nodes", total).select("vec_id", "weight", *keys, "n_links", "component_id")
    of_groups = settle(told.where("weight > 1").drop("vec_id"))
    members = join_facts(
        rows.join(copied, keys, "left_semi").select("vec_id", *keys), of_groups, keys, "weight", embeddings.count()).select("vec_id", "n_links", "component_id")
    linked_rows = told.where("weight = 1").select("vec_id", "n_links", "component_id").unionByName(members)
    return linked_rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).select(*columns).unionByName(alone)
