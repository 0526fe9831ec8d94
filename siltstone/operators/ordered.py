"""Neighbour and running-total operators over a total order of a large table.

A window with one huge partition (or none at all) would sort the whole table in
one task.  Here the rows are range-partitioned by (keys, order) first, every
range is worked on by itself, and ranges are stitched together with one small
row per range.  The cut is checkpointed once, so that all readers of it see
the same ranges even when an executor is lost.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from siltstone.session import settle, ship_package, shuffle_width, written

RANGE = "_range"


def cut_by_range(df: DataFrame, keys: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Range-partition by ``keys`` and record the range number of each row."""
    n = ranges or shuffle_width(df.sparkSession)
    cut = df.repartitionByRange(n, *[F.col(k) for k in keys])
    return settle(cut.withColumn(RANGE, F.spark_partition_id()))


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two arrays agree as groups do: NULL with NULL, NaN with NaN."""
    same = pc.or_(pc.equal(a, b).fill_null(False), pc.and_(a.is_null(), b.is_null()))
    if pa.types.is_floating(a.type):
        same = pc.or_(same, pc.and_(pc.is_nan(a), pc.is_nan(b)).fill_null(False))
    return same.to_numpy(zero_copy_only=False)


# Rows that see their neighbour in their own range, first rows of a range, and copies of last rows, for the range that follows.
INNER, FIRST, LAST = range(3)


def with_neighbour(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    source: str | Column,
    name: str,
    ahead: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``source`` of the row before (or after) within ``by`` in ascending ``order``.

    Rows are shuffled once, by range, and read in order: a task sees neighbours
    as they come and hands over its last row for the range that follows. Rows
    equal in ``by`` and ``order`` would share one range, so callers reduce them
    to a single row beforehand.
    """
    by, order = list(by), list(order)
    wanted = F.col(source) if isinstance(source, str) else source
    keys = [F.col(k) for k in by + order]
    rows = df.withColumn("_source", wanted).repartitionByRange(ranges or shuffle_width(df.sparkSession), *keys)
    rows = rows.sortWithinPartitions(*[k.desc() for k in keys] if ahead else keys)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, rows.schema["_source"].dataType)]
                          + T.StructType.fromDDL(f"{RANGE} int, _kind int").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId(), None

        def told(rows: pa.RecordBatch, near: pa.Array, kind: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*rows.columns, near, pa.array(np.full(rows.num_rows, task, np.int32)), pa.array(kind.astype(np.int32))], names=schema.names)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            # Row i of ``both`` stands before row i of the batch; the first of all has none and stands in for itself.
            both = pa.Table.from_batches([batch.slice(0, 1) if before is None else before, batch]).combine_chunks().to_batches()[0]
            alike = np.ones(n, bool)
            for k in by:
                column = both.column(k)
                alike &= _same(column.slice(0, n), column.slice(1))
            kind = np.zeros(n, np.int32)
            if before is None:
                kind[0], alike[0] = FIRST, False
            place = pa.array(np.arange(n), mask=~alike)
            yield told(batch, both.column("_source").take(place), kind)
            before = batch.slice(n - 1)
        if before is not None:
            yield told(before, before.column("_source").take(pa.array([None], pa.int64())), np.array([LAST]))

    ship_package(df.sparkSession)
    found = settle(rows.mapInArrow(run, schema))
    # One row per range moves to the range that follows.
    group = F.struct(*[F.col(k) for k in by]) if by else F.lit(True)
    follows = F.lead if ahead else F.lag
    ends = found.where(F.col("_kind") == LAST).select(F.col(RANGE).alias("_at"), F.struct(group.alias("by"), F.col("_source").alias("value")).alias("_end"))
    firsts = found.where(F.col("_kind") == FIRST).select(F.col(RANGE).alias("_at"))
    carried = firsts.join(ends, "_at").select("_at", follows("_end").over(W.orderBy("_at")).alias("_end"))
    across = F.when(F.col("_end.by").eqNullSafe(group), F.col("_end.value"))
    edge = F.col("_kind") == FIRST
    return (
        found.where(F.col("_kind") != LAST).join(F.broadcast(carried), edge & (F.col(RANGE) == F.col("_at")), "left")
        .withColumn(name, F.when(edge, across).otherwise(F.col(name)))
        .drop("_source", RANGE, "_kind", "_at", "_end")
    )


def with_running_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    amount: str,
    name: str,
    total: str,
    ranges: int | None = None,
) -> DataFrame:
    """Add the running sum of ``amount`` within ``by`` (inclusive) and the sum of the group.

    Only a group that reaches over the edge of a range needs sums from other
    ranges. Such groups are first or last in their ranges, so at most two rows
    per range are sent to the tasks.
    """
    by, order = list(by), list(order)
    cut = cut_by_range(df, by + order, ranges)
    here = W.partitionBy(RANGE, *by)
    so_far = here.orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = cut.withColumns({"_inside": F.sum(amount).over(so_far), "_here": F.sum(amount).over(here)})
    sums = cut.groupBy(RANGE, *by).agg(F.sum(amount).alias("_sum"))
    if by:
        group = F.struct(*[F.col(k) for k in by])
        edges = sums.groupBy(RANGE).agg(F.min(group).alias("_first"), F.max(group).alias("_last"))
        at_edge = group.eqNullSafe(F.col("_first")) | group.eqNullSafe(F.col("_last"))
        sums = sums.join(F.broadcast(edges), RANGE).where(at_edge)
    whole = W.partitionBy(*by)
    before = whole.orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        F.col(RANGE).alias("_at"),
        *[F.col(k).alias(f"_k_{k}") for k in by],
        F.sum("_sum").over(before).alias("_offset"),
        F.sum("_sum").over(whole).alias("_total"),
    )
    same = [F.col(RANGE) == F.col("_at")] + [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by]
    return rows.join(F.broadcast(offsets), same, "left").withColumns({
        name: F.col("_inside") + F.coalesce(F.col("_offset"), F.lit(0)),
        total: F.coalesce(F.col("_total"), F.col("_here")),
    }).drop(RANGE, "_inside", "_here", "_at", "_offset", "_total", *[f"_k_{k}" for k in by])


# Rank error of the first-pass sketch, and the half widths of the brackets laid around a quantile.
SKETCH_ACCURACY = 10_000
BRACKETS = (0.0005, 0.001, 0.01, 0.1, 1.0)


def _collapse_far_values(rows: DataFrame, by: list[str], quantiles: Sequence[float]) -> DataFrame:
    """Replace values that cannot be next to a quantile by one stand-in per gap.

    A bounded sketch gives each group a bracket of values around each quantile,
    wide enough for the sketch's rank error and for small groups. Values inside
    a bracket stay; the rest keep only their place in the order, so that almost
    all rows vanish in the partial counts that follow. ``_far`` marks stand-ins.
    """
    ends = sorted({min(max(q + side * w, 0.0), 1.0) for q in quantiles for w in BRACKETS for side in (-1, 1)})
    marks = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_size"),
        F.percentile_approx("_v", [float(e) for e in ends], SKETCH_ACCURACY).alias("_marks"),
    )
    needed = F.lit(2.0 / SKETCH_ACCURACY) + F.try_divide(F.lit(2.0), F.col("_size"))
    chosen = []
    for i, q in enumerate(quantiles):
        for side, name in ((-1, f"_from{i}"), (1, f"_to{i}")):
            places = [ends.index(min(max(q + side * w, 0.0), 1.0)) for w in BRACKETS]
            mark = F.col("_marks")[places[-1]]
            for w, place in reversed(list(zip(BRACKETS[:-1], places[:-1], strict=True))):
                mark = F.when(needed <= w, F.col("_marks")[place]).otherwise(mark)
            chosen.append(mark.alias(name))
    brackets = marks.select(*[F.col(k).alias(f"_k_{k}") for k in by], *chosen)
    # Without groups the brackets are one row. With them they are written, as Spark would judge them by the size of the
    # sketches and send all rows of a group to one task; it chooses by what was written, and splits large groups.
    same_group = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by] or None
    beside = written(brackets, "brackets") if by else F.broadcast(brackets)
    v = F.col("_v")
    near = F.lit(False)
    below = F.lit(float("-inf"))
    for i in range(len(quantiles)):
        near = near | v.between(F.col(f"_from{i}"), F.col(f"_to{i}"))
        below = F.greatest(below, F.when(F.col(f"_to{i}") < v, F.col(f"_to{i}")))
    return rows.join(beside, same_group, "inner").select(
        *by, F.when(near, v).otherwise(below).alias("_v"), (~near).alias("_far")
    )


def spread_exact_quantiles(
    df: DataFrame,
    value: str | Column,
    quantiles: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Exact interpolated quantiles without gathering a group's values in one task.

    A first pass brackets each quantile; the second counts the values in the
    brackets (partial counts before the shuffle). These few are ranked by a
    distributed running total and the two neighbours of each quantile's position
    are picked with a plain aggregate.
    """
    by = list(by)
    names = list(names or [f"q{round(q * 100)}" for q in quantiles])
    v = F.col(value) if isinstance(value, str) else value
    rows = df.select(*by, v.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    counts = _collapse_far_values(rows, by, quantiles).groupBy(*by, "_v", "_far").agg(F.count(F.lit(1)).alias("_n"))
    ranked = with_running_total(counts, by, ["_v", "_far"], "_n", "_upto", "_size", ranges)
    picks, results = [], []
    missed = F.raise_error(F.lit("quantile outside its bracket")).cast("double")
    for i, (q, name) in enumerate(zip(quantiles, names, strict=True)):
        at = F.lit(float(q)) * (F.col("_size") - 1)

        def value_at(rank: Column) -> Column:
            inside = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
            return F.max(F.when(inside & F.col("_far"), missed).when(inside, F.col("_v")))

        picks += [
            value_at(F.floor(at)).alias(f"_lo{i}"),
            value_at(F.ceil(at)).alias(f"_hi{i}"),
            F.max(at - F.floor(at)).alias(f"_part{i}"),
        ]
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        results.append((lo + (hi - lo) * F.col(f"_part{i}")).alias(name))
    return ranked.groupBy(*by).agg(*picks).select(*by, *results)
