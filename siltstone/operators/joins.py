"""Join operators.

No join is forced to broadcast here except against rows that are bounded by
construction (one row, or one row per range).  Elsewhere Spark broadcasts a side
only when its known size is below ``spark.sql.autoBroadcastJoinThreshold`` and
splits skewed partitions of the remaining sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same(left: str, right: str, keys: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{a}") == F.col(f"{right}.{b}") for a, b in keys])


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of ``left`` without a partner; NULL keys never find one."""
    return left.alias("l").join(right.alias("r"), _same("l", "r", keys), "left_anti")


def not_in(left: DataFrame, column: str, right: DataFrame, field: str) -> DataFrame:
    """``NOT IN`` with its treatment of NULL, as an ordinary anti join.

    Everything passes an empty right side; nothing passes one that holds a NULL;
    a NULL on the left passes only an empty one.  (Spark's own ``NOT IN`` can
    only be run by sending the whole right side to every task.)
    """
    facts = right.agg(F.count(F.lit(1)).alias("_rows"), F.count_if(F.col(field).isNull()).alias("_nulls"))
    keys = right.where(F.col(field).isNotNull()).select(F.col(field).alias("_key")).distinct()
    alone = left.join(keys, F.col(column) == F.col("_key"), "left_anti")
    passes = (F.col("_rows") == 0) | ((F.col("_nulls") == 0) & F.col(column).isNotNull())
    return with_one_row(alone, facts).where(passes).drop("_rows", "_nulls")


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join on equally named keys, keys merged, other columns of both sides kept."""
    joined = left.alias("l").join(right.alias("r"), _same("l", "r", [(k, k) for k in keys]), "full")
    merged = [F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys]
    rest = [F.col(f"l.{c}") for c in left.columns if c not in keys]
    rest += [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return joined.select(*merged, *rest)


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row frame (an ungrouped aggregate) beside every row."""
    return df.join(F.broadcast(one_row), how="inner")


def explode_to(df: DataFrame, count: Column, name: str) -> DataFrame:
    """One row per number 1..count of each row."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), count)))


def join_day_ranges(
    facts: DataFrame, day: str, ranges: DataFrame, start: str, end: str
) -> DataFrame:
    """Join days to the date ranges that contain them.

    Both ends belong to a range.
    """
    number = lambda c: F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return join_intervals(facts, number(day), ranges, number(start), number(end) + 1)


# Bits by which blocks grow from level to level, and levels: numbers of 64 bits.
BLOCK_BITS, BLOCK_LEVELS = 4, 16


def _on_level(level: int, numbers: Column) -> Column:
    return F.transform(numbers, lambda x: F.struct(F.lit(level).alias("level"), x.alias("number")))


def interval_blocks(start: Column, end: Column) -> Column:
    """The aligned blocks, as (level, number), that make up start <= x < end: a few per level, however long the interval.

    On every level the numbers up to the next multiple of a block's size, and
    those after the last one, are blocks; the middle is left to the next level.
    """
    size = 1 << BLOCK_BITS
    parts = []
    none = F.array().cast("array<struct<level:int,number:bigint>>")
    for level in range(BLOCK_LEVELS):
        # Whole blocks of the level between the ends, and of the next level, in units of this one.
        low, high = -F.shiftright(-start, BLOCK_BITS * level), F.shiftright(end, BLOCK_BITS * level)
        above, below = -F.shiftright(-low, BLOCK_BITS) * size, F.shiftright(high, BLOCK_BITS) * size
        head_end = F.least(high, above)
        tail_start = F.greatest(head_end, below)
        for a, b in ((low, head_end), (tail_start, high)):
            parts.append(F.when(a < b, _on_level(level, F.sequence(a, b - 1))).otherwise(none))
    return F.flatten(F.array(*parts))


def join_intervals(
    facts: DataFrame, at: Column, ranges: DataFrame, start: Column, end: Column, parts: Sequence[Column] = (),
) -> DataFrame:
    """Inner join of facts with the ranges that contain them, start <= at < end, on whole numbers such as microseconds.

    A range is a few aligned blocks, and a fact has one block on each level that
    any range uses, so the join is on equality: facts are never compared with
    every range, and a range is not opened into its points. NULLs match nothing.

    With ``parts``, named aggregates of the facts, each range comes with one row
    of them per block that holds facts, to be merged by the caller: facts are
    added up once per block, so the work does not grow with the pairs.
    """
    blocked = ranges.withColumns({"_start": start.cast("bigint"), "_end": end.cast("bigint")}).where("_start < _end")
    opened = blocked.withColumn("_block", F.explode(interval_blocks(F.col("_start"), F.col("_end")))).drop("_start", "_end")
    opened = opened.select(*ranges.columns, F.col("_block.level").alias("_level"), F.col("_block.number").alias("_number"))
    levels = [r["_level"] for r in opened.select("_level").distinct().collect()]  # at most BLOCK_LEVELS
    own = F.array(*[F.struct(F.lit(n).alias("_level"), F.shiftright(F.col("_at"), BLOCK_BITS * n).alias("_number")) for n in sorted(levels)])
    if not levels:
        own = F.array().cast("array<struct<_level:int,_number:bigint>>")
    placed = facts.withColumn("_at", at.cast("bigint")).where("_at is not null").select(*facts.columns, F.inline(own))
    if parts:
        placed = placed.groupBy("_level", "_number").agg(*parts)
    return placed.join(opened, ["_level", "_number"]).drop("_level", "_number")


def join_spine(spine: DataFrame, facts: DataFrame, key: str, counted: str) -> DataFrame:
    """Every spine row with the facts' count, 0 where there are none."""
    return spine.join(facts, key, "left").withColumn(counted, F.coalesce(F.col(counted), F.lit(0)))
