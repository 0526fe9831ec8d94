"""Window operators.

``row_number`` filters are planned with a group limit before the shuffle, so a
key that holds a large share of the rows sends only one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siltstone.functions.maths import log_natural
from siltstone.operators.joins import with_one_row
from siltstone.operators.ordered import with_neighbour, with_running_total
from siltstone.operators.reshape import repeat_rows


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row per key in the given order."""
    numbered = df.withColumn("_n", F.row_number().over(W.partitionBy(*partition_by).orderBy(*order_by)))
    return numbered.where("_n = 1").drop("_n")


def latest_per_key(df: DataFrame, partition_by: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """Row with the greatest ``latest_by`` per key, as an aggregate."""
    rest = [c for c in df.columns if c not in partition_by]
    best = F.max_by(F.struct(*rest), F.struct(*latest_by)).alias("_best")
    return df.groupBy(*partition_by).agg(best).select(*partition_by, "_best.*").select(df.columns)


def monotonic_breaks(
    df: DataFrame,
    column: str,
    sort_column: str | None = None,
    by: Sequence[str] = (),
    increasing: bool = True,
    strictly: bool = True,
) -> DataFrame:
    """Rows that do not go up (or down) against the row before them.

    Equal sort keys are read in the direction of the check, so only their
    smallest and largest value and their repeats matter: every sort key is
    reduced to one row before anything is ordered, whatever share of the table
    it holds.
    """
    by = list(by)
    pairs = df.select(*by, F.col(sort_column or column).alias("sort_column"), F.col(column).alias("value_field"))
    value = F.col("value_field")
    first, last = (F.min, F.max) if increasing else (F.max, F.min)
    # A NULL comes first among equal sort keys, and nothing is compared with it.
    has_null = F.max(value.isNull())
    keys = pairs.groupBy(*by, "sort_column").agg(
        F.when(~has_null, first(value)).alias("_enter"), last(value).alias("_leave")
    )
    lagged = with_neighbour(keys, by, ["sort_column"], "_leave", "value_field_lag")
    enter, before = F.col("_enter"), F.col("value_field_lag")
    if increasing:
        broken = enter <= before if strictly else enter < before
    else:
        broken = enter >= before if strictly else enter > before
    between = lagged.where(broken).select(*by, "sort_column", enter.alias("value_field"), before)
    if not strictly:
        return between
    counted = pairs.where(value.isNotNull()).groupBy(*by, "sort_column", "value_field")
    repeats = repeat_rows(counted.agg(F.count(F.lit(1)).alias("_copies")), F.col("_copies") - 1)
    return between.unionByName(repeats.select(*by, "sort_column", "value_field", value.alias("value_field_lag")))


def with_previous_value(df: DataFrame, column: str, by: Sequence[str], name: str) -> DataFrame:
    """Every row's group and value with the value before it in value order.

    Copies of a value follow each other, so each distinct value is ranged once
    and its further copies see the value itself.
    """
    by = list(by)
    counted = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("_copies"))
    once = with_neighbour(counted, by, [column], column, name)
    copies = repeat_rows(once, F.col("_copies") - 1).select(*by, column, F.col(column).alias(name))
    return once.select(*by, column, name).unionByName(copies)


def with_next_range(df: DataFrame, lower: str, upper: str, by: Sequence[str] = ()) -> DataFrame:
    """Ranges with the lower bound that follows in (lower, upper) order, and whether they are last.

    Equal ranges are counted first; all but the last copy are followed by their own bound.
    """
    by = list(by)
    bounds = [F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound")]
    counted = df.select(*by, *bounds).groupBy(*by, "lower_bound", "upper_bound").agg(
        F.count(F.lit(1)).alias("_copies")
    )
    order = ["lower_bound", "upper_bound"]
    following = with_neighbour(counted, by, order, F.struct("lower_bound"), "_next", ahead=True)
    final = following.select(
        *by, *order, F.col("_next.lower_bound").alias("next_lower_bound"), F.col("_next").isNull().alias("is_last_record")
    )
    copies = repeat_rows(following, F.col("_copies") - 1).select(
        *by, *order, F.col("lower_bound").alias("next_lower_bound"), F.lit(False).alias("is_last_record")
    )
    return final.unionByName(copies)


def lag_difference(
    df: DataFrame, by: Sequence[str], order: str, value: str, back: int = 1,
    take_diffs: bool = True, take_logs: bool = True, name: str = "metric_test_value",
) -> DataFrame:
    """Change against ``back`` periods earlier, on logs if wanted.

    The input is a per-period aggregate: a group has one row per period.
    """
    def metric(c: str) -> Column:
        return F.coalesce(log_natural(c) if take_logs else F.col(c), F.lit(0))

    if not take_diffs:
        return df.withColumn(name, metric(value))
    prior = f"prior_{value}"
    rows = over_blocks(df, by, order, back, lambda window: {prior: F.lag(value, back).over(window)})
    return rows.withColumn(name, metric(value) - metric(prior))


# Rows of a block; the rows before it that a moving window needs are copied in.
BLOCK_ROWS = 1 << 13


def over_blocks(
    df: DataFrame, by: Sequence[str], order: str, back: int, columns: Callable[[WindowSpec], dict[str, Column]],
) -> DataFrame:
    """Columns over windows that reach back ``back`` rows, of groups of any size (one row per period).

    The rows of a group are numbered by a distributed running total and cut into
    blocks; the last ``back`` rows of a block are copied into the next one. A
    window never holds more than a block, whatever share of the rows a group has.
    """
    by, size = list(by), max(back, BLOCK_ROWS)
    counted = with_running_total(df.withColumn("_one", F.lit(1)), by, [order], "_one", "_number", "_all")
    place = F.col("_number") - 1
    own = F.struct(F.floor(place / size).alias("_block"), F.lit(False).alias("_halo"))
    following = F.struct((F.floor(place / size) + 1).alias("_block"), F.lit(True).alias("_halo"))
    dealt = counted.select(
        *df.columns, "_number", F.inline(F.when(place % size >= size - back, F.array(own, following)).otherwise(F.array(own))))
    window = W.partitionBy(*by, "_block").orderBy("_number")
    found = columns(window)
    return dealt.withColumns(found).where(~F.col("_halo")).select(*df.columns, *found)


def moving_stats(df: DataFrame, by: Sequence[str], order: str, value: str, back: int, prefix: str) -> DataFrame:
    """Mean and standard deviation of the ``back`` rows before each row (per-period input)."""
    return over_blocks(df, by, order, back, lambda window: {
        f"{prefix}_average": F.avg(value).over(window.rowsBetween(-back, -1)),
        f"{prefix}_stddev": F.stddev_samp(value).over(window.rowsBetween(-back, -1)),
    })


def with_global_stats(df: DataFrame, value: str) -> DataFrame:
    """Mean and standard deviation of the whole column beside every row."""
    stats = df.agg(F.avg(value).alias(f"{value}_average"), F.stddev_samp(value).alias(f"{value}_stddev"))
    return with_one_row(df, stats)


def rolling_sum(df: DataFrame, by: Sequence[str], order: str, value: str, name: str, descending: bool = False) -> DataFrame:
    """Running sum up to and including each row (per-period input), NULL before the first value.

    Sums within ranges and one offset per range and group, so a group of any size is spread over tasks.
    """
    by = list(by)
    known = F.col(value).isNotNull()
    summed = with_running_total(
        df.withColumn("_amount", F.coalesce(F.col(value), F.lit(0))), by, [order], "_amount", "_upto", "_all")
    first = (F.max if descending else F.min)(F.when(known, F.col(order))).alias("_first")
    if by:
        starts = df.groupBy(*by).agg(first).withColumnsRenamed({k: f"_k_{k}" for k in by})
        beside = summed.join(starts, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by])
    else:
        beside = with_one_row(summed, df.agg(first))
    total = F.col("_all") - F.col("_upto") + F.col("_amount") if descending else F.col("_upto")
    begun = F.col(order) <= F.col("_first") if descending else F.col(order) >= F.col("_first")
    return beside.withColumn(name, F.when(begun, total)).select(*df.columns, name)
