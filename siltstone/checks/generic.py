"""Checks on single tables and pairs of tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.checks.kernel import between
from siltstone.operators.joins import anti_join
from siltstone.operators.project import row_condition as keep
from siltstone.operators.reshape import except_counts, except_symmetric, repeat_rows
from siltstone.operators.windows import with_next_range, with_previous_value


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counted.agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside a list, with their counts."""
    counted = df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.where(~F.col("value_field").isin(list(values)))


def source_freshness(
    df: DataFrame, stamp: str, as_of: Column, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Age of the newest row in hours and the resulting status."""
    newest = df.agg(F.max(stamp).alias("max_loaded_at"))
    age = F.timestamp_diff("HOUR", F.col("max_loaded_at"), as_of)
    status = F.when(F.col("age_hours") > error_hours, "error").when(F.col("age_hours") > warn_hours, "warn")
    return newest.withColumn("age_hours", age).withColumn("status", status.otherwise("pass"))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    if min_value is None and max_value is None:
        return df.where(F.lit(False))
    return df.where(~between(F.col(column), min_value, max_value, strictly=not inclusive))


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the table) without a single value."""
    return df.groupBy(*group_by).agg(F.count(column).alias("filled")).where("filled = 0")


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    return except_counts(df, column, to, field)


def _paired_counts(df: DataFrame, compare: DataFrame, group_by: Sequence[str], a: str, b: str) -> DataFrame:
    """Row counts of both tables per group; one aggregate over the tagged union, no join.

    A NULL in a group key matches nothing, so such groups stay apart by side.
    """
    by = list(group_by)
    mine = df.select(*by, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    theirs = compare.select(*by, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    totals = F.sum("_a").alias(a), F.sum("_b").alias(b)
    if not by:
        both = mine.union(theirs).agg(*totals)
        return both.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in (a, b)])
    any_null = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in by])
    sided = mine.union(theirs).withColumn("_side", F.when(any_null, F.col("_a")))
    both = sided.groupBy(*by, "_side").agg(*totals)
    return both.select(*by, *[F.when(F.col(c) > 0, F.col(c)).alias(c) for c in (a, b)])


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Counts per group and their difference.

    A group on one side only has no difference unless ``strict`` counts its rows.
    """
    counts = _paired_counts(df, compare, group_by, "count_a", "count_b")
    a, b = F.col("count_a"), F.col("count_b")
    if strict:
        a, b = F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))
    return counts.withColumn("diff_count", F.abs(a - b))


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Counts per group and by how many rows the first table is too large (1 when equal)."""
    counts = _paired_counts(df, compare, group_by, "count_our_model", "count_comparison_model")
    a, b = F.col("count_our_model"), F.col("count_comparison_model")
    return counts.withColumn("row_count_delta", F.when(a > b, a - b).when(a == b, 1).otherwise(0))


def equality(df: DataFrame, compare: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return except_symmetric(df, compare, columns)


# The failure count of ``equality``: differing rows plus the imbalance between the sides.
EQUALITY_FAIL_CALC = (
    "count(*) + coalesce(abs(count_if(which_diff = 'a_minus_b') - count_if(which_diff = 'b_minus_a')), 0)"
)


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows for which the expression (put behind the column, if one is given) is false."""
    return df.where(~F.expr(f"{column} {expression}" if column else expression))


def mutually_exclusive_ranges(
    df: DataFrame, lower: str, upper: str, partition_by: Sequence[str] = (),
    gaps: str = "allowed", zero_length: bool = False,
) -> DataFrame:
    """Ranges that are reversed, overlap the next one, or break the rule on gaps."""
    if gaps not in ("allowed", "not_allowed", "required"):
        raise ValueError(f"unknown gaps rule {gaps!r}")
    low, high, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    rule = {"allowed": high <= following, "not_allowed": high == following, "required": high < following}[gaps]
    ordered = F.coalesce(low <= high if zero_length else low < high, F.lit(False))
    apart = F.coalesce(rule, F.col("is_last_record"), F.lit(False))
    return with_next_range(df, lower, upper, partition_by).where(~(ordered & apart))


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    forbidden = df.where(F.col(column).isin(list(values)))
    return forbidden.select(F.col(column).alias("value_field")).distinct()


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the table) with exactly one distinct value; two extremes tell as much as a distinct count."""
    extremes = df.groupBy(*group_by).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    return extremes.where("_lo = _hi").select(*group_by, F.lit(1).cast("bigint").alias("distinct_values"))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    text = F.trim(column) if trim_whitespace else F.col(column)
    return df.where(text == "")


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    share = (F.count(column) / F.count(F.lit(1))).alias("not_null_proportion")
    found = F.col("not_null_proportion")
    return df.groupBy(*group_by).agg(share).where((found < at_least) | (found > at_most))


def recency(
    df: DataFrame, field: str, datepart: str, interval: int, as_of: Column,
    ignore_time: bool = False, group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups (or the table) whose newest row is older than the interval before ``as_of``."""
    newest = F.max(field).cast("timestamp_ntz")
    limit = F.timestamp_add(datepart, F.lit(-interval), as_of.cast("timestamp_ntz"))
    if ignore_time:
        newest, limit = newest.cast("date"), limit.cast("date")
    found = df.groupBy(*group_by).agg(newest.alias("most_recent")).withColumn("threshold", limit)
    return found.where("most_recent < threshold")


def relationships_where(
    df: DataFrame, column: str, to: DataFrame, field: str,
    from_condition: str | None = None, to_condition: str | None = None,
) -> DataFrame:
    """Non-null keys without a partner, one row per occurrence.

    Both sides are reduced to distinct keys before they meet, so a frequent key
    is looked up once; only missing keys are multiplied again.
    """
    mine = keep(df, from_condition).where(F.col(column).isNotNull()).groupBy(F.col(column).alias("id"))
    theirs = keep(to, to_condition).where(F.col(field).isNotNull()).select(F.col(field).alias("id")).distinct()
    missing = anti_join(mine.agg(F.count(F.lit(1)).alias("_n")), theirs, [("id", "id")])
    return repeat_rows(missing, F.col("_n")).select("id")


def sequential_values(
    df: DataFrame, column: str, interval: int = 1, datepart: str | None = None, group_by: Sequence[str] = ()
) -> DataFrame:
    """Rows that do not follow the value before them by exactly the interval."""
    name = f"previous_{column}"
    lagged = with_previous_value(df, column, group_by, name)
    if datepart:
        expected = F.timestamp_add(datepart, F.lit(interval), F.col(name).cast("timestamp_ntz")).cast("timestamp_ntz")
        return lagged.where(~(F.col(column).cast("timestamp_ntz") == expected))
    return lagged.where(~(F.col(column) == F.col(name) + interval))


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")

