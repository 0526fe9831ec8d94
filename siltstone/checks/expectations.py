"""Expectations on columns and tables, grouped as aggregate, value, multi-column, text,
distribution and shape checks.  All of them return failing rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.checks import kernel as K
from siltstone.functions.text import match_position
from siltstone.operators import aggregates as A
from siltstone.operators import windows as WO
from siltstone.operators.joins import with_one_row
from siltstone.operators.project import keep_unless_missing, like_predicate
from siltstone.operators.project import row_condition as keep
from siltstone.operators.reshape import literal_rows, spine_between

# ---------------------------------------------------------------- aggregates


def _distinct(column: str) -> Column:
    return F.count_distinct(F.col(column))


def expect_column_distinct_count_to_be_greater_than(df, column, value, group_by=None, row_condition=None):
    return K.expression_between(df, _distinct(column), value, None, group_by, row_condition, True, True)


def expect_column_distinct_count_to_be_less_than(df, column, value, group_by=None, row_condition=None):
    return K.expression_between(df, _distinct(column), None, value, group_by, row_condition, True, True)


def expect_column_distinct_count_to_equal(df, column, value, group_by=None, row_condition=None):
    return K.expression_between(df, _distinct(column), value, value, group_by, row_condition, False, True)


def expect_column_distinct_count_to_equal_other_table(
    df, column, compare, compare_column=None, row_condition=None, compare_row_condition=None
):
    return K.equal_expression(
        df, _distinct(column), compare, _distinct(compare_column or column),
        row_condition=row_condition, compare_row_condition=compare_row_condition,
    )


def _distinct_values(df: DataFrame, column: str, row_condition) -> DataFrame:
    return keep(df, row_condition).select(F.col(column).alias("value_field")).distinct()


def expect_column_distinct_values_to_be_in_set(df, column, value_set, row_condition=None):
    value = F.col("value_field")
    return _distinct_values(df, column, row_condition).where(value.isNull() | ~value.isin(list(value_set)))


def expect_column_distinct_values_to_contain_set(df, column, value_set, row_condition=None):
    """Values of the set that the column lacks; only values in the set are gathered from the table."""
    wanted = list(dict.fromkeys(value_set))
    found = _distinct_values(df, column, row_condition).where(F.col("value_field").isin(wanted))
    return literal_rows(df.sparkSession, wanted).join(found, "value_field", "left_anti")


def expect_column_distinct_values_to_equal_set(df, column, value_set, row_condition=None):
    """Values on one side only: column_value beside NULL, or NULL beside value_field."""
    wanted = literal_rows(df.sparkSession, list(dict.fromkeys(value_set)))
    found = _distinct_values(df, column, row_condition).select(F.col("value_field").alias("column_value"))
    both = found.join(wanted, F.col("column_value") == F.col("value_field"), "full")
    return both.where(F.col("column_value").isNull() | F.col("value_field").isNull())


def _aggregate_between(measure: Column):
    def check(df, min_value=None, max_value=None, group_by=None, row_condition=None, strictly=False):
        return K.expression_between(df, measure, min_value, max_value, group_by, row_condition, strictly, True)

    return check


def expect_column_max_to_be_between(df, column, *bounds, **options):
    return _aggregate_between(F.max(column))(df, *bounds, **options)


def expect_column_mean_to_be_between(df, column, *bounds, **options):
    return _aggregate_between(F.avg(column))(df, *bounds, **options)


def expect_column_min_to_be_between(df, column, *bounds, **options):
    return _aggregate_between(F.min(column))(df, *bounds, **options)


def expect_column_stdev_to_be_between(df, column, *bounds, **options):
    return _aggregate_between(F.stddev_samp(column))(df, *bounds, **options)


def expect_column_sum_to_be_between(df, column, *bounds, **options):
    return _aggregate_between(F.sum(column))(df, *bounds, **options)


def expect_column_unique_value_count_to_be_between(df, column, *bounds, **options):
    return _aggregate_between(_distinct(column))(df, *bounds, **options)


def expect_column_proportion_of_unique_values_to_be_between(df, column, *bounds, **options):
    share = F.try_divide(_distinct(column).cast("double"), F.count(column))
    return _aggregate_between(share)(df, *bounds, **options)


def expect_column_quantile_values_to_be_between(
    df, column, quantile, min_value=None, max_value=None, group_by=None, row_condition=None, strictly=False
):
    found = A.percentile_cont(keep(df, row_condition), column, [quantile], list(group_by or []), ["observed"])
    return K.outside(found, min_value, max_value, strictly)


def expect_column_median_to_be_between(df, column, *bounds, **options):
    return expect_column_quantile_values_to_be_between(df, column, 0.5, *bounds, **options)


def expect_column_most_common_value_to_be_in_set(df, column, value_set, top_n=1, row_condition=None):
    """The value in place ``top_n`` by frequency (ties by value) when it is not in the set."""
    ranked = A.value_rank(keep(df, row_condition), column, top_n)
    value = F.col("value")
    chosen = ranked.where(F.col("value_rank") == top_n).select(value.alias("value_field"))
    return chosen.where(~F.col("value_field").isin(list(value_set)))


# -------------------------------------------------------------------- values


def expect_column_values_to_be_between(df, column, min_value=None, max_value=None, row_condition=None, strictly=False):
    return K.expression_between(df, F.col(column), min_value, max_value, None, row_condition, strictly)


def expect_column_values_to_be_decreasing(
    df, column, sort_column=None, strictly=True, row_condition=None, group_by=()
):
    return WO.monotonic_breaks(keep(df, row_condition), column, sort_column, group_by, False, strictly)


def expect_column_values_to_be_increasing(
    df, column, sort_column=None, strictly=True, row_condition=None, group_by=()
):
    return WO.monotonic_breaks(keep(df, row_condition), column, sort_column, group_by, True, strictly)


def expect_column_values_to_be_in_set(df, column, value_set, row_condition=None):
    """Rows whose value is not in the set; a NULL is not in it either."""
    value = F.col(column)
    return keep(df, row_condition).where(value.isNull() | ~value.isin(list(value_set)))


def expect_column_values_to_not_be_in_set(df, column, value_set, row_condition=None):
    return keep(df, row_condition).where(F.col(column).isin(list(value_set)))


def _schema_rows(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """Rows made from the schema alone; the table is not read."""
    return df.sparkSession.createDataFrame(rows, schema)


def expect_column_values_to_be_in_type_list(df, column, column_type_list):
    wanted = {t.upper() for t in column_type_list}
    found = [(name.upper(), kind.upper()) for name, kind in df.dtypes]
    wrong = [(n, k) for n, k in found if n == column.upper() and k not in wanted]
    return _schema_rows(df, wrong, "relation_column string, relation_column_type string")


def expect_column_values_to_be_of_type(df, column, column_type):
    return expect_column_values_to_be_in_type_list(df, column, [column_type])


def expect_column_values_to_be_null(df, column, row_condition=None):
    return K.expression_is_true(df, F.col(column).isNull(), row_condition=row_condition)


def expect_column_values_to_not_be_null(df, column, row_condition=None):
    return K.expression_is_true(df, F.col(column).isNotNull(), row_condition=row_condition)


def expect_column_values_to_be_unique(df, column, row_condition=None):
    return expect_compound_columns_to_be_unique(df, [column], row_condition=row_condition)


def expect_column_values_to_have_consistent_casing(df, column, display_inconsistent_columns=False):
    values = df.select(F.col(column).alias("_v")).distinct()
    if display_inconsistent_columns:
        spellings = values.groupBy(F.lower("_v").alias("inconsistent_columns")).agg(
            F.count("_v").alias("set_count_case_insensitive")
        )
        return spellings.where("set_count_case_insensitive > 1")
    counts = values.agg(
        F.count(F.lit(1)).alias("set_count"),
        F.count_distinct(F.lower("_v")).alias("set_count_case_insensitive"),
    )
    return counts.where("set_count != set_count_case_insensitive")


# -------------------------------------------------------------- multi-column


def expect_column_pair_values_A_to_be_greater_than_B(df, column_a, column_b, or_equal=False, row_condition=None):
    a, b = F.col(column_a), F.col(column_b)
    return K.expression_is_true(df, a >= b if or_equal else a > b, row_condition=row_condition)


def expect_column_pair_values_to_be_equal(df, column_a, column_b, row_condition=None):
    return K.expression_is_true(df, F.col(column_a) == F.col(column_b), row_condition=row_condition)


def expect_column_pair_values_to_be_in_set(df, column_a, column_b, value_pairs_set, row_condition=None):
    if any(len(pair) != 2 for pair in value_pairs_set):
        raise ValueError("every entry of value_pairs_set must be a pair")
    a, b = F.col(column_a), F.col(column_b)
    allowed = reduce(lambda x, y: x | y, [(a == K.as_value(p)) & (b == K.as_value(q)) for p, q in value_pairs_set])
    return K.expression_is_true(df, allowed, row_condition=row_condition)


def expect_compound_columns_to_be_unique(
    df, columns: Sequence[str], ignore_row_if="all_values_are_missing", row_condition=None
):
    if not columns:
        raise ValueError("give a list of columns")
    rows = keep(df, row_condition).where(keep_unless_missing(ignore_row_if, columns))
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def expect_multicolumn_sum_to_equal(df, columns: Sequence[str], sum_total, group_by=None, row_condition=None):
    total = reduce(lambda a, b: a + b, [F.sum(c) for c in columns])
    goal = F.sum(sum_total) if isinstance(sum_total, str) else K.as_value(sum_total)
    return K.expression_is_true(df, total == goal, None, group_by, row_condition, aggregate=True)


def expect_select_column_values_to_be_unique_within_record(
    df, columns: Sequence[str], ignore_row_if="all_values_are_missing", row_condition=None
):
    """Rows in which two of the columns hold the same value; decided inside each row."""
    rows = keep(df, row_condition).where(keep_unless_missing(ignore_row_if, columns))
    values = F.array(*[F.col(c).cast("string") for c in columns])
    return rows.where(F.size(F.array_distinct(F.array_compact(values))) < len(columns))


# ---------------------------------------------------------------------- text


def expect_column_value_lengths_to_be_between(
    df, column, min_value=None, max_value=None, row_condition=None, strictly=False
):
    return K.expression_between(df, F.length(column), min_value, max_value, None, row_condition, strictly)


def expect_column_value_lengths_to_equal(df, column, value, row_condition=None):
    return K.expression_is_true(df, F.length(column) == value, row_condition=row_condition)


def _combine(tests: Sequence[Column], match_on: str) -> Column:
    if match_on not in ("any", "all"):
        raise ValueError("match_on must be 'any' or 'all'")
    return reduce((lambda a, b: a & b) if match_on == "all" else (lambda a, b: a | b), tests)


def expect_column_values_to_match_like_pattern(df, column, pattern, row_condition=None):
    return K.expression_is_true(df, like_predicate(column, pattern), row_condition=row_condition)


def expect_column_values_to_not_match_like_pattern(df, column, pattern, row_condition=None):
    return K.expression_is_true(df, like_predicate(column, pattern, False), row_condition=row_condition)


def expect_column_values_to_match_like_pattern_list(df, column, patterns, match_on="any", row_condition=None):
    tests = [like_predicate(column, p) for p in patterns]
    return K.expression_is_true(df, _combine(tests, match_on), row_condition=row_condition)


def expect_column_values_to_not_match_like_pattern_list(df, column, patterns, match_on="any", row_condition=None):
    tests = [like_predicate(column, p, False) for p in patterns]
    return K.expression_is_true(df, _combine(tests, match_on), row_condition=row_condition)


def _matches(column: str, regex: str, flags: str) -> Column:
    return match_position(column, regex, flags=flags) > 0


def expect_column_values_to_match_regex(df, column, regex, row_condition=None, flags=""):
    return K.expression_is_true(df, _matches(column, regex, flags), row_condition=row_condition)


def expect_column_values_to_not_match_regex(df, column, regex, row_condition=None, flags=""):
    return K.expression_is_true(df, ~_matches(column, regex, flags), row_condition=row_condition)


def expect_column_values_to_match_regex_list(df, column, regexes, match_on="any", row_condition=None, flags=""):
    tests = [_matches(column, r, flags) for r in regexes]
    return K.expression_is_true(df, _combine(tests, match_on), row_condition=row_condition)


def expect_column_values_to_not_match_regex_list(df, column, regexes, match_on="any", row_condition=None, flags=""):
    tests = [~_matches(column, r, flags) for r in regexes]
    return K.expression_is_true(df, _combine(tests, match_on), row_condition=row_condition)


# -------------------------------------------------------------- distribution


def expect_column_values_to_be_within_n_stdevs(df, column, group_by=None, sigma_threshold=3):
    """Group sums further than ``sigma_threshold`` standard deviations from their mean."""
    sums = df.groupBy(*(group_by or [])).agg(F.sum(column).alias(column))
    scored = WO.with_global_stats(sums, column)
    gap = F.col(column) - F.col(f"{column}_average")
    sigma = F.try_divide(gap.cast("double"), F.col(f"{column}_stddev"))
    return scored.withColumn(f"{column}_sigma", sigma).where(F.abs(f"{column}_sigma") > sigma_threshold)


def expect_column_values_to_be_within_n_moving_stdevs(
    df, column, date_column, as_of: Column, group_by: Sequence[str] = (), period="day", lookback_periods=1,
    trend_periods=7, test_periods=14, sigma_threshold=3, sigma_threshold_upper=None, sigma_threshold_lower=None,
    take_diffs=True, take_logs=True,
):
    """Recent periods whose change lies outside the moving band of the periods before them.

    Everything after the first aggregate works on one row per period and group.
    """
    upper = sigma_threshold if sigma_threshold_upper is None else sigma_threshold_upper
    lower = -sigma_threshold if sigma_threshold_lower is None else sigma_threshold_lower
    by = list(group_by)
    truncated = F.date_trunc(period, F.col(date_column)).cast("timestamp_ntz").alias("metric_period")
    sums = df.groupBy(truncated, *by).agg(F.sum(column).alias("agg_metric_value"))
    metric = WO.lag_difference(sums, by, "metric_period", "agg_metric_value", lookback_periods, take_diffs, take_logs)
    banded = WO.moving_stats(metric, by, "metric_period", "metric_test_value", trend_periods, "metric_test_rolling")
    delta = F.col("metric_test_value") - F.col("metric_test_rolling_average")
    scored = banded.withColumn("metric_test_delta", delta).withColumn(
        "metric_test_sigma", F.try_divide(F.col("metric_test_delta"), F.col("metric_test_rolling_stddev"))
    )
    end = F.date_trunc(period, as_of).cast("timestamp_ntz")
    start = F.timestamp_add(period, F.lit(-test_periods), end)
    recent = (F.col("metric_period") >= start) & (F.col("metric_period") < end)
    inside = (F.col("metric_test_sigma") >= lower) & (F.col("metric_test_sigma") <= upper)
    return scored.where(recent & ~inside)


def expect_row_values_to_have_data_for_every_n_datepart(
    df, date_column, date_part="day", row_condition=None, exclusion_condition=None, interval=None,
    test_start_date=None, test_end_date=None,
):
    """Calendar periods between first and last day that have no row (the last day is not checked)."""
    rows = keep(df, row_condition)
    stamp = F.col(date_column)
    bounds = rows.agg(
        F.coalesce(F.lit(test_start_date).cast("date"), F.min(stamp.cast("date"))).alias("start_date"),
        F.coalesce(F.lit(test_end_date).cast("date"), F.max(stamp.cast("date"))).alias("end_date"),
    )
    period = f"date_{date_part}"
    spine = spine_between(bounds, date_part, "start_date", "end_date")
    truncated = F.date_trunc(date_part, stamp).cast("timestamp_ntz")
    if interval:
        first = bounds.select(F.col("start_date").cast("timestamp_ntz").alias("_start"))
        spine = with_one_row(spine, first).where(
            F.pmod(F.timestamp_diff(date_part, F.col("_start"), F.col(period)), F.lit(interval)) == 0
        ).drop("_start")
        offset = F.timestamp_diff(date_part, F.col("_start"), truncated) % F.lit(interval)
        placed = with_one_row(rows, first).select(
            F.timestamp_add(date_part, -offset.cast("int"), truncated).cast("timestamp_ntz").alias(period)
        )
    else:
        placed = rows.select(truncated.alias(period))
    counted = placed.groupBy(period).agg(F.count(F.lit(1)).alias("row_cnt"))
    final = spine.join(counted, period, "left").select(
        period, F.col("row_cnt").isNull().alias("is_missing"), F.coalesce("row_cnt", F.lit(0)).alias("row_cnt")
    )
    return keep(final.where("row_cnt = 0"), exclusion_condition)


# --------------------------------------------------------------------- shape


def _names(df: DataFrame, transform: str) -> list[str]:
    return [getattr(c, transform)() for c in df.columns]


def expect_column_to_exist(df, column, column_index=None, transform="upper"):
    name, names = getattr(column, transform)(), _names(df, transform)
    place = names.index(name) if name in names else -1
    in_place = not column_index or place == max(column_index - 1, 0)
    wrong = [] if place >= 0 and in_place else [(name, place, in_place)]
    return _schema_rows(df, wrong, "column_name string, matching_column_index int, column_index_matches boolean")


def expect_grouped_row_values_to_have_recent_data(
    df, group_by: Sequence[str], timestamp_column, datepart, interval, as_of: Column, row_condition=None
):
    """Groups whose newest row, future rows aside, is too old."""
    limit = as_of.cast("timestamp_ntz")
    stamp = F.col(timestamp_column).cast("timestamp_ntz")
    newest = keep(df, row_condition).where(stamp <= limit).groupBy(*group_by).agg(
        F.max(stamp).alias("latest_timestamp_column")
    )
    return newest.where(F.col("latest_timestamp_column") < F.timestamp_add(datepart, F.lit(-interval), limit))


def expect_row_values_to_have_recent_data(df, column, datepart, interval, as_of: Column, row_condition=None):
    """The newest timestamp when it is too old; a table without rows counts as dated 1970-01-01."""
    limit = as_of.cast("timestamp_ntz")
    stamp = F.col(column).cast("timestamp_ntz")
    newest = keep(df, row_condition).where(stamp <= limit).agg(F.max(stamp).alias("max_timestamp"))
    known = F.coalesce("max_timestamp", F.lit("1970-01-01").cast("timestamp_ntz"))
    return newest.where(known < F.timestamp_add(datepart, F.lit(-interval), limit))


def expect_table_aggregation_to_equal_other_table(df, expression, compare, compare_expression=None, **options):
    return K.equal_expression(df, expression, compare, compare_expression, **options)


def expect_table_column_count_to_be_between(df, min_value=None, max_value=None):
    if min_value is None and max_value is None:
        raise ValueError("give a lower bound, an upper bound or both")
    n = len(df.columns)
    wrong = (min_value is not None and n < min_value) or (max_value is not None and n > max_value)
    rows = [(n, min_value or 0, max_value or 0)] if wrong else []
    return _schema_rows(df, rows, "number_actual_columns int, min_value int, max_value int")


def expect_table_column_count_to_equal(df, value):
    n = len(df.columns)
    return _schema_rows(df, [(n, value)] if n != value else [], "number_actual_columns int, value int")


def expect_table_column_count_to_equal_other_table(df, compare):
    a, b = len(df.columns), len(compare.columns)
    return _schema_rows(df, [(a, b)] if a != b else [], "number_columns int, compare_number_columns int")


def expect_table_columns_to_contain_set(df, columns, transform="upper"):
    have = set(_names(df, transform))
    missing = [(c,) for c in (getattr(x, transform)() for x in columns) if c not in have]
    return _schema_rows(df, missing, "input_column string")


def expect_table_columns_to_match_ordered_list(df, columns, transform="upper"):
    have = list(enumerate(_names(df, transform), 1))
    want = list(enumerate((getattr(x, transform)() for x in columns), 1))
    extra = [(i, c, None, None) for i, c in have if (i, c) not in want]
    missing = [(None, None, i, c) for i, c in want if (i, c) not in have]
    schema = "relation_column_idx int, relation_column string, input_column_idx int, input_column string"
    return _schema_rows(df, extra + missing, schema)


def expect_table_columns_to_match_set(df, columns, transform="upper"):
    have, want = _names(df, transform), [getattr(x, transform)() for x in columns]
    rows = [(c, None) for c in have if c not in want] + [(None, c) for c in want if c not in have]
    return _schema_rows(df, rows, "relation_column string, input_column string")


def expect_table_columns_to_not_contain_set(df, columns, transform="upper"):
    have = set(_names(df, transform))
    clash = [(c, c) for c in (getattr(x, transform)() for x in columns) if c in have]
    return _schema_rows(df, clash, "input_column string, relation_column string")


def expect_table_row_count_to_be_between(df, *bounds, **options):
    return _aggregate_between(F.count(F.lit(1)))(df, *bounds, **options)


def expect_table_row_count_to_equal(df, value, group_by=None, row_condition=None):
    return K.expression_between(df, F.count(F.lit(1)), value, value, group_by, row_condition, False, True)


def expect_table_row_count_to_equal_other_table(
    df, compare, group_by=None, compare_group_by=None, factor=1, row_condition=None, compare_row_condition=None
):
    count = F.count(F.lit(1))
    return K.equal_expression(
        df, count, compare, count * F.lit(factor), group_by, compare_group_by, row_condition, compare_row_condition
    )


def expect_table_row_count_to_equal_other_table_times_factor(df, compare, factor, **options):
    return expect_table_row_count_to_equal_other_table(df, compare, factor=factor, **options)
