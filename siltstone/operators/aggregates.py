"""Aggregate operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siltstone.functions.text import as_col, slug
from siltstone.functions.vectors import has_vector
from siltstone.operators.joins import with_one_row
from siltstone.operators.ordered import spread_exact_quantiles


def index_status(df: DataFrame, stamp: str = "created_at") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("document_count"), F.max(stamp).alias("last_updated"))


def embedding_coverage(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Row count, rows with a vector, share in per cent and a status word."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_documents"),
        F.count_if(has_vector(column)).alias("documents_with_embeddings"),
    )
    total, done = F.col("total_documents"), F.col("documents_with_embeddings")
    share = F.when(total > 0, F.format_string("%.1f%%", done * 100.0 / total)).otherwise("0%")
    status = F.when(done > 0, "ready").otherwise("no_embeddings")
    return counted.withColumns({"embedding_coverage": share, "status": status})


def column_values(
    df: DataFrame, column: str, max_records: int | None = None, where: str | None = None
) -> DataFrame:
    """Distinct values by falling frequency (ties by value)."""
    rows = df.where(where) if where else df
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = counted.orderBy(F.desc("n"), F.asc("value"))
    return ranked.limit(max_records) if max_records is not None else ranked


COMPARISONS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "like": lambda c, v: c.like(v),
}

AGGREGATES = {
    "sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "avg": F.avg,
}


def pivot(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    values: Sequence,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Column | str | int = 1,
    else_value: Column | str | int | None = 0,
    distinct: bool = False,
    slugify: bool = False,
) -> DataFrame:
    """One conditional aggregate per value: a single pass and a single shuffle."""
    def operand(x):
        return as_col(x) if isinstance(x, (str, Column)) else F.lit(x)

    out = []
    for value in values:
        name = f"{prefix}{value}{suffix}"
        picked = F.when(COMPARISONS[cmp](F.col(column), F.lit(value)), operand(then_value)).otherwise(operand(else_value))
        if distinct:
            measure = F.count_distinct(picked) if agg == "count" else getattr(F, f"{agg}_distinct")(picked)
        else:
            measure = AGGREGATES[agg](picked)
        out.append(measure.alias(slug(name) if slugify else name))
    return df.groupBy(*by).agg(*out)


def count_distinct_by(df: DataFrame, column: str, by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Distinct values per group: (group, value) pairs are reduced first, then counted."""
    if approximate:
        return df.groupBy(*by).agg(F.approx_count_distinct(column).alias("distinct_count"))
    return df.groupBy(*by).agg(F.count_distinct(F.col(column)).alias("distinct_count"))


def proportion_unique(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    share = F.try_divide(F.count_distinct(F.col(column)).cast("double"), F.count(column))
    return df.groupBy(*by).agg(share.alias("proportion_unique"))


def profile(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """min, max, sum and avg in one pass."""
    return df.groupBy(*by).agg(
        F.min(column).alias("min_value"), F.max(column).alias("max_value"),
        F.sum(column).alias("sum_value"), F.avg(column).alias("avg_value"),
    )


def stddev(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.stddev_samp(column).alias("stddev_value"))


def percentile_cont(
    df: DataFrame, column: str, quantiles: Sequence[float], by: Sequence[str] = (),
    names: Sequence[str] | None = None, approximate: bool = False,
) -> DataFrame:
    """Interpolated quantiles per group: exact and spread over all tasks, or a bounded sketch."""
    if approximate:
        labels = names or [f"q{round(q * 100)}" for q in quantiles]
        return df.groupBy(*by).agg(
            *[F.percentile_approx(column, q, 100000).alias(n) for q, n in zip(quantiles, labels, strict=True)]
        )
    return spread_exact_quantiles(df, column, quantiles, by, names)


def median(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return percentile_cont(df, column, [0.5], by, ["median_value"])


def percentile_over(df: DataFrame, column: str, quantile: float, by: Sequence[str], name: str) -> DataFrame:
    """Each row with its group's quantile beside it."""
    per_group = percentile_cont(df, column, [quantile], by, [name])
    if not by:
        return with_one_row(df, per_group)
    keyed = per_group.select(*[F.col(k).alias(f"_k_{k}") for k in by], name)
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by]
    return df.join(keyed, same, "left").drop(*[f"_k_{k}" for k in by])


def having(df: DataFrame, by: Sequence[str], measure: Column, name: str, condition: str) -> DataFrame:
    return df.groupBy(*by).agg(measure.alias(name)).where(condition)


def group_by_first(df: DataFrame, n: int, *measures: Column) -> DataFrame:
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n]).agg(*measures)


def scalar_value(df: DataFrame, default=None, name: str = "value") -> DataFrame:
    """First column of the first row as a one-row frame, or the default when there is no row."""
    first = df.select(F.col(df.columns[0]).alias("_v")).limit(1)
    picked = first.agg(F.count(F.lit(1)).alias("_rows"), F.max("_v").alias("_v"))
    return picked.select(F.when(F.col("_rows") > 0, F.col("_v")).otherwise(F.lit(default)).alias(name))


def row_count(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))


def period_sum(df: DataFrame, stamp: str, period: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum per truncated period and group."""
    truncated = F.date_trunc(period, F.col(stamp)).cast("timestamp_ntz").alias("period")
    return df.groupBy(truncated, *by).agg(F.sum(value).alias("period_value"))


def value_rank(df: DataFrame, column: str, top: int) -> DataFrame:
    """The most frequent values with their rank."""
    best = column_values(df, column, top)
    # Runs over the ``top`` rows kept before it, never over the table.
    return best.withColumn("value_rank", F.row_number().over(W.orderBy(F.desc("n"), F.asc("value"))))
