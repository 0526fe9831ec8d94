"""Set operations, unions of uneven schemas, unpivot, number and date series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.session import shuffle_width


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column: str | None = "_source_relation",
    where: str | None = None,
) -> DataFrame:
    """UNION ALL over the superset of columns; columns a relation lacks are NULL.

    A column has the type of its first appearance unless overridden.
    """
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    wanted = {c.lower() for c in include}
    gone = {c.lower() for c in exclude}
    types: dict[str, str | T.DataType] = {}
    for df in relations.values():
        for f in df.schema.fields:
            name = f.name.lower()
            if name not in gone and (not wanted or name in wanted):
                types.setdefault(f.name, f.dataType)
    if not types:
        raise ValueError("no columns left to union")
    types.update({k: v for k, v in (column_override or {}).items() if k in types})
    parts = []
    for label, df in relations.items():
        rows = df.where(where) if where else df
        cols = [
            (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()
        ]
        tag = [F.lit(label).alias(source_column)] if source_column else []
        parts.append(rows.select(*tag, *cols))
    return reduce(lambda a, b: a.unionByName(b), parts)


def except_symmetric(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows found on one side only, tagged with the side.

    One aggregate over the union of both sides: each distinct row carries the
    sides it was seen on, and copies are combined before the shuffle.
    """
    cols = list(columns or a.columns)
    left = a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    right = b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    seen = left.union(right).groupBy(*cols).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    tag = F.when(F.col("_a") == 1, "a_minus_b").otherwise("b_minus_a").alias("which_diff")
    return seen.where("_a <> _b").select(tag, *cols)


def except_counts(a: DataFrame, column: str, b: DataFrame, field: str) -> DataFrame:
    """(value, count) pairs present on one side only."""
    def counted(df: DataFrame, c: str) -> DataFrame:
        return df.groupBy(F.col(c).alias(column)).agg(F.count(F.lit(1)).alias("num_rows"))

    return except_symmetric(counted(a, column), counted(b, field)).drop("which_diff")


def literal_rows(spark: SparkSession, values: Sequence, name: str = "value_field") -> DataFrame:
    """A literal list as rows."""
    items = F.array(*[F.lit(v) for v in values])
    return spark.range(1).select(F.explode(items).alias(name))


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows in one pass; ``exclude`` columns are kept beside each row."""
    skip = {c.lower() for c in (*exclude, *remove)}
    fields = [f for f in df.schema.fields if f.name.lower() not in skip]
    pairs = [
        F.struct(F.lit(f.name).alias(field_name), F.col(f.name).cast(cast_to).alias(value_name)) for f in fields
    ]
    return df.select(*exclude, F.inline(F.array(*pairs)))


# Units of a spine made by one generator call.
SPINE_BLOCK = 10_000

# Copies of a row made by one generator call.
COPIES_AT_ONCE = 10_000


def repeat_rows(df: DataFrame, times: Column) -> DataFrame:
    """Every row ``times`` times.

    Large counts are cut into blocks that are spread over the tasks first, so
    neither an array nor a task has to hold all copies of a row.
    """
    n = F.col("_times")
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / COPIES_AT_ONCE).cast("bigint"))
    counted = df.withColumn("_times", times.cast("bigint")).where(n > 0)
    cut = counted.withColumn("_block", F.explode(blocks)).repartition(shuffle_width(df.sparkSession))
    in_block = F.least(n - F.col("_block") * COPIES_AT_ONCE, F.lit(COPIES_AT_ONCE))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), in_block)).alias("_copy")
    return cut.select(*df.columns, copies).drop("_copy")


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    """Numbers 1..upper, made in parallel."""
    if upper < 1:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).select(F.col("id").alias("generated_number"))


def intervals_between(start: Column, end: Column, unit: str) -> Column:
    """Whole units between two timestamps."""
    return F.timestamp_diff(unit, start, end)


def _literal_time(value: date | datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def date_spine(
    spark: SparkSession, unit: str, start: date | datetime | str, end: date | datetime | str
) -> DataFrame:
    """One row per unit in [start, end)."""
    a, b = _literal_time(start), _literal_time(end)
    bounds = spark.range(1).select(a.alias("start_date"), b.alias("end_date"))
    return spine_between(bounds, unit, "start_date", "end_date")


def spine_between(bounds: DataFrame, unit: str, start: str, end: str) -> DataFrame:
    """The spine for bounds held in a frame of few rows, for instance min and max of a table.

    The number of rows is the number of calendar units between the bounds. They
    are made a block at a time, and blocks are spread over the tasks first, so
    neither an array nor a task has to hold a long spine.
    """
    a, b = F.col(start).cast("timestamp_ntz"), F.col(end).cast("timestamp_ntz")
    steps = intervals_between(a, b, unit)
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((steps - 1) / SPINE_BLOCK).cast("bigint"))
    cut = bounds.where(steps > 0).select(
        a.alias("_start"), steps.alias("_steps"), F.explode(blocks).alias("_block")).repartition("_block")
    first = F.col("_block") * SPINE_BLOCK
    last = F.least(first + SPINE_BLOCK, F.col("_steps")) - 1
    numbered = cut.select("_start", F.explode(F.sequence(first, last)).alias("_step"))
    return numbered.select(
        F.timestamp_add(unit, F.col("_step").cast("int"), F.col("_start")).cast("timestamp_ntz").alias(f"date_{unit}")
    )


def base_dates(
    spark: SparkSession,
    start: date | str | None = None,
    end: date | str | None = None,
    n_dateparts: int | None = None,
    unit: str = "day",
    as_of: date | str | None = None,
) -> DataFrame:
    """A spine over explicit bounds, or over the last n units up to tomorrow."""
    if start is not None and end is not None:
        return date_spine(spark, unit, start, end)
    if not n_dateparts:
        raise ValueError("give start and end, or n_dateparts")
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    first = F.timestamp_add(unit, F.lit(-n_dateparts), today.cast("timestamp_ntz"))
    bounds = spark.range(1).select(
        first.cast("timestamp_ntz").alias("start_date"), F.date_add(today, 1).alias("end_date")
    )
    return spine_between(bounds, unit, "start_date", "end_date")
