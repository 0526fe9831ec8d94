"""Measures and checks of a day-partitioned table from partial results kept per day.

For every day folder one small row per group is kept: counts, sums, extremes and
sketches that can be merged.  A run lists the table's files, aggregates the days
whose files are new or have changed since (late rows included), and merges what
is kept; days that have left the table are left out.  The table's other days
are not read.

Counts, sums and extremes are exact.  Distinct counts come from HyperLogLog
sketches and quantiles from KLL sketches, which are bounded in size and merge
without loss beyond their own error; ``count_distinct_by`` and ``percentile_cont``
remain the exact way.

Defined results: measures skip NULL like their aggregates; an empty table has
counts of 0 without groups, no rows with them, and NULL for other measures; an
unknown predicate counts as passed; a NULL day is a folder like any other.  The
day column holds dates, or text and numbers that need no escapes in a folder name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.checks.kernel import Check, Expr, as_expr
from siltstone.sources.files import list_files
from siltstone.sources.tables import gathered

# Logarithm of a distinct count's registers (error about 0.8 %) and size of a quantile's levels (about 0.8 %).
DISTINCT_REGISTERS = 14
QUANTILE_LEVELS = 400

NULL_DAY = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder Spark gives to NULL


@dataclass(frozen=True)
class Measure:
    """What is kept of a day, how days are merged, and the value read from the merged."""

    name: str
    make: Column
    merge: Callable[[Column], Column]
    value: Callable[[Column], Column] = lambda merged: merged


def failures(name: str, row: Expr, where: Expr | None = None) -> Measure:
    """Rows for which a predicate is false."""
    failed = ~as_expr(row)
    return Measure(name, F.count_if(failed & as_expr(where) if where is not None else failed), F.sum, _or_zero)


def row_total(name: str) -> Measure:
    return Measure(name, F.count(F.lit(1)), F.sum, _or_zero)


def total(name: str, e: Expr) -> Measure:
    return Measure(name, F.sum(as_expr(e)), F.sum)


def least(name: str, e: Expr) -> Measure:
    return Measure(name, F.min(as_expr(e)), F.min)


def greatest(name: str, e: Expr) -> Measure:
    return Measure(name, F.max(as_expr(e)), F.max)


def mean(name: str, e: Expr) -> Measure:
    made = F.struct(F.sum(as_expr(e).cast("double")).alias("s"), F.count(as_expr(e)).alias("n"))
    return Measure(
        name, made, lambda c: F.struct(F.sum(c["s"]).alias("s"), F.sum(c["n"]).alias("n")),
        lambda c: F.try_divide(c["s"], c["n"]))


def distinct(name: str, e: Expr, registers: int = DISTINCT_REGISTERS) -> Measure:
    """About how many distinct values there are."""
    return Measure(
        name, F.hll_sketch_agg(as_expr(e), registers), F.hll_union_agg,
        lambda c: F.coalesce(F.hll_sketch_estimate(c), F.lit(0).cast("bigint")))


def quantile(name: str, e: Expr, share: float, levels: int = QUANTILE_LEVELS) -> Measure:
    """A value with about the given share of the values at or below it."""
    sketch = F.kll_sketch_agg_double(as_expr(e).cast("double"), F.lit(levels))
    rank = F.lit(share).cast("double")
    return Measure(
        name, sketch, lambda c: F.kll_merge_agg_double(c, F.lit(levels)),
        lambda c: F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, rank)))


def _or_zero(merged: Column) -> Column:
    return F.coalesce(merged, F.lit(0).cast("bigint"))


def day_files(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(day, state): per day folder a digest of its files' names, sizes and times; contents are not read."""
    day = F.regexp_extract("path", f"/{column}=([^/]*)/", 1)
    mark = F.concat_ws("|", "path", F.col("length").cast("string"), F.col("modificationTime").cast("string"))
    files = list_files(spark, path).where(F.col("path").contains(f"/{column}=")).select(day.alias("day"), F.xxhash64(mark).cast("decimal(38,0)").alias("mark"))
    return files.groupBy("day").agg(F.concat_ws("|", F.count(F.lit(1)), F.sum("mark")).alias("state"))


def _definition(measures: Sequence[Measure], by: Sequence[str]) -> str:
    """A digest of what is measured, so that other measures are not mistaken for the kept ones."""
    text = "\n".join([*by, *[f"{m.name}={m.make}" for m in measures]])
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def refresh(
    spark: SparkSession, path: str, column: str, measures: Sequence[Measure], kept_path: str, by: Sequence[str] = (),
) -> list[str]:
    """Aggregate the days that are new or changed and return them; one name per day folder."""
    root = f"{kept_path}/{_definition(measures, by)}"
    now = day_files(spark, path, column)
    known = kept(spark, root)
    todo = now if known is None else now.join(known.select("day", "state").distinct(), ["day", "state"], "left_anti")
    days = {r["day"]: r["state"] for r in todo.collect()}  # bounded by the number of day folders
    if not days:
        return []
    table = spark.read.parquet(path)
    dated = [d for d in days if d != NULL_DAY]
    wanted = F.col(column).isin([F.lit(d).cast(table.schema[column].dataType) for d in dated]) if dated else F.lit(False)
    if NULL_DAY in days:
        wanted = wanted | F.col(column).isNull()
    named = F.coalesce(F.col(column).cast("string"), F.lit(NULL_DAY))
    states = spark.createDataFrame(sorted(days.items()), "day string, state string")
    made = table.where(wanted).groupBy(named.alias("day"), *by).agg(*[m.make.alias(m.name) for m in measures])
    # Rows are written under the state they were listed with: what is added meanwhile is seen as a change next time.
    rows = states.join(made, "day").withColumn("kept_day", F.col("day"))
    writer = gathered(rows, "kept_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("kept_day").parquet(root)
    return sorted(days)


def kept(spark: SparkSession, root: str) -> DataFrame | None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.parquet(root).drop("kept_day")


def measured(
    spark: SparkSession, path: str, column: str, measures: Sequence[Measure], kept_path: str, by: Sequence[str] = (),
) -> DataFrame:
    """The measures of the whole table, by groups where given, after refreshing what is kept."""
    refresh(spark, path, column, measures, kept_path, by)
    rows = kept(spark, f"{kept_path}/{_definition(measures, by)}")
    if rows is None:
        table = spark.read.parquet(path)
        rows = table.groupBy(*by).agg(*[m.make.alias(m.name) for m in measures]).where("false")
    else:
        rows = rows.join(day_files(spark, path, column).select("day"), "day", "left_semi")
    merged = rows.groupBy(*by).agg(*[m.merge(F.col(m.name)).alias(m.name) for m in measures])
    return merged.select(*by, *[m.value(F.col(m.name)).alias(m.name) for m in measures])


@dataclass(frozen=True)
class KeptCheck:
    """A check of a kept measure: its value is the number of failures, or must meet a condition."""

    measure: Measure
    holds: Callable[[Column], Column] | None = None
    error_if: str = "!= 0"
    warn_if: str = "!= 0"


def run_kept_checks(
    spark: SparkSession, path: str, column: str, checks: Sequence[KeptCheck], kept_path: str,
) -> DataFrame:
    """(check, failures, status) like ``run_checks``, reading only new and changed days."""
    values = measured(spark, path, column, [c.measure for c in checks], kept_path)
    rows = []
    for c in checks:
        value = F.col(c.measure.name)
        failed = value if c.holds is None else F.coalesce((~c.holds(value)).cast("bigint"), F.lit(0).cast("bigint"))
        status = Check(c.measure.name, error_if=c.error_if, warn_if=c.warn_if).status()
        rows.append((F.struct(F.lit(c.measure.name).alias("check"), failed.alias("failures")), status))
    found = values.select(F.inline(F.array(*[r for r, _ in rows])))
    verdict = F.when(F.lit(False), F.lit(""))
    for c, (_, status) in zip(checks, rows, strict=True):
        verdict = verdict.when(F.col("check") == c.measure.name, status)
    return found.withColumn("status", verdict)
