"""Checks and measures from partial results kept per day."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.checks import kernel as K
from siltstone.checks import kept as P
from siltstone.session import scratch_path

SCHEMA = "id int, source string, size int, day date"


def day_rows(spark, days, each=200, first=0):
    random.seed(first)
    rows = []
    for n, day in enumerate(days):
        for i in range(each * 5 if n == 0 else each):
            rows.append((first + len(rows), None if i % 50 == 0 else f"s{i % 7}", None if i % 9 == 0 else random.randrange(1000), day))
    return spark.createDataFrame(rows, "id int, source string, size int, d string").select("id", "source", "size", F.to_date("d").alias("day"))


@pytest.fixture
def table(spark):
    path = scratch_path(spark, "days")
    day_rows(spark, ["2024-01-01", "2024-01-02", None]).write.partitionBy("day").parquet(path)
    return path


def all_measures():
    return [
        P.row_total("n"), P.failures("no source", "source is not null"), P.failures("large", "size < 990", "source = 's1'"),
        P.total("sum", "size"), P.least("low", "size"), P.greatest("high", "size"), P.mean("mean", "size"),
        P.distinct("ids", "id"), P.quantile("middle", "size", 0.5),
    ]


def exact(df, *by):
    return df.groupBy(*by).agg(
        F.count(F.lit(1)), F.count_if(F.col("source").isNull()), F.count_if((F.col("size") >= 990) & (F.col("source") == "s1")),
        F.sum("size"), F.min("size"), F.max("size"), F.round(F.avg("size"), 9))


def shown(df, *by):
    return df.select(*by, "n", "no source", "large", "sum", "low", "high", F.round("mean", 9))


@pytest.mark.parametrize("by", [(), ("source",)])
def test_measures_equal_a_scan_and_sketches_are_near(spark, table, rows, by):
    path = scratch_path(spark, "kept")
    for more in (None, ["2024-01-03"], ["2024-01-01"]):  # a new day, then late rows of an old one
        if more:
            day_rows(spark, more, 20, first=5000 + len(more[0]) + int(more[0][-1])).write.mode("append").partitionBy("day").parquet(table)
        df = spark.read.parquet(table)
        found = P.measured(spark, table, "day", all_measures(), path, by)
        assert rows(shown(found, *by)) == rows(exact(df, *by))
        truth = df.groupBy(*by).agg(F.count_distinct("id").alias("d"), F.percentile_approx("size", [0.47, 0.53], 100000).alias("p"))
        pairs = {tuple(r[k] for k in by): r for r in truth.collect()}
        for r in found.collect():
            t = pairs[tuple(r[k] for k in by)]
            assert abs(r["ids"] - t["d"]) <= 0.03 * t["d"] and t["p"][0] <= r["middle"] <= t["p"][1]


def test_second_run_reads_new_and_changed_days_alone(spark, table, capsys):
    path, measures = scratch_path(spark, "kept"), all_measures()
    assert P.refresh(spark, table, "day", measures, path) == ["2024-01-01", "2024-01-02", P.NULL_DAY]
    assert P.refresh(spark, table, "day", measures, path) == []
    day_rows(spark, ["2024-01-05"], first=9000).write.mode("append").partitionBy("day").parquet(table)
    assert P.refresh(spark, table, "day", measures, path) == ["2024-01-05"]
    day_rows(spark, [None], first=9900).write.mode("append").partitionBy("day").parquet(table)
    assert P.refresh(spark, table, "day", measures, path) == [P.NULL_DAY]
    assert len(P.refresh(spark, table, "day", measures[:3], path)) == 4  # other measures are not mistaken for these
    P.measured(spark, table, "day", measures, path).explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count(path) and f"{table}/day" not in plan  # what is kept is merged; the table's rows are not read


def test_days_that_leave_the_table_are_left_out(spark, table, rows):
    path, measures = scratch_path(spark, "kept"), all_measures()
    P.refresh(spark, table, "day", measures, path)
    smaller = scratch_path(spark, "days")
    spark.read.parquet(table).where("day = '2024-01-02'").write.partitionBy("day").parquet(smaller)
    found = P.measured(spark, smaller, "day", measures, path)
    assert rows(shown(found)) == rows(exact(spark.read.parquet(smaller)))


def test_verdicts_equal_those_of_a_full_scan(spark, table, rows):
    path = scratch_path(spark, "kept")
    kept_checks = [
        P.KeptCheck(P.failures("source", "source is not null")),
        P.KeptCheck(P.failures("size", "size < 2000")),
        P.KeptCheck(P.failures("large", "size < 990", "source = 's1'"), error_if="> 1000000"),
        P.KeptCheck(P.least("low", "size"), lambda v: v >= 0),
        P.KeptCheck(P.distinct("many", "source"), lambda v: v > 1000),
    ]
    checks = [
        K.Check("source", row="source is not null"), K.Check("size", row="size < 2000"),
        K.Check("large", row="size < 990", where="source = 's1'", error_if="> 1000000"),
        K.Check("low", measure="min(size)", holds=lambda v: v >= 0),
        K.Check("many", measure="count(distinct source)", holds=lambda v: v > 1000),
    ]
    for _ in range(2):
        found = P.run_kept_checks(spark, table, "day", kept_checks, path)
        assert rows(found) == rows(K.run_checks(spark.read.parquet(table), checks))
        day_rows(spark, ["2024-01-09"], first=7000).write.mode("append").partitionBy("day").parquet(table)


def test_empty_table(spark, rows):
    table, path = scratch_path(spark, "days"), scratch_path(spark, "kept")
    spark.createDataFrame([], SCHEMA).write.parquet(table)
    found = P.measured(spark, table, "day", all_measures(), path).first()
    assert found["n"] == found["no source"] == found["ids"] == 0 and found["middle"] is None and found["low"] is None
    assert P.measured(spark, table, "day", all_measures(), path, ["source"]).isEmpty()
