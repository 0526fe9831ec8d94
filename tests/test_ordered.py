"""Order-dependent operators against brute force, with skewed keys, copies and NULLs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.checks import generic as G
from siltstone.operators import ordered as O
from siltstone.operators import windows as WO


def skewed(n=600, seed=3):
    """Groups and sort keys of which one holds a third of the rows; values with NULLs."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        group = "hot" if r.random() < 0.34 else f"g{r.randrange(6)}"
        stamp = 100 if r.random() < 0.34 else r.randrange(200)
        value = None if r.random() < 0.05 else r.randrange(30)
        out.append((group, stamp, value, i))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(skewed(), "g string, s int, v int, i int")


def brute_breaks(data, increasing, strictly, by_group):
    groups = {}
    for g, s, v, _ in data:
        groups.setdefault(g if by_group else None, []).append((s, v))
    out = []
    for g, pairs in groups.items():
        sign = 1 if increasing else -1
        pairs.sort(key=lambda p: (p[0], p[1] is not None, sign * (p[1] or 0)))
        for (_, before), (s, v) in zip(pairs, pairs[1:]):
            if before is None or v is None:
                continue
            fine = sign * v > sign * before if strictly else sign * v >= sign * before
            if not fine:
                out.append(((g,) if by_group else ()) + (s, v, before))
    return sorted(out)


@pytest.mark.parametrize("by_group", [True, False])
@pytest.mark.parametrize("increasing", [True, False])
@pytest.mark.parametrize("strictly", [True, False])
def test_monotonic_breaks(table, by_group, increasing, strictly):
    found = WO.monotonic_breaks(table, "v", "s", ["g"] if by_group else [], increasing, strictly)
    assert sorted(tuple(r) for r in found.collect()) == brute_breaks(skewed(), increasing, strictly, by_group)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_neighbours_cross_ranges_and_stop_at_groups(spark, ranges):
    data = [(g, i) for g in "abc" for i in range(20)]
    df = spark.createDataFrame(data, "g string, i int")
    before = O.with_neighbour(df, ["g"], ["i"], "i", "n", ranges=ranges).collect()
    assert {(r.g, r.i, r.n) for r in before} == {(g, i, i - 1 if i else None) for g, i in data}
    after = O.with_neighbour(df, ["g"], ["i"], "i", "n", ahead=True, ranges=ranges).collect()
    assert {(r.g, r.i, r.n) for r in after} == {(g, i, i + 1 if i < 19 else None) for g, i in data}


def test_neighbour_that_is_null_is_not_replaced(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "i int, v int")
    found = {r.i: r.p for r in O.with_neighbour(df, [], ["i"], "v", "p", ranges=3).collect()}
    assert found == {1: None, 2: 5, 3: None}


def test_running_total(table):
    counted = table.groupBy("g", "s").agg(F.count(F.lit(1)).alias("n"))
    found = O.with_running_total(counted, ["g"], ["s"], "n", "upto", "total", ranges=5).collect()
    data = [(r.g, r.s, r.n) for r in counted.collect()]
    for r in found:
        assert r.upto == sum(n for g, s, n in data if g == r.g and s <= r.s)
        assert r.total == sum(n for g, s, n in data if g == r.g)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_exact_quantiles(table, by):
    qs = [0.0, 0.1, 0.5, 0.777, 1.0]
    found = O.spread_exact_quantiles(table, "v", qs, by, names=list("abcde"), ranges=4).collect()
    groups = {}
    for g, _, v, _ in skewed():
        if v is not None:
            groups.setdefault(g if by else None, []).append(v)
    assert len(found) == len(groups)
    for r in found:
        expected = np.quantile(groups[r.g if by else None], qs)
        assert [r[n] for n in "abcde"] == pytest.approx(list(expected))


def test_quantiles_of_large_and_small_groups(spark):
    r = np.random.default_rng(5)
    sizes = {"one": 1, "two": 2, "few": 11, "some": 900, "many": 60_000, None: 3}
    data = {g: np.round(r.normal(size=n) * 1000, 2) for g, n in sizes.items()}
    data["many"][:20_000] = 7.5  # one value holds a third of the group
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs], "g string, v double")
    qs = [0.01, 0.37, 0.5, 0.999]
    for row in O.spread_exact_quantiles(df, "v", qs, ["g"], list("abcd")).collect():
        assert [row[n] for n in "abcd"] == pytest.approx(list(np.quantile(data[row.g], qs)))
    kept = O._collapse_far_values(df.select("g", F.col("v").alias("_v")), ["g"], [0.5]).where("g = 'many'")
    assert kept.select("_v").distinct().count() < 1000


def test_quantile_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "g int, v double")
    assert [tuple(r) for r in O.spread_exact_quantiles(empty, "v", [0.5]).collect()] == [(None,)]
    assert O.spread_exact_quantiles(empty, "v", [0.5], ["g"]).isEmpty()


def test_previous_value_with_copies(table):
    found = sorted(
        (r.g, r.v if r.v is not None else -1, r.p if r.p is not None else -1)
        for r in WO.with_previous_value(table, "v", ["g"], "p").collect()
    )
    expected = []
    groups = {}
    for g, _, v, _ in skewed():
        groups.setdefault(g, []).append(-1 if v is None else v)
    for g, values in groups.items():
        values.sort()
        expected += [(g, v, p) for p, v in zip([-1, *values], values)]
    assert found == sorted(expected)


def test_ranges_with_copies(spark):
    data = [("a", 1, 3), ("a", 1, 3), ("a", 3, 4), ("a", 6, 5), ("b", 1, 2)]
    df = spark.createDataFrame(data, "k string, lo int, hi int")
    found = sorted(tuple(r) for r in WO.with_next_range(df, "lo", "hi", ["k"]).fillna(-1).collect())
    assert found == [
        ("a", 1, 3, 1, False), ("a", 1, 3, 3, False), ("a", 3, 4, 6, False), ("a", 6, 5, -1, True), ("b", 1, 2, -1, True)
    ]
    broken = G.mutually_exclusive_ranges(df, "lo", "hi", ["k"]).collect()
    assert sorted((r.lower_bound, r.upper_bound) for r in broken) == [(1, 3), (6, 5)]


def test_ranges_by_hand(spark):
    touching = spark.createDataFrame([(10, 20), (20, 25), (25, 40)], "lo int, hi int")
    assert G.mutually_exclusive_ranges(touching, "lo", "hi", gaps="not_allowed").isEmpty()
    assert G.mutually_exclusive_ranges(touching, "lo", "hi", gaps="required").count() == 2
    leases = [("a", "2001-02-03", "2001-04-05"), ("a", "2001-05-01", "2001-06-01"), ("b", "2001-01-01", "2001-01-02"), ("b", "2001-01-03", None)]
    dated = spark.createDataFrame(leases, "flat string, f string, t string").withColumns({
        "f": F.to_date("f"), "t": F.coalesce(F.to_date("t"), F.to_date(F.lit("2999-01-01"))),
    })
    assert G.mutually_exclusive_ranges(dated, "f", "t", ["flat"], gaps="required").isEmpty()
    # Two ranges of no length, one per group, which only the check with zero_length accepts.
    points = spark.createDataFrame(
        [("a", 1, 2), ("a", 3, 3), ("a", 3, 6), ("a", 8, 9), ("b", 4, 5), ("b", 7, 7), ("b", 9, 12)], "k string, lo int, hi int")
    assert G.mutually_exclusive_ranges(points, "lo", "hi", ["k"], zero_length=True).isEmpty()
    assert G.mutually_exclusive_ranges(points, "lo", "hi", ["k"]).count() == 2
    with pytest.raises(ValueError):
        G.mutually_exclusive_ranges(points, "lo", "hi", gaps="maybe")


def test_sequences_golden(spark):
    even = spark.createDataFrame([(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)], "a int, v int")
    assert G.sequential_values(even, "v", 2).isEmpty()
    assert G.sequential_values(even, "v", 2, group_by=["a"]).isEmpty()
    assert G.sequential_values(even, "v", 1).count() == 4
    hours = spark.createDataFrame([(f"2021-01-01 0{i}:00",) for i in range(4)], "t string").select(F.col("t").cast("timestamp_ntz"))
    assert G.sequential_values(hours, "t", 1, "HOUR").isEmpty()
    assert G.sequential_values(hours, "t", 1, "DAY").count() == 3


@pytest.mark.parametrize("at_once", [3, 10_000])
def test_rows_are_repeated_in_blocks(spark, monkeypatch, at_once):
    from siltstone.operators import reshape as R

    monkeypatch.setattr(R, "COPIES_AT_ONCE", at_once)
    counts = {"a": 0, "b": 1, "c": 3, "d": 4, "e": 25_000}
    df = spark.createDataFrame(list(counts.items()), "k string, n int")
    found = {r.k: r["count"] for r in R.repeat_rows(df, F.col("n")).groupBy("k").count().collect()}
    assert found == {k: n for k, n in counts.items() if n}


def test_rows_of_a_group_are_not_sent_to_one_task_for_its_brackets(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("_v")).repartition(4)
    near = O._collapse_far_values(df, ["g"], [0.5])
    plan = near._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert near.count() == 5000
