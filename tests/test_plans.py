"""The physical plans are the ones the operators are written for."""

import re

import pytest
from pyspark.sql import functions as F

from siltstone.checks import expectations as E
from siltstone.checks import generic as G
from siltstone.checks import kernel as K
from siltstone.operators import aggregates as A
from siltstone.operators import reshape as R
from siltstone.operators import search as S
from siltstone.operators import windows as WO
from siltstone.plans import documents as P
from siltstone.queries.common import gold, query_vector
from siltstone.queries.registry import ntz
from siltstone.sources import tables as SO
from siltstone.sources.tables import Tables


@pytest.fixture(scope="module")
def t(spark, sf):
    return Tables(spark, sf)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", plan(df)))


def test_dedup_is_limited_before_its_only_shuffle(t):
    p = plan(WO.deduplicate(t.orders, ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"]))
    before, after = p.split("Exchange hashpartitioning")
    assert "Partial" in after and "WindowGroupLimit" in after
    assert "Final" in before


def test_silver_shuffles_once_and_gold_adds_nothing(t):
    rows = SO.bronze_from_documents(t.documents)
    clean = P.silver_documents(rows, ntz("2024-02-01"))
    assert exchanges(clean) == 1
    assert exchanges(P.gold_documents(clean, ntz("2024-02-01"))) == 1


def test_chunks_are_cut_once(t):
    assert plan(gold(t)).count("substr(") == 1


def test_topk_takes_from_every_task(t):
    p = plan(S.vector_topk(t.embeddings, query_vector(t), 5, "vec_id"))
    assert "TakeOrderedAndProject" in p and "Exchange" not in p
    assert re.search(r"ReadSchema: struct<vec_id:bigint,embedding:array<float>>", p)
    assert p.count("ArrowEvalPython") == 1


def test_text_encoders_run_once_below_filters(t):
    from siltstone.functions.encoder import hashed_embedding

    made = t.documents.select("doc_id", hashed_embedding("text", 8).alias("v")).where("size(v) > 0 and v[0] > 0")
    assert plan(made).count("ArrowEvalPython") == 1


def test_filters_and_columns_reach_the_scan(t):
    p = plan(E.expect_column_sum_to_be_between(t.orders, "o_totalprice", 1, group_by=["o_custkey"], row_condition="o_orderstatus = 'F'"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in p


def test_pivot_and_unpivot_read_the_table_once(t):
    wide = A.pivot(t.orders, ["o_orderstatus"], "o_orderpriority", ["1-URGENT", "5-LOW", "2-HIGH"])
    assert plan(wide).count("FileScan") == 1 and exchanges(wide) == 1
    long = R.unpivot(t.supplier, exclude=["s_suppkey"])
    assert plan(long).count("FileScan") == 1 and exchanges(long) == 0


def test_a_suite_of_shared_checks_reads_the_table_once(t):
    df = K.run_checks(t.orders, [
        K.Check("a", row="o_totalprice > 0"), K.Check("b", row="o_custkey is not null"),
        K.Check("c", measure="max(o_totalprice)", holds=lambda v: v < 1e9),
    ])
    assert plan(df).count("FileScan") == 1


def test_pair_counts_and_differences_need_no_join(t):
    a, b = t.customer.select(F.col("c_nationkey").alias("n")), t.supplier.select(F.col("s_nationkey").alias("n"))
    for df in (G.equal_rowcount(a, b, ["n"]), G.equality(a, b), G.cardinality_equality(a, "n", b, "n")):
        assert "Join" not in plan(df)


def test_no_window_over_a_whole_table(t):
    """A single partition only ever holds one row per range, period or kept value."""
    for df in (
        WO.monotonic_breaks(t.events, "value", "ts"), WO.with_previous_value(t.events, "event_id", [], "p"),
        WO.with_next_range(t.lineitem, "l_orderkey", "l_partkey"),
    ):
        p = plan(df)
        assert p.count("SinglePartition") == 1
        inside = p[p.index("SinglePartition"):]
        assert re.search(r"Filter .*_kind#\d+ = ", inside)  # last and first rows of ranges


def test_upsert_does_not_shuffle_the_large_side(spark, t):
    current = t.customer.select(F.col("c_custkey").alias("id"), "c_name", ntz("2024-01-01").alias("created_at"))
    batch = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("c_name"))
    merged = SO.upsert_documents(current, batch, ntz("2024-02-01"))
    p = plan(merged)
    shuffled = [part.split("FileScan parquet [")[1] for part in p.split("Exchange hashpartitioning")[1:]]
    assert shuffled and all(scan.startswith("s_suppkey") for scan in shuffled)  # the batch's rows per key only
    assert "SortMergeJoin" not in p and "CartesianProduct" not in p


def test_schema_checks_do_not_scan(t):
    assert "FileScan" not in plan(E.expect_table_column_count_to_equal(t.lineitem, 3))


def test_large_sides_are_not_broadcast(spark, t):
    """Without size limits in its favour no join of the checks is broadcast but those of one row per range."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (
            G.relationships_where(t.orders, "o_custkey", t.customer, "c_custkey"),
            E.expect_table_row_count_to_equal_other_table(t.orders, t.orders, ["o_custkey"]),
        ):
            assert "Broadcast" not in plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_moving_windows_without_groups_hold_no_period_series_in_one_task(spark, t):
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("v"))
    for made in (WO.moving_stats(days, [], "day", "v", 7, "m"), WO.lag_difference(days, [], "day", "v", 2)):
        windows = [line for line in plan(made).splitlines() if "Window [avg" in line or "Window [lag" in line]
        assert windows and all("_block#" in line for line in windows)


def test_moving_windows_without_groups_give_the_windows_values(spark):
    rows = [(i, float(i * i % 17) if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "day int, v double")
    tagged = df.withColumn("g", F.lit(1))
    for make, names in (
        (lambda d, by: WO.moving_stats(d, by, "day", "v", 4, "m"), ["day", "m_average", "m_stddev"]),
        (lambda d, by: WO.lag_difference(d, by, "day", "v", 3, take_logs=False), ["day", "prior_v", "metric_test_value"]),
    ):
        one = {r[0]: r[1:] for r in make(df, []).select(names).collect()}
        two = {r[0]: r[1:] for r in make(tagged, ["g"]).select(names).collect()}
        assert one.keys() == two.keys()
        for key, values in one.items():
            assert values == pytest.approx(two[key], nan_ok=True) or values == two[key]


def test_a_long_spine_is_made_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "SPINE_BLOCK", 7)
    spine = R.date_spine(spark, "day", "2020-01-01", "2020-03-01")
    assert [str(r[0])[:10] for r in spine.orderBy("date_day").collect()][:2] == ["2020-01-01", "2020-01-02"]
    assert spine.count() == 60 and spine.distinct().count() == 60
