"""Checks in pairs: one input that passes, one that fails."""

import pytest
from pyspark.sql import functions as F

from siltstone.checks import expectations as E
from siltstone.checks import generic as G
from siltstone.checks import kernel as K


@pytest.fixture(scope="module")
def data(spark):
    trees = [("oak", 2.0), ("elm", 3.0), ("oak", 4.0), ("oak", 6.0), ("fir", 7.0)]
    days = ["2023-05-01", "2023-05-02", "2023-05-02", "2023-05-03", "2023-05-04"]
    rows = [(10 * i, day, a, 8.0 - a, tree, "pqrst"[:i], None, None, 8.0) for i, ((tree, a), day) in enumerate(zip(trees, days, strict=True), 1)]
    return spark.createDataFrame(rows, "idx int, date_col string, a double, b double, s string, w string, n string, n2 string, total double")


@pytest.fixture(scope="module")
def refs(spark):
    return spark.createDataFrame([("lot#12-a", "K4471"), ("box#7-b", "K0093"), ("bin#40-c", "K1200")], "ref string, code string")


def ntz(v):
    return F.lit(v).cast("timestamp_ntz")


PAIRS = {
    "distinct greater": (lambda d: E.expect_column_distinct_count_to_be_greater_than(d, "s", 2), lambda d: E.expect_column_distinct_count_to_be_greater_than(d, "s", 3)),
    "distinct less": (lambda d: E.expect_column_distinct_count_to_be_less_than(d, "s", 4), lambda d: E.expect_column_distinct_count_to_be_less_than(d, "s", 3)),
    "distinct equal": (lambda d: E.expect_column_distinct_count_to_equal(d, "s", 3), lambda d: E.expect_column_distinct_count_to_equal(d, "s", 4)),
    "distinct other": (lambda d: E.expect_column_distinct_count_to_equal_other_table(d, "s", d.where("idx < 50"), "date_col"), lambda d: E.expect_column_distinct_count_to_equal_other_table(d, "s", d, "w")),
    "distinct in set": (lambda d: E.expect_column_distinct_values_to_be_in_set(d, "s", ["oak", "elm", "fir", "ash"]), lambda d: E.expect_column_distinct_values_to_be_in_set(d, "s", ["oak", "elm"])),
    "contain set": (lambda d: E.expect_column_distinct_values_to_contain_set(d, "s", ["oak", "elm"]), lambda d: E.expect_column_distinct_values_to_contain_set(d, "s", ["oak", "yew"])),
    "equal set": (lambda d: E.expect_column_distinct_values_to_equal_set(d, "s", ["oak", "elm", "fir", "fir"]), lambda d: E.expect_column_distinct_values_to_equal_set(d, "s", ["oak", "elm"])),
    "max": (lambda d: E.expect_column_max_to_be_between(d, "idx", 50, 50), lambda d: E.expect_column_max_to_be_between(d, "idx", 50, 60, strictly=True)),
    "mean": (lambda d: E.expect_column_mean_to_be_between(d, "a", 4.3, 4.5), lambda d: E.expect_column_mean_to_be_between(d, "a", 4.6)),
    "median": (lambda d: E.expect_column_median_to_be_between(d, "idx", 30, 30), lambda d: E.expect_column_median_to_be_between(d, "idx", 31, 40)),
    "min": (lambda d: E.expect_column_min_to_be_between(d, "idx", 0, 10), lambda d: E.expect_column_min_to_be_between(d, "idx", 11)),
    "most common": (lambda d: E.expect_column_most_common_value_to_be_in_set(d, "s", ["oak"], 1), lambda d: E.expect_column_most_common_value_to_be_in_set(d, "s", ["oak"], 2)),
    "proportion unique": (lambda d: E.expect_column_proportion_of_unique_values_to_be_between(d, "s", 0.5, 0.7), lambda d: E.expect_column_proportion_of_unique_values_to_be_between(d, "s", 0.7)),
    "quantile": (lambda d: E.expect_column_quantile_values_to_be_between(d, "idx", 0.75, 40, 40), lambda d: E.expect_column_quantile_values_to_be_between(d, "idx", 0.75, 41)),
    "stdev": (lambda d: E.expect_column_stdev_to_be_between(d, "idx", 15.8, 15.9), lambda d: E.expect_column_stdev_to_be_between(d, "idx", max_value=15)),
    "sum": (lambda d: E.expect_column_sum_to_be_between(d, "idx", 150, 150), lambda d: E.expect_column_sum_to_be_between(d, "idx", 150, 160, strictly=True)),
    "unique count": (lambda d: E.expect_column_unique_value_count_to_be_between(d, "s", 3, 3), lambda d: E.expect_column_unique_value_count_to_be_between(d, "s", 4)),
    "between": (lambda d: E.expect_column_values_to_be_between(d, "a", 2, 7), lambda d: E.expect_column_values_to_be_between(d, "a", 2, 7, strictly=True)),
    "decreasing": (lambda d: E.expect_column_values_to_be_decreasing(d.withColumn("x", -F.col("idx")), "x", "idx"), lambda d: E.expect_column_values_to_be_decreasing(d, "idx", "idx")),
    "increasing": (lambda d: E.expect_column_values_to_be_increasing(d, "date_col", strictly=False), lambda d: E.expect_column_values_to_be_increasing(d, "date_col")),
    "in set": (lambda d: E.expect_column_values_to_be_in_set(d, "s", ["oak", "elm", "fir"]), lambda d: E.expect_column_values_to_be_in_set(d, "n", ["oak"])),
    "not in set": (lambda d: E.expect_column_values_to_not_be_in_set(d, "s", ["yew"]), lambda d: E.expect_column_values_to_not_be_in_set(d, "s", ["oak", "oak"])),
    "type list": (lambda d: E.expect_column_values_to_be_in_type_list(d, "IDX", ["bigint", "INT"]), lambda d: E.expect_column_values_to_be_in_type_list(d, "idx", ["date"])),
    "type": (lambda d: E.expect_column_values_to_be_of_type(d, "s", "STRING"), lambda d: E.expect_column_values_to_be_of_type(d, "s", "int")),
    "null": (lambda d: E.expect_column_values_to_be_null(d, "n"), lambda d: E.expect_column_values_to_be_null(d, "s")),
    "not null": (lambda d: E.expect_column_values_to_not_be_null(d, "s"), lambda d: E.expect_column_values_to_not_be_null(d, "n")),
    "unique": (lambda d: E.expect_column_values_to_be_unique(d, "idx"), lambda d: E.expect_column_values_to_be_unique(d, "s")),
    "casing": (lambda d: E.expect_column_values_to_have_consistent_casing(d, "s"), lambda d: E.expect_column_values_to_have_consistent_casing(d.union(d.withColumn("s", F.upper("s"))), "s")),
    "A greater B": (lambda d: E.expect_column_pair_values_A_to_be_greater_than_B(d, "idx", "a"), lambda d: E.expect_column_pair_values_A_to_be_greater_than_B(d, "a", "b", or_equal=True)),
    "pair equal": (lambda d: E.expect_column_pair_values_to_be_equal(d, "s", "s"), lambda d: E.expect_column_pair_values_to_be_equal(d, "s", "w")),
    "pair in set": (lambda d: E.expect_column_pair_values_to_be_in_set(d, "a", "b", [(2, 6), (3, 5), (4, 4), (6, 2), (7, 1)]), lambda d: E.expect_column_pair_values_to_be_in_set(d, "a", "b", [(2, 6)])),
    "compound unique": (lambda d: E.expect_compound_columns_to_be_unique(d, ["date_col", "w"]), lambda d: E.expect_compound_columns_to_be_unique(d, ["s", "total"])),
    "compound with nulls": (lambda d: E.expect_compound_columns_to_be_unique(d, ["n", "n2"]), lambda d: E.expect_compound_columns_to_be_unique(d, ["n", "s"])),
    "multicolumn sum": (lambda d: E.expect_multicolumn_sum_to_equal(d, ["a", "b"], 40), lambda d: E.expect_multicolumn_sum_to_equal(d, ["a", "b"], "idx")),
    "multicolumn sum of column": (lambda d: E.expect_multicolumn_sum_to_equal(d, ["a", "b"], "total", group_by=["date_col"]), lambda d: E.expect_multicolumn_sum_to_equal(d, ["a"], "total", group_by=["date_col"])),
    "within record": (lambda d: E.expect_select_column_values_to_be_unique_within_record(d, ["s", "w"]), lambda d: E.expect_select_column_values_to_be_unique_within_record(d, ["a", "b"])),
    "lengths between": (lambda d: E.expect_column_value_lengths_to_be_between(d, "w", 1, 5), lambda d: E.expect_column_value_lengths_to_be_between(d, "w", 1, 5, strictly=True)),
    "lengths equal": (lambda d: E.expect_column_value_lengths_to_equal(d, "s", 3), lambda d: E.expect_column_value_lengths_to_equal(d, "w", 1)),
    "n stdevs": (lambda d: E.expect_column_values_to_be_within_n_stdevs(d, "idx", ["w"], 2), lambda d: E.expect_column_values_to_be_within_n_stdevs(d, "idx", ["w"], 1)),
    "every day": (lambda d: E.expect_row_values_to_have_data_for_every_n_datepart(d.select(F.to_date("date_col").alias("d")), "d"), lambda d: E.expect_row_values_to_have_data_for_every_n_datepart(d.where("idx <> 40").select(F.to_date("date_col").alias("d")), "d")),
    "column exists": (lambda d: E.expect_column_to_exist(d, "S", 5), lambda d: E.expect_column_to_exist(d, "s", 4)),
    "group recent": (lambda d: E.expect_grouped_row_values_to_have_recent_data(d, ["date_col"], "date_col", "DAY", 4, ntz("2023-05-05")), lambda d: E.expect_grouped_row_values_to_have_recent_data(d, ["date_col"], "date_col", "DAY", 3, ntz("2023-05-05"))),
    "recent": (lambda d: E.expect_row_values_to_have_recent_data(d, "date_col", "DAY", 1, ntz("2023-05-05")), lambda d: E.expect_row_values_to_have_recent_data(d, "date_col", "DAY", 1, ntz("2023-05-06"))),
    "recent without rows": (lambda d: E.expect_row_values_to_have_recent_data(d, "date_col", "DAY", 1, ntz("2023-05-05")), lambda d: E.expect_row_values_to_have_recent_data(d, "date_col", "DAY", 1, ntz("2023-05-05"), "idx > 90")),
    "aggregation equal": (lambda d: E.expect_table_aggregation_to_equal_other_table(d, "sum(a)", d, "sum(b) + 4"), lambda d: E.expect_table_aggregation_to_equal_other_table(d, "sum(a)", d, "sum(b) + 5", tolerance=0.5)),
    "aggregation tolerance": (lambda d: E.expect_table_aggregation_to_equal_other_table(d, "sum(a)", d, "sum(b) + 5", tolerance=1), lambda d: E.expect_table_aggregation_to_equal_other_table(d, "sum(a)", d, "sum(b) + 5", tolerance_percent=0.04)),
    "column count between": (lambda d: E.expect_table_column_count_to_be_between(d, 1, 9), lambda d: E.expect_table_column_count_to_be_between(d, 10)),
    "column count": (lambda d: E.expect_table_column_count_to_equal(d, 9), lambda d: E.expect_table_column_count_to_equal(d, 10)),
    "column count other": (lambda d: E.expect_table_column_count_to_equal_other_table(d, d), lambda d: E.expect_table_column_count_to_equal_other_table(d, d.select("idx"))),
    "columns contain": (lambda d: E.expect_table_columns_to_contain_set(d, ["IDX", "s"]), lambda d: E.expect_table_columns_to_contain_set(d, ["zz"])),
    "columns ordered": (lambda d: E.expect_table_columns_to_match_ordered_list(d.select("idx", "s"), ["idx", "S"]), lambda d: E.expect_table_columns_to_match_ordered_list(d.select("idx", "s"), ["s", "idx"])),
    "columns set": (lambda d: E.expect_table_columns_to_match_set(d.select("idx", "s"), ["s", "idx"]), lambda d: E.expect_table_columns_to_match_set(d, ["s"])),
    "columns not": (lambda d: E.expect_table_columns_to_not_contain_set(d, ["zz"]), lambda d: E.expect_table_columns_to_not_contain_set(d, ["S"])),
    "rows between": (lambda d: E.expect_table_row_count_to_be_between(d, 1, 5), lambda d: E.expect_table_row_count_to_be_between(d, 1, 5, strictly=True)),
    "rows equal": (lambda d: E.expect_table_row_count_to_equal(d, 5), lambda d: E.expect_table_row_count_to_equal(d, 1, group_by=["date_col"])),
    "rows other": (lambda d: E.expect_table_row_count_to_equal_other_table(d, d), lambda d: E.expect_table_row_count_to_equal_other_table(d, d, row_condition="idx > 10", compare_row_condition="idx > 20")),
    "rows factor": (lambda d: E.expect_table_row_count_to_equal_other_table_times_factor(d.union(d), d, 2), lambda d: E.expect_table_row_count_to_equal_other_table_times_factor(d, d, 2)),
}


@pytest.mark.parametrize("name", list(PAIRS))
def test_expectation_passes_and_fails(data, name):
    good, bad = PAIRS[name]
    assert good(data).isEmpty()
    assert bad(data).count() > 0


TEXT = [
    (lambda d: E.expect_column_values_to_match_regex(d, "ref", "#[0-9]+"), 0),
    (lambda d: E.expect_column_values_to_match_regex(d, "ref", "~[0-9]+"), 3),
    (lambda d: E.expect_column_values_to_match_regex(d, "ref", "[A-Z]", flags="i"), 0),
    (lambda d: E.expect_column_values_to_match_regex(d, "ref", "(?i)[A-Z]", flags="i"), 0),
    (lambda d: E.expect_column_values_to_not_match_regex(d, "ref", "[A-Z]"), 0),
    (lambda d: E.expect_column_values_to_not_match_regex(d, "ref", "[a-z]"), 3),
    (lambda d: E.expect_column_values_to_match_regex_list(d, "ref", ["#[0-9]+", "~[0-9]+"]), 0),
    (lambda d: E.expect_column_values_to_match_regex_list(d, "ref", ["#[0-9]+", "~[0-9]+"], "all"), 3),
    (lambda d: E.expect_column_values_to_not_match_regex_list(d, "ref", ["#[0-9]+", "~[0-9]+"]), 0),
    (lambda d: E.expect_column_values_to_not_match_regex_list(d, "ref", ["#[0-9]+", "~[0-9]+"], "all"), 3),
    (lambda d: E.expect_column_values_to_match_like_pattern(d, "ref", "%#%"), 0),
    (lambda d: E.expect_column_values_to_match_like_pattern(d, "ref", "%~%"), 3),
    (lambda d: E.expect_column_values_to_not_match_like_pattern(d, "ref", "%~%"), 0),
    (lambda d: E.expect_column_values_to_not_match_like_pattern(d, "ref", "%#%"), 3),
    (lambda d: E.expect_column_values_to_match_like_pattern_list(d, "ref", ["%#%", "%~%"]), 0),
    (lambda d: E.expect_column_values_to_match_like_pattern_list(d, "ref", ["%#%", "%~%"], "all"), 3),
    (lambda d: E.expect_column_values_to_not_match_like_pattern_list(d, "ref", ["%#%", "%~%"]), 0),
    (lambda d: E.expect_column_values_to_not_match_like_pattern_list(d, "ref", ["%#%", "%~%"], "all"), 3),
    (lambda d: E.expect_column_values_to_match_regex(d, "code", r"^K\d{4}$"), 0),
    (lambda d: E.expect_column_values_to_match_regex(d, "code", r"^\d{5}"), 3),
]


@pytest.mark.parametrize("i", range(len(TEXT)))
def test_text_expectations(refs, i):
    check, failures = TEXT[i]
    assert check(refs).count() == failures


def test_unknown_counts_as_true_except_for_sets(spark):
    df = spark.createDataFrame([(None,), (3,)], "v int")
    assert E.expect_column_values_to_be_between(df, "v", 1, 5).isEmpty()
    assert E.expect_column_values_to_be_in_set(df, "v", [3]).count() == 1
    assert G.accepted_range(df, "v", 1, 5).isEmpty()


def test_moving_stdevs_flags_a_jump(spark):
    days = [(f"2024-01-{d:02d}", 100.0 + d % 3) for d in range(1, 30)] + [("2024-01-30", 900.0)]
    df = spark.createDataFrame(days, "d string, v double").withColumn("d", F.to_timestamp_ntz("d"))
    as_of = ntz("2024-01-31 09:00:00")
    found = E.expect_column_values_to_be_within_n_moving_stdevs(df, "v", "d", as_of).collect()
    assert [str(r.metric_period)[:10] for r in found] == ["2024-01-30"]
    assert E.expect_column_values_to_be_within_n_moving_stdevs(df.where("v < 500"), "v", "d", as_of).isEmpty()


def test_every_n_dateparts(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2020-01-04",), ("2020-01-11",)], "d string").withColumn("d", F.to_timestamp_ntz("d"))
    daily = E.expect_row_values_to_have_data_for_every_n_datepart(df, "d")
    assert daily.count() == 8
    paired = E.expect_row_values_to_have_data_for_every_n_datepart(df, "d", interval=2)
    assert sorted(str(r.date_day)[:10] for r in paired.collect()) == ["2020-01-05", "2020-01-07", "2020-01-09"]
    assert E.expect_row_values_to_have_data_for_every_n_datepart(df, "d", exclusion_condition="false").isEmpty()


# ------------------------------------------------------------------ generic


def test_generic_checks(spark):
    proportion = spark.createDataFrame([(i if i % 2 else None, None if i == 3 else i) for i in range(20)], "half int, most int")
    assert G.not_null_proportion(proportion, "half", 0.5, 0.5).isEmpty()
    assert G.not_null_proportion(proportion, "most", 0.9).isEmpty()
    assert G.not_null_proportion(proportion, "half", 0.6).count() == 1
    outside = spark.createDataFrame([(-1,), (11,)], "id int")
    assert G.accepted_range(outside, "id", -1, 11).isEmpty()
    assert G.accepted_range(outside, "id", -1, 11, inclusive=False).count() == 2
    assert G.accepted_range(outside, "id").isEmpty()
    cities = spark.createDataFrame([("Turin",), ("Oslo",)], "city string")
    assert G.not_accepted_values(cities, "city", ["Lima"]).isEmpty()
    assert G.not_accepted_values(cities, "city", ["Oslo"]).count() == 1
    fields = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "col_a int, field int")
    assert G.not_constant(fields, "field", ["col_a"]).isEmpty() and G.not_constant(fields, "col_a").count() == 1
    a, b = spark.createDataFrame([(1,), (2,), (3,)], "id int"), spark.createDataFrame([(1,), (2,), (4,), (2,)], "id int")
    assert G.relationships_where(a, "id", b, "id", "id <> 3").isEmpty()
    assert [tuple(r) for r in G.relationships_where(a.union(a), "id", b, "id").collect()] == [(3,), (3,)]
    assert G.cardinality_equality(a, "id", a, "id").isEmpty() and G.cardinality_equality(a, "id", b, "id").count() == 4
    assert G.equality(a, a).isEmpty() and G.equality(a, b).count() == 2
    assert G.unique_combination_of_columns(fields, ["col_a", "field"]).count() == 1
    texts = spark.createDataFrame([("",), (" ",), ("a",), (None,)], "t string")
    assert G.not_empty_string(texts, "t").count() == 2 and G.not_empty_string(texts, "t", False).count() == 1
    assert G.expression_is_true(fields, "col_a + field > 0").isEmpty() and G.expression_is_true(fields, "> 1", "field").count() == 2


def test_at_least_one_per_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "g string, v int")
    assert G.at_least_one(df, "v").isEmpty()
    assert [r.g for r in G.at_least_one(df, "v", ["g"]).collect()] == ["b"]


def test_row_counts_of_pairs(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "g int")
    b = spark.createDataFrame([(1,), (3,), (None,), (None,)], "g int")
    found = {(r.g, r.count_a, r.count_b, r.diff_count) for r in G.equal_rowcount(a, b, ["g"]).collect()}
    assert found == {(1, 2, 1, 1), (2, 1, None, None), (3, None, 1, None), (None, 1, None, None), (None, None, 2, None)}
    strict = {(r.g, r.diff_count) for r in G.equal_rowcount(a, b, ["g"], strict=True).collect()}
    assert (2, 1) in strict and (3, 1) in strict
    assert G.equal_rowcount(a, b).first().diff_count == 0
    assert G.fewer_rows_than(a, b).first().row_count_delta == 1
    assert G.fewer_rows_than(a, a.union(b)).first().row_count_delta == 0
    assert G.fewer_rows_than(a.union(b), a).first().row_count_delta == 4


def test_recency_and_freshness(spark):
    df = spark.createDataFrame([("a", "2024-01-01 10:00:00"), ("b", "2024-01-03 10:00:00")], "g string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert G.recency(df, "t", "DAY", 1, ntz("2024-01-04 09:00:00")).isEmpty()
    assert [r.g for r in G.recency(df, "t", "DAY", 1, ntz("2024-01-04"), group_by=["g"]).collect()] == ["a"]
    assert G.recency(df, "t", "DAY", 1, ntz("2024-01-04 23:00:00"), ignore_time=True).isEmpty()
    ages = [G.source_freshness(df, "t", ntz(v)).first().status for v in ("2024-01-03 12:00:00", "2024-01-04 12:00:00", "2024-01-06 12:00:00")]
    assert ages == ["pass", "warn", "error"]


def test_suite_and_enforcement(data):
    summary = K.run_checks(data, [
        K.Check("fine", row="idx > 0"), K.Check("broken", row="idx < 40", error_if="> 5"),
        K.Check("largest", measure="max(idx)", holds=lambda v: v < 50, where="s <> 'fir'"),
        K.Check("equal", frame=G.equality(data, data.where("idx > 10"), ["idx"]), fail_calc=G.EQUALITY_FAIL_CALC),
    ])
    assert {(r.check, r.failures, r.status) for r in summary.collect()} == {
        ("fine", 0, "pass"), ("broken", 2, "warn"), ("largest", 0, "pass"), ("equal", 2, "error")
    }
    K.enforce(summary.where("check <> 'equal'"))
    with pytest.raises(AssertionError, match="equal: 2"):
        K.enforce(summary)


def test_bad_arguments(data):
    with pytest.raises(ValueError):
        E.expect_column_values_to_be_between(data, "idx")
    with pytest.raises(ValueError):
        E.expect_table_column_count_to_be_between(data)
    with pytest.raises(ValueError):
        E.expect_column_pair_values_to_be_in_set(data, "a", "b", [(1, 2, 3)])
    with pytest.raises(ValueError):
        E.expect_compound_columns_to_be_unique(data, [])
    with pytest.raises(ValueError):
        E.expect_compound_columns_to_be_unique(data, ["s"], "sometimes")
    with pytest.raises(ValueError):
        E.expect_column_values_to_match_regex_list(data, "s", ["a"], "some")


def test_not_in_with_null(spark, rows):
    from siltstone.operators.joins import not_in

    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    right = spark.createDataFrame([(2,), (3,)], "b int")
    with_null = right.union(spark.createDataFrame([(None,)], "b int"))
    assert rows(not_in(left, "a", right, "b")) == [(1,)]
    assert not_in(left, "a", with_null, "b").isEmpty()
    assert len(rows(not_in(left, "a", right.where("false"), "b"))) == 3
