"""Expectations, with settings that leave failures to compare."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.checks import expectations as E
from siltstone.checks.kernel import Check, run_checks
from siltstone.queries.registry import ntz, query, rounded

OBSERVED = "SELECT {by}, {m} AS observed FROM {table} {where} GROUP BY ALL HAVING NOT ({test})"


def observed(table: str, by: str, measure: str, test: str, where: str = "", shown: str | None = None) -> str:
    return OBSERVED.format(by=by, m=shown or measure, table=table, where=where, test=test.replace("$m", measure))


# ---------------------------------------------------------------- aggregates

USERS = "count(DISTINCT user_id)"


@query("expect_column_distinct_count_to_be_greater_than", observed("events", "event_type", USERS, "$m > 149", "WHERE value > 40"))
def _(t):
    return E.expect_column_distinct_count_to_be_greater_than(t.events, "user_id", 149, ["event_type"], "value > 40")


@query("expect_column_distinct_count_to_be_less_than", observed("events", "event_type", USERS, "$m < 150", "WHERE value > 10"))
def _(t):
    return E.expect_column_distinct_count_to_be_less_than(t.events, "user_id", 150, ["event_type"], "value > 10")


@query("expect_column_distinct_count_to_equal", observed("orders", "o_orderpriority", "count(DISTINCT o_orderstatus)", "$m = 2"))
def _(t):
    return E.expect_column_distinct_count_to_equal(t.orders, "o_orderstatus", 2, ["o_orderpriority"])


@query("expect_column_distinct_count_to_equal_other_table", """SELECT a.e AS expression, b.e AS compare_expression, abs(a.e - b.e) AS expression_difference,
  round(abs(a.e - b.e) / nullif(a.e::DOUBLE, 0), 9) AS expression_difference_percent
FROM (SELECT count(DISTINCT o_custkey) AS e FROM orders WHERE o_orderstatus = 'F') a, (SELECT count(DISTINCT c_custkey) AS e FROM customer WHERE c_acctbal > 0) b WHERE abs(a.e - b.e) > 0""")
def _(t):
    found = E.expect_column_distinct_count_to_equal_other_table(
        t.orders, "o_custkey", t.customer, "c_custkey", "o_orderstatus = 'F'", "c_acctbal > 0"
    )
    return rounded(found, 9, "expression_difference_percent")


@query("expect_column_distinct_values_to_be_in_set", f"""SELECT DISTINCT quality AS value_field FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality NOT IN (1)""")
def _(t):
    marks = t.documents.join(t.labels, "doc_id", "left")
    return E.expect_column_distinct_values_to_be_in_set(marks, "quality", [1])


@query("expect_column_distinct_values_to_contain_set", """SELECT v AS value_field FROM (VALUES ('click'), ('refund'), ('return')) s(v) WHERE v NOT IN (SELECT event_type FROM events)""")
def _(t):
    return E.expect_column_distinct_values_to_contain_set(t.events, "event_type", ["click", "refund", "return", "refund"])


@query("expect_column_distinct_values_to_equal_set", """SELECT a.v AS column_value, b.v AS value_field FROM (SELECT DISTINCT o_orderpriority AS v FROM orders) a
FULL JOIN (VALUES ('1-URGENT'), ('6-NEVER')) b(v) ON a.v = b.v WHERE a.v IS NULL OR b.v IS NULL""")
def _(t):
    return E.expect_column_distinct_values_to_equal_set(t.orders, "o_orderpriority", ["1-URGENT", "6-NEVER"])


@query("expect_column_max_to_be_between", observed("customer", "c_nationkey", "max(c_acctbal)", "$m >= 9900 AND $m <= 9990"))
def _(t):
    return E.expect_column_max_to_be_between(t.customer, "c_acctbal", 9900, 9990, group_by=["c_nationkey"])


@query("expect_column_mean_to_be_between", observed("lineitem", "l_suppkey", "avg(l_quantity)", "$m >= 25 AND $m <= 26", shown="round(avg(l_quantity), 6)"))
def _(t):
    return rounded(E.expect_column_mean_to_be_between(t.lineitem, "l_quantity", 25, 26, group_by=["l_suppkey"]), 6, "observed")


@query("expect_column_median_to_be_between", observed("events", "user_id", "median(value)", "$m > 30", shown="round(median(value), 6)"))
def _(t):
    return rounded(E.expect_column_median_to_be_between(t.events, "value", 30, group_by=["user_id"], strictly=True), 6, "observed")


@query("expect_column_min_to_be_between", observed("customer", "c_mktsegment", "min(c_acctbal)", "$m > -970", "WHERE c_nationkey <> 3"))
def _(t):
    return E.expect_column_min_to_be_between(t.customer, "c_acctbal", -970, group_by=["c_mktsegment"], row_condition="c_nationkey <> 3", strictly=True)


@query("expect_column_most_common_value_to_be_in_set", """SELECT p_brand AS value_field FROM (SELECT p_brand, row_number() OVER (ORDER BY n DESC, p_brand) AS place
  FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY ALL)) WHERE place = 2 AND p_brand NOT IN ('Brand#none')""")
def _(t):
    return E.expect_column_most_common_value_to_be_in_set(t.part, "p_brand", ["Brand#none"], top_n=2)


SHARE = "count(DISTINCT user_id)::DOUBLE / count(user_id)"


@query("expect_column_proportion_of_unique_values_to_be_between", observed("events", "event_type", SHARE, "$m >= 0.9", shown=f"round({SHARE}, 9)"))
def _(t):
    found = E.expect_column_proportion_of_unique_values_to_be_between(t.events, "user_id", 0.9, group_by=["event_type"])
    return rounded(found, 9, "observed")


@query("expect_column_quantile_values_to_be_between", observed("lineitem", "l_suppkey", "quantile_cont(l_extendedprice, 0.25)", "$m >= 25000 AND $m <= 27000", shown="round(quantile_cont(l_extendedprice, 0.25), 6)"))
def _(t):
    found = E.expect_column_quantile_values_to_be_between(t.lineitem, "l_extendedprice", 0.25, 25000, 27000, ["l_suppkey"])
    return rounded(found, 6, "observed")


@query("expect_column_stdev_to_be_between", observed("customer", "c_nationkey", "stddev_samp(c_acctbal)", "$m <= 3200", shown="round(stddev_samp(c_acctbal), 6)"))
def _(t):
    return rounded(E.expect_column_stdev_to_be_between(t.customer, "c_acctbal", max_value=3200, group_by=["c_nationkey"]), 6, "observed")


@query("expect_column_sum_to_be_between", observed("orders", "o_custkey", "sum(o_totalprice)", "$m >= 1000000 AND $m <= 4000000", shown="round(sum(o_totalprice), 2)"))
def _(t):
    return rounded(E.expect_column_sum_to_be_between(t.orders, "o_totalprice", 1000000, 4000000, group_by=["o_custkey"]), 2, "observed")


@query("expect_column_unique_value_count_to_be_between", observed("lineitem", "l_orderkey", "count(DISTINCT l_suppkey)", "$m >= 2 AND $m <= 6"))
def _(t):
    return E.expect_column_unique_value_count_to_be_between(t.lineitem, "l_suppkey", 2, 6, group_by=["l_orderkey"])


# -------------------------------------------------------------------- values


def rows(table: str, shown: str, test: str, where: str = "true") -> str:
    return f"SELECT {shown} FROM {table} WHERE {where} AND NOT ({test})"


@query("expect_column_values_to_be_between", rows("events", "event_id, value", "value > 1 AND value < 30", "event_type = 'click'"))
def _(t):
    return E.expect_column_values_to_be_between(t.events, "value", 1, 30, "event_type = 'click'", strictly=True).select("event_id", "value")


LAG = """SELECT {by} CAST(ts AS VARCHAR) AS sort_column, value AS value_field, p AS value_field_lag FROM (
  SELECT user_id, ts, value, lag(value) OVER ({part} ORDER BY ts, value {dir} NULLS FIRST) AS p FROM events)
WHERE p IS NOT NULL AND NOT (value {op} p)"""


@query("expect_column_values_to_be_decreasing", LAG.format(by="user_id,", part="PARTITION BY user_id", dir="DESC", op="<"))
def _(t):
    return E.expect_column_values_to_be_decreasing(t.events, "value", "ts", group_by=["user_id"])


@query("expect_column_values_to_be_increasing", LAG.format(by="", part="", dir="", op=">="))
def _(t):
    return E.expect_column_values_to_be_increasing(t.events, "value", "ts", strictly=False)


@query("expect_column_values_to_be_in_set", "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality NOT IN (1)")
def _(t):
    marks = t.documents.join(t.labels, "doc_id", "left")
    return E.expect_column_values_to_be_in_set(marks, "quality", [1]).select("doc_id", "quality")


@query("expect_column_values_to_not_be_in_set", "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'refund') AND value > 10")
def _(t):
    return E.expect_column_values_to_not_be_in_set(t.events, "event_type", ["error", "refund"], "value > 10").select("event_id", "event_type")


@query("expect_column_values_to_be_null", "SELECT doc_id, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic IS NOT NULL")
def _(t):
    return E.expect_column_values_to_be_null(t.documents.join(t.labels, "doc_id", "left"), "toxic").select("doc_id", "toxic")


@query("expect_column_values_to_not_be_null", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic IS NULL AND n_chars > 300")
def _(t):
    return E.expect_column_values_to_not_be_null(t.documents.join(t.labels, "doc_id", "left"), "toxic", "n_chars > 300").select("doc_id")


@query("expect_column_values_to_be_unique", "SELECT p_name, count(*) AS n_records FROM part GROUP BY ALL HAVING count(*) > 1")
def _(t):
    return E.expect_column_values_to_be_unique(t.part, "p_name")


WORDS = "(SELECT unnest(string_split(text, ' ')) AS w FROM documents)"


@query("expect_column_values_to_have_consistent_casing", f"""SELECT lower(w) AS inconsistent_columns, count(DISTINCT w) AS set_count_case_insensitive
FROM {WORDS} GROUP BY lower(w) HAVING count(DISTINCT w) > 1""")
def _(t):
    words = t.documents.select(F.explode(F.split("text", " ")).alias("w"))
    return E.expect_column_values_to_have_consistent_casing(words, "w", display_inconsistent_columns=True)


@query("expect_consistent_casing_summary", f"SELECT count(DISTINCT w) AS set_count, count(DISTINCT lower(w)) AS set_count_case_insensitive FROM {WORDS}")
def _(t):
    words = t.documents.select(F.explode(F.split("text", " ")).alias("w"))
    return E.expect_column_values_to_have_consistent_casing(words, "w")


# -------------------------------------------------------------- multi-column


@query("expect_column_pair_values_A_to_be_greater_than_B", rows("lineitem", "l_orderkey, l_linenumber, l_partkey", "l_quantity >= l_linenumber * 4", "l_returnflag = 'N'"))
def _(t):
    wide = t.lineitem.withColumn("b", F.col("l_linenumber") * 4)
    found = E.expect_column_pair_values_A_to_be_greater_than_B(wide, "l_quantity", "b", True, "l_returnflag = 'N'")
    return found.select("l_orderkey", "l_linenumber", "l_partkey")


@query("expect_column_pair_values_to_be_equal", rows("lineitem", "l_orderkey, l_linenumber, l_partkey", "l_discount = l_tax"))
def _(t):
    return E.expect_column_pair_values_to_be_equal(t.lineitem, "l_discount", "l_tax").select("l_orderkey", "l_linenumber", "l_partkey")


@query("expect_column_pair_values_to_be_in_set", rows("lineitem", "l_orderkey, l_linenumber, l_partkey", "(l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'N' AND l_linestatus = 'O')"))
def _(t):
    pairs = [("A", "F"), ("N", "O")]
    return E.expect_column_pair_values_to_be_in_set(t.lineitem, "l_returnflag", "l_linestatus", pairs).select("l_orderkey", "l_linenumber", "l_partkey")


@query("expect_compound_columns_to_be_unique", """SELECT quality, toxic, lang, count(*) AS n_records FROM documents LEFT JOIN labels USING (doc_id)
WHERE NOT (quality IS NULL OR toxic IS NULL OR lang IS NULL) AND n_chars > 100 GROUP BY ALL HAVING count(*) > 1""")
def _(t):
    marks = t.documents.join(t.labels, "doc_id", "left")
    return E.expect_compound_columns_to_be_unique(marks, ["quality", "toxic", "lang"], "any_value_is_missing", "n_chars > 100")


@query("expect_multicolumn_sum_to_equal", """SELECT l_orderkey, false AS expression FROM lineitem GROUP BY ALL HAVING NOT (sum(l_linenumber) + sum(l_suppkey) = sum(l_partkey))""")
def _(t):
    return E.expect_multicolumn_sum_to_equal(t.lineitem, ["l_linenumber", "l_suppkey"], "l_partkey", ["l_orderkey"])


@query("expect_select_column_values_to_be_unique_within_record", """SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id)
WHERE NOT (quality IS NULL OR toxic IS NULL) AND quality = toxic""")
def _(t):
    marks = t.documents.join(t.labels, "doc_id", "left")
    return E.expect_select_column_values_to_be_unique_within_record(marks, ["quality", "toxic"], "any_value_is_missing").select("doc_id")


# ---------------------------------------------------------------------- text


@query("expect_column_value_lengths_to_be_between", rows("documents", "doc_id, n_chars", "length(text) >= 200 AND length(text) <= 3000"))
def _(t):
    return E.expect_column_value_lengths_to_be_between(t.documents, "text", 200, 3000).select("doc_id", "n_chars")


@query("expect_column_value_lengths_to_equal", rows("part", "p_partkey, p_name", "length(p_name) = 10"))
def _(t):
    return E.expect_column_value_lengths_to_equal(t.part, "p_name", 10).select("p_partkey", "p_name")


@query("expect_column_values_to_match_like_pattern", rows("part", "p_partkey, p_name", "p_name LIKE '%in%'"))
def _(t):
    return E.expect_column_values_to_match_like_pattern(t.part, "p_name", "%in%").select("p_partkey", "p_name")


@query("expect_column_values_to_match_like_pattern_list", rows("part", "p_partkey, p_name", "p_name LIKE 'small%' OR p_name LIKE '%ring'"))
def _(t):
    return E.expect_column_values_to_match_like_pattern_list(t.part, "p_name", ["small%", "%ring"]).select("p_partkey", "p_name")


@query("expect_column_values_to_not_match_like_pattern", rows("part", "p_partkey, p_name", "p_name NOT LIKE '%widget'"))
def _(t):
    return E.expect_column_values_to_not_match_like_pattern(t.part, "p_name", "%widget").select("p_partkey", "p_name")


@query("expect_column_values_to_not_match_like_pattern_list", rows("part", "p_partkey, p_name", "p_name NOT LIKE 'red%' AND p_name NOT LIKE '%ring'"))
def _(t):
    return E.expect_column_values_to_not_match_like_pattern_list(t.part, "p_name", ["red%", "%ring"], "all").select("p_partkey", "p_name")


@query("expect_column_values_to_match_regex", rows("pages", "page_id, url", r"regexp_matches(url, '^https://[a-z.]+\.org/')"))
def _(t):
    return E.expect_column_values_to_match_regex(t.pages, "url", r"^HTTPS://[a-z.]+\.org/", flags="i").select("page_id", "url")


@query("expect_column_values_to_match_regex_list", rows("pages", "page_id, url", "regexp_matches(url, '/en/') AND regexp_matches(url, '[0-9]{3}')"))
def _(t):
    return E.expect_column_values_to_match_regex_list(t.pages, "url", ["/en/", "[0-9]{3}"], "all").select("page_id", "url")


@query("expect_column_values_to_not_match_regex", rows("documents", "doc_id", "NOT regexp_matches(text, '[0-9]{3}-[0-9]+')"))
def _(t):
    return E.expect_column_values_to_not_match_regex(t.documents, "text", "[0-9]{3}-[0-9]+").select("doc_id")


@query("expect_column_values_to_not_match_regex_list", rows("pages", "page_id, url", "NOT regexp_matches(url, '/en/') OR NOT regexp_matches(url, 'ref=')"))
def _(t):
    return E.expect_column_values_to_not_match_regex_list(t.pages, "url", ["/en/", "ref="], "any").select("page_id", "url")


# -------------------------------------------------------------- distribution


@query("expect_column_values_to_be_within_n_stdevs", """SELECT o_custkey, round(v, 2) AS o_totalprice, round(s, 6) AS o_totalprice_sigma FROM (
  SELECT o_custkey, v, (v - avg(v) OVER ()) / nullif(stddev_samp(v) OVER (), 0) AS s FROM (SELECT o_custkey, sum(o_totalprice) AS v FROM orders GROUP BY ALL)) WHERE abs(s) > 2""")
def _(t):
    found = E.expect_column_values_to_be_within_n_stdevs(t.orders, "o_totalprice", ["o_custkey"], 2)
    return rounded(rounded(found, 2, "o_totalprice"), 6, "o_totalprice_sigma").drop("o_totalprice_average", "o_totalprice_stddev")


@query("expect_column_values_to_be_within_n_moving_stdevs", """WITH daily AS (SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS p, sum(value) AS v FROM events GROUP BY ALL),
change AS (SELECT *, coalesce(ln(nullif(v, 0)), 0) - coalesce(ln(nullif(lag(v) OVER (PARTITION BY event_type ORDER BY p), 0)), 0) AS m FROM daily),
band AS (SELECT *, avg(m) OVER w AS a, stddev_samp(m) OVER w AS s FROM change WINDOW w AS (PARTITION BY event_type ORDER BY p ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT CAST(p AS VARCHAR) AS metric_period, event_type, round((m - a) / nullif(s, 0), 6) AS metric_test_sigma FROM band
WHERE p >= TIMESTAMP '2024-01-16' AND p < TIMESTAMP '2024-01-30' AND NOT ((m - a) / nullif(s, 0) >= -1 AND (m - a) / nullif(s, 0) <= 1.5)""")
def _(t):
    found = E.expect_column_values_to_be_within_n_moving_stdevs(
        t.events, "value", "ts", ntz("2024-01-30 10:00:00"), ["event_type"], sigma_threshold_upper=1.5, sigma_threshold_lower=-1
    )
    return rounded(found.select("metric_period", "event_type", "metric_test_sigma"), 6, "metric_test_sigma")


@query("expect_row_values_to_have_data_for_every_n_datepart", """SELECT CAST(d AS VARCHAR) AS date_day, true AS is_missing, 0::BIGINT AS row_cnt FROM (
  SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE)::TIMESTAMP, CAST(max(o_orderdate) AS DATE)::TIMESTAMP - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders WHERE o_totalprice > 495000)
WHERE d NOT IN (SELECT date_trunc('day', o_orderdate) FROM orders WHERE o_totalprice > 495000) AND d < TIMESTAMP '2000-01-01'""")
def _(t):
    return E.expect_row_values_to_have_data_for_every_n_datepart(
        t.orders, "o_orderdate", "day", "o_totalprice > 495000", "date_day < timestamp_ntz'2000-01-01'"
    )


@query("expect_data_for_every_third_hour", """SELECT CAST(d AS VARCHAR) AS date_hour, true AS is_missing, 0::BIGINT AS row_cnt FROM (
  SELECT unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-28 23:00:00', INTERVAL 3 HOUR)) AS d)
WHERE NOT EXISTS (SELECT 1 FROM events WHERE value > 250 AND date_trunc('hour', ts) >= d AND date_trunc('hour', ts) < d + INTERVAL 3 HOUR)""")
def _(t):
    return E.expect_row_values_to_have_data_for_every_n_datepart(
        t.events, "ts", "hour", "value > 250", interval=3, test_start_date="2024-01-02", test_end_date="2024-01-29"
    )


# --------------------------------------------------------------------- shape
#
# Schema checks read no rows. They are shown inside a suite, beside checks that scan the same
# table once, which is how they are used.

SUITE = """SELECT 'passes' AS "check", 0::BIGINT AS failures, 'pass' AS status
UNION ALL SELECT 'fails', {n}::BIGINT, 'error'
UNION ALL SELECT 'rows', (SELECT count(*) FROM {table} WHERE NOT ({test})), CASE WHEN (SELECT count(*) FROM {table} WHERE NOT ({test})) = 0 THEN 'pass' ELSE 'error' END"""


def shape(name: str, table: str, test: str, good, bad, failures: int = 1) -> None:
    """Register a schema check: once passing, once failing, beside a row check of the table."""
    @query(name, SUITE.format(n=failures, table=table, test=test))
    def _(t):
        df = getattr(t, table)
        return run_checks(df, [
            Check("passes", frame=good(df, t)), Check("fails", frame=bad(df, t)), Check("rows", row=test),
        ])


shape("expect_column_to_exist", "orders", "o_totalprice > 1000",
      lambda d, t: E.expect_column_to_exist(d, "O_OrderKey", 1), lambda d, t: E.expect_column_to_exist(d, "o_comment"))
shape("expect_column_values_to_be_in_type_list", "lineitem", "l_tax <= 0.07",
      lambda d, t: E.expect_column_values_to_be_in_type_list(d, "l_tax", ["float", "Double"]),
      lambda d, t: E.expect_column_values_to_be_in_type_list(d, "l_tax", ["int", "string"]))
shape("expect_column_values_to_be_of_type", "lineitem", "l_linenumber < 7",
      lambda d, t: E.expect_column_values_to_be_of_type(d, "l_linenumber", "int"),
      lambda d, t: E.expect_column_values_to_be_of_type(d, "l_linenumber", "string"))
shape("expect_table_column_count_to_be_between", "customer", "c_acctbal > -900",
      lambda d, t: E.expect_table_column_count_to_be_between(d, 5, 6), lambda d, t: E.expect_table_column_count_to_be_between(d, 6))
shape("expect_table_column_count_to_equal", "customer", "c_nationkey < 24",
      lambda d, t: E.expect_table_column_count_to_equal(d, 5), lambda d, t: E.expect_table_column_count_to_equal(d, 4))
shape("expect_table_column_count_to_equal_other_table", "supplier", "s_acctbal > 0",
      lambda d, t: E.expect_table_column_count_to_equal_other_table(d, t.supplier),
      lambda d, t: E.expect_table_column_count_to_equal_other_table(d, t.part))
shape("expect_table_columns_to_contain_set", "part", "p_size > 3",
      lambda d, t: E.expect_table_columns_to_contain_set(d, ["p_size", "P_NAME"]),
      lambda d, t: E.expect_table_columns_to_contain_set(d, ["p_size", "p_colour", "p_weight"]), 2)
shape("expect_table_columns_to_match_ordered_list", "region", "r_regionkey < 9",
      lambda d, t: E.expect_table_columns_to_match_ordered_list(d, ["r_regionkey", "r_name"]),
      lambda d, t: E.expect_table_columns_to_match_ordered_list(d, ["r_name", "r_regionkey"]), 4)
shape("expect_table_columns_to_match_set", "nation", "n_regionkey < 4",
      lambda d, t: E.expect_table_columns_to_match_set(d, ["n_name", "n_nationkey", "n_regionkey"]),
      lambda d, t: E.expect_table_columns_to_match_set(d, ["n_name", "n_key"]), 3)
shape("expect_table_columns_to_not_contain_set", "events", "value < 50",
      lambda d, t: E.expect_table_columns_to_not_contain_set(d, ["password"]),
      lambda d, t: E.expect_table_columns_to_not_contain_set(d, ["user_id", "password"]))


@query("expect_grouped_row_values_to_have_recent_data", """SELECT o_custkey, CAST(max(o_orderdate) AS VARCHAR) AS latest_timestamp_column FROM orders
WHERE o_orderdate <= TIMESTAMP '2001-08-02' AND o_orderstatus <> 'P' GROUP BY ALL HAVING max(o_orderdate) < TIMESTAMP '2001-08-02' - INTERVAL 100 DAY""")
def _(t):
    return E.expect_grouped_row_values_to_have_recent_data(
        t.orders, ["o_custkey"], "o_orderdate", "DAY", 100, ntz("2001-08-02"), "o_orderstatus <> 'P'"
    )


@query("expect_row_values_to_have_recent_data", """SELECT CAST(max(ts) AS VARCHAR) AS max_timestamp FROM events
WHERE ts <= TIMESTAMP '2024-01-25' AND event_type = 'error' HAVING coalesce(max(ts), TIMESTAMP '1970-01-01') < TIMESTAMP '2024-01-25' - INTERVAL 1 MINUTE""")
def _(t):
    return E.expect_row_values_to_have_recent_data(t.events, "ts", "MINUTE", 1, ntz("2024-01-25"), "event_type = 'error'")


EQUAL = """SELECT coalesce(a.k, b.k) AS {k}, a.e AS expression, b.e AS compare_expression, {d} AS expression_difference
FROM ({a}) a FULL JOIN ({b}) b ON a.k = b.k WHERE {d} > {tol}"""
GAP = "abs(coalesce(a.e, 0) - coalesce(b.e, 0))"


@query("expect_table_aggregation_to_equal_other_table", EQUAL.format(
    k="nation", d=f"round({GAP}, 6)", tol=5, a="SELECT c_nationkey AS k, round(avg(c_acctbal), 9) AS e FROM customer GROUP BY ALL",
    b="SELECT s_nationkey AS k, round(avg(s_acctbal), 9) AS e FROM supplier GROUP BY ALL"))
def _(t):
    found = E.expect_table_aggregation_to_equal_other_table(
        t.customer.withColumnRenamed("c_nationkey", "nation"), "round(avg(c_acctbal), 9)", t.supplier, "round(avg(s_acctbal), 9)",
        group_by=["nation"], compare_group_by=["s_nationkey"], tolerance=5,
    )
    return rounded(found.drop("expression_difference_percent"), 6, "expression_difference")


@query("expect_table_row_count_to_be_between", observed("orders", "o_custkey", "count(*)", "$m >= 5 AND $m <= 15"))
def _(t):
    return E.expect_table_row_count_to_be_between(t.orders, 5, 15, group_by=["o_custkey"])


@query("expect_table_row_count_to_equal", observed("conversations", "conv_id", "count(*)", "$m = 3", "WHERE role = 'user'"))
def _(t):
    return E.expect_table_row_count_to_equal(t.conversations, 3, ["conv_id"], "role = 'user'")


@query("expect_table_row_count_to_equal_other_table", EQUAL.format(
    k="nation", d=GAP, tol=0, a="SELECT c_nationkey AS k, count(*) AS e FROM customer WHERE c_acctbal > 9000 GROUP BY ALL",
    b="SELECT s_nationkey AS k, count(*) AS e FROM supplier WHERE s_acctbal > 0 GROUP BY ALL"))
def _(t):
    found = E.expect_table_row_count_to_equal_other_table(
        t.customer.withColumnRenamed("c_nationkey", "nation"), t.supplier, ["nation"], ["s_nationkey"],
        row_condition="c_acctbal > 9000", compare_row_condition="s_acctbal > 0",
    )
    return found.drop("expression_difference_percent")


@query("expect_table_row_count_to_equal_other_table_times_factor", EQUAL.format(
    k="nation", d=GAP, tol=0, a="SELECT c_nationkey AS k, count(*) AS e FROM customer GROUP BY ALL",
    b="SELECT s_nationkey AS k, count(*) * 15 AS e FROM supplier GROUP BY ALL"))
def _(t):
    found = E.expect_table_row_count_to_equal_other_table_times_factor(
        t.customer.withColumnRenamed("c_nationkey", "nation"), t.supplier, 15, group_by=["nation"], compare_group_by=["s_nationkey"]
    )
    return found.drop("expression_difference_percent")
