"""Window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators import aggregates as A
from siltstone.operators import windows as WO
from siltstone.operators.calendar import date_dimension, fiscal_periods, fiscal_year_ends
from siltstone.plans.documents import newest_per_content
from siltstone.queries.common import NEWEST, bronze
from siltstone.queries.days import CALENDAR, FISCAL, YEAR_ENDS, order_days
from siltstone.queries.registry import query, rounded


@query("deduplicate", """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def deduplicate(t):
    best = WO.deduplicate(t.orders, ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"])
    return best.select("o_custkey", "o_orderkey", "o_totalprice")


@query("deduplicate_by_aggregate", """SELECT conv_id, turn, role FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""")
def deduplicate_by_aggregate(t):
    return WO.latest_per_key(t.conversations.select("conv_id", "turn", "role"), ["conv_id"], ["turn"])


@query("dedup_by_content_hash", f"WITH {NEWEST} SELECT id, content_hash FROM newest")
def dedup_by_content_hash(t):
    return newest_per_content(bronze(t)).select("id", "content_hash")


@query("lag_monotonic", """SELECT user_id, CAST(ts AS VARCHAR) AS sort_column, value AS value_field, lag_value AS value_field_lag FROM (
  SELECT user_id, ts, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, value NULLS FIRST) AS lag_value FROM events)
WHERE lag_value IS NOT NULL AND NOT (value >= lag_value)""")
def lag_monotonic(t):
    return WO.monotonic_breaks(t.events, "value", "ts", ["user_id"], increasing=True, strictly=False)


@query("lag_sequential", """SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS previous
FROM events""")
def lag_sequential(t):
    return WO.with_previous_value(t.events, "event_id", ["user_id"], "previous")


@query("lead_ranges", """SELECT l_suppkey, lower_bound, upper_bound, next_lower_bound, is_last_record FROM (
  SELECT l_suppkey, l_quantity AS lower_bound, l_quantity + l_linenumber AS upper_bound,
    lead(l_quantity) OVER w AS next_lower_bound,
    lead(true) OVER w IS NULL AS is_last_record
  FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_quantity, l_quantity + l_linenumber))""")
def lead_ranges(t):
    rows = t.lineitem.withColumn("high", F.col("l_quantity") + F.col("l_linenumber"))
    return WO.with_next_range(rows, "l_quantity", "high", ["l_suppkey"])


@query("rank_closest", f"""WITH {CALENDAR}, {YEAR_ENDS}
SELECT fiscal_year_number, CAST(fiscal_year_end_date AS VARCHAR) AS fiscal_year_end_date FROM year_range""")
def rank_closest(t):
    ends = fiscal_year_ends(date_dimension(order_days(t)), 1, 1, 1)
    return ends.select("fiscal_year_number", "fiscal_year_end_date")


@query("lag_fiscal_start", f"""WITH {CALENDAR}, {YEAR_ENDS}
SELECT fiscal_year_number, CAST(fiscal_year_start_date AS VARCHAR) AS fiscal_year_start_date FROM year_range""")
def lag_fiscal_start(t):
    ends = fiscal_year_ends(date_dimension(order_days(t)), 1, 1, 1)
    return ends.select("fiscal_year_number", "fiscal_year_start_date")


@query("dense_rank_weeks", f"""WITH {CALENDAR}, {FISCAL}
SELECT CAST(date_day AS VARCHAR) AS date_day, fiscal_week_of_year, fiscal_week_of_period FROM periods""")
def dense_rank_weeks(t):
    found = fiscal_periods(date_dimension(order_days(t)), 1, 1, 1)
    return found.select("date_day", "fiscal_week_of_year", "fiscal_week_of_period")


DAILY = """daily AS (SELECT event_type, date_trunc('day', ts) AS period, round(sum(value), 4) AS v FROM events GROUP BY ALL)"""


def _daily(t):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("period")
    return t.events.groupBy("event_type", day).agg(F.round(F.sum("value"), 4).alias("v"))


@query("moving_stats", f"""WITH {DAILY}
SELECT event_type, CAST(CAST(period AS TIMESTAMP) AS VARCHAR) AS period, round(avg(v) OVER w, 4) AS v_average,
  round(stddev_samp(v) OVER w, 4) AS v_stddev FROM daily
WINDOW w AS (PARTITION BY event_type ORDER BY period ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
def moving_stats(t):
    found = WO.moving_stats(_daily(t), ["event_type"], "period", "v", 7, "v").drop("v")
    return rounded(found, 4, "v_average", "v_stddev")


@query("lag_diff", f"""WITH {DAILY}
SELECT event_type, CAST(CAST(period AS TIMESTAMP) AS VARCHAR) AS period, round(coalesce(ln(nullif(v, 0)), 0)
  - coalesce(ln(nullif(lag(v, 2) OVER (PARTITION BY event_type ORDER BY period), 0)), 0), 6) AS change FROM daily""")
def lag_diff(t):
    found = WO.lag_difference(_daily(t), ["event_type"], "period", "v", 2, name="change")
    return rounded(found.select("event_type", "period", "change"), 6, "change")


@query("global_stats_over", """SELECT p_partkey, round(avg(p_retailprice) OVER (), 6) AS p_retailprice_average,
  round(stddev_samp(p_retailprice) OVER (), 6) AS p_retailprice_stddev FROM part""")
def global_stats_over(t):
    found = WO.with_global_stats(t.part.select("p_partkey", "p_retailprice"), "p_retailprice").drop("p_retailprice")
    return rounded(found, 6, "p_retailprice_average", "p_retailprice_stddev")


@query("value_rank", """SELECT value, n, row_number() OVER (ORDER BY n DESC, value)::INTEGER AS value_rank FROM
  (SELECT p_brand AS value, count(*) AS n FROM part GROUP BY ALL) ORDER BY value_rank LIMIT 5""")
def value_rank(t):
    return A.value_rank(t.part, "p_brand", 5)


@query("percentile_over", """SELECT c_custkey, round(quantile_cont(c_acctbal, 0.9) OVER (PARTITION BY c_mktsegment), 6) AS q90
FROM customer""")
def percentile_over(t):
    found = A.percentile_over(t.customer, "c_acctbal", 0.9, ["c_mktsegment"], "q90")
    return rounded(found.select("c_custkey", "q90"), 6, "q90")


@query("rolling_sum", f"""WITH {DAILY}
SELECT event_type, CAST(CAST(period AS TIMESTAMP) AS VARCHAR) AS period,
  round(sum(v) OVER (PARTITION BY event_type ORDER BY period), 3) AS up,
  round(sum(v) OVER (PARTITION BY event_type ORDER BY period DESC), 3) AS down FROM daily""")
def rolling_sum(t):
    up = WO.rolling_sum(_daily(t), ["event_type"], "period", "v", "up")
    both = WO.rolling_sum(up, ["event_type"], "period", "v", "down", descending=True).drop("v")
    return rounded(both, 3, "up", "down")
