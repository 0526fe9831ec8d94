"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators import joins as J
from siltstone.operators import reshape as R
from siltstone.operators.calendar import date_dimension, fiscal_dimension, fiscal_periods
from siltstone.operators.windows import deduplicate
from siltstone.queries.registry import ntz, query


@query("join_left_anti", """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
  (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""")
def join_left_anti(t):
    big = t.orders.where("o_totalprice > 300000").select("o_custkey")
    return J.anti_join(t.customer, big, [("c_custkey", "o_custkey")]).select("c_custkey", "c_name")


@query("join_inner_set", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('ECONOMY', 'PROMO')")
def join_inner_set(t):
    values = R.literal_rows(t.spark, ["ECONOMY", "PROMO"], "p_type")
    return t.part.join(F.broadcast(values), "p_type").select("p_partkey", "p_type")


@query("join_full_outer", """SELECT coalesce(a.k, b.k) AS k, a.rich, b.suppliers FROM
  (SELECT c_nationkey AS k, count(*) AS rich FROM customer WHERE c_acctbal > 9800 GROUP BY ALL) a
  FULL JOIN (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY ALL) b ON a.k = b.k""")
def join_full_outer(t):
    a = t.customer.where("c_acctbal > 9800").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("rich"))
    b = t.supplier.where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("suppliers"))
    return J.full_outer(a, b, ["k"])


@query("join_full_outer_set", """SELECT v.value AS column_value, s.value_field FROM
  (SELECT DISTINCT event_type AS value FROM events) v
  FULL JOIN (VALUES ('click'), ('error'), ('refund')) s(value_field) ON v.value = s.value_field
  WHERE v.value IS NULL OR s.value_field IS NULL""")
def join_full_outer_set(t):
    seen = t.events.select(F.col("event_type").alias("column_value")).distinct()
    wanted = R.literal_rows(t.spark, ["click", "error", "refund"])
    both = seen.join(wanted, F.col("column_value") == F.col("value_field"), "full")
    return both.where("column_value is null or value_field is null")


YEARS = """years AS (
  SELECT year(o_orderdate)::INTEGER AS y, CAST(make_date(year(o_orderdate), 1, 1) AS DATE) AS start_date,
         CAST(make_date(year(o_orderdate), 12, 31) AS DATE) AS end_date FROM orders GROUP BY ALL)"""


@query("join_range_calendar", f"""WITH {YEARS}
SELECT y, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
JOIN years ON CAST(o_orderdate AS DATE) BETWEEN start_date AND end_date GROUP BY ALL""")
def join_range_calendar(t):
    year = F.year("o_orderdate").alias("y")
    years = t.orders.select(year).distinct().select(
        "y", F.make_date("y", F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date("y", F.lit(12), F.lit(31)).alias("end_date"),
    )
    joined = J.join_day_ranges(t.orders, "o_orderdate", years, "start_date", "end_date")
    return joined.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("join_interval_seconds", """WITH spans AS (
  SELECT event_id AS span_id, event_type AS span_type, ts AS start_ts, ts + CAST(1 + event_id % 97 AS BIGINT) * INTERVAL 1 HOUR AS end_ts FROM events WHERE event_id % 50 = 0)
SELECT span_id, span_type, count(*) AS n, round(sum(value), 4) AS total, min(event_id) AS first_event, max(event_id) AS last_event
FROM events JOIN spans ON ts >= start_ts AND ts < end_ts GROUP BY ALL""")
def join_interval_seconds(t):
    """Events within spans of an hour to four days, at microseconds, added up per block before they meet the spans."""
    spans = t.events.where("event_id % 50 = 0").selectExpr(
        "event_id as span_id", "event_type as span_type", "ts as start_ts", "ts + (1 + event_id % 97) * interval '1' hour as end_ts")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    parts = [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")]
    joined = J.join_intervals(t.events, micros("ts"), spans, micros("start_ts"), micros("end_ts"), parts)
    return joined.groupBy("span_id", "span_type").agg(
        F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"), F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"))


@query("join_cross_series", """SELECT n AS generated_number, count(p_partkey) AS parts
FROM range(1, (SELECT max(p_size) + 1 FROM part)) r(n) LEFT JOIN part ON p_size = n GROUP BY ALL""")
def join_cross_series(t):
    upper = t.part.agg(F.max("p_size")).first()[0]
    series = R.generate_series(t.spark, upper)
    parts = t.part.groupBy(F.col("p_size").cast("bigint").alias("generated_number")).agg(F.count(F.lit(1)).alias("parts"))
    return J.join_spine(series, parts, "generated_number", "parts")


@query("join_cross_unnest", """SELECT doc_id, unnest(range(1, 1 + CAST(ceil(n_chars / 1000.0) AS INTEGER)))::INTEGER AS chunk
FROM documents""")
def join_cross_unnest(t):
    return J.explode_to(t.documents, F.ceil(F.col("n_chars") / 1000).cast("int"), "chunk").select("doc_id", "chunk")


@query("join_cross_scalar", """SELECT a.total_quantity, b.order_count FROM
  (SELECT round(sum(l_quantity), 2) AS total_quantity FROM lineitem) a, (SELECT count(*) AS order_count FROM orders) b""")
def join_cross_scalar(t):
    a = t.lineitem.agg(F.round(F.sum("l_quantity"), 2).alias("total_quantity"))
    return J.with_one_row(a, t.orders.agg(F.count(F.lit(1)).alias("order_count")))


@query("join_natural", """SELECT user_id, event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""")
def join_natural(t):
    best = deduplicate(t.events, ["user_id", "event_type"], [F.desc("ts"), "event_id"])
    return best.select("user_id", "event_type", "event_id")


SPINE = """SELECT CAST(d AS VARCHAR) AS date_hour, count(event_id) AS row_cnt FROM
  (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS d FROM events) s
  LEFT JOIN (SELECT event_id, date_trunc('hour', ts) AS h FROM events WHERE event_type = 'error') e ON h = d GROUP BY ALL"""


@query("join_left_spine", SPINE)
def join_left_spine(t):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    bounds = t.events.agg(F.min(hour).alias("a"), F.timestamp_add("HOUR", F.lit(1), F.max(hour)).alias("b"))
    errors = t.events.where("event_type = 'error'").groupBy(hour.alias("date_hour")).agg(F.count(F.lit(1)).alias("row_cnt"))
    return J.join_spine(R.spine_between(bounds, "HOUR", "a", "b").withColumnRenamed("date_HOUR", "date_hour"), errors, "date_hour", "row_cnt")


@query("join_group_recency", """SELECT user_id, count(*) AS row_count, CAST(max(ts) AS VARCHAR) AS latest FROM events
GROUP BY ALL HAVING max(ts) < TIMESTAMP '2024-01-30'""")
def join_group_recency(t):
    seen = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("row_count"), F.max("ts").alias("latest"))
    return seen.where(F.col("latest") < ntz("2024-01-30"))


@query("not_in_subquery", """SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def not_in_subquery(t):
    return J.not_in(t.documents, "doc_id", t.labels.where("quality = 1"), "doc_id").select("doc_id", "lang")


from siltstone.queries.days import CALENDAR, FISCAL, order_days  # noqa: E402


@query("fiscal_dim_left_join", f"""WITH {CALENDAR}, {FISCAL}
SELECT CAST(c.date_day AS VARCHAR) AS date_day, p.fiscal_week_of_year, p.fiscal_period_number, p.fiscal_quarter_number
FROM calendar c LEFT JOIN periods p ON c.date_day = p.date_day""")
def fiscal_dim_left_join(t):
    calendar = date_dimension(order_days(t))
    joined = fiscal_dimension(calendar, fiscal_periods(calendar, 1, 1, 1))
    return joined.select("date_day", "fiscal_week_of_year", "fiscal_period_number", "fiscal_quarter_number")
