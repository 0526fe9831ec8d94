"""Calendar functions, spines and fiscal calendars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from siltstone.functions import dates as D
from siltstone.operators import calendar as C
from siltstone.operators.reshape import spine_between
from siltstone.queries.registry import ntz, query


def order_days(t):
    bounds = t.orders.agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    return spine_between(bounds, "day", "a", "b")


CALENDAR = """calendar AS (
  SELECT date_day, year(date_day) AS year_number, month(date_day) AS month_of_year,
         dayofweek(date_day) + 1 AS day_of_week, last_day(date_day) AS month_end_date
  FROM (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE) - 1, INTERVAL 1 DAY)) AS DATE) AS date_day
        FROM orders))"""

YEAR_ENDS = """year_range AS (
  SELECT year_number - 1 AS fiscal_year_number, lag(week_end) OVER (ORDER BY week_end) + 1 AS fiscal_year_start_date,
         week_end AS fiscal_year_end_date
  FROM (SELECT year_number, date_day + 6 AS week_end FROM calendar WHERE month_of_year = 1 AND day_of_week = 1
        QUALIFY rank() OVER (PARTITION BY year_number ORDER BY abs(month_end_date - (date_day + 6))) = 1))"""

FISCAL = YEAR_ENDS + """, year_weeks AS (
  SELECT c.date_day, fiscal_year_number, fiscal_year_start_date, fiscal_year_end_date, w.date_day AS week_start_date,
         w.date_day + 6 AS week_end_date,
         dense_rank() OVER (PARTITION BY fiscal_year_number ORDER BY w.date_day)::INTEGER AS fiscal_week_of_year
  FROM calendar c JOIN year_range ON c.date_day BETWEEN fiscal_year_start_date AND fiscal_year_end_date
  JOIN calendar w ON w.day_of_week = 1 AND c.date_day BETWEEN w.date_day AND w.date_day + 6),
placed AS (
  SELECT *, CAST(least((fiscal_week_of_year - 1) // 13, 3) AS INTEGER) AS q0,
         CASE WHEN fiscal_week_of_year = 53 THEN 3 WHEN (fiscal_week_of_year - 1) % 13 <= 3 THEN 1
              WHEN (fiscal_week_of_year - 1) % 13 <= 8 THEN 2 ELSE 3 END AS fiscal_period_of_quarter
  FROM year_weeks),
periods AS (
  SELECT * EXCLUDE (q0), q0 + 1 AS fiscal_quarter_number, q0 * 3 + fiscal_period_of_quarter AS fiscal_period_number,
         dense_rank() OVER (PARTITION BY q0 * 3 + fiscal_period_of_quarter ORDER BY fiscal_week_of_year)::INTEGER AS fiscal_week_of_period
  FROM placed)"""

ORDER_DAY = "CAST(o_orderdate AS DATE)"


def on_orders(name: str, columns: Callable[[], dict], sql: str) -> None:
    """Register Column expressions of the order date beside their SQL."""
    @query(name, f"SELECT o_orderkey, {sql.replace('$d', ORDER_DAY)} FROM orders")
    def build(t):
        return t.orders.select("o_orderkey", *[c.alias(n) for n, c in columns().items()])


def on_events(name: str, columns: Callable[[], dict], sql: str) -> None:
    @query(name, f"SELECT event_id, {sql} FROM events")
    def build(t):
        return t.events.select("event_id", *[c.alias(n) for n, c in columns().items()])


def order_day():
    return F.to_date("o_orderdate")


def text(e: str, name: str) -> str:
    return f"CAST(CAST({e} AS DATE) AS VARCHAR) AS {name}"


on_orders("date_part", lambda: {
    "y": D.date_part("year", order_day()), "q": D.date_part("quarter", order_day()), "m": D.date_part("month", order_day()), "doy": D.date_part("doy", order_day()),
}, "year($d)::INTEGER AS y, quarter($d)::INTEGER AS q, month($d)::INTEGER AS m, dayofyear($d)::INTEGER AS doy")
on_orders("day_name", lambda: {"short": D.day_name(order_day()), "long": D.day_name(order_day(), short=False)}, "strftime($d, '%a') AS short, strftime($d, '%A') AS long")
on_orders("day_of_week", lambda: {"iso": D.day_of_week(order_day()), "sunday": D.day_of_week(order_day(), iso=False)},
          "isodow($d)::INTEGER AS iso, (dayofweek($d) + 1)::INTEGER AS sunday")
on_orders("day_of_month", lambda: {"d": D.day_of_month(order_day())}, "day($d)::INTEGER AS d")
on_orders("day_of_year", lambda: {"d": D.day_of_year(order_day())}, "dayofyear($d)::INTEGER AS d")
on_orders("week_start", lambda: {"monday": D.week_start(order_day()), "sunday": D.week_start(order_day(), sunday=True)},
          text("date_trunc('week', $d)", "monday") + ", " + text("$d - CAST(dayofweek($d) AS INTEGER)", "sunday"))
on_orders("week_end", lambda: {"iso": D.week_end(order_day()), "saturday": D.week_end(order_day(), sunday=True)},
          text("CAST(date_trunc('week', $d) AS DATE) + 6", "iso") + ", " + text("$d - CAST(dayofweek($d) AS INTEGER) + 6", "saturday"))
on_orders("week_of_year", lambda: {"iso": D.week_of_year(order_day()), "simple": D.week_of_year(order_day(), simple=True)},
          "weekofyear($d)::INTEGER AS iso, CAST(ceil(dayofyear($d) / 7.0) AS INTEGER) AS simple")
on_orders("iso_week_start", lambda: {"w": D.iso_week_start(order_day())}, text("date_trunc('week', $d)", "w"))
on_orders("iso_week_end", lambda: {"w": D.iso_week_end(order_day())}, text("CAST(date_trunc('week', $d) AS DATE) + 6", "w"))
on_orders("iso_week_of_year", lambda: {"w": D.iso_week_of_year(order_day())}, "weekofyear($d)::INTEGER AS w")
on_orders("month_name", lambda: {"short": D.month_name(order_day()), "long": D.month_name(order_day(), short=False)}, "strftime($d, '%b') AS short, strftime($d, '%B') AS long")
on_orders("yesterday", lambda: {"d": D.yesterday(order_day())}, text("$d - 1", "d"))
on_orders("tomorrow", lambda: {"d": D.tomorrow(order_day())}, text("$d + 1", "d"))
on_orders("n_days_ago", lambda: {"d": D.n_days_ago(17, order_day())}, text("$d - 17", "d"))
on_orders("n_days_away", lambda: {"d": D.n_days_away(17, order_day())}, text("$d + 17", "d"))
on_orders("n_weeks_ago", lambda: {"d": D.n_weeks_ago(3, order_day())}, text("date_trunc('week', $d - 21)", "d"))
on_orders("n_weeks_away", lambda: {"d": D.n_weeks_away(3, order_day())}, text("date_trunc('week', $d + 21)", "d"))
on_orders("last_week", lambda: {"d": D.last_week(order_day())}, text("date_trunc('week', $d - 7)", "d"))
on_orders("next_week", lambda: {"d": D.next_week(order_day())}, text("date_trunc('week', $d + 7)", "d"))
on_orders("n_months_ago", lambda: {"d": D.n_months_ago(5, order_day())}, text("date_trunc('month', $d - INTERVAL 5 MONTH)", "d"))
on_orders("n_months_away", lambda: {"d": D.n_months_away(5, order_day())}, text("date_trunc('month', $d + INTERVAL 5 MONTH)", "d"))
on_orders("last_month", lambda: {"d": D.last_month(order_day()), "name": D.last_month_name(True, order_day()), "number": D.last_month_number(order_day())},
          text("date_trunc('month', $d - INTERVAL 1 MONTH)", "d") + ", strftime($d - INTERVAL 1 MONTH, '%b') AS name, month($d - INTERVAL 1 MONTH)::INTEGER AS number")
on_orders("next_month", lambda: {"d": D.next_month(order_day()), "name": D.next_month_name(False, order_day()), "number": D.next_month_number(order_day())},
          text("date_trunc('month', $d + INTERVAL 1 MONTH)", "d") + ", strftime($d + INTERVAL 1 MONTH, '%B') AS name, month($d + INTERVAL 1 MONTH)::INTEGER AS number")

on_events("periods_since", lambda: {
    "days": D.periods_since("ts", "DAY", ntz("2024-02-01 12:00:00")), "hours": D.periods_since("ts", "HOUR", ntz("2024-02-01 12:00:00")),
}, """datesub('day', ts, TIMESTAMP '2024-02-01 12:00:00') AS days, datesub('hour', ts, TIMESTAMP '2024-02-01 12:00:00') AS hours""")
on_events("round_timestamp", lambda: {"d": D.round_timestamp("ts")}, "CAST(CAST(date_trunc('day', ts + INTERVAL 12 HOUR) AS TIMESTAMP) AS VARCHAR) AS d")
on_events("convert_timezone", lambda: {
    "new_york": D.convert_timezone("ts", "America/New_York"), "utc": D.convert_timezone("ts", "UTC", "Asia/Tokyo"),
}, "CAST(ts - INTERVAL 5 HOUR AS VARCHAR) AS new_york, CAST(ts - INTERVAL 9 HOUR AS VARCHAR) AS utc")


def seconds():
    return F.unix_seconds(F.col("ts").cast("timestamp"))


def micros():
    return F.unix_micros(F.col("ts").cast("timestamp"))


on_events("from_unixtimestamp", lambda: {
    "s": D.from_unix(seconds()), "ms": D.from_unix(F.floor(micros() / F.lit(1000)), "milliseconds"),
    "us": D.from_unix(micros(), "microseconds"), "ns": D.from_unix(micros() * 1000, "nanoseconds"),
}, """CAST(date_trunc('second', ts) AS VARCHAR) AS s, CAST(date_trunc('millisecond', ts) AS VARCHAR) AS ms,
  CAST(ts AS VARCHAR) AS us, CAST(ts AS VARCHAR) AS ns""")
on_events("to_unixtimestamp", lambda: {"s": D.to_unix("ts")}, "CAST(floor(epoch(ts)) AS BIGINT) AS s")


@query("now", "SELECT event_type, count(*) AS n, true AS passed, true AS today_passed FROM events GROUP BY ALL")
def now(t):
    stamp, day = F.col("ts"), F.to_date("ts")
    return t.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(stamp < D.now("Europe/Berlin")).alias("passed"),
        F.bool_and((day < D.today("Asia/Tokyo")) & (day < D.today())).alias("today_passed"),
    )


@query("today", "SELECT o_orderstatus, count(*) AS n, true AS before_yesterday, true AS before_tomorrow FROM orders GROUP BY ALL")
def today(t):
    return t.orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(order_day() < D.yesterday()).alias("before_yesterday"),
        F.bool_and((order_day() < D.tomorrow()) & (D.last_month() < D.next_month())).alias("before_tomorrow"),
    )


DIMENSION = {
    "date_day": "d", "prior_date_day": "d - 1", "next_date_day": "d + 1", "prior_year_date_day": "py",
    "prior_year_over_year_date_day": "sw", "day_of_week": "(dayofweek(d) + 1)::INTEGER", "day_of_week_iso": "isodow(d)::INTEGER",
    "day_of_week_name": "strftime(d, '%A')", "day_of_week_name_short": "strftime(d, '%a')", "day_of_month": "day(d)::INTEGER",
    "day_of_year": "dayofyear(d)::INTEGER", "week_start_date": "date_trunc('week', d)", "week_end_date": "CAST(date_trunc('week', d) AS DATE) + 6",
    "prior_year_week_start_date": "date_trunc('week', sw)", "prior_year_week_end_date": "CAST(date_trunc('week', sw) AS DATE) + 6",
    "week_of_year": "weekofyear(d)::INTEGER", "iso_week_start_date": "date_trunc('week', d)",
    "iso_week_end_date": "CAST(date_trunc('week', d) AS DATE) + 6", "prior_year_iso_week_start_date": "date_trunc('week', sw)",
    "prior_year_iso_week_end_date": "CAST(date_trunc('week', sw) AS DATE) + 6", "iso_week_of_year": "weekofyear(d)::INTEGER",
    "prior_year_week_of_year": "weekofyear(sw)::INTEGER", "prior_year_iso_week_of_year": "weekofyear(sw)::INTEGER",
    "month_of_year": "month(d)::INTEGER", "month_name": "strftime(d, '%B')", "month_name_short": "strftime(d, '%b')",
    "month_start_date": "date_trunc('month', d)", "month_end_date": "last_day(d)", "prior_year_month_start_date": "date_trunc('month', py)",
    "prior_year_month_end_date": "last_day(py)", "quarter_of_year": "quarter(d)::INTEGER", "quarter_start_date": "date_trunc('quarter', d)",
    "quarter_end_date": "CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH AS DATE) - 1", "year_number": "year(d)::INTEGER",
    "year_start_date": "date_trunc('year', d)", "year_end_date": "make_date(year(d), 12, 31)",
}


def _dimension_sql() -> str:
    shown = [
        text(e, n) if n.endswith(("_date", "date_day")) else f"{e} AS {n}" for n, e in DIMENSION.items()
    ]
    return f"""WITH {CALENDAR}, base AS (
      SELECT date_day AS d, CAST(date_day - INTERVAL 1 YEAR AS DATE) AS py, date_day - 364 AS sw FROM calendar)
    SELECT {', '.join(shown)} FROM base"""


@query("date_dimension", _dimension_sql())
def date_dimension(t):
    return C.date_dimension(order_days(t))


@query("fiscal_year_dates", f"""WITH {CALENDAR}, {FISCAL}
SELECT CAST(date_day AS VARCHAR) AS date_day, fiscal_year_number, CAST(fiscal_year_start_date AS VARCHAR) AS fiscal_year_start_date,
  CAST(fiscal_year_end_date AS VARCHAR) AS fiscal_year_end_date, CAST(week_start_date AS VARCHAR) AS week_start_date,
  CAST(week_end_date AS VARCHAR) AS week_end_date, fiscal_week_of_year FROM year_weeks""")
def fiscal_year_dates(t):
    return C.fiscal_year_dates(C.date_dimension(order_days(t)), 1, 1, 1)


@query("fiscal_periods", f"""WITH {CALENDAR}, {FISCAL}
SELECT CAST(date_day AS VARCHAR) AS date_day, fiscal_year_number, CAST(week_start_date AS VARCHAR) AS week_start_date,
  CAST(week_end_date AS VARCHAR) AS week_end_date, fiscal_week_of_year, fiscal_week_of_period, fiscal_period_number,
  fiscal_quarter_number, fiscal_period_of_quarter FROM periods""")
def fiscal_periods(t):
    return C.fiscal_periods(C.date_dimension(order_days(t)), 1, 1, 1)
