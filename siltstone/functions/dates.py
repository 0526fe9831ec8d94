"""Calendar functions on date and timestamp columns.

Relative functions (``n_days_ago`` and friends) take the reference day as an
argument; it defaults to the session's current date.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import as_col


def _day(day: Column | str | None, zone: str | None = None) -> Column:
    return today(zone) if day is None else as_col(day).cast("date")


def now(zone: str = "UTC") -> Column:
    """Current wall-clock time in a zone, without zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.current_timestamp().cast("timestamp_ntz"))


def today(zone: str | None = None) -> Column:
    return F.current_date() if zone is None else now(zone).cast("date")


def date_part(part: str, c: Column | str) -> Column:
    return F.date_part(F.lit(part), as_col(c))


def day_name(c: Column | str, short: bool = True) -> Column:
    return F.date_format(as_col(c), "E" if short else "EEEE")


def day_of_week(c: Column | str, iso: bool = True) -> Column:
    """ISO: Monday 1 .. Sunday 7; otherwise Sunday 1 .. Saturday 7."""
    return F.weekday(as_col(c)) + 1 if iso else F.dayofweek(as_col(c))


def day_of_month(c: Column | str) -> Column:
    return F.dayofmonth(as_col(c))


def day_of_year(c: Column | str) -> Column:
    return F.dayofyear(as_col(c))


def week_start(c: Column | str, sunday: bool = False) -> Column:
    """Monday of the week, or its Sunday."""
    day = as_col(c).cast("date")
    return F.date_sub(day, F.dayofweek(day) - 1) if sunday else F.date_sub(day, F.weekday(day))


def week_end(c: Column | str, sunday: bool = False) -> Column:
    return F.date_add(week_start(c, sunday), 6)


def week_of_year(c: Column | str, simple: bool = False) -> Column:
    """ISO week; ``simple`` counts blocks of seven days from 1 January."""
    return F.ceil(F.dayofyear(as_col(c)) / 7).cast("int") if simple else F.weekofyear(as_col(c))


def iso_week_start(c: Column | str) -> Column:
    return week_start(c)


def iso_week_end(c: Column | str) -> Column:
    return week_end(c)


def iso_week_of_year(c: Column | str) -> Column:
    return F.weekofyear(as_col(c))


def month_name(c: Column | str, short: bool = True) -> Column:
    return F.date_format(as_col(c), "MMM" if short else "MMMM")


def n_days_ago(n: int, day=None, zone: str | None = None) -> Column:
    return F.date_sub(_day(day, zone), n)


def n_days_away(n: int, day=None, zone: str | None = None) -> Column:
    return F.date_add(_day(day, zone), n)


def yesterday(day=None, zone: str | None = None) -> Column:
    return n_days_ago(1, day, zone)


def tomorrow(day=None, zone: str | None = None) -> Column:
    return n_days_away(1, day, zone)


def n_weeks_ago(n: int, day=None, zone: str | None = None) -> Column:
    """Monday of the week ``n`` weeks back."""
    return week_start(n_days_ago(7 * n, day, zone))


def n_weeks_away(n: int, day=None, zone: str | None = None) -> Column:
    return n_weeks_ago(-n, day, zone)


def last_week(day=None, zone: str | None = None) -> Column:
    return n_weeks_ago(1, day, zone)


def next_week(day=None, zone: str | None = None) -> Column:
    return n_weeks_away(1, day, zone)


def n_months_ago(n: int, day=None, zone: str | None = None) -> Column:
    """First day of the month ``n`` months back."""
    return F.trunc(F.add_months(_day(day, zone), -n), "month")


def n_months_away(n: int, day=None, zone: str | None = None) -> Column:
    return n_months_ago(-n, day, zone)


def last_month(day=None, zone: str | None = None) -> Column:
    return n_months_ago(1, day, zone)


def next_month(day=None, zone: str | None = None) -> Column:
    return n_months_away(1, day, zone)


def last_month_name(short: bool = True, day=None, zone: str | None = None) -> Column:
    return month_name(last_month(day, zone), short)


def next_month_name(short: bool = True, day=None, zone: str | None = None) -> Column:
    return month_name(next_month(day, zone), short)


def last_month_number(day=None, zone: str | None = None) -> Column:
    return F.month(last_month(day, zone))


def next_month_number(day=None, zone: str | None = None) -> Column:
    return F.month(next_month(day, zone))


def periods_since(c: Column | str, period: str = "day", as_of: Column | None = None) -> Column:
    """Whole elapsed periods between the column and ``as_of`` (now by default)."""
    return F.timestamp_diff(period, as_col(c), F.current_timestamp() if as_of is None else as_of)


def round_timestamp(c: Column | str) -> Column:
    """Midnight nearest to the timestamp."""
    return F.date_trunc("day", as_col(c) + F.expr("interval 12 hours")).cast("timestamp_ntz")


def convert_timezone(c: Column | str, target: str, source: str = "UTC") -> Column:
    """Wall-clock time in ``target`` for a wall-clock time in ``source``."""
    return F.convert_timezone(F.lit(source), F.lit(target), as_col(c).cast("timestamp_ntz"))


def from_unix(c: Column | str, unit: str = "seconds") -> Column:
    """Timestamp (UTC wall clock) from an epoch count; microseconds are kept, finer is dropped."""
    count = as_col(c).cast("bigint")
    if unit == "seconds":
        ts = F.timestamp_seconds(count)
    elif unit == "milliseconds":
        ts = F.timestamp_millis(count)
    elif unit == "microseconds":
        ts = F.timestamp_micros(count)
    elif unit == "nanoseconds":
        exact = count.cast("decimal(20,0)") / F.lit(1000).cast("decimal(4,0)")
        ts = F.timestamp_micros(F.floor(exact).cast("bigint"))
    else:
        raise ValueError(f"unsupported epoch unit {unit!r}")
    return ts.cast("timestamp_ntz")


def to_unix(c: Column | str) -> Column:
    return F.unix_timestamp(as_col(c).cast("timestamp"))


def last_day(c: Column | str, unit: str = "month") -> Column:
    """Last day of the month, quarter or year."""
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    return F.date_sub(F.add_months(F.trunc(as_col(c), unit), months), 1)

