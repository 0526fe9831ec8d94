"""Date dimension and the 4-5-4 fiscal calendar.

A calendar holds one row per day: its size is bounded by the years it covers,
not by the data, so windows over it stay small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siltstone.functions import dates as D

# A fiscal quarter has 13 weeks, cut 4-5-4; week 53 joins the last period.
WEEKS_PER_QUARTER = 13
SECOND_PERIOD_FROM = 4
THIRD_PERIOD_FROM = 9
LEAP_WEEK = 53


def date_dimension(days: DataFrame, column: str = "date_day", sunday: bool = False) -> DataFrame:
    """Calendar attributes of every day in ``days`` (see the spine operators)."""
    day = F.col("date_day")
    base = days.select(F.col(column).cast("date").alias("date_day")).withColumns({
        "prior_year_date_day": F.add_months(day, -12),
        "prior_year_over_year_date_day": F.date_sub(day, 364),
    })
    last_year, same_week = F.col("prior_year_date_day"), F.col("prior_year_over_year_date_day")
    columns = {
        "date_day": day,
        "prior_date_day": D.yesterday(day),
        "next_date_day": D.tomorrow(day),
        "prior_year_date_day": last_year,
        "prior_year_over_year_date_day": same_week,
        "day_of_week": D.day_of_week(day, iso=False),
        "day_of_week_iso": D.day_of_week(day, iso=True),
        "day_of_week_name": D.day_name(day, short=False),
        "day_of_week_name_short": D.day_name(day, short=True),
        "day_of_month": D.day_of_month(day),
        "day_of_year": D.day_of_year(day),
        "week_start_date": D.week_start(day, sunday),
        "week_end_date": D.week_end(day, sunday),
        "prior_year_week_start_date": D.week_start(same_week, sunday),
        "prior_year_week_end_date": D.week_end(same_week, sunday),
        "week_of_year": D.week_of_year(day),
        "iso_week_start_date": D.iso_week_start(day),
        "iso_week_end_date": D.iso_week_end(day),
        "prior_year_iso_week_start_date": D.iso_week_start(same_week),
        "prior_year_iso_week_end_date": D.iso_week_end(same_week),
        "iso_week_of_year": D.iso_week_of_year(day),
        "prior_year_week_of_year": D.week_of_year(same_week),
        "prior_year_iso_week_of_year": D.iso_week_of_year(same_week),
        "month_of_year": F.month(day),
        "month_name": D.month_name(day, short=False),
        "month_name_short": D.month_name(day, short=True),
        "month_start_date": F.trunc(day, "month"),
        "month_end_date": D.last_day(day, "month"),
        "prior_year_month_start_date": F.trunc(last_year, "month"),
        "prior_year_month_end_date": D.last_day(last_year, "month"),
        "quarter_of_year": F.quarter(day),
        "quarter_start_date": F.trunc(day, "quarter"),
        "quarter_end_date": D.last_day(day, "quarter"),
        "year_number": F.year(day),
        "year_start_date": F.trunc(day, "year"),
        "year_end_date": D.last_day(day, "year"),
    }
    return base.select([c.alias(name) for name, c in columns.items()])


def fiscal_year_ends(
    calendar: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """First and last day of each fiscal year: it ends with the week closest to the month's end."""
    in_month = calendar.where(F.col("month_of_year") == year_end_month)
    weeks = in_month.where(F.col("day_of_week") == week_start_day).select(
        (F.col("year_number") - shift_year).alias("fiscal_year_number"),
        F.date_add("date_day", 6).alias("week_end_date"), "month_end_date",
    )
    gap = F.abs(F.datediff("month_end_date", "week_end_date"))
    closest = F.rank().over(W.partitionBy("fiscal_year_number").orderBy(gap))
    ends = weeks.withColumn("_closest", closest).where("_closest = 1")
    # A handful of rows, one per fiscal year.
    start = F.date_add(F.lag("week_end_date").over(W.orderBy("week_end_date")), 1)
    return ends.select(
        "fiscal_year_number", start.alias("fiscal_year_start_date"),
        F.col("week_end_date").alias("fiscal_year_end_date"),
    )


def fiscal_year_dates(
    calendar: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """Every day that lies in a known fiscal year, with its week and week number.

    Years and weeks are opened into days, so both lookups are equi-joins.
    """
    years = fiscal_year_ends(calendar, year_end_month, week_start_day, shift_year)
    year_days = years.where(F.col("fiscal_year_start_date").isNotNull()).withColumn(
        "date_day", F.explode(F.sequence("fiscal_year_start_date", "fiscal_year_end_date"))
    )
    weeks = calendar.where(F.col("day_of_week") == week_start_day).select(
        F.col("date_day").alias("week_start_date"), F.date_add("date_day", 6).alias("week_end_date")
    )
    week_days = weeks.withColumn("date_day", F.explode(F.sequence("week_start_date", "week_end_date")))
    week = F.dense_rank().over(W.partitionBy("fiscal_year_number").orderBy("week_start_date"))
    return (
        calendar.select("date_day").join(year_days, "date_day").join(week_days, "date_day")
        .select(
            "date_day", "fiscal_year_number", "fiscal_year_start_date", "fiscal_year_end_date",
            "week_start_date", "week_end_date", week.alias("fiscal_week_of_year"),
        )
    )


def fiscal_periods(
    calendar: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """4-5-4 periods and 13-week quarters of every fiscal day."""
    week = F.col("fiscal_week_of_year")
    place = F.pmod(week - 1, F.lit(WEEKS_PER_QUARTER))
    quarter = F.least(F.floor((week - 1) / WEEKS_PER_QUARTER), F.lit(3)).cast("int")
    period = (
        F.when(week == LEAP_WEEK, 3).when(place < SECOND_PERIOD_FROM, 1)
        .when(place < THIRD_PERIOD_FROM, 2).otherwise(3)
    )
    numbered = fiscal_year_dates(calendar, year_end_month, week_start_day, shift_year).withColumns({
        "_quarter": quarter, "fiscal_period_of_quarter": period,
    }).withColumn("fiscal_period_number", F.col("_quarter") * 3 + F.col("fiscal_period_of_quarter"))
    in_period = F.dense_rank().over(W.partitionBy("fiscal_period_number").orderBy("fiscal_week_of_year"))
    return numbered.select(
        "date_day", "fiscal_year_number", "week_start_date", "week_end_date", "fiscal_week_of_year",
        in_period.alias("fiscal_week_of_period"), "fiscal_period_number",
        (F.col("_quarter") + 1).alias("fiscal_quarter_number"), "fiscal_period_of_quarter",
    )


def fiscal_dimension(calendar: DataFrame, periods: DataFrame) -> DataFrame:
    """The date dimension with the fiscal columns beside it, NULL outside known fiscal years."""
    wanted = periods.select(
        "date_day", "fiscal_week_of_year", "fiscal_week_of_period", "fiscal_period_number",
        "fiscal_quarter_number", "fiscal_period_of_quarter",
    )
    return calendar.join(wanted, "date_day", "left")
