"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CALENDAR_START = date(2024, 10, 1)
CALENDAR_END = date(2025, 12, 31)


def week_start(d: Column, first_day: str = "sunday") -> Column:
    if first_day == "sunday":
        return F.date_sub(d, F.dayofweek(d) - 1)
    if first_day == "monday":
        return F.date_sub(d, F.weekday(d))
    raise ValueError(f"week must start on sunday or monday, not {first_day!r}")


def calendar_columns(d: Column, first_day: str = "sunday") -> dict[str, Column]:
    """Every attribute of the calendar as an expression over one DATE column.

    They depend on nothing but the date, so a report can also compute them in place of a join.
    """
    year_before = F.add_months(d, -12)
    same_weekday_year_before = F.date_sub(d, 364)

    def quarter_start(x: Column) -> Column:
        return F.trunc(x, "quarter")

    # Week 0 holds the days before the first Sunday of the year.
    sunday_week = F.floor((F.dayofyear(d) + 6 - (F.dayofweek(d) - 1)) / 7)
    prior_sunday_week = F.floor(
        (F.dayofyear(same_weekday_year_before) + 6 - (F.dayofweek(same_weekday_year_before) - 1)) / 7
    )
    return {
        "date_day": d,
        "prior_date_day": F.date_sub(d, 1),
        "next_date_day": F.date_add(d, 1),
        "prior_year_date_day": year_before,
        "prior_year_over_year_date_day": same_weekday_year_before,
        "day_of_week": F.dayofweek(d).cast("bigint"),
        "day_of_week_iso": (F.weekday(d) + 1).cast("bigint"),
        "day_of_week_name": F.date_format(d, "EEEE"),
        "day_of_week_name_short": F.date_format(d, "E"),
        "day_of_month": F.dayofmonth(d).cast("bigint"),
        "day_of_year": F.dayofyear(d).cast("bigint"),
        "week_start_date": week_start(d, first_day),
        "week_end_date": F.date_add(week_start(d, first_day), 6),
        "prior_year_week_start_date": week_start(same_weekday_year_before, first_day),
        "prior_year_week_end_date": F.date_add(week_start(same_weekday_year_before, first_day), 6),
        "week_of_year": sunday_week.cast("bigint"),
        "prior_year_week_of_year": prior_sunday_week.cast("bigint"),
        "iso_week_start_date": week_start(d, "monday"),
        "iso_week_end_date": F.date_add(week_start(d, "monday"), 6),
        "prior_year_iso_week_start_date": week_start(same_weekday_year_before, "monday"),
        "prior_year_iso_week_end_date": F.date_add(
            week_start(same_weekday_year_before, "monday"), 6
        ),
        "iso_week_of_year": F.weekofyear(d).cast("bigint"),
        "prior_year_iso_week_of_year": F.weekofyear(same_weekday_year_before).cast("bigint"),
        "month_of_year": F.month(d).cast("bigint"),
        "month_name": F.date_format(d, "MMMM"),
        "month_name_short": F.date_format(d, "MMM"),
        "month_start_date": F.trunc(d, "month"),
        "month_end_date": F.last_day(d),
        "prior_year_month_start_date": F.trunc(year_before, "month"),
        "prior_year_month_end_date": F.last_day(year_before),
        "quarter_of_year": F.quarter(d).cast("bigint"),
        "quarter_start_date": quarter_start(d),
        "quarter_end_date": F.date_sub(F.add_months(quarter_start(d), 3), 1),
        "year_number": F.year(d).cast("bigint"),
        "year_start_date": F.trunc(d, "year"),
        "year_end_date": F.date_sub(F.add_months(F.trunc(d, "year"), 12), 1),
    }


def _expand(bounds: DataFrame, first_day: str) -> DataFrame:
    days = bounds.where("first_date <= last_date").select(
        F.explode(F.sequence("first_date", "last_date")).alias("date_day")
    )
    columns = calendar_columns(F.col("date_day"), first_day)
    return days.select(*[c.alias(name) for name, c in columns.items()])


def dim_date(
    spark: SparkSession,
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
    end_exclusive: bool = True,
    first_day: str = "sunday",
) -> DataFrame:
    """One row per day. The number of rows is fixed by the arguments, never by data."""
    bounds = spark.range(1).select(
        F.lit(start).alias("first_date"),
        F.date_sub(F.lit(end), 1 if end_exclusive else 0).alias("last_date"),
    )
    return _expand(bounds, first_day)


def dim_date_spanning(df: DataFrame, day: str, first_day: str = "sunday") -> DataFrame:
    """Calendar from the earliest to the latest day found in ``df``."""
    bounds = df.agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))
    return _expand(bounds, first_day)
