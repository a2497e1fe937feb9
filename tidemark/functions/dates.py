"""Calendar attributes and time conversions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Holidays by (month, day), and the one that is the fourth Thursday of its month.
FIXED_HOLIDAYS = {
    (1, 1): "New Year's Day",
    (7, 4): "Independence Day",
    (12, 25): "Christmas Day",
}
FOURTH_THURSDAY_HOLIDAYS = {11: "Thanksgiving"}

# F.dayofweek counts from Sunday = 1.
SUNDAY, THURSDAY, SATURDAY = 1, 5, 7


def holiday_name(day: Column) -> Column:
    """Name of the holiday on ``day``, NULL on other days."""
    month, number = F.month(day), F.dayofmonth(day)
    cases = [F.when((month == m) & (number == d), F.lit(name)) for (m, d), name in FIXED_HOLIDAYS.items()]
    cases += [
        F.when((month == m) & (F.dayofweek(day) == THURSDAY) & (F.ceil(number / 7) == 4), F.lit(name))
        for m, name in FOURTH_THURSDAY_HOLIDAYS.items()
    ]
    return F.coalesce(*cases)


def calendar_attributes(days: DataFrame, day: str = "calendar_date") -> DataFrame:
    """Add year, quarter, month, week, day, weekend and holiday columns to a table of dates."""
    d = F.col(day)
    weekend = F.dayofweek(d).isin(SUNDAY, SATURDAY)
    return days.withColumns({
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
        "day_type": F.when(weekend, "Weekend").otherwise("Weekday"),
        "is_weekend": weekend,
        "is_weekday": ~weekend,
        "is_us_holiday": holiday_name(d).isNotNull(),
        "holiday_name": holiday_name(d),
    })


def date_rows(bounds: DataFrame, start: str, end: str, day: str = "calendar_date") -> DataFrame:
    """One row per day from ``start`` to ``end`` (inclusive) of every row of ``bounds``."""
    days = F.sequence(F.to_date(start), F.to_date(end), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(day))


def calendar(spark, start: str, end: str) -> DataFrame:
    """The calendar dimension between two ISO dates."""
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return calendar_attributes(date_rows(bounds, "start", "end"))


def calendar_of(df: DataFrame, date_column: str) -> DataFrame:
    """The calendar dimension over the date range of a column."""
    bounds = df.agg(F.min(date_column).alias("start"), F.max(date_column).alias("end"))
    return calendar_attributes(date_rows(bounds, "start", "end"))


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds as a timestamp, independent of any text format."""
    return F.timestamp_seconds(seconds)


def to_utc(local_time: Column, zone: Column | str) -> Column:
    """A wall-clock time of ``zone`` as the wall-clock time of UTC."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(zone, F.lit("UTC"), local_time)


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from ``start`` to ``end``."""
    return F.timestamp_diff("MINUTE", start, end)
