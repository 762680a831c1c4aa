"""Calendar columns and date keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.config import Calendar

# Fixed value: the key of the unknown member, the one date dimension row whose date is NULL.
UNKNOWN_DATE_KEY = 0


def calendar_columns(date: Column) -> dict[str, Column]:
    """Attributes of a day. ``is_weekend`` refers to ``day_of_week`` of the same ``withColumns`` call."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": F.dayofweek(date),
        "week_of_year": F.weekofyear(date),
        "quarter": F.quarter(date),
        "day_of_year": F.dayofyear(date),
        "is_month_end": F.last_day(date) == date,
        "is_month_start": F.dayofmonth(date) == 1,
        "is_weekend": F.when(F.col("day_of_week").isin(1, 7), True).otherwise(False),
    }


def day_ordinal(date: Column, start: Column) -> Column:
    """Position of a day in a gapless calendar: what a rank over all its days gives, without sorting them."""
    return F.datediff(date, start) + 1


def calendar_days(calendar: Calendar | DataFrame) -> tuple[Column, Column]:
    """First and last day of a calendar, also one in a one-row frame (``start_date``, ``end_date``) that is read with the
    query that uses them."""
    if isinstance(calendar, Calendar):
        return F.lit(calendar.start), F.lit(calendar.end)
    # One subquery, so that Spark runs it once however often the days are used.
    days = calendar.select(F.struct("start_date", "end_date").alias("days")).scalar()
    return days.getField("start_date"), days.getField("end_date")


def date_key(date: Column, start: Column | Calendar, end: Column | None = None) -> Column:
    """Key that a NULL-safe left join with the date dimension over these days, or this calendar's, finds.

    NULL finds the unknown member, a day outside the calendar finds nothing.
    """
    if isinstance(start, Calendar):
        start, end = calendar_days(start)
    return F.when(date.isNull(), UNKNOWN_DATE_KEY).when(date.between(start, end), day_ordinal(date, start))
