"""Calendar features of a transaction time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Saturday and Sunday with Monday = 0, and the night hours.
WEEKEND_DAYS = (5, 6)
NIGHT_UNTIL = 6
NIGHT_FROM = 22


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(ts)


def month_of_year(ts: Column) -> Column:
    return F.month(ts)


def is_weekend(day: Column) -> Column:
    return day.isin(*WEEKEND_DAYS)


def is_night(hour: Column) -> Column:
    return (hour <= NIGHT_UNTIL) | (hour >= NIGHT_FROM)
