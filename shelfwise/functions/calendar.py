"""Date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def iso_day_of_week(date: Column | str) -> Column:
    """1 = Monday to 7 = Sunday."""
    return F.weekday(date) + 1


def iso_week(date: Column | str) -> Column:
    """ISO week number, without the ISO year."""
    return F.weekofyear(date)


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end``; negative when ``end`` is earlier."""
    return F.datediff(end, start)


def weekday_name(date: Column | str) -> Column:
    """English weekday name. A NULL date falls to the last branch, Sunday."""
    day = iso_day_of_week(date)
    name = F.when(day == 1, WEEKDAY_NAMES[0])
    for number, label in enumerate(WEEKDAY_NAMES[1:6], start=2):
        name = name.when(day == number, label)
    return name.otherwise(WEEKDAY_NAMES[6])


def calendar_columns(date: str) -> list[Column]:
    """The columns of the calendar dimension for the date column ``date``."""
    return [
        F.col(date),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day_of_month"),
        iso_day_of_week(date).alias("iso_day_of_week"),
        iso_week(date).alias("iso_week"),
        weekday_name(date).alias("weekday_name"),
        (iso_day_of_week(date) >= 6).alias("is_weekend"),
    ]
