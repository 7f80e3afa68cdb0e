"""Date keys and date parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: the wire formats of dates
DAY_FORMAT = "yyyy-MM-dd"
KEY_FORMAT = "yyyyMMdd"


def to_day(text: Column) -> Column:
    """``yyyy-MM-dd`` text as a date; anything else is null, also under ANSI."""
    return F.try_to_date(text, DAY_FORMAT)


def key_to_day(key: Column) -> Column:
    """Integer ``yyyyMMdd`` as a date, null when it names no day."""
    return F.try_to_date(key.cast("string"), KEY_FORMAT)


def day_to_key(day: Column) -> Column:
    """Date as integer ``yyyyMMdd``, by arithmetic so it stays in generated code."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_parts(day: Column) -> list[Column]:
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    ]


def processing_day_parts() -> list[Column]:
    """Year, month and day of today; one value per batch or micro-batch."""
    return day_parts(F.current_date())
