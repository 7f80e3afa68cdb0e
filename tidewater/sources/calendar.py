"""The generated calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.functions.dates import day_parts, day_to_key
from tidewater.schemas import DIM_DATE

# fixed values: default first and last day, both inclusive
FIRST_DAY = "2000-01-01"
LAST_DAY = "2025-01-01"


def _day(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def date_dim(
    spark: SparkSession, first: str | dt.date = FIRST_DAY, last: str | dt.date = LAST_DAY
) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included.

    Built on ``spark.range``, whose exact size estimate (366 rows a year at most)
    lets Catalyst broadcast the calendar without a hint.
    """
    start, end = _day(first), _day(last)
    days = spark.range((end - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("d")
    )
    d = F.col("d")
    return days.select(
        day_to_key(d).alias("date_key"),
        *day_parts(d),
        F.quarter(d).cast("string").alias("quarter"),
        F.date_format(d, "EEEE").alias("weekday"),
        F.weekday(d).alias("weekday_number"),
    ).to(DIM_DATE)
