"""Typed schemas of the silver and gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

RIDES = T.StructType(
    [
        T.StructField("ride_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("driver_id", T.StringType()),
        T.StructField("ride_date", T.DateType()),
        T.StructField("ride_time", T.StringType()),
        T.StructField("pick_up_city", T.StringType()),
        T.StructField("pick_up_state", T.StringType()),
        T.StructField("pickup_location", T.StringType()),
        T.StructField("dropoff_location", T.StringType()),
        T.StructField("distance_travelled", T.DoubleType()),
        T.StructField("ride_duration", T.StringType()),
        T.StructField("fare", MONEY),
    ]
)

TIPS = T.StructType(
    [
        T.StructField("tip_id", T.StringType()),
        T.StructField("ride_id", T.StringType()),
        T.StructField("tip_amount", MONEY),
    ]
)

USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("phone_number", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

DRIVERS = T.StructType(
    [
        T.StructField("driver_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("phone_number", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("car_make", T.StringType()),
        T.StructField("car_model", T.StringType()),
        T.StructField("license_plate", T.StringType()),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

DIM_DATE = T.StructType(
    [
        T.StructField("date_key", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("quarter", T.StringType()),
        T.StructField("weekday", T.StringType()),
        T.StructField("weekday_number", T.IntegerType()),
    ]
)

DRIVER_EARNINGS = T.StructType(
    [
        T.StructField("driver_id", T.StringType()),
        T.StructField("ride_id", T.StringType()),
        T.StructField("fare", MONEY),
        T.StructField("tip_amount", MONEY),
        T.StructField("total_amount", MONEY),
        T.StructField("earning_date_key", T.IntegerType()),
    ]
)


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns as they travel on the wire: all strings."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
