"""Ride-share tables read from an order-processing schema.

| ours    | from                                                        |
|---------|-------------------------------------------------------------|
| rides   | orders, driver = smallest supplier of the order             |
| tips    | line items that were returned, one tip per line             |
| drivers | suppliers with their nation                                 |
| users   | customers with their nation                                 |
| changes | events as change records                                    |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewater.functions.cleaning import fill_nulls
from tidewater.operators.latest import latest_per_key
from tidewater.schemas import MONEY, RIDES, TIPS
from tidewater.sources.change_records import encode_changes

RIDE_COLUMNS = ("ride_id", "user_id", "driver_id", "ride_date", "pick_up_state", "fare")
RIDE_SCHEMA = T.StructType([RIDES[c] for c in RIDE_COLUMNS])
TIP_SCHEMA = T.StructType([*TIPS.fields, T.StructField("tipped_on", T.DateType())])
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StructType([T.StructField("k", T.LongType())])),
    ]
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order; an order without lines has no driver.

    Keys become text before the aggregate and the join, so that later joins on
    ``ride_id`` reuse their partitioning.
    """
    drivers = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").cast("string").alias("ride_id"))
        .agg(F.min("l_suppkey").cast("string").alias("driver_id"))
    )
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("ride_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("ride_date"),
        F.col("o_orderpriority").alias("pick_up_state"),
        F.col("o_totalprice").cast(MONEY).alias("fare"),
    )
    return orders.join(drivers, "ride_id", "left").select(*RIDE_COLUMNS)


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the key is never null; filling it would only hide its partitioning
    rows = raw_rides(spark, sf_dir)
    return fill_nulls(rows, [c for c in rows.columns if c != "ride_id"])


def raw_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tip versions: a tip_id comes more than once."""
    lines = read_table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    order_key = F.col("l_orderkey").cast("string")
    return lines.select(
        F.concat_ws("-", order_key, F.col("l_linenumber").cast("string")).alias("tip_id"),
        order_key.alias("ride_id"),
        F.col("l_quantity").cast(MONEY).alias("tip_amount"),
        F.col("l_shipdate").cast("date").alias("tipped_on"),
    )


def tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last version of each tip."""
    newest = [F.desc("tipped_on"), F.desc("tip_amount")]
    return latest_per_key(raw_tips(spark, sf_dir), ["tip_id"], newest)


def _people(spark: SparkSession, sf_dir: str, name: str, prefix: str, key: str) -> DataFrame:
    nations = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias(f"{prefix}_nationkey"), F.col("n_name").alias("state")
    )
    return (
        read_table(spark, sf_dir, name)
        .join(nations, f"{prefix}_nationkey")
        .select(
            F.col(f"{prefix}_{'supp' if prefix == 's' else 'cust'}key").cast("string").alias(key),
            F.col(f"{prefix}_name").alias("name"),
            "state",
            F.col(f"{prefix}_acctbal").cast(MONEY).alias("balance"),
        )
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir, "supplier", "s", "driver_id")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir, "customer", "c", "user_id")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``props`` as a struct."""
    props = F.from_json("props", EVENT_SCHEMA["props"].dataType)
    return read_table(spark, sf_dir, "events").withColumn("props", props)


def event_name() -> Column:
    """What kind of change an event is: signups insert, errors remove, the rest modify."""
    kind = F.col("event_type")
    return F.when(kind == "signup", "INSERT").when(kind == "error", " remove ").otherwise("Modify")


def change_records(
    spark: SparkSession, sf_dir: str, sequence: Column | None = None
) -> DataFrame:
    """Events as change-record JSON."""
    return encode_changes(
        events(spark, sf_dir), EVENT_SCHEMA, event_name(), keys=("user_id",), sequence=sequence
    )
