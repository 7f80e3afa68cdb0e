"""Gold views over the earnings fact, the drivers and the rides.

The fact is summed per driver before it meets the driver table: the shuffle then
carries one row per driver and period and map task, however hot a driver is, and
the driver table joins the sums instead of the fact.  The last ``groupBy`` keeps
the result right for driver tables with several rows per driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# fixed values: the names of the first three views
VIEWS = (
    "gold_driver_earning_month_year",
    "gold_driver_earning_year",
    "gold_driver_who_made_most_money_on_tips",
    "gold_rides_month_year",
)
TOP_DRIVERS = 5


def _per_driver(fact: DataFrame, dim: DataFrame, drivers: DataFrame, period: list[str]) -> DataFrame:
    days = dim.select(F.col("date_key").alias("earning_date_key"), *period)
    sums = (
        fact.join(days, "earning_date_key")
        .groupBy("driver_id", *period)
        .agg(F.sum("total_amount").alias("total_earnings"))
    )
    names = drivers.select("driver_id", F.col("name").alias("driver_name"))
    return sums.join(names, "driver_id")


def driver_month_year(fact: DataFrame, dim: DataFrame, drivers: DataFrame) -> DataFrame:
    return (
        _per_driver(fact, dim, drivers, ["month", "year"])
        .groupBy("driver_id", "driver_name", "month", "year")
        .agg(F.sum("total_earnings").alias("total_earnings"))
        .orderBy("driver_id", "month", "year", "driver_name")
    )


def driver_year(fact: DataFrame, dim: DataFrame, drivers: DataFrame) -> DataFrame:
    """By name: drivers that share a name are one line."""
    return (
        _per_driver(fact, dim, drivers, ["year"])
        .groupBy("driver_name", "year")
        .agg(F.sum("total_earnings").alias("total_earnings"))
        .orderBy("driver_name", "year")
    )


def tips_by_driver(fact: DataFrame, drivers: DataFrame) -> DataFrame:
    sums = fact.groupBy("driver_id").agg(F.sum("tip_amount").alias("total_tips"))
    names = drivers.select("driver_id", F.col("name").alias("driver_name"))
    return (
        sums.join(names, "driver_id")
        .groupBy("driver_id", "driver_name")
        .agg(F.sum("total_tips").alias("total_tips"))
        .orderBy(F.desc("total_tips"), "driver_id", "driver_name")
    )


def top_tipped_drivers(fact: DataFrame, drivers: DataFrame, n: int = TOP_DRIVERS) -> DataFrame:
    """The first ``n`` of :func:`tips_by_driver`; ties go to the smaller driver_id."""
    return tips_by_driver(fact, drivers).limit(n)


def rides_month_year(rides: DataFrame) -> DataFrame:
    return (
        rides.groupBy(F.year("ride_date").alias("year"), F.month("ride_date").alias("month"))
        .agg(F.count("ride_id").alias("ride_count"))
        .orderBy("year", "month")
    )


def create_views(fact: DataFrame, dim: DataFrame, drivers: DataFrame, rides: DataFrame) -> None:
    """Create or replace the four views in the session."""
    frames = (
        driver_month_year(fact, dim, drivers),
        driver_year(fact, dim, drivers),
        tips_by_driver(fact, drivers),
        rides_month_year(rides),
    )
    for name, frame in zip(VIEWS, frames):
        frame.createOrReplaceTempView(name)


_SUMS = """(
  SELECT f.driver_id, {period}, sum(f.total_amount) AS earned
  FROM {fact} f JOIN {dim} c ON f.earning_date_key = c.date_key
  GROUP BY f.driver_id, {period}
)"""
_DEFINITIONS = (
    f"""SELECT s.driver_id, d.name AS driver_name, month, year, sum(earned) AS total_earnings
FROM {_SUMS.replace("{period}", "c.month, c.year")} s JOIN {{drivers}} d ON s.driver_id = d.driver_id
GROUP BY s.driver_id, d.name, month, year ORDER BY driver_id, month, year, driver_name""",
    f"""SELECT d.name AS driver_name, year, sum(earned) AS total_earnings
FROM {_SUMS.replace("{period}", "c.year")} s JOIN {{drivers}} d ON s.driver_id = d.driver_id
GROUP BY d.name, year ORDER BY driver_name, year""",
    """SELECT s.driver_id, d.name AS driver_name, sum(tips) AS total_tips
FROM (SELECT driver_id, sum(tip_amount) AS tips FROM {fact} GROUP BY driver_id) s
JOIN {drivers} d ON s.driver_id = d.driver_id
GROUP BY s.driver_id, d.name ORDER BY total_tips DESC, driver_id, driver_name""",
    """SELECT year(ride_date) AS year, month(ride_date) AS month, count(ride_id) AS ride_count
FROM {rides} GROUP BY year(ride_date), month(ride_date) ORDER BY year, month""",
)


def create_catalog_views(
    spark: SparkSession, database: str, fact: str, dim: str, drivers: str, rides: str
) -> None:
    """Create or replace the four views in the catalog, over catalog names.

    Over names from :func:`~tidewater.operators.maintenance.register` they show the newest
    compacted state whenever they are read, and outlive the session where the catalog does.
    """
    names = {"fact": fact, "dim": dim, "drivers": drivers, "rides": rides}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for view, text in zip(VIEWS, _DEFINITIONS):
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{view}` AS {text.format(**names)}")
