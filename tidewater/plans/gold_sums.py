"""The gold views over sums that are kept by differences, so a read doesn't sum the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewater import paths
from tidewater.operators.keyed_table import KeyedTable
from tidewater.operators.rollup import Rollup, Shape
from tidewater.plans.gold import TOP_DRIVERS
from tidewater.session import shared_dir

SUM = T.DecimalType(38, 2)


class GoldSums:
    """Three tables of sums below a folder, refreshed after the fact and the rides.

    Driver names are joined when a view is read, from as many rows as there are sums.
    """

    def __init__(self, spark: SparkSession, path: str):
        fields = T.StructType.fromDDL
        self.earned = Rollup(spark, f"{path}/earned", fields("driver_id string, month int, year int"), {"total_earnings": SUM})
        self.tips = Rollup(spark, f"{path}/tips", fields("driver_id string"), {"total_tips": SUM})
        self.rides = Rollup(spark, f"{path}/rides", fields("year int, month int"), {"ride_count": T.LongType()})

    def refresh(self, fact: KeyedTable, rides: KeyedTable, dim: DataFrame, rebuild: bool = False) -> None:
        """Bring all sums up to date; ``rebuild`` when the calendar has changed."""
        days = dim.select(F.col("date_key").alias("earning_date_key"), "month", "year")
        earned = F.col("total_amount").alias("total_earnings")
        self._refresh_both(
            fact,
            lambda rows: rows.join(days, "earning_date_key").select("driver_id", "month", "year", earned),
            lambda rows: rows.select("driver_id", F.col("tip_amount").alias("total_tips")),
            rebuild,
        )
        counted = F.when(F.col("ride_id").isNotNull(), 1).alias("ride_count")
        months = F.year("ride_date").alias("year"), F.month("ride_date").alias("month")
        self.rides.refresh(rides, lambda rows: rows.select(*months, counted), rebuild)

    def _refresh_both(self, fact: KeyedTable, earned: Shape, tips: Shape, rebuild: bool) -> None:
        """Both sums over the fact; the rows that its commits replace are looked up once for both."""
        end = fact.last_commit()
        begin = None if rebuild else self.earned.upto()
        if begin in (None, end) or self.tips.upto() != begin:
            self.earned.refresh(fact, earned, rebuild)
            self.tips.refresh(fact, tips, rebuild)
            return
        spark = self.earned.table.spark
        work = shared_dir(spark, "replaced_rows")
        try:
            found = fact.before_images(begin, end)
            found.write.parquet(work)
            before = spark.read.schema(found.schema).parquet(work)
            self.earned.advance(fact, earned, begin, end, before)
            self.tips.advance(fact, tips, begin, end, before)
        finally:
            paths.delete(spark, work)

    def driver_month_year(self, drivers: DataFrame) -> DataFrame:
        by = ["driver_id", "driver_name", "month", "year"]
        return _sum(_named(self.earned.rows(), drivers), by, "total_earnings").orderBy("driver_id", "month", "year", "driver_name")

    def driver_year(self, drivers: DataFrame) -> DataFrame:
        """By name: drivers that share a name are one line."""
        years = _sum(self.earned.rows(), ["driver_id", "year"], "total_earnings")
        return _sum(_named(years, drivers), ["driver_name", "year"], "total_earnings").orderBy("driver_name", "year")

    def tips_by_driver(self, drivers: DataFrame) -> DataFrame:
        found = _sum(_named(self.tips.rows(), drivers), ["driver_id", "driver_name"], "total_tips")
        return found.orderBy(F.desc("total_tips"), "driver_id", "driver_name")

    def top_tipped_drivers(self, drivers: DataFrame, n: int = TOP_DRIVERS) -> DataFrame:
        return self.tips_by_driver(drivers).limit(n)

    def rides_month_year(self) -> DataFrame:
        return self.rides.rows().orderBy("year", "month")


def _named(sums: DataFrame, drivers: DataFrame) -> DataFrame:
    return sums.join(drivers.select("driver_id", F.col("name").alias("driver_name")), "driver_id")


def _sum(rows: DataFrame, by: list[str], measure: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum(measure).alias(measure))
