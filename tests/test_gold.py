from decimal import Decimal

import pytest

from tests.conftest import plan, rows
from tidewater.plans import gold
from tidewater.schemas import DRIVER_EARNINGS
from tidewater.sources.calendar import date_dim


@pytest.fixture
def star(spark):
    facts = [
        ("d1", "r1", 20240115), ("d1", "r2", 20240120), ("d1", "r3", 20230115), ("d2", "r4", 20240201),
        ("d3", "r5", 20240301), ("d4", "r6", 20240301), ("gone", "r7", 20240301),
    ]
    fact = spark.createDataFrame(
        [(d, r, Decimal(8), Decimal(2), Decimal(10), k) for d, r, k in facts], DRIVER_EARNINGS
    )
    drivers = spark.createDataFrame(
        [("d1", "Ann"), ("d2", "Ann"), ("d3", "Bo"), ("d4", "Cy")], "driver_id string, name string"
    )
    return fact, date_dim(spark), drivers


def test_by_month_and_year(star):
    got = [tuple(r) for r in gold.driver_month_year(*star).collect()]
    assert got[:3] == [
        ("d1", "Ann", 1, 2023, Decimal(10)), ("d1", "Ann", 1, 2024, Decimal(20)),
        ("d2", "Ann", 2, 2024, Decimal(10)),
    ]
    assert len(got) == 5


def test_namesakes_merge_by_year(star):
    got = {(r.driver_name, r.year): r.total_earnings for r in gold.driver_year(*star).collect()}
    assert got["Ann", 2024] == 30 and got["Ann", 2023] == 10 and len(got) == 4


def test_tips_and_top(star):
    fact, _, drivers = star
    got = [(r.driver_id, r.total_tips) for r in gold.tips_by_driver(fact, drivers).collect()]
    assert got == [("d1", 6), ("d2", 2), ("d3", 2), ("d4", 2)]
    top = gold.top_tipped_drivers(fact, drivers, 2)
    assert [r.driver_id for r in top.collect()] == ["d1", "d2"]
    assert "TakeOrderedAndProject" in plan(top)


def test_driver_with_two_rows_counts_twice(spark, star):
    """A partition-scoped driver table may hold a driver twice; a plain join doubles too."""
    fact, dim, drivers = star
    twice = drivers.unionAll(spark.createDataFrame([("d1", "Ann")], drivers.schema))
    plain = (
        fact.join(dim, fact.earning_date_key == dim.date_key)
        .join(twice, "driver_id")
        .groupBy("driver_id", "name", "month", "year")
        .agg({"total_amount": "sum"})
    )
    assert rows(gold.driver_month_year(fact, dim, twice)) == rows(plain)


def test_rides_per_month(spark):
    rides = spark.sql(
        "SELECT * FROM VALUES ('r1', DATE'2024-01-01'), ('r2', DATE'2024-01-31'), "
        "('r3', DATE'2023-05-05'), (NULL, DATE'2023-05-06') AS t(ride_id, ride_date)"
    )
    assert [tuple(r) for r in gold.rides_month_year(rides).collect()] == [(2023, 5, 1), (2024, 1, 2)]


def test_views(spark, star):
    fact, dim, drivers = star
    rides = spark.sql("SELECT 'r1' AS ride_id, DATE'2024-01-01' AS ride_date")
    gold.create_views(fact, dim, drivers, rides)
    gold.create_views(fact, dim, drivers, rides)
    for view in gold.VIEWS:
        assert spark.table(view).count() > 0


def test_fact_is_summed_before_it_meets_the_drivers(star):
    shown = plan(gold.driver_month_year(*star))
    assert shown.index("Join [driver_id") < shown.index("partial_sum(total_amount")
