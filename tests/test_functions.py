import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F, types as T

from tests.conftest import rows
from tidewater.functions import cleaning, dates
from tidewater.plans.silver import RIDE_PARTITIONS_SQL
from tidewater.schemas import DIM_DATE, RIDES, as_text
from tidewater.sources.calendar import date_dim


def test_calendar_covers_its_bounds(spark):
    dim = date_dim(spark)
    assert dim.dtypes == spark.createDataFrame([], DIM_DATE).dtypes
    assert dim.count() == 9133
    low, high = dim.agg(F.min("date_key"), F.max("date_key")).first()
    assert (low, high) == (20000101, 20250101)


def test_calendar_leap_day(spark):
    row = date_dim(spark).where("date_key = 20240229").first()
    assert tuple(row) == (20240229, 2024, 2, 29, "1", "Thursday", 3)


def test_calendar_agrees_with_python(spark):
    for row in date_dim(spark, "2019-12-25", "2020-03-05").collect():
        day = dt.date(row.year, row.month, row.day)
        assert row.date_key == int(day.strftime("%Y%m%d"))
        assert row.quarter == str((day.month + 2) // 3)
        assert (row.weekday, row.weekday_number) == (day.strftime("%A"), day.weekday())


def test_dates_survive_bad_text(spark):
    df = spark.createDataFrame([("2024-02-29", 20240229), ("n/a", 1), (None, None)], "t string, k int")
    got = rows(df.select(dates.to_day(F.col("t")), dates.key_to_day(F.col("k"))))
    day = dt.date(2024, 2, 29)
    assert got == sorted([(day, day), (None, None), (None, None)], key=repr)


def test_day_key_round_trip(spark):
    keys = date_dim(spark, "1999-12-30", "2000-01-02").select("date_key")
    back = keys.select("date_key", dates.day_to_key(dates.key_to_day(F.col("date_key"))).alias("b"))
    assert back.where("date_key <> b").isEmpty()


def test_fill_nulls_only_strings(spark):
    df = spark.createDataFrame([(None, None), ("x", 1)], "s string, n int")
    assert rows(cleaning.fill_nulls(df)) == sorted([("n/a", None), ("x", 1)], key=repr)


def test_clean_text_matches_exactly(spark):
    df = spark.createDataFrame(
        [(None, 1.5), ("None", None), ("null", 2.0), ("", 3.0), (" null", 4.0), ("NULL", 5.0)],
        "s string, v double",
    )
    got = {tuple(r) for r in cleaning.clean_text(df).collect()}
    assert got == {
        ("n/a", "1.5"), ("n/a", "n/a"), ("n/a", "2.0"), ("n/a", "3.0"), (" null", "4.0"), ("NULL", "5.0"),
    }


def test_to_schema_turns_bad_values_into_null(spark):
    wire = spark.createDataFrame(
        [("r1", "2024-01-02", "10.50"), ("r2", "n/a", "n/a")], "ride_id string, ride_date string, fare string"
    )
    typed = cleaning.to_schema(wire, RIDES).select("ride_id", "ride_date", "fare", "user_id")
    assert rows(typed) == [
        ("r1", dt.date(2024, 1, 2), Decimal("10.50"), None),
        ("r2", None, None, None),
    ]
    assert all(f.dataType == T.StringType() for f in as_text(RIDES))


def test_flatten_joins_names(spark):
    df = spark.sql("SELECT 1 AS a, struct('x' AS c, struct(2 AS e, array(1) AS f) AS d) AS b")
    flat = cleaning.flatten(df)
    assert flat.columns == ["a", "b_c", "b_d_e", "b_d_f"]
    assert tuple(flat.first()) == (1, "x", 2, [1])


def test_flatten_of_null_struct(spark):
    df = spark.sql("SELECT CAST(NULL AS STRUCT<c: STRING>) AS b")
    assert tuple(cleaning.flatten(df).first()) == (None,)


def test_surrogate_key_is_sha256(spark):
    df = spark.createDataFrame([("Ann",), ("",)], "name string")
    got = dict(df.select("name", cleaning.surrogate_key("name")).collect())
    assert got == {n: hashlib.sha256(n.encode()).hexdigest() for n in ("Ann", "")}


def test_surrogate_keys_of_several_columns_differ(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a|b", None, None), ("a", "b", "")], "x string, y string, z string")
    assert df.select(cleaning.surrogate_key("x", "y", "z")).distinct().count() == 4


def test_sql_transformer_adds_partitions(spark):
    df = spark.createDataFrame([("r1", dt.date(2024, 2, 29))], "ride_id string, ride_date date")
    out = cleaning.sql_transform(df, RIDE_PARTITIONS_SQL)
    assert tuple(out.first()) == ("r1", dt.date(2024, 2, 29), 2024, 2, 29)
