import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidewater import paths
from tidewater.operators import bucketed, catalog, maintenance
from tidewater.operators.keyed_table import KeyedTable
from tidewater.plans import earnings

DDL = "k string, state string, v int, seq int"


@pytest.fixture
def make(spark, folder):
    def build(name="t", schema=DDL, key="k", precombine="seq", **options):
        fields = spark.createDataFrame([], schema).schema
        return KeyedTable.create(spark, f"{folder}/{name}", fields, key, precombine, **{"join_buckets": 4, **options})

    return build


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def batch(spark, *values, schema=DDL):
    return spark.createDataFrame(list(values), schema)


def many(spark, start, stop, seq=1):
    return spark.range(start, stop, 1, 5).select(
        F.format_string("k%d", "id").alias("k"), F.lit("CA").alias("state"),
        F.col("id").cast("int").alias("v"), F.lit(seq).alias("seq"),
    )


def bucket_files(spark, base):
    return [re.search(r"_(\d{5})\.c000", p)[1] for p in paths.glob(spark, f"{base.path}/*.parquet")]


def exchanged_bases(df):
    """Scans of bases that stand below an exchange."""
    shown, found, depth = plan(df).splitlines(), [], []
    for line in shown:
        level = len(re.match(r"[\s:+\-|]*", line)[0])
        depth = [d for d in depth if d < level]
        if "Exchange" in line:
            depth.append(level)
        if "base_" in line and "FileScan" in line:
            assert "Bucketed: true" in line
            found += [line] if depth else []
    return found


@pytest.mark.parametrize("options", [{}, {"partition_fields": "state"}, {"ordered": True}], ids=str)
def test_same_rows_as_without_buckets(spark, make, options):
    t, other = make(**options), make("other", join_buckets=0, **options)
    for some in (
        batch(spark, ("a", "CA", 1, 1), ("b", None, 2, 1), ("c", "", 3, 1)),
        batch(spark, ("a", "TX", 10, 2), ("d", "CA", None, 1)),
        batch(spark, ("c", "CA", 30, 3)),
        many(spark, 0, 50),
    ):
        t.upsert(some)
        other.upsert(some)
        assert rows(t.snapshot()) == rows(other.snapshot())
        maintenance.compact(t)
        maintenance.compact(other)
        assert rows(t.snapshot()) == rows(other.snapshot())
    for table in (t, other):
        table.delete("k", "b")
        maintenance.compact(table)
    assert rows(t.snapshot()) == rows(other.snapshot())
    assert rows(t.snapshot(2)) == rows(other.snapshot(2))
    assert rows(t.incremental(2, deletes=True)) == rows(other.incremental(2, deletes=True))
    assert rows(t.before_images(2)) == rows(other.before_images(2))


def test_a_compacted_base_has_one_sorted_file_for_each_bucket(spark, make):
    t = make()
    t.upsert(many(spark, 0, 200))
    first = maintenance.compact(t)
    assert sorted(bucket_files(spark, first)) == ["00000", "00001", "00002", "00003"]
    t.upsert(many(spark, 100, 300, 2))
    t.upsert(many(spark, 250, 260, 3))
    second = maintenance.compact(t)
    assert sorted(bucket_files(spark, second)) == ["00000", "00001", "00002", "00003"]
    assert t.snapshot().count() == 300 and t.snapshot().where("seq = 3").count() == 10
    for file in paths.glob(spark, f"{second.path}/*.parquet"):
        keys = [r.k for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)


def test_upsert_match_and_joins_leave_the_base_where_it_is(spark, make, no_broadcast):
    t, other = make(), make("other")
    for table in (t, other):
        table.upsert(many(spark, 0, 100))
        maintenance.compact(table)
    assert exchanged_bases(t.snapshot().join(other.snapshot().withColumnRenamed("v", "w"), "k")) == []
    for table in (t, other):
        table.upsert(many(spark, 50, 150, 2))
        table.upsert(many(spark, 60, 70, 3))
    assert exchanged_bases(t.snapshot()) == []
    both = t.snapshot().join(other.snapshot().select("k", F.col("v").alias("w")), "k")
    assert both.count() == 150
    assert exchanged_bases(t.snapshot().groupBy("k").count()) == []


def test_earnings_join_rides_and_tips_in_their_buckets(spark, make, no_broadcast):
    ride = "ride_id string, driver_id string, ride_date date, fare decimal(18,2)"
    tip = "tip_id string, ride_id string, tip_amount decimal(18,2), tipped_on date"
    rides = make("rides", ride, "ride_id", "ride_date")
    tips = make("tips", tip, "ride_id,tip_id", "tipped_on", bucket_by="ride_id")
    days = spark.sql("SELECT DATE'2024-01-02' AS d")
    ids = spark.range(60).select(F.col("id").cast("string").alias("ride_id"))
    rides.upsert(ids.select("ride_id", F.lit("x").alias("driver_id"), F.lit("2024-01-02").alias("ride_date"), F.lit(2).alias("fare")))
    tips.upsert(ids.select(F.lit("1").alias("tip_id"), "ride_id", F.lit(1).alias("tip_amount"), F.lit("2024-01-02").alias("tipped_on")))
    maintenance.compact(rides)
    maintenance.compact(tips)
    dim = days.select(F.date_format("d", "yyyyMMdd").cast("int").alias("date_key"))
    ridden = rides.snapshot().join(earnings.tips_per_ride(tips.snapshot()), "ride_id", "left")
    assert exchanged_bases(ridden) == []
    fact = earnings.earnings(rides.snapshot(), tips.snapshot(), dim)
    assert fact.count() == 60 and {r[0] for r in fact.select("total_amount").distinct().collect()} == {3}


def test_a_catalog_without_the_entry_gets_it_again(spark, make, folder):
    t = make(partition_fields="state")
    t.upsert(many(spark, 0, 20))
    base = maintenance.compact(t)
    name = bucketed.table_over(t, base)
    bucketed.forget(t, base)
    assert not spark.catalog.tableExists(name)
    assert t.snapshot().count() == 20 and spark.catalog.tableExists(name)
    # a wider definition is another entry over the same files
    t = make(schema=f"{DDL}, note string", partition_fields="state", evolve=True)
    assert t.snapshot().where("note is null").count() == 20
    shown = catalog.register(t, "buckets_shown", "t", f"{folder}/db")
    t.upsert(batch(spark, ("k1", "TX", -1, 2, "n"), schema=f"{DDL}, note string"))
    assert rows(spark.sql(f"SELECT k, v, note FROM {shown} WHERE k in ('k1', 'k2')")) == [("k1", -1, "n"), ("k2", 2, None)]
    for _ in range(2):
        t.upsert(many(spark, 20, 30).withColumn("note", F.lit("")))
        last = maintenance.compact(t)
    maintenance.vacuum(t, keep=1)
    assert [(b.upto, b.rev) for b in t.bases()] == [(last.upto, last.rev)] and not spark.catalog.tableExists(name)
    spark.sql("DROP DATABASE buckets_shown CASCADE")


def test_wrong_definitions_are_refused(spark, make):
    for options in (
        {"buckets": 4}, {"scope": "partition", "partition_fields": "state"}, {"partition_fields": "k"},
        {"bucket_by": "v"}, {"join_buckets": -1},
    ):
        with pytest.raises(ValueError):
            make("wrong", **options)
    t = make()
    t.upsert(many(spark, 0, 3))
    with pytest.raises(ValueError, match="join buckets"):
        maintenance.cluster(t, "v")
