"""The earnings fact: rides with their tips, priced, for days in the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater import paths
from tidewater.functions.dates import day_to_key
from tidewater.operators.checkpoint import Checkpoint, Increment, next_increment
from tidewater.operators.keyed_table import KeyedTable
from tidewater.schemas import DRIVER_EARNINGS, MONEY
from tidewater.session import shared_dir
from tidewater.sources.change_records import DELETE, OP, UPSERT

TIP_POLICIES = ("latest", "sum")
MODES = ("complete", "reference")
FACT_KEY = ("driver_id", "ride_id")


def tips_per_ride(tips: DataFrame, policy: str = "latest") -> DataFrame:
    """One tip row per ride: the greatest tip_id, or the sum.

    Ids of digits only are ordered as numbers, before them all others as text.

    Both are aggregates with a partial step, so a ride that got a third of all
    tips is reduced before the shuffle and the join that follows is one to one.
    """
    return tips.groupBy("ride_id").agg(tip_of_ride(policy).alias("tip_amount"))


def tip_of_ride(policy: str = "latest", counts: Column | None = None) -> Column:
    """The aggregate over the tips of a ride, of those rows that ``counts``; null without any."""
    if policy not in TIP_POLICIES:
        raise ValueError(f"tip policy is one of {TIP_POLICIES}, not {policy!r}")
    digits = F.when(F.col("tip_id").rlike("^[0-9]+$"), F.ltrim(F.col("tip_id"), F.lit("0")))
    last = F.struct(F.coalesce(F.length(digits), F.lit(-1)), F.coalesce(digits, "tip_id"), "tip_id")
    value = F.col("tip_amount")
    if counts is not None:
        last, value = F.when(counts, last), F.when(counts, value)
    amount = F.max_by("tip_amount", last) if policy == "latest" else F.sum(value)
    return amount.cast(MONEY)


def _priced(fare: Column, tip: Column) -> list[Column]:
    tip = F.coalesce(tip, F.lit(0).cast(MONEY))
    return [
        fare.cast(MONEY).alias("fare"),
        tip.alias("tip_amount"),
        (fare + tip).cast(MONEY).alias("total_amount"),
    ]


def earnings(rides: DataFrame, tips: DataFrame, dim: DataFrame, policy: str = "latest") -> DataFrame:
    """Fact rows of the given rides; a ride outside the calendar is dropped."""
    return join_calendar(rides.join(tips_per_ride(tips, policy), "ride_id", "left"), dim)


def _days(dim: DataFrame) -> DataFrame:
    return dim.select(F.col("date_key").alias("earning_date_key"))


def join_calendar(ridden: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact rows of rides that have their ``tip_amount`` already."""
    keyed = ridden.select(
        "driver_id",
        "ride_id",
        *_priced(F.col("fare"), F.col("tip_amount")),
        day_to_key(F.col("ride_date")).alias("earning_date_key"),
    )
    return keyed.join(_days(dim), "earning_date_key").select(DRIVER_EARNINGS.fieldNames())


def reprice(fact: DataFrame, tips: DataFrame, policy: str = "latest") -> DataFrame:
    """Fact rows whose ride has a tip among ``tips``, with that tip."""
    return (
        fact.drop("tip_amount", "total_amount")
        .join(tips_per_ride(tips, policy), "ride_id")
        .select(
            "driver_id", "ride_id", *_priced(F.col("fare"), F.col("tip_amount")), "earning_date_key"
        )
    )


def create_fact(spark: SparkSession, path: str, buckets: int = 0, join_buckets: int = 0) -> KeyedTable:
    """An empty fact, or the one there; with ``buckets`` it is laid out by ride, so that a
    refresh reads the buckets of the touched rides only, with ``join_buckets`` so that joins
    by ride leave it where it is."""
    return KeyedTable.create(
        spark, path, DRIVER_EARNINGS, "driver_id,ride_id", "ride_id",
        buckets=buckets, bucket_by="ride_id", join_buckets=join_buckets,
    )


def refresh_earnings(
    rides: KeyedTable,
    tips: KeyedTable,
    fact: KeyedTable,
    dim: DataFrame,
    checkpoint: Checkpoint,
    mode: str = "complete",
    policy: str = "latest",
) -> int | None:
    """Bring the fact up to date with the commits since the checkpoint.

    ``complete`` re-prices every ride that a changed ride or tip touches with all
    of its tips, so late, early, moved and deleted rows come out as in a full
    recompute.  ``reference`` looks at the two increments only: with new rides it
    joins them to the new tips, without any it re-prices known rides.

    A first run, also one after the checkpoint was cleared, recomputes the whole
    fact; clear it when the calendar has changed.  The checkpoint moves after the
    write, so a failed run is simply repeated.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")
    new_rides = next_increment(rides, "rides", checkpoint)
    new_tips = next_increment(tips, "tips", checkpoint)
    if new_rides.is_empty and new_tips.is_empty:
        return None
    if mode == "reference":
        commit = _refresh_from_slices(new_rides, new_tips, fact, dim, policy)
    elif new_rides.begin is None:
        commit = _rebuild(new_rides, new_tips, fact, dim, policy)
    else:
        commit = _refresh_affected(new_rides, new_tips, fact, dim, policy)
    new_rides.done(checkpoint)
    new_tips.done(checkpoint)
    return commit


def _refresh_from_slices(
    new_rides: Increment, new_tips: Increment, fact: KeyedTable, dim: DataFrame, policy: str
) -> int | None:
    ride_rows, tip_rows = new_rides.rows(), new_tips.rows()
    if not new_rides.is_empty and not ride_rows.isEmpty():
        return fact.upsert(earnings(ride_rows, tip_rows, dim, policy), unique=True)
    if new_tips.is_empty:
        return None
    return fact.upsert(reprice(fact.snapshot(), tip_rows, policy), unique=True)


def _rebuild(
    new_rides: Increment, new_tips: Increment, fact: KeyedTable, dim: DataFrame, policy: str
) -> int | None:
    """The whole fact; stored rows that no longer belong there are deleted."""
    rides = new_rides.table.snapshot(new_rides.end)
    tips = new_tips.table.snapshot(new_tips.end)
    current = earnings(rides, tips, dim, policy)
    if fact.last_commit() is None:
        return fact.upsert(current, unique=True)
    names = DRIVER_EARNINGS.fieldNames()
    new = current.select(*FACT_KEY, F.struct(*names).alias("_new"))
    old = fact.snapshot().select(*FACT_KEY, F.struct(*names).alias("_old"))
    both = new.join(old, list(FACT_KEY), "full_outer")
    changed = both.where(~F.col("_new").eqNullSafe(F.col("_old")))
    row = F.coalesce("_new", "_old").alias("_row")
    op = F.when(F.col("_new").isNull(), DELETE).otherwise(UPSERT).alias(OP)
    return fact.upsert(changed.select(row, op).select("_row.*", OP), unique=True)


def _refresh_affected(
    new_rides: Increment, new_tips: Increment, fact: KeyedTable, dim: DataFrame, policy: str
) -> int | None:
    """Only rides in the increments are touched; the ride table is not read.

    What a ride without a new image needs is in its fact row already.  The fact
    is scanned once and the tips twice, before and after the increment; the scans of the fact
    and of the tips before meet the touched rides or tips in a semi join, ahead of ranking.
    Of a bucketed fact only the buckets of the
    touched rides are read, of bucketed tips before the increment only those it touches.
    """
    work = shared_dir(fact.spark, "touched_rides")
    try:
        # written once: several joins read them, and their true sizes decide whether
        # Catalyst broadcasts them
        arrived = new_rides.rows(deletes=True).select("ride_id", "driver_id", "fare", "ride_date", OP)
        ride_rows = _stored(arrived, f"{work}/arrived")
        touched = (
            ride_rows.select("ride_id")
            .unionByName(new_tips.rows(deletes=True).select("ride_id"))
            # a tip that moved or went leaves a mark on the ride it had before
            .unionByName(_before(new_tips).select("ride_id"))
            .distinct()
        )
        touched = _stored(touched, f"{work}/touched")
        few = fact.broadcasts(f"{work}/touched")
        return fact.upsert(_changes(ride_rows, touched, new_tips, fact, dim, policy, few), unique=True)
    finally:
        paths.delete(fact.spark, work)


def _stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _changes(
    ride_rows: DataFrame,
    touched: DataFrame,
    new_tips: Increment,
    fact: KeyedTable,
    dim: DataFrame,
    policy: str,
    few_touched: bool = True,
) -> DataFrame:
    tips = tips_per_ride(new_tips.table.snapshot(new_tips.end), policy)
    # the semi join is on the grouping key: Catalyst moves it below the aggregate while
    # ``touched`` is small enough to broadcast; beyond that it would sort both sides to
    # leave out what no row below asks for anyway
    if few_touched:
        tips = tips.join(touched, "ride_id", "left_semi")
    # before ranking: a fact row's ride is part of its key
    stored = fact.snapshot(buckets=fact.buckets_of(touched), only=touched)

    arrived = ride_rows.select(
        "ride_id", "driver_id", "fare", OP, day_to_key(F.col("ride_date")).alias("earning_date_key")
    ).join(_days(dim).withColumn("_in_calendar", F.lit(True)), "earning_date_key", "left")
    live = (F.col(OP) == UPSERT) & F.col("_in_calendar").isNotNull()
    columns = ["driver_id", "ride_id", "fare", "earning_date_key"]
    fresh = arrived.where(live).select(*columns, F.lit(None).alias("_old_tip"), OP)

    # a stored row meets the new image of its ride: replaced under its own key,
    # deleted when the ride went or has another driver, re-priced when there is none
    images = arrived.select(
        "ride_id", F.lit(True).alias("_came"), F.when(live, F.col("driver_id")).alias("_driver")
    )
    known = (
        stored.join(images, "ride_id", "left")
        .where(~F.col("driver_id").eqNullSafe(F.col("_driver")))
        .select(
            *columns,
            F.col("tip_amount").alias("_old_tip"),
            F.when(F.col("_came"), DELETE).otherwise(UPSERT).alias(OP),
        )
    )
    priced = (
        fresh.unionByName(known)
        .join(tips, "ride_id", "left")
        .select(
            "driver_id",
            "ride_id",
            *_priced(F.col("fare"), F.col("tip_amount")),
            "earning_date_key",
            "_old_tip",
            OP,
        )
    )
    changed = (F.col(OP) == DELETE) | ~F.col("tip_amount").eqNullSafe(F.col("_old_tip"))
    return priced.where(changed)


def _before(increment: Increment) -> DataFrame:
    begin = increment.end if increment.is_empty else increment.begin
    return increment.table.before_images(begin, increment.end)
