"""Each query runs library code over whole tables and returns a DataFrame.

Queries that need a stored table build it from the given tables in the shared
folder, in increments cut by date, so the work grows with the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewater.functions import cleaning, dates
from tidewater.functions.dates import day_parts
from tidewater.operators import catalog, maintenance
from tidewater.operators.checkpoint import Checkpoint, next_increment
from tidewater.operators.keyed_table import KeyedTable
from tidewater.operators.latest import latest_per_key
from tidewater.plans import earnings as earn, gold, silver
from tidewater.plans.gold_sums import GoldSums
from tidewater.session import shared_dir
from tidewater.sources import order_rides as src
from tidewater.sources.calendar import date_dim
from tidewater.sources.change_outcomes import REASON, read_accounts, read_landed, read_set_aside
from tidewater.sources.change_records import (
    OP, UPSERT, decode_changes, encode_changes, landed_schema,
)
from tidewater.sources.raw_files import land_raw, read_raw
from tidewater.streaming.earnings_stream import EarningsStream
from tidewater.streaming.ingest import ingest_stream, new_files
from tidewater.streaming.position import start_position
from tidewater.sources.whole_images import discover_schema, typed
from tidewater.streaming.landing import change_stream, land_accounted, land_changes, land_images

Query = Callable[[SparkSession, str], DataFrame]

# the orders run from 1995 on, so this calendar keeps every ride
FIRST_DAY = "1995-01-01"
# increments end before these days; the last one brings tips and no rides
CUTS = ("1998-01-01", "2000-01-01", "2001-08-02")
EVENT_CUTS = ("2024-01-11", "2024-01-21")
STORED_RIDES = T.StructType(
    [*src.RIDE_SCHEMA.fields, *(T.StructField(c, T.IntegerType()) for c in ("year", "month", "day"))]
)


def plain(df: DataFrame) -> DataFrame:
    """Types that every SQL engine prints alike: double, bigint, boolean, text."""
    out = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampNTZType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(column.alias(field.name))
    return df.select(out)


def between(df: DataFrame, day: str, cuts: Sequence[str], index: int) -> DataFrame:
    """The ``index``-th increment of rows cut by ``day``."""
    if index > 0:
        df = df.where(F.col(day) >= F.lit(cuts[index - 1]).cast("timestamp_ntz"))
    if index < len(cuts):
        df = df.where(F.col(day) < F.lit(cuts[index]).cast("timestamp_ntz"))
    return df


def calendar(spark: SparkSession) -> DataFrame:
    return date_dim(spark, first=FIRST_DAY)


# ---- dimensions and change records ----------------------------------------------------


def q_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the order and shipping days, with the rides of each day."""
    orders = src.read_table(spark, sf_dir, "orders")
    lines = src.read_table(spark, sf_dir, "lineitem")
    days = orders.select(F.col("o_orderdate").alias("d")).unionAll(lines.select("l_shipdate"))
    bounds = days.agg(F.min("d").cast("date"), F.max("d").cast("date")).first()
    rides = orders.groupBy(F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key"))
    return date_dim(spark, *bounds).join(
        rides.agg(F.count("*").alias("rides")), "date_key", "left"
    ).na.fill(0, ["rides"])


def q_date_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days as integer keys and back, and read from text that may be no day."""
    day = F.col("o_orderdate").cast("date")
    text = F.when(F.col("o_orderstatus") == "P", cleaning.MISSING).otherwise(
        F.date_format(day, dates.DAY_FORMAT)
    )
    return src.read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.day_to_key(day).alias("date_key"),
        dates.key_to_day(dates.day_to_key(day)).alias("from_key"),
        dates.to_day(text).alias("from_text"),
    )


def q_cdc_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as change records of all three events, with every kind of attribute."""
    customers = src.read_table(spark, sf_dir, "customer")
    in_debt = F.col("c_acctbal") < 0
    rows = customers.select(
        *customers.columns,
        in_debt.alias("in_debt"),
        F.when(in_debt, F.col("c_mktsegment")).alias("warned_as"),
        F.struct(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name")).alias("home"),
        F.array("c_mktsegment", "c_name").alias("tags"),
    )
    event = (
        F.when(F.col("c_mktsegment") == "BUILDING", "INSERT")
        .when(F.col("c_mktsegment") == "MACHINERY", "REMOVE").otherwise("MODIFY")
    )
    return encode_changes(rows, rows.schema, event, keys=("c_custkey",))


def q_cdc_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _change_rows(decode_changes(src.change_records(spark, sf_dir), src.EVENT_SCHEMA))


def _change_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "event_id", "ts", "user_id", "event_type", "value", F.col("props.k").alias("k"),
        F.col(OP).alias("op"),
    )


def q_cdc_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last state per user; users whose last change is a removal are gone."""
    rows = decode_changes(src.change_records(spark, sf_dir), src.EVENT_SCHEMA)
    newest = [F.desc_nulls_last("ts"), F.desc_nulls_last("event_id")]
    return _change_rows(latest_per_key(rows, ["user_id"], newest).where(F.col(OP) == UPSERT))


def q_cdc_apply_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All changes in one upsert, whose order is the records' place in their stream only."""
    place = F.concat(F.unix_micros(F.col("ts").cast("timestamp")), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    path = shared_dir(spark, "cdc_apply_batch")
    src.change_records(spark, sf_dir, place).write.text(f"{path}/changes")
    land_changes(
        change_stream(spark, f"{path}/changes"), src.EVENT_SCHEMA, f"{path}/raw", f"{path}/state",
        sequence=True,
    ).awaitTermination()
    table = KeyedTable.create(spark, f"{path}/users", src.EVENT_SCHEMA, "user_id", "user_id")
    table.upsert(spark.read.schema(landed_schema(src.EVENT_SCHEMA, sequence=True)).parquet(f"{path}/raw"))
    return _change_rows(table.snapshot().withColumn(OP, F.lit(UPSERT)))


def q_cdc_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All changes, shuffled into batches: late changes and late removals change nothing."""
    place = F.concat(F.unix_micros(F.col("ts").cast("timestamp")), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    path = shared_dir(spark, "cdc_out_of_order")
    rows = decode_changes(src.change_records(spark, sf_dir, place), src.EVENT_SCHEMA, sequence=True)
    rows = _staged(rows, path)
    table = KeyedTable.create(spark, f"{path}/users", src.EVENT_SCHEMA, "user_id", "user_id", ordered=True)
    batches = 4
    for index in range(batches):
        table.upsert(rows.where(F.pmod(F.xxhash64("event_id"), F.lit(batches)) == index))
        if index == 1:
            maintenance.compact(table)
    return _change_rows(table.snapshot().withColumn(OP, F.lit(UPSERT)))


def _with_broken_lines(lines: DataFrame) -> DataFrame:
    """Change lines (value, event_id), of 16 each one of seven kinds that can't be landed."""
    kind = F.pmod("event_id", F.lit(16))
    broken = (
        F.when(kind == 0, F.concat(F.lit("{"), "value"))
        .when(kind == 1, F.regexp_replace("value", '"eventName":"[^"]*"', '"eventName":"TRUNCATE"'))
        .when(kind == 2, F.concat(F.lit('{"eventName":"INSERT","dynamodb":"'), F.col("event_id").cast("string"), F.lit('"}')))
        .when(kind == 3, F.lit('{"eventName":"INSERT","dynamodb":{"NewImage":[1]}}'))
        .when(kind == 4, F.lit('{"eventName":"INSERT","dynamodb":{"NewImage":{"user_id":{"NULL":true}}}}'))
        .when(kind == 5, F.lit('{"eventName":"MODIFY","dynamodb":{}}'))
        .when(kind == 6, F.lit('{"dynamodb":{"NewImage":{"user_id":{"N":"1"}}}}'))
    )
    return lines.select(F.coalesce(broken, "value").alias("value"))


def q_cdc_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by what became of them: counted while landing, and read back from storage."""
    path = shared_dir(spark, "cdc_outcomes")
    rows = src.events(spark, sf_dir)
    lines = encode_changes(rows, src.EVENT_SCHEMA, src.event_name(), keys=("user_id",), kept=("event_id",))
    _with_broken_lines(lines).repartition(4).write.text(f"{path}/changes")
    for _ in range(2):
        land_accounted(
            change_stream(spark, f"{path}/changes", max_files=2), src.EVENT_SCHEMA, ["user_id"],
            f"{path}/raw", f"{path}/accounts", f"{path}/state",
        ).awaitTermination()
    counted = read_accounts(spark, f"{path}/accounts").groupBy("outcome", "reason").agg(F.sum("lines").alias("lines"))
    landed = read_landed(spark, f"{path}/raw", src.EVENT_SCHEMA).agg(
        F.lit("landed").alias(REASON), F.count("*").alias("stored"), F.sum("event_id").alias("ids")
    )
    aside = read_set_aside(spark, f"{path}/raw").groupBy(REASON).agg(F.count("*").alias("stored"), F.lit(0).cast("long").alias("ids"))
    stored = landed.unionByName(aside).withColumnRenamed(REASON, "reason")
    return counted.join(stored, "reason")


def q_cdc_new_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that bring more attributes half way, landed whole, under the schema they have."""
    path = shared_dir(spark, "cdc_new_attribute")
    rows = src.events(spark, sf_dir).select(
        "*", F.struct(F.upper("event_type").alias("name"), (F.col("value") * 2).alias("weight")).alias("channel"),
        F.array("event_type", F.lit("x")).alias("tags"),
    )
    for index in range(2):
        part = between(rows, "ts", EVENT_CUTS[:1], index)
        schema = rows.schema if index else src.EVENT_SCHEMA
        encode_changes(part, schema, src.event_name(), keys=("user_id",)).write.mode("append").text(f"{path}/changes")
        land_images(change_stream(spark, f"{path}/changes"), f"{path}/raw", f"{path}/state").awaitTermination()
    images = spark.read.parquet(f"{path}/raw").select("image", OP)
    found = typed(images, discover_schema(images))
    return found.select(
        F.col("event_id").cast("long"), "event_type", "value", F.col("props.k").cast("long").alias("k"),
        F.col("channel.name").alias("channel"), F.col("channel.weight").alias("weight"),
        F.array_join("tags", ",").alias("tags"), F.col(OP).alias("op"),
    )


def q_raw_land_and_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "raw_land_and_scan")
    rows = decode_changes(src.change_records(spark, sf_dir), src.EVENT_SCHEMA)
    land_raw(rows, path)
    return _change_rows(read_raw(spark, path, "parquet", rows.schema))


def q_stream_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-record files, decoded and landed by a stream; a second run adds nothing."""
    path = shared_dir(spark, "stream_land")
    src.change_records(spark, sf_dir).write.text(f"{path}/changes")
    for _ in range(2):
        stream = change_stream(spark, f"{path}/changes")
        land_changes(stream, src.EVENT_SCHEMA, f"{path}/raw", f"{path}/state").awaitTermination()
    # Spark reads a streamed folder through its sink log: each file counts once
    return _change_rows(spark.read.parquet(f"{path}/raw"))


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ride files into a keyed table; new files come in between two runs."""
    path = shared_dir(spark, "stream_ingest")
    table = _rides_table(spark, f"{path}/rides")
    raw = src.raw_rides(spark, sf_dir)
    for index in range(2):
        land_raw_rides = between(raw, "ride_date", CUTS[1:2], index)
        land_raw_rides.write.mode("append").parquet(f"{path}/raw")
        files = new_files(spark, f"{path}/raw", src.RIDE_SCHEMA)
        ingest_stream(
            files, table, f"{path}/state", silver.RIDE_PARTITIONS_SQL
        ).awaitTermination()
    return table.snapshot()


def q_stream_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ride files from the oldest on, and from the first that comes after those there at
    the start; both streams are started twice, in batches of bounded bytes."""
    path = shared_dir(spark, "stream_start")
    starts = ("oldest", "next")
    tables = {start: _rides_table(spark, f"{path}/rides_{start}") for start in starts}
    raw = src.raw_rides(spark, sf_dir)
    for index in range(2):
        between(raw, "ride_date", CUTS[1:2], index).write.mode("append").parquet(f"{path}/raw")
        for start, table in tables.items():
            since = start_position(spark, f"{path}/raw", f"{path}/start_{start}.json", start)
            files = new_files(spark, f"{path}/raw", src.RIDE_SCHEMA, max_bytes=512 * 1024 * 1024, since=since)
            ingest_stream(files, table, f"{path}/state_{start}", silver.RIDE_PARTITIONS_SQL).awaitTermination()
    shown = [table.snapshot().withColumn("start", F.lit(start)) for start, table in tables.items()]
    return shown[0].unionByName(shown[1])


# ---- silver functions -----------------------------------------------------------------


def q_silver_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.fill_nulls(src.raw_rides(spark, sf_dir))


def q_silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; labels bring null, ``None`` and empty texts."""
    labels = src.read_table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, "good").otherwise("None").alias("quality"),
        F.when(F.col("toxic") == 1, "null").otherwise("").alias("toxic"),
    )
    documents = src.read_table(spark, sf_dir, "documents")
    return cleaning.clean_text(documents.join(labels, "doc_id", "left"))


def q_flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = src.rides(spark, sf_dir)
    users = src.users(spark, sf_dir)
    nested = rides.join(users, "user_id").select(
        F.struct(
            F.col("ride_id").alias("id"),
            "fare",
            F.struct("user_id", "name", F.struct("state").alias("home")).alias("rider"),
        ).alias("ride"),
        "driver_id",
    )
    return cleaning.flatten(nested)


def q_sql_transformer_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.sql_transform(src.rides(spark, sf_dir), silver.RIDE_PARTITIONS_SQL)


def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = src.users(spark, sf_dir).select(F.lit("user").alias("kind"), "name").unionAll(
        src.drivers(spark, sf_dir).select(F.lit("driver").alias("kind"), "name")
    )
    return people.withColumn("id", cleaning.surrogate_key("name"))


# ---- keyed tables ---------------------------------------------------------------------


def _user_state(spark: SparkSession, sf_dir: str, name: str, scope: str) -> DataFrame:
    """Events as the moving state of users, in three upserts."""
    events = src.read_table(spark, sf_dir, "events").select(
        "user_id", F.col("event_type").alias("state"), "ts", "event_id", "value", "props"
    )
    table = KeyedTable.create(
        spark, f"{shared_dir(spark, name)}/users", events.schema,
        record_key="user_id", precombine="ts,event_id", partition_fields="state", scope=scope,
    )
    for index in range(len(EVENT_CUTS) + 1):
        table.upsert(between(events, "ts", EVENT_CUTS, index))
    return table.snapshot()


def q_upsert_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_state(spark, sf_dir, "upsert_global", "global")


def q_upsert_partition_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_state(spark, sf_dir, "upsert_partition_scoped", "partition")


def q_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest lines, the later ones in a log over a compacted, bucketed base."""
    lines = src.read_table(spark, sf_dir, "lineitem")
    table = KeyedTable.create(
        spark, shared_dir(spark, "upsert_bucketed"), lines.schema,
        record_key="l_orderkey,l_linenumber", precombine="l_shipdate", buckets=16, bucket_by="l_orderkey",
    )
    table.upsert(between(lines, "l_shipdate", CUTS[:1], 0))
    maintenance.compact(table)
    table.upsert(between(lines, "l_shipdate", CUTS[:1], 1))
    return table.snapshot()


def q_upsert_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = src.read_table(spark, sf_dir, "lineitem")
    table = KeyedTable.create(
        spark, shared_dir(spark, "upsert_composite_key"), lines.schema,
        record_key="l_orderkey,l_linenumber", precombine="l_shipdate",
    )
    for index in range(2):
        table.upsert(between(lines, "l_shipdate", CUTS[:1], index))
    return table.snapshot()


def q_hard_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete one user by key, then all users in debt by a list of keys."""
    users = src.users(spark, sf_dir)
    table = KeyedTable.create(
        spark, shared_dir(spark, "hard_delete"), users.schema, "user_id", "user_id",
        partition_fields="state",
    )
    table.upsert(users)
    table.delete("user_id", "7")
    table.delete_keys(users.where(F.col("balance") < 0).select("user_id"))
    return table.snapshot()


def _rides_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable.create(
        spark, path, STORED_RIDES, "ride_id", "ride_date",
        partition_fields="year", cluster_columns="pick_up_state",
    )


def _staged(df: DataFrame, path: str) -> DataFrame:
    """The rows written once, for plans that read them in several increments."""
    df.write.parquet(f"{path}/source")
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/source")


def _with_day_parts(rides: DataFrame) -> DataFrame:
    return rides.select("*", *day_parts(F.col("ride_date")))


def _rides_in_commits(
    spark: SparkSession, sf_dir: str, name: str, cuts: Sequence[str] = CUTS[:2]
) -> tuple[KeyedTable, str]:
    """Rides upserted in one commit per increment."""
    path = shared_dir(spark, name)
    table = _rides_table(spark, f"{path}/rides")
    rides = _staged(_with_day_parts(src.rides(spark, sf_dir)), path)
    for index in range(len(cuts) + 1):
        table.upsert(between(rides, "ride_date", cuts, index))
    return table, path


def q_incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _rides_in_commits(spark, sf_dir, "incremental_read")
    return table.incremental(begin=1)


def q_incremental_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of one consumer: the first rows, the next rows, nothing new."""
    path = shared_dir(spark, "incremental_resume")
    table = _rides_table(spark, f"{path}/rides")
    checkpoint = Checkpoint(spark, f"{path}/consumer")
    rides = _staged(_with_day_parts(src.rides(spark, sf_dir)), path)
    seen = []
    for run in (1, 2, 3):
        if run < 3:
            table.upsert(between(rides, "ride_date", CUTS[1:2], run - 1))
        increment = next_increment(table, "rides", checkpoint)
        seen.append(increment.rows().select("ride_id", "fare", F.lit(run).alias("run")))
        increment.done(checkpoint)
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


def q_as_of_savepoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table at a savepoint, after later commits, compaction and retention."""
    table, _ = _rides_in_commits(spark, sf_dir, "as_of_savepoint")
    commit = maintenance.create_savepoint(table, "before_2000", commit=2)
    maintenance.compact(table)
    maintenance.vacuum(table, keep=1)
    return table.snapshot(as_of=commit)


def q_commit_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _rides_in_commits(spark, sf_dir, "commit_list")
    table.delete("driver_id", cleaning.MISSING)
    return maintenance.show_commits(table).drop("committed_at")


def q_savepoint_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Savepoints with the number of rows the table had at each."""
    table, _ = _rides_in_commits(spark, sf_dir, "savepoint_list")
    counts = []
    for commit in (1, 3):
        maintenance.create_savepoint(table, commit=commit)
        counts.append(
            table.snapshot(commit).agg(F.lit(commit).alias("commit"), F.count("*").alias("rows_then"))
        )
    return maintenance.show_savepoints(table).join(counts[0].unionAll(counts[1]), "commit")


def q_clustered_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _rides_in_commits(spark, sf_dir, "clustered_snapshot")
    maintenance.cluster(table, "pick_up_state")
    return table.snapshot()


def q_vacuumed_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each increment is compacted; the oldest versions are then removed."""
    path = shared_dir(spark, "vacuumed_snapshot")
    table = _rides_table(spark, f"{path}/rides")
    rides = _staged(_with_day_parts(src.rides(spark, sf_dir)), path)
    cuts = ("1997-01-01", "1998-01-01", "2000-01-01")
    for index in range(len(cuts) + 1):
        table.upsert(between(rides, "ride_date", cuts, index))
        maintenance.compact(table)
    maintenance.vacuum(table)
    return table.snapshot()


def q_catalog_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog name after one more commit, compaction and retention."""
    path = shared_dir(spark, "catalog_view")
    table = _rides_table(spark, f"{path}/rides")
    rides = _staged(_with_day_parts(src.rides(spark, sf_dir)), path)
    table.upsert(between(rides, "ride_date", CUTS[1:2], 0))
    database = f"silver_{uuid.uuid4().hex}"
    name = catalog.register(table, database, "rides", f"{path}/database")
    table.upsert(between(rides, "ride_date", CUTS[1:2], 1))
    maintenance.compact(table)
    maintenance.vacuum(table, keep=1)
    return spark.sql(f"SELECT * FROM {name}")


def q_catalog_view_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog name right after commits that update, add and delete, none of them compacted."""
    path = shared_dir(spark, "catalog_view_pending")
    table = _rides_table(spark, f"{path}/rides")
    rides = _staged(_with_day_parts(src.rides(spark, sf_dir)), path)
    first, second = (between(rides, "ride_date", CUTS[1:2], i) for i in range(2))
    table.upsert(first.withColumn("pick_up_state", F.lit("old")))
    database = f"silver_{uuid.uuid4().hex}"
    name = catalog.register(table, database, "rides", f"{path}/database")
    table.upsert(first)
    table.upsert(second)
    table.delete("pick_up_state", "5-LOW")
    return spark.sql(f"SELECT * FROM {name}")


# ---- the earnings fact ----------------------------------------------------------------


def batch_earnings(spark: SparkSession, sf_dir: str, policy: str = "latest") -> DataFrame:
    return earn.earnings(
        src.rides(spark, sf_dir), src.tips(spark, sf_dir), calendar(spark), policy
    )


def q_earnings_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_earnings(spark, sf_dir)


def q_earnings_join_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides and tips kept in the same buckets: compacted halves, the others in the logs."""
    path = shared_dir(spark, "earnings_join_buckets")
    rides = KeyedTable.create(spark, f"{path}/rides", src.RIDE_SCHEMA, "ride_id", "ride_date", join_buckets=16)
    tips = KeyedTable.create(
        spark, f"{path}/tips", src.TIP_SCHEMA, "ride_id,tip_id", "tipped_on", join_buckets=16, bucket_by="ride_id"
    )
    for table, rows, day in (
        (rides, _staged(src.rides(spark, sf_dir), f"{path}/r"), "ride_date"),
        (tips, _staged(src.tips(spark, sf_dir), f"{path}/t"), "tipped_on"),
    ):
        for index in range(3):
            table.upsert(between(rows, day, CUTS[:2], index))
            if index < 2:
                maintenance.compact(table)
    return earn.earnings(rides.snapshot(), tips.snapshot(), calendar(spark))


def q_earnings_sum_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_earnings(spark, sf_dir, "sum")


def q_earnings_default_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the default calendar; rides before it drop out."""
    return earn.earnings(src.rides(spark, sf_dir), src.tips(spark, sf_dir), date_dim(spark))


def incremental_earnings(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    mode: str,
    cuts: Sequence[str],
    all_tips: DataFrame | None = None,
    after: Callable[[int, KeyedTable, KeyedTable, DataFrame], None] | None = None,
) -> KeyedTable:
    """Rides and tips in increments, the fact refreshed after each, then ``after`` called, also
    with the rides of all increments."""
    path = shared_dir(spark, name)
    rides = KeyedTable.create(spark, f"{path}/rides", src.RIDE_SCHEMA, "ride_id", "ride_date")
    tips = KeyedTable.create(
        spark, f"{path}/tips", src.TIP_SCHEMA, "tip_id", "tipped_on,tip_amount"
    )
    fact = earn.create_fact(spark, f"{path}/driver_earnings")
    checkpoint = Checkpoint(spark, f"{path}/consumer")
    all_rides = _staged(src.rides(spark, sf_dir), path)
    all_tips = src.raw_tips(spark, sf_dir) if all_tips is None else all_tips
    for index in range(len(cuts) + 1):
        rides.upsert(between(all_rides, "ride_date", cuts, index))
        tips.upsert(between(all_tips, "tipped_on", cuts, index))
        earn.refresh_earnings(rides, tips, fact, calendar(spark), checkpoint, mode)
        if after:
            after(index, rides, fact, all_rides)
    return fact


def q_earnings_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_earnings(spark, sf_dir, "earnings_incremental", "complete", CUTS).snapshot()


def q_earnings_incremental_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_earnings(
        spark, sf_dir, "earnings_incremental_reference", "reference", CUTS
    ).snapshot()


def q_earnings_tips_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rides first, then an increment that holds tips only."""
    return incremental_earnings(
        spark, sf_dir, "earnings_tips_only", "reference", CUTS[2:]
    ).snapshot()


def q_earnings_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides and tips as two joined streams, in four runs over one checkpoint.

    A tip comes as many days after its ride as its line number says; the first tips of old
    rides come at the very end, behind the watermark, and are settled.
    """
    path = shared_dir(spark, "earnings_streamed")
    rides = src.rides(spark, sf_dir).withColumn("ride_at", F.col("ride_date").cast("timestamp"))
    line = F.split("tip_id", "-")[1].cast("int")
    at = F.date_add("ride_date", line).cast("timestamp")
    # the last version of a tip is that of the last day, then the greatest amount
    amount = F.lpad((F.col("tip_amount") * 100).cast("decimal(20,0)").cast("string"), 20, "0")
    tips = (
        src.raw_tips(spark, sf_dir).join(rides.select("ride_id", "ride_date"), "ride_id")
        .withColumn("tipped_at", at)
        .withColumn("_seq", F.concat(F.date_format("tipped_on", "yyyyMMdd"), amount))
        .withColumn("_late", (line == 1) & (F.col("tipped_at") < F.lit(CUTS[0])))
    )
    feeds = {"rides": _staged(rides, f"{path}/all_rides"), "tips": _staged(tips, f"{path}/all_tips")}
    stream = EarningsStream(spark, f"{path}/earnings", calendar(spark), within=timedelta(days=10))
    for index in range(len(CUTS) + 1):
        for name, time in (("rides", "ride_at"), ("tips", "tipped_at")):
            rows = between(feeds[name], time, CUTS, index)
            if name == "tips":
                late = F.col("_late")
                rows = rows.where(~late)
                rows = rows.unionByName(feeds[name].where(late)) if index == len(CUTS) else rows
            rows.write.mode("append").parquet(f"{path}/feed/{name}")
        query = stream.start(*(new_files(spark, f"{path}/feed/{n}", f.schema) for n, f in feeds.items()))
        query.awaitTermination()
    stored = [spark.read.schema(f.schema).parquet(f"{path}/feed/{n}") for n, f in feeds.items()]
    stream.settle(*stored, stream.open_since(query))
    return stream.fact.snapshot()


# ---- gold -----------------------------------------------------------------------------


def q_gold_driver_month_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.driver_month_year(
        batch_earnings(spark, sf_dir), calendar(spark), src.drivers(spark, sf_dir)
    )


def q_gold_driver_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.driver_year(
        batch_earnings(spark, sf_dir), calendar(spark), src.drivers(spark, sf_dir)
    )


def q_gold_tips_by_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.tips_by_driver(batch_earnings(spark, sf_dir), src.drivers(spark, sf_dir))


def q_gold_top5_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_tipped_drivers(batch_earnings(spark, sf_dir), src.drivers(spark, sf_dir))


def q_gold_rides_month_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.rides_month_year(src.rides(spark, sf_dir))


def q_gold_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four views, queried by name and reduced to one line each."""
    gold.create_views(
        batch_earnings(spark, sf_dir), calendar(spark), src.drivers(spark, sf_dir),
        src.rides(spark, sf_dir),
    )
    return _one_line_each(spark)


def q_gold_by_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four views over sums that four refreshes of the fact have changed.

    Old rides of low priority are removed half way, late tips change prices.
    """
    sums = GoldSums(spark, shared_dir(spark, "gold_by_differences"))
    old = (F.col("pick_up_state") == "5-LOW") & (F.col("ride_date") < CUTS[0])

    def after(index: int, rides: KeyedTable, fact: KeyedTable, all_rides: DataFrame) -> None:
        sums.refresh(fact, rides, calendar(spark))
        if index == 1:
            rides.delete_keys(all_rides.where(old).select("ride_id"))

    incremental_earnings(spark, sf_dir, "gold_by_differences", "complete", CUTS, after=after)
    drivers = src.drivers(spark, sf_dir)
    frames = (sums.driver_month_year(drivers), sums.driver_year(drivers), sums.tips_by_driver(drivers), sums.rides_month_year())
    columns = ("driver_id", "driver_name", "year", "month")
    out = []
    for name, frame in zip(gold.VIEWS, frames):
        keys = [(F.col(c) if c in frame.columns else F.lit(None)).cast("string").alias(c) for c in columns]
        total = next(c for c in frame.columns if c not in columns)
        out.append(frame.select(F.lit(name).alias("view_name"), *keys, F.col(total).cast("double").alias("total")))
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3])


def _one_line_each(spark: SparkSession, prefix: str = "") -> DataFrame:
    measures = ("total_earnings", "total_earnings", "total_tips", "ride_count")
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{view}' AS view_name, count(*) AS n, cast(sum({measure}) AS double) AS total"
        f" FROM {prefix}{view}"
        for view, measure in zip(gold.VIEWS, measures)
    ))


def q_gold_catalog_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four views in the catalog, made early and read after more commits and retention."""
    path = shared_dir(spark, "gold_catalog_views")
    database = f"lake_{uuid.uuid4().hex}"
    rides = KeyedTable.create(spark, f"{path}/rides", src.RIDE_SCHEMA, "ride_id", "ride_date")
    drivers = src.drivers(spark, sf_dir)
    people = KeyedTable.create(spark, f"{path}/drivers", drivers.schema, "driver_id", "driver_id")
    fact = earn.create_fact(spark, f"{path}/driver_earnings")
    tables = {"rides": rides, "drivers": people, "fact": fact}
    people.upsert(drivers)
    all_rides = _staged(src.rides(spark, sf_dir), path)
    tips = src.tips(spark, sf_dir)
    for index in range(2):
        slice_ = between(all_rides, "ride_date", CUTS[1:2], index)
        rides.upsert(slice_)
        fact.upsert(earn.earnings(slice_, tips, calendar(spark)), unique=True)
        if index == 0:
            names = {k: catalog.register(t, database, k, f"{path}/database") for k, t in tables.items()}
            names["dim"] = f"`{database}`.`date_dim`"
            calendar(spark).write.option("path", f"{path}/date_dim").saveAsTable(names["dim"])
            gold.create_catalog_views(spark, database, **names)
    for table in tables.values():
        maintenance.compact(table)
        maintenance.vacuum(table, keep=1)
    return _one_line_each(spark, f"`{database}`.")


def q_pipeline_cdc_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records, raw files, silver tables, stored fact, gold: three runs of all steps.

    The last run removes the old rides of low priority.
    """
    path = shared_dir(spark, "pipeline_cdc_to_gold")
    rides = _rides_table(spark, f"{path}/rides")
    tips = KeyedTable.create(spark, f"{path}/tips", src.TIP_SCHEMA, "tip_id", "tipped_on,tip_amount")
    fact = earn.create_fact(spark, f"{path}/driver_earnings")
    checkpoint = Checkpoint(spark, f"{path}/consumer")
    all_rides = _staged(src.rides(spark, sf_dir), path)
    gone = all_rides.where((F.col("pick_up_state") == "5-LOW") & (F.col("ride_date") < CUTS[0]))
    feeds = (
        ("rides", all_rides, src.RIDE_SCHEMA, "ride_date", rides, silver.RIDE_PARTITIONS_SQL),
        ("tips", src.raw_tips(spark, sf_dir), src.TIP_SCHEMA, "tipped_on", tips, None),
    )
    for index in range(3):
        for name, rows, schema, day, table, sql in feeds:
            changes = encode_changes(between(rows, day, CUTS[:2], index), schema, F.lit("INSERT"))
            if index == 2 and name == "rides":
                changes = changes.unionAll(encode_changes(gone, schema, F.lit("REMOVE"), ("ride_id",)))
            changes.write.mode("append").text(f"{path}/changes/{name}")
            land_changes(
                change_stream(spark, f"{path}/changes/{name}"), schema, f"{path}/raw/{name}",
                f"{path}/state/land_{name}",
            ).awaitTermination()
            ingest_stream(
                new_files(spark, f"{path}/raw/{name}", landed_schema(schema)), table,
                f"{path}/state/ingest_{name}", sql,
            ).awaitTermination()
        earn.refresh_earnings(rides, tips, fact, calendar(spark), checkpoint)
        if index == 1:
            maintenance.compact(rides)
            maintenance.compact(fact)
    return gold.driver_month_year(fact.snapshot(), calendar(spark), src.drivers(spark, sf_dir))


def registered() -> dict[str, Query]:
    """All ``q_`` functions by name, with results in plain types."""

    def plainly(query: Query) -> Query:
        return lambda spark, sf_dir: plain(query(spark, sf_dir))

    return {
        name.removeprefix("q_"): plainly(query)
        for name, query in globals().items()
        if name.startswith("q_")
    }
