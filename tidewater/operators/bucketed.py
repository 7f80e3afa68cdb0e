"""Bases of a keyed table as bucketed Spark tables: joins on the buckets need no exchange.

A bucketed layout is known to Spark by the catalog only.  The entry is an external table
over the base's folder; where a catalog lacks it, as in a new session without a shared
metastore, it is made again from the table's definition, without reading data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

from tidewater.paths import sql_text
from tidewater.sources.change_records import OP, SEQ

if TYPE_CHECKING:
    from tidewater.operators.keyed_table import Base, KeyedTable

DATABASE = "tidewater_bases"
KEEP_BUCKETS = "spark.sql.sources.bucketing.autoBucketedScan.enabled"


def clause(table: KeyedTable) -> str:
    """The layout in SQL; empty for a table without join buckets."""
    if not table.join_buckets:
        return ""
    by, order = (", ".join(f"`{c}`" for c in names) for names in (table.bucket_by, table.record_key))
    return f" CLUSTERED BY ({by}) SORTED BY ({order}) INTO {table.join_buckets} BUCKETS"


def table_over(table: KeyedTable, base: Base) -> str:
    """Catalog name of a base, which is entered if it isn't known."""
    types = {f.name: f.dataType.simpleString() for f in table.schema} | {"_commit": "bigint"}
    types |= {SEQ: "string", OP: "string"} if table.ordered else {}
    columns = ", ".join(f"`{c}` {kind}" for c, kind in types.items())
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in table.layout)})" if table.layout else ""
    name = _name(table, base)
    if not table.spark.catalog.tableExists(name):
        table.spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
        table.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{clause(table)} LOCATION {sql_text(base.path)}"
        )
        if table.layout:
            table.spark.catalog.recoverPartitions(name)
    return name


def write(table: KeyedTable, rows: DataFrame, base: Base) -> None:
    """Store rows as a bucketed base: one sorted file for each bucket, in each partition.

    Rows that come from an older base stay in their buckets, without an exchange.
    """
    table.spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
    forget(table, base)
    if not table.bases():
        rows = rows.repartition(table.join_buckets, *table.bucket_by)
    writer = table.writer(rows).bucketBy(table.join_buckets, *table.bucket_by).sortBy(*table.record_key)
    with _kept_buckets(table.spark):
        writer.option("path", base.path).saveAsTable(_name(table, base))


def forget(table: KeyedTable, base: Base) -> None:
    """Take a base out of the catalog, under every definition it had; its files stay."""
    spark = table.spark
    if not table.join_buckets or not spark.catalog.databaseExists(DATABASE):
        return
    stem = _name(table, base).partition(".")[2].rpartition("_")[0]
    for entry in spark.catalog.listTables(DATABASE, f"{stem}_*"):
        spark.sql(f"DROP TABLE IF EXISTS {DATABASE}.`{entry.name}`")


def _name(table: KeyedTable, base: Base) -> str:
    # added columns make another entry over the same files
    place = hashlib.sha256(table.path.encode()).hexdigest()[:32]
    return f"{DATABASE}.base_{place}_{base.upto}_{base.rev}_{len(table.columns)}"


@contextmanager
def _kept_buckets(spark: SparkSession) -> Iterator[None]:
    """Scans keep their buckets, though no join or aggregate above them asks for that."""
    before = spark.conf.get(KEEP_BUCKETS)
    spark.conf.set(KEEP_BUCKETS, "false")
    try:
        yield
    finally:
        spark.conf.set(KEEP_BUCKETS, before)
