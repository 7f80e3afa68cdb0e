"""Raw rows into a keyed silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from tidewater.functions.cleaning import fill_nulls, sql_transform, to_schema
from tidewater.operators.keyed_table import KeyedTable
from tidewater.operators.latest import SEQ

# fixed value: the SQL that derives the ride partitions
RIDE_PARTITIONS_SQL = """
SELECT *, extract(year from ride_date) as year, extract(month from ride_date) as month,
       extract(day from ride_date) as day
FROM temp;
"""


def prepare(raw: DataFrame, table: KeyedTable, sql: str | None = None) -> DataFrame:
    """Typed columns, then user SQL, then the placeholder for null strings.

    Typing comes first: under ANSI a placeholder in a date or amount would fail.
    """
    derived = set(table.columns) - set(raw.columns)
    source = T.StructType([f for f in table.schema if f.name not in derived])
    rows = to_schema(raw, source)
    if sql:
        rows = sql_transform(rows, sql)
    rows = to_schema(rows, table.schema)
    # a null key stays null, for the upsert to refuse: filled, such rows would merge
    return fill_nulls(rows, [c for c in rows.columns if c not in (*table.record_key, SEQ)])


def ingest(
    raw: DataFrame,
    table: KeyedTable,
    sql: str | None = None,
    source: tuple[str, int] | None = None,
) -> int | None:
    """Upsert a raw batch; the commit, or None for an empty batch."""
    return table.upsert(prepare(raw, table, sql), source=source)
