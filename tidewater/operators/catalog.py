"""Catalog names of a keyed table: they show every commit as soon as it is written.

A name is a SQL view over two external tables: the newest base, and the log after it,
to which every commit adds its partitions.  The view ranks the log's rows by key and
passes base rows whose key is not in the log, as :meth:`KeyedTable.snapshot` does.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched
from urllib.parse import unquote

from tidewater import paths
from tidewater.operators import bucketed
from tidewater.operators.keyed_table import BUCKET, COMMIT, Base, KeyedTable
from tidewater.sources.change_records import OP, UPSERT

# so many partitions are added by one statement
ADDED_AT_ONCE = 500
# how Spark names the folder of a null partition value
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def register(table: KeyedTable, database: str, name: str, location: str | None = None) -> str:
    """Show the table in the catalog under a name that stays readable.

    What is pending is compacted first.  From then on every commit is seen under the name
    once it is written, and every compaction or clustering moves the name on to its base;
    :func:`~tidewater.operators.maintenance.vacuum` spares what it shows.  A commit whose
    writer broke off before the catalog learned of it is seen with the next one.  Columns
    added to the table are seen from the next compaction on.
    """
    from tidewater.operators.maintenance import compact

    compact(table)
    bases = table.bases()
    if not bases:
        raise ValueError(f"{table.path} has no commit to register")
    full = f"`{database}`.`{name}`"
    known = table.registered().get(full, {"database": database, "name": name, "location": location})
    _show(table, full, known, bases[-1])
    return full


def unregister(table: KeyedTable, database: str, name: str) -> None:
    """Take the name out of the catalog; the table stays."""
    full = f"`{database}`.`{name}`"
    entries = table.registered()
    entry = entries.pop(full)
    table.spark.sql(f"DROP VIEW IF EXISTS {full}")
    for version in _versions(entry):
        table.spark.sql(f"DROP TABLE IF EXISTS {version}")
    paths.write_json(table.spark, f"{table.path}/registered.json", entries)


def shown(table: KeyedTable, base: Base) -> Base:
    """The new base, with all catalog names moved on to it."""
    for full, entry in table.registered().items():
        _show(table, full, entry, base)
    return base


def follow(table: KeyedTable) -> None:
    """Let all catalog names show the commits that they don't know yet."""
    for full, entry in table.registered().items():
        if "seen" in entry:  # names of older tables move with their bases only
            _show_log(table, full, entry)


def _versions(entry: dict) -> tuple[str, str]:
    """Catalog names of the tables behind a registered name: base and log."""
    upto, rev = entry["base"]
    stem = f"`{entry['database']}`.`{entry['name']}"
    return f"{stem}_upto_{upto}_rev_{rev}`", f"{stem}_after_{upto}_rev_{rev}`"


def _external(table: KeyedTable, name: str, extra: dict[str, str], layout: tuple[str, ...], path: str) -> None:
    """An external Parquet table with the columns of the keyed table and ``extra`` ones."""
    types = {f.name: f.dataType.simpleString() for f in table.schema}
    types |= ({BUCKET: "int"} if table.buckets else {}) | extra
    columns = ", ".join(f"`{c}` {kind}" for c, kind in types.items())
    partitioned = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in layout)})" if layout else ""
    # a base in join buckets is one under its catalog name too
    buckets = bucketed.clause(table) if COMMIT not in layout else ""
    table.spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitioned}{buckets} LOCATION {paths.sql_text(path)}"
    )


def _show(table: KeyedTable, full: str, entry: dict, base: Base) -> None:
    spark = table.spark
    new = {**entry, "base": [base.upto, base.rev], "seen": base.upto}
    at = f" LOCATION {paths.sql_text(entry['location'])}" if entry["location"] else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{entry['database']}`{at}")
    stored, log = _versions(new)
    marks = {OP: "string"} if table.ordered else {}
    _external(table, stored, {**marks, COMMIT: "bigint"}, table.layout, base.path)
    if table.layout:
        spark.catalog.recoverPartitions(stored)
    _external(table, log, {OP: "string", COMMIT: "bigint"}, (COMMIT, *table.layout), f"{table.path}/log")
    spark.sql(f"CREATE OR REPLACE VIEW {full} AS {_newest(table, stored, log, base.upto)}")
    _note(table, full, new)
    if "base" in entry and entry["base"] != new["base"]:
        for version in _versions(entry):
            spark.sql(f"DROP TABLE IF EXISTS {version}")
    _show_log(table, full, new)


def _newest(table: KeyedTable, stored: str, log: str, upto: int) -> str:
    """SQL of the rows as they are now.

    The filter on commits takes none away.  A partitioned table without statistics counts
    as huge; pruned by a filter its size is that of its files, so a small log is broadcast.
    """
    names = ", ".join(f"`{c}`" for c in table.columns)
    keys = ", ".join(f"`{c}`" for c in table.key)
    # a null partition value matches itself
    same = " AND ".join(
        f"kept.`{c}` {'<=>' if c in table.partition_fields else '='} changed.`{c}`" for c in table.key
    )
    after = f"(SELECT * FROM {log} WHERE `{COMMIT}` > {upto})"
    live = f"WHERE kept.`{OP}` = '{UPSERT}'" if table.ordered else ""
    return f"""
SELECT {names} FROM {stored} AS kept LEFT ANTI JOIN {after} AS changed ON {same} {live}
UNION ALL
SELECT {names} FROM (
  SELECT {names}, `{OP}`, row_number() OVER (PARTITION BY {keys} ORDER BY `{COMMIT}` DESC) AS _place FROM {after}
) WHERE _place = 1 AND `{OP}` = '{UPSERT}'"""


def _show_log(table: KeyedTable, full: str, entry: dict) -> None:
    """Add the finished commits that the name doesn't show yet to its log table."""
    commits = table.commits_between(int(entry["seen"]))
    if not commits:
        return
    _, log = _versions(entry)
    for some in batched((p for c in commits for p in _partitions(table, c)), ADDED_AT_ONCE):
        table.spark.sql(f"ALTER TABLE {log} ADD IF NOT EXISTS {' '.join(some)}")
    _note(table, full, {**entry, "seen": commits[-1]})


def _partitions(table: KeyedTable, commit: int) -> Iterator[str]:
    """The folders of a commit as SQL partitions; their names only are read."""
    path = table.commit_path(commit)
    if not table.layout:
        yield f"PARTITION (`{COMMIT}` = {commit}) LOCATION {paths.sql_text(path)}"
        return
    depth = len(table.layout)
    for folder in paths.glob(table.spark, "/".join([path, *(f"{c}=*" for c in table.layout)])):
        values = [part.partition("=")[2] for part in folder.split("/")[-depth:]]
        spec = ", ".join(
            f"`{c}` = {'null' if v == NULL_FOLDER else paths.sql_text(unquote(v))}" for c, v in zip(table.layout, values)
        )
        yield f"PARTITION (`{COMMIT}` = {commit}, {spec}) LOCATION {paths.sql_text(folder)}"


def _note(table: KeyedTable, full: str, entry: dict) -> None:
    paths.write_json(table.spark, f"{table.path}/registered.json", {**table.registered(), full: entry})
