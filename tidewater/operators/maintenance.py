"""Jobs on a keyed table: compaction, clustering, savepoints, retention."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewater import paths
from tidewater.functions.cleaning import split_names
from tidewater.operators import bucketed
from tidewater.operators.catalog import shown
from tidewater.operators.keyed_table import COMMIT, Base, KeyedTable
from tidewater.sources.change_records import DELETE, OP, UPSERT

# fixed values: default sizing and retention
MAX_FILE_BYTES = 512 * 1024 * 1024
SMALL_FILE_BYTES = 100 * 1024 * 1024
CLUSTER_FILE_BYTES = 1024 * 1024 * 1024
# so many stored bytes are sorted by one task; in memory narrow rows take about 12 times that
SORTED_BYTES = 32 * 1024 * 1024
KEPT_VERSIONS = 3
LISTED_COMMITS = 5


def compact(
    table: KeyedTable,
    min_commits: int = 1,
    max_file_bytes: int = MAX_FILE_BYTES,
    small_file_bytes: int = SMALL_FILE_BYTES,
) -> Base | None:
    """Fold the log into a new base once it has ``min_commits``; None if it has not.

    The base is written as it is read, without a shuffle, unless it would come in
    many small files; then they are merged up to ``max_file_bytes``, or to what one
    task sorts if that is less.
    """
    base, log = table.files_at(None)
    if not log or len(log) < min_commits:
        return None
    rows = table.state()
    parts = table.usage(log, base)
    stored, files = sum(p.bytes for p in parts), sum(p.files for p in parts)
    tasks = _tasks(stored, max_file_bytes)
    # every partition folder has a file of its own in any case
    needed = max(tasks, *(p.folders for p in parts))
    if not table.join_buckets and files > 2 * needed and stored / files < small_file_bytes:
        rows = _in_files(table.with_layout(rows), tasks, (*table.layout, *table.key))
    return shown(table, table.write_base(rows, log[-1]))


def cluster(
    table: KeyedTable,
    columns: str | Sequence[str] = (),
    target_file_bytes: int = CLUSTER_FILE_BYTES,
) -> Base | None:
    """Rewrite the table as a base sorted by ``columns`` in files of a target size, or of
    what one task sorts if that is less."""
    if table.join_buckets:
        raise ValueError(f"{table.path} is kept in join buckets, sorted by its key")
    upto = table.last_commit()
    if upto is None:
        return None
    base, log = table.files_at(None)
    stored = sum(part.bytes for part in table.usage(log, base))
    order = (
        *table.layout,
        *(split_names(columns) or table.cluster_columns),
        *table.key,
    )
    rows = table.with_layout(table.state())
    return shown(table, table.write_base(_in_files(rows, _tasks(stored, target_file_bytes), order), upto))


def _tasks(stored: int, file_bytes: int) -> int:
    """How many tasks write so many bytes: a sort in memory doesn't grow with the table."""
    return math.ceil(stored / min(file_bytes, SORTED_BYTES))


def _in_files(rows: DataFrame, files: int, order: Sequence[str]) -> DataFrame:
    """Range-partitioned and sorted; the key ends the order, so the ranges of a
    value that holds a third of the rows are split like any other."""
    order = list(dict.fromkeys(order))
    return rows.repartitionByRange(max(1, files), *order).sortWithinPartitions(*order)


def show_commits(table: KeyedTable, n: int = LISTED_COMMITS) -> DataFrame:
    """The newest ``n`` commits with their time and row counts, newest first."""
    newest = table.commits()[-n:]
    if not newest:
        return table.spark.createDataFrame(
            [], "commit long, committed_at timestamp, upserts long, deletes long"
        )
    written = F.col("_metadata.file_modification_time").alias("_at")
    return (
        table.log_scan(newest)
        .select(COMMIT, OP, written)
        .groupBy(F.col(COMMIT).alias("commit"))
        .agg(
            F.max("_at").alias("committed_at"),
            F.count_if(F.col(OP) == UPSERT).alias("upserts"),
            F.count_if(F.col(OP) == DELETE).alias("deletes"),
        )
        .orderBy(F.desc("commit"))
    )


def create_savepoint(table: KeyedTable, name: str | None = None, commit: int | None = None) -> int:
    """Pin a commit (the latest by default) against :func:`vacuum`."""
    commit = table.last_commit() if commit is None else commit
    if commit is None:
        raise ValueError(f"{table.path} has no commit to pin")
    table.check_readable(commit)
    state = {**table.savepoints(), name or f"commit_{commit}": commit}
    paths.write_json(table.spark, f"{table.path}/savepoints.json", state)
    return commit


def show_savepoints(table: KeyedTable) -> DataFrame:
    rows = sorted(table.savepoints().items(), key=lambda item: (item[1], item[0]))
    return table.spark.createDataFrame(rows, "savepoint string, commit long")


def vacuum(table: KeyedTable, keep: int = KEPT_VERSIONS) -> list[str]:
    """Keep the newest ``keep`` bases and the log after the oldest of them.

    What a savepoint needs stays too: the newest base at or before it and the log
    between; so do the bases that catalog names show.  Bases whose writing broke off
    before the newest one go.  Returns the removed directories.
    """
    if keep < 1:
        raise ValueError("at least one version has to stay")
    bases = table.bases()
    if len(bases) < keep:
        return []
    kept = set(bases[-keep:])
    floor = bases[-keep].upto
    commits = table.commits()
    kept_commits = {c for c in commits if c > floor}
    for pinned in table.savepoints().values():
        base, log = table.files_at(pinned)
        if base:
            kept.add(base)
        kept_commits.update(log)
    # names show a base and the log after it
    in_catalog = [tuple(entry["base"]) for entry in table.registered().values()]
    kept.update(b for b in bases if (b.upto, b.rev) in in_catalog)
    kept_commits.update(c for c in commits if any(c > upto for upto, _ in in_catalog))
    gone = [b.path for b in bases if b not in kept]
    done = {(b.upto, b.rev) for b in bases}
    gone += [b.path for b in table.started_bases() if (b.upto, b.rev) not in done and b < bases[-1]]
    # folders of broken-off writes go as well; a running one has a later number
    started = table.commits(finished=False)
    gone += [table.commit_path(c) for c in started if c <= floor and c not in kept_commits]
    # readers learn of the new limit before anything disappears; it never goes back, since
    # the oldest of the newest bases is never older than at the run before
    last = paths.read_json(table.spark, f"{table.path}/retention.json") or {"floor": 0}
    paths.write_json(
        table.spark, f"{table.path}/retention.json", {"floor": max(floor, int(last["floor"]))}
    )
    for base in set(bases) - kept:
        bucketed.forget(table, base)
    for path in gone:
        paths.delete(table.spark, path)
    return gone
