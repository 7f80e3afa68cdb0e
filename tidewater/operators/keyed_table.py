"""Keyed, mutable tables over append-only Parquet.

A table is a folder::

    table.json                   keys, ordering, partitioning, schema
    log/_commit=<n>/             rows of one commit plus ``_op`` (U or D)
    base/upto=<n>/rev=<k>/       compacted rows up to commit n, with their ``_commit``
    sources/<stream>.json        last batch of a stream, its commit, whether it is done
    savepoints.json              name -> commit
    retention.json               commit after which the log is whole
    registered.json              catalog names, the base and the last commit each of them shows

A bucketed table has a folder ``_bucket=<b>`` for each hash value of its keys below every
commit and base.  Each commit holds a key once.  A directory counts only when it has its
``_SUCCESS`` marker, so a half-written commit is never read, and no directory is
rewritten while a plan may be reading it.  One writer per table is assumed.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from tidewater import paths
from tidewater.functions.cleaning import split_names
from tidewater.operators import bucketed
from tidewater.operators.latest import latest_per_key, newest_first, place
from tidewater.session import no_rows
from tidewater.sources.change_records import DELETE, OP, SEQ, UPSERT

COMMIT, BUCKET = "_commit", "_bucket"
SCOPES = ("global", "partition")
# so many partition values, a few dozen bytes each, are safe to broadcast
BROADCAST_PARTITIONS = 50_000
# a plan names the buckets that it reads, so there are not too many of them
MOST_BUCKETS = 10_000


class HistoryLost(ValueError):
    """Retention has removed commits that the read needs."""


@dataclass(frozen=True, order=True)
class Base:
    """One compacted version of a table."""

    upto: int
    rev: int
    path: str


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        spec = paths.read_json(spark, f"{self.path}/table.json")
        if spec is None:
            raise ValueError(f"no keyed table at {path}")
        self.schema = T.StructType.fromJson(spec["schema"])
        self.record_key = tuple(spec["record_key"])
        self.precombine = tuple(spec["precombine"])
        self.partition_fields = tuple(spec["partition_fields"])
        self.cluster_columns = tuple(spec["cluster_columns"])
        self.scope = spec["scope"]
        self.codec = spec["codec"]
        self.max_records_per_file = int(spec["max_records_per_file"])
        self.buckets = int(spec.get("buckets", 0))
        self.bucket_by = tuple(spec.get("bucket_by", ()))
        self.join_buckets = int(spec.get("join_buckets", 0))
        self.ordered = bool(spec.get("ordered", False))

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        record_key: str | Sequence[str],
        precombine: str | Sequence[str],
        partition_fields: str | Sequence[str] = (),
        cluster_columns: str | Sequence[str] = (),
        scope: str = "global",
        codec: str = "gzip",
        max_records_per_file: int = 0,
        buckets: int = 0,
        bucket_by: str | Sequence[str] = (),
        ordered: bool = False,
        evolve: bool = False,
        join_buckets: int = 0,
    ) -> KeyedTable:
        """Make an empty table, or open it if it is there already.

        ``scope="global"`` keeps one row per record key; ``"partition"`` keeps one
        per record key and partition.  ``cluster_columns`` deals every commit into
        files by ranges of them.  ``max_records_per_file`` caps file length (0: no cap).

        ``buckets`` lays a table without partition fields out by the hash of ``bucket_by``,
        columns of its record key (all of them by default).  A key stays in its bucket, so
        reads leave alone the buckets that a change can't be in.

        ``join_buckets`` keeps every base as a Spark table in that many buckets of ``bucket_by``,
        sorted by the record key.  Joins of compacted tables on these columns need no exchange;
        aggregates by them leave the base where it is, also with a log over it.  So do compaction
        and the upsert match, this if ``bucket_by`` is the whole record key or the log can be
        broadcast.  A join exchanges a table with a pending log: Spark loses track of how the
        union is partitioned once a filter or an alias stands below it.

        ``ordered`` keeps the ``_seq`` of every row and of every deleted key, and a change
        that comes after a later one of its key, in whatever batch, is left out.  Deleted keys
        stay in storage for that, in bases too.

        A table that is there must have this definition.  With ``evolve`` it takes over
        nullable columns added at the end of the schema, which are null in rows stored
        before, and another clustering, codec or file length for later writes.
        """
        if scope not in SCOPES:
            raise ValueError(f"scope is one of {SCOPES}, not {scope!r}")
        spec = {
            "schema": json.loads(schema.json()),
            "record_key": split_names(record_key),
            "precombine": split_names(precombine),
            "partition_fields": split_names(partition_fields),
            "cluster_columns": split_names(cluster_columns),
            "scope": scope,
            "codec": codec,
            "max_records_per_file": max_records_per_file,
        }
        if buckets:
            spec |= {"buckets": buckets, "bucket_by": split_names(bucket_by) or spec["record_key"]}
            if spec["partition_fields"] or not 0 < buckets <= MOST_BUCKETS:
                raise ValueError(f"buckets are 1 to {MOST_BUCKETS}, on a table without partition fields")
            if set(spec["bucket_by"]) - set(spec["record_key"]):
                raise ValueError("a table is bucketed by columns of its record key")
        if join_buckets:
            by = split_names(bucket_by) or spec["record_key"]
            spec |= {"join_buckets": join_buckets, "bucket_by": by}
            if buckets or scope != "global" or join_buckets < 0 or set(spec["record_key"]) & set(spec["partition_fields"]):
                raise ValueError("join buckets are for a global scope, without other buckets or a partition by key")
            if set(by) - set(spec["record_key"]):
                raise ValueError("a table is bucketed by columns of its record key")
        if ordered:
            spec |= {"ordered": True}
        names = set(schema.fieldNames())
        roles = ("record_key", "precombine", "partition_fields", "cluster_columns")
        unknown = [c for role in roles for c in spec[role] if c not in names]
        if unknown or not spec["record_key"]:
            raise ValueError(f"columns that are not in the schema: {unknown}, or no record key")
        target = f"{path.rstrip('/')}/table.json"
        stored = paths.read_json(spark, target)
        if stored is None:
            paths.write_json(spark, target, spec)
        elif stored != json.loads(json.dumps(spec)):
            if not evolve or not _may_follow(stored, json.loads(json.dumps(spec))):
                raise ValueError(f"{path} holds a table with another definition")
            paths.write_json(spark, target, spec)
        return cls(spark, path)

    # ---- what is on storage ----------------------------------------------------------

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def key(self) -> tuple[str, ...]:
        """Columns that identify a row, given the scope."""
        if self.scope == "partition":
            own = tuple(c for c in self.partition_fields if c not in self.record_key)
            return (*own, *self.record_key)
        return self.record_key

    @property
    def layout(self) -> tuple[str, ...]:
        """Columns that name the folders within a commit or base."""
        return (BUCKET,) if self.buckets else self.partition_fields

    def with_layout(self, rows: DataFrame) -> DataFrame:
        """``rows``, with their bucket if the table has any."""
        return rows.withColumn(BUCKET, self._bucket()) if self.buckets else rows

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def buckets_of(self, keys: DataFrame) -> set[int] | None:
        """Buckets that ``keys`` fall into, no more than the table has; None for all, as when
        key columns are missing or of another type, so that equal ones may differ in hash."""
        types = {f.name: f.dataType for f in keys.schema}
        if not self.buckets or any(types.get(c) != self.schema[c].dataType for c in self.bucket_by):
            return None
        return {row[0] for row in keys.select(self._bucket()).distinct().collect()}

    def _buckets_in(self, commits: Sequence[int]) -> set[int] | None:
        """Buckets that commits have a folder of; None for all."""
        if not self.buckets:
            return None
        found = [p for c in commits for p in paths.glob(self.spark, f"{self.commit_path(c)}/{BUCKET}=*")]
        return {int(p.rsplit("=", 1)[1]) for p in found}

    def commit_path(self, commit: int) -> str:
        return f"{self.path}/log/{COMMIT}={commit}"

    def commits(self, finished: bool = True) -> list[int]:
        """Commits still in the log, oldest first; with unfinished ones on demand."""
        marker = "/_SUCCESS" if finished else ""
        found = paths.glob(self.spark, f"{self.path}/log/{COMMIT}=*{marker}")
        return sorted(int(re.search(rf"/{COMMIT}=(\d+)", p)[1]) for p in found)

    def bases(self) -> list[Base]:
        """Complete compacted versions, oldest first."""
        found = []
        for marker in paths.glob(self.spark, f"{self.path}/base/upto=*/rev=*/_SUCCESS"):
            upto, rev = re.search(r"/upto=(\d+)/rev=(\d+)/", marker).groups()
            found.append(Base(int(upto), int(rev), marker.rsplit("/", 1)[0]))
        return sorted(found)

    def started_bases(self) -> list[Base]:
        """Compacted versions with a folder, finished or not."""
        found = []
        for path in paths.glob(self.spark, f"{self.path}/base/upto=*/rev=*"):
            upto, rev = re.search(r"/upto=(\d+)/rev=(\d+)$", path).groups()
            found.append(Base(int(upto), int(rev), path))
        return sorted(found)

    def last_commit(self) -> int | None:
        known = [*self.commits(), *(b.upto for b in self.bases())]
        return max(known, default=None)

    def savepoints(self) -> dict[str, int]:
        return paths.read_json(self.spark, f"{self.path}/savepoints.json") or {}

    def floor(self) -> int:
        """The log holds every commit after this one."""
        state = paths.read_json(self.spark, f"{self.path}/retention.json")
        if state is None:
            # every base ends in a commit of the log until retention removes it
            if {b.upto for b in self.bases()} - set(self.commits()):
                raise HistoryLost(f"{self.path}: the log has gaps and retention.json is missing")
            return 0
        return int(state["floor"])

    def registered(self) -> dict[str, dict]:
        """Catalog names that show this table, see :func:`catalog.register`."""
        return paths.read_json(self.spark, f"{self.path}/registered.json") or {}

    def check_readable(self, commit: int) -> None:
        if commit < self.floor() and commit not in self.savepoints().values():
            raise HistoryLost(f"{self.path}: commit {commit} is older than the kept history")

    def files_at(self, as_of: int | None) -> tuple[Base | None, list[int]]:
        """Newest base and the commits after it that make up the table at ``as_of``."""
        wanted = [b for b in self.bases() if as_of is None or b.upto <= as_of]
        base = wanted[-1] if wanted else None
        after = base.upto if base else 0
        log = [c for c in self.commits() if c > after and (as_of is None or c <= as_of)]
        return base, log

    # ---- reads -----------------------------------------------------------------------

    def _with(self, *extra: tuple[str, T.DataType]) -> T.StructType:
        return T.StructType([*self.schema.fields, *(T.StructField(n, t) for n, t in extra)])

    def log_scan(self, commits: Sequence[int]) -> DataFrame:
        """Files of the named commits, with ``_op``, ``_commit``, a bucket and ``_seq``."""
        stored = self._with((OP, T.StringType()), (COMMIT, T.LongType()), *self._hidden())
        if not commits:
            return no_rows(self.spark, stored)
        reader = self.spark.read.schema(stored).option("basePath", f"{self.path}/log")
        return reader.parquet(*[self.commit_path(c) for c in commits])

    def _hidden(self) -> list[tuple[str, T.DataType]]:
        bucket = [(BUCKET, T.IntegerType())] if self.buckets else []
        return bucket + ([(SEQ, T.StringType())] if self.ordered else [])

    @property
    def _order(self) -> list[str]:
        return [SEQ] if self.ordered else []

    def read_log(self, commits: Sequence[int], buckets: set[int] | None = None) -> DataFrame:
        return _within(self.log_scan(commits), buckets).select(*self.columns, *self._order, OP, COMMIT)

    def _latest(
        self, commits: Sequence[int], buckets: set[int] | None = None, joined: bool = False, only: DataFrame | None = None
    ) -> DataFrame:
        rows = self._only(self.read_log(commits, buckets), only)
        if joined:  # to the base's buckets, so that Spark knows both to be partitioned alike
            rows = rows.repartition(self.join_buckets, *self.bucket_by)
        if len(commits) < 2:  # a commit holds each key once
            return rows
        return latest_per_key(rows, self.key, [F.desc(COMMIT)], few=True)

    def _read_base(self, base: Base, buckets: set[int] | None = None, but: set[int] | None = None) -> DataFrame:
        """Rows of a base: of all buckets or the named ones, less those of ``but``."""
        marks = [(OP, T.StringType())] if self.ordered else []
        if self.join_buckets:
            rows = self.spark.table(bucketed.table_over(self, base))
        else:
            reader = self.spark.read.schema(self._with((COMMIT, T.LongType()), *self._hidden(), *marks))
            rows = _within(reader.parquet(base.path), buckets)
        if but is not None:
            rows = rows.where(~F.col(BUCKET).isin(sorted(but)))
        return rows.select(*self.columns, *self._order, *(name for name, _ in marks), COMMIT)

    def _match(self, rows: DataFrame, others: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
        """Semi or anti join on key columns; a null partition value matches itself."""
        right = others.select([F.col(c).alias(f"_key_{c}") for c in keys])
        same: list[Column] = [
            F.col(c).eqNullSafe(F.col(f"_key_{c}"))
            if c in self.partition_fields
            else F.col(c) == F.col(f"_key_{c}")
            for c in keys
        ]
        return rows.join(right, functools.reduce(Column.__and__, same), how)

    def _only(self, rows: DataFrame, only: DataFrame | None) -> DataFrame:
        return rows if only is None else self._match(rows, only, only.columns, "left_semi")

    def snapshot(
        self,
        as_of: int | None = None,
        with_commit: bool = False,
        buckets: set[int] | None = None,
        only: DataFrame | None = None,
    ) -> DataFrame:
        """The table now, or as it was after commit ``as_of``; of a bucketed table only the
        rows in ``buckets``, if given.  ``only`` holds some or all of the key's columns: rows that
        match none of its rows are left out before anything is ranked.

        Only keys touched since the last compaction are ranked.  The base side
        meets them in an anti join against the key columns of the log, which
        Catalyst broadcasts while they are small, so the base is not shuffled.
        A larger log of a partition-scoped table is joined to the partitions it
        touches, one of a bucketed table to the buckets it touches; the others pass by.
        """
        rows = self.state(as_of, buckets, only)
        if self.ordered:
            rows = rows.where(F.col(OP) == UPSERT).drop(OP, SEQ)
        return rows if with_commit else rows.drop(COMMIT)

    def state(
        self, as_of: int | None = None, buckets: set[int] | None = None, only: DataFrame | None = None
    ) -> DataFrame:
        """What a base holds: rows with ``_commit``, of an ordered table also deleted keys,
        with ``_op`` and ``_seq``."""
        # all versions of a key match or none does, so the newest of those that match is the newest
        if only is not None and not set(only.columns) <= set(self.key):
            raise ValueError(f"{only.columns} are not all in the key {self.key}")
        if as_of is not None:
            self.check_readable(as_of)
        base, log = self.files_at(as_of)
        fresh = self._latest(log, buckets, joined=bool(base and log and self.join_buckets), only=only)
        if not self.ordered:
            fresh = fresh.where(F.col(OP) == UPSERT).drop(OP)
        if base is None:
            return fresh
        if not log:
            return self._only(self._read_base(base, buckets), only)
        return self._untouched(base, log, buckets, only).unionByName(fresh)

    def _untouched(
        self, base: Base, log: Sequence[int], buckets: set[int] | None, only: DataFrame | None = None
    ) -> DataFrame:
        """Base rows whose key is not in the log, and among ``only``."""
        if self.buckets:
            # known from the folders, so both scans are pruned when they are planned
            touched = self._buckets_in(log)
            here = self._read_base(base, touched if buckets is None else touched & buckets)
            kept = self._match(here, self.read_log(log, buckets), self.key, "left_anti")
            return self._only(self._read_base(base, buckets, but=touched).unionByName(kept), only)
        stored, changed = self._read_base(base), self.read_log(log)
        if not self._spares_partitions(log):
            return self._match(self._only(stored, only), changed, self.key, "left_anti")
        # plain equality and a filter (always true here) let Spark prune partitions
        # at run time; rows with a null partition value are few and join as touched
        fields = [F.col(c).alias(f"_in_{c}") for c in self.partition_fields]
        touched = changed.where(F.col(COMMIT) > base.upto).select(fields).distinct()
        same = functools.reduce(
            Column.__and__, [F.col(c) == F.col(f"_in_{c}") for c in self.partition_fields]
        )
        null = functools.reduce(Column.__or__, [F.col(c).isNull() for c in self.partition_fields])
        elsewhere = stored.where(~null).join(F.broadcast(touched), same, "left_anti")
        here = stored.join(F.broadcast(touched), same, "left_semi").unionByName(stored.where(null))
        return self._only(elsewhere.unionByName(self._match(here, changed, self.key, "left_anti")), only)

    def _spares_partitions(self, log: Sequence[int]) -> bool:
        """A log too large to broadcast, but over a counted, small set of partitions."""
        if self.scope != "partition" or not self.partition_fields:
            return False
        if sum(part.bytes for part in self.usage(log)) <= self._broadcast_bytes():
            return False
        folders = "/".join(f"{field}=*" for field in self.partition_fields)
        touched = sum(len(paths.glob(self.spark, f"{self.commit_path(c)}/{folders}")) for c in log)
        return touched <= BROADCAST_PARTITIONS

    def usage(self, commits: Sequence[int], base: Base | None = None) -> list[paths.Usage]:
        """Stored size of each of some commits and of a base."""
        folders = [*map(self.commit_path, commits), *([base.path] if base else [])]
        return [paths.usage(self.spark, folder) for folder in folders]

    def broadcasts(self, path: str) -> bool:
        """Whether what is stored at ``path`` is small enough for Spark to broadcast."""
        return paths.usage(self.spark, path).bytes <= self._broadcast_bytes()

    def _broadcast_bytes(self) -> int:
        threshold = self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        return int(threshold)

    def incremental(
        self,
        begin: int | None = None,
        end: int | None = None,
        deletes: bool = False,
        with_commit: bool = False,
    ) -> DataFrame:
        """Latest image of each key committed after ``begin`` (up to ``end``).

        Deleted keys are left out unless ``deletes`` is set, which adds ``_op``.
        ``begin=None`` is the first run and reads the whole table.
        """
        if begin is None:
            rows = self.snapshot(end, with_commit=True).withColumn(OP, F.lit(UPSERT))
        else:
            if begin < self.floor():
                raise HistoryLost(f"{self.path}: commits after {begin} are partly removed")
            rows = self._latest(self.commits_between(begin, end))
        if not deletes:
            rows = rows.where(F.col(OP) == UPSERT).drop(OP)
        rows = rows.drop(SEQ) if self.ordered else rows
        return rows if with_commit else rows.drop(COMMIT)

    def commits_between(self, begin: int, end: int | None = None) -> list[int]:
        return [c for c in self.commits() if c > begin and (end is None or c <= end)]

    def before_images(self, begin: int | None, end: int | None = None) -> DataFrame:
        """Rows as of ``begin`` whose keys were written again up to ``end``."""
        if begin is None:
            return no_rows(self.spark, self.schema)
        commits = self.commits_between(begin, end)
        keys = self.read_log(commits).select(*self.key)
        return self.snapshot(begin, buckets=self._buckets_in(commits), only=keys)

    # ---- writes ----------------------------------------------------------------------

    def upsert(
        self,
        df: DataFrame,
        unique: bool = False,
        source: tuple[str, int] | None = None,
        known: DataFrame | None = None,
    ) -> int | None:
        """Write the batch as one commit; its rows win over stored ones.

        The batch is reduced to the newest row per key first, unless the caller
        knows that keys are ``unique``.  A row may carry ``_op`` = ``D`` to delete
        its key, and ``_seq`` to say in which order changes of a key happened: within
        the batch, and in an ordered table against all batches before.  ``source`` names
        a stream and its batch, which is then written once however often it is replayed.
        ``known`` is what :meth:`state` has of the batch's keys, or of more, where the caller
        of an ordered table has read it.  Returns the commit, or None if nothing came.
        """
        rows = self._reduced(df, unique)
        rows = self._not_overtaken(rows, known) if self.ordered else rows.drop(SEQ)
        if source is None:
            return self._append(rows, self._next_commit())
        commit = self._reserve(*source)
        if commit is None:
            return None
        written = self._append(rows, commit)
        self._note_source(*source, commit, done=True)
        return written

    def changes(self, df: DataFrame, few: bool = True) -> DataFrame:
        """Rows that an upsert of ``df`` into this ordered table would change: one for each key,
        with ``_op`` and ``_seq``, less those that are overtaken or stored just so.  Unless they
        are ``few``, the table is not searched for their keys before it is joined."""
        if not self.ordered:
            raise ValueError(f"{self.path} is not ordered")
        return self._not_overtaken(self._reduced(df), new_only=True, few=few)

    def _reduced(self, df: DataFrame, unique: bool = False) -> DataFrame:
        """The typed batch with ``_op``, and ``_seq`` where it counts, one row for each key."""
        rows = df if OP in df.columns else df.withColumn(OP, F.lit(UPSERT))
        seq = F.col(SEQ).cast("string") if SEQ in df.columns else F.lit(None).cast("string")
        carried = [seq.alias(SEQ)] if self.ordered or (SEQ in df.columns and not unique) else []
        rows = rows.select(
            *[self._typed(f).alias(f.name) for f in self.schema], F.col(OP).cast("string"), *carried
        )
        if unique:
            return rows
        return latest_per_key(rows, self.key, newest_first(rows, self.key, self.precombine))

    def _not_overtaken(
        self, rows: DataFrame, known: DataFrame | None = None, new_only: bool = False, few: bool = True
    ) -> DataFrame:
        """Rows of a batch, one for each key, less those that a stored change of the key goes
        before.  A row without a sequence number comes right after what is stored.

        Of the table only key columns and ``_seq`` are read, and only rows of keys in the
        batch are shuffled while Catalyst can broadcast the batch's keys.  Where it can't, ``few``
        is better false: the join drops other keys anyway.  ``new_only`` reads all columns, and
        leaves out rows that are stored just so.
        """
        if known is None:
            known = self.state(buckets=self.buckets_of(rows))
            known = self._match(known, rows, self.key, "left_semi") if few else known
        held = [c for c in (*self.columns, OP) if c not in self.key] if new_only else []
        known = known.select(
            *[F.col(c).alias(f"_at_{c}") for c in self.key], *[F.col(c).alias(f"_was_{c}") for c in held],
            F.col(SEQ).alias("_known"), F.lit(True).alias("_there"),
        )
        same = [
            F.col(c).eqNullSafe(F.col(f"_at_{c}")) if c in self.partition_fields else F.col(c) == F.col(f"_at_{c}")
            for c in self.key
        ]
        both = rows.join(known, functools.reduce(Column.__and__, same), "left")
        late = place(F.col(SEQ)) < place(F.col("_known"))
        seq = F.coalesce(F.col(SEQ), F.col("_known"))
        left_out = F.coalesce(late, F.lit(False))
        if new_only:
            as_stored = [F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in held]
            there = F.col("_there").isNotNull() & seq.eqNullSafe(F.col("_known"))
            left_out = left_out | functools.reduce(Column.__and__, as_stored, there)
        return both.where(~left_out).select(*self.columns, OP, seq.alias(SEQ))

    def _typed(self, field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if field.name in self.partition_fields and isinstance(field.dataType, T.StringType):
            # read back from a folder name the empty string is null; so it is from the start
            value = F.nullif(value, F.lit(""))
        if field.name in self.record_key:
            missing = F.raise_error(F.lit(f"null in record key column {field.name}"))
            return F.coalesce(value, missing.cast(field.dataType))
        return value

    def _next_commit(self) -> int:
        started = self.commits(finished=False)
        return max([*started, *(b.upto for b in self.bases()), 0]) + 1

    def _reserve(self, stream: str, batch: int) -> int | None:
        """Commit number for a stream's batch; None when that batch is in already."""
        state = paths.read_json(self.spark, self._source_file(stream))
        if state and batch < state["batch"]:
            return None
        if state and batch == state["batch"]:
            if state["done"] or state["commit"] in self.commits():
                return None
            # a number that others have passed meanwhile would go unnoticed
            if state["commit"] > (self.last_commit() or 0):
                return state["commit"]
        commit = self._next_commit()
        # the empty directory keeps the number from being given out again
        paths.make_dir(self.spark, self.commit_path(commit))
        self._note_source(stream, batch, commit, done=False)
        return commit

    def _source_file(self, stream: str) -> str:
        return f"{self.path}/sources/{stream}.json"

    def _note_source(self, stream: str, batch: int, commit: int, done: bool) -> None:
        state = {"batch": batch, "commit": commit, "done": done}
        paths.write_json(self.spark, self._source_file(stream), state)

    def _append(self, rows: DataFrame, commit: int) -> int | None:
        from tidewater.operators.catalog import follow

        self._write(rows, self.commit_path(commit), rebalance=True)
        if self.read_log([commit]).isEmpty():
            paths.delete(self.spark, self.commit_path(commit))
            return None
        follow(self)
        return commit

    def _write(self, rows: DataFrame, path: str, rebalance: bool) -> None:
        fields, rows = self.layout, self.with_layout(rows)
        if rebalance and self.cluster_columns:
            # ranges, so that files differ in their bounds; the key ends the order, so a
            # hot value is split; AQE merges small ranges
            order = list(dict.fromkeys((*fields, *self.cluster_columns, *self.key)))
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        elif rebalance and fields:
            # AQE splits a hot partition over several tasks and merges tiny ones
            rows = rows.hint("rebalance", *fields)
        self.writer(rows).parquet(path)

    def writer(self, rows: DataFrame) -> DataFrameWriter:
        """How the table's files are written: codec, file length, folders."""
        writer = (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", self.codec)
        )
        if self.max_records_per_file:
            writer = writer.option("maxRecordsPerFile", self.max_records_per_file)
        return writer.partitionBy(*self.layout) if self.layout else writer

    def write_base(self, rows: DataFrame, upto: int, rebalance: bool = False) -> Base:
        """Store rows with ``_commit`` as a new compacted version."""
        started = paths.glob(self.spark, f"{self.path}/base/upto={upto}/rev=*")
        rev = max([int(p.rsplit("=", 1)[1]) for p in started], default=0) + 1
        base = Base(upto, rev, f"{self.path}/base/upto={upto}/rev={rev}")
        if self.join_buckets:
            bucketed.write(self, rows, base)
        else:
            self._write(rows, base.path, rebalance)
        return base

    def delete(self, field: str, value) -> int | None:
        """Delete the rows whose ``field`` equals ``value``; None if there are none."""
        return self._delete_rows(self.snapshot().where(F.col(field) == F.lit(value)))

    def delete_keys(self, keys: DataFrame) -> int | None:
        """Delete the rows whose record key occurs in ``keys``."""
        rows = self.snapshot(buckets=self.buckets_of(keys), only=keys.select(*self.record_key))
        return self._delete_rows(rows)

    def _delete_rows(self, rows: DataFrame) -> int | None:
        # tombstones carry the whole row, so that readers of deletes see what went
        return self.upsert(rows.withColumn(OP, F.lit(DELETE)), unique=True)


def _may_follow(old: dict, new: dict) -> bool:
    """Whether rows stored under the old definition can be read under the new one."""
    free = ("schema", "cluster_columns", "codec", "max_records_per_file")
    kept = {k: v for k, v in old.items() if k not in free} == {k: v for k, v in new.items() if k not in free}
    had, has = old["schema"]["fields"], new["schema"]["fields"]
    return kept and has[: len(had)] == had and all(f["nullable"] for f in has[len(had) :])


def _within(rows: DataFrame, buckets: set[int] | None) -> DataFrame:
    return rows if buckets is None else rows.where(F.col(BUCKET).isin(sorted(buckets)))
