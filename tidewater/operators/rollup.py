"""Sums and counts by group, kept up to date by differences.

A refresh reads what the source committed since the last one: the new images of the changed
keys, and the images that they replace.  New ones count once, replaced and deleted ones count
back, and only groups that this changes are written.  The source as a whole is read once, for
the first refresh.

The commit of the source that the sums stand for is a row of the sums themselves.  Both change
in one commit, so a refresh that breaks off is repeated from where the sums really are, and
nothing counts twice.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewater.operators.keyed_table import KeyedTable
from tidewater.operators.latest import DELETE, OP
from tidewater.sources.change_records import UPSERT

GROUP, ROWS, UPTO = "_group", "_rows", "_upto"
# the group of the row that holds the commit; a real one is a JSON object
MARKER = ""

#: Turns source rows into rows of key and measure columns, each by itself: a projection, a
#: filter, an inner join with a table that stays as it is.
Shape = Callable[[DataFrame], DataFrame]


class Rollup:
    def __init__(self, spark: SparkSession, path: str, keys: T.StructType, measures: Mapping[str, T.DataType]):
        """Open the sums below ``path``, or make an empty table of them.

        ``keys``: the grouping columns, which may be null.  ``measures``: the columns to sum,
        with the type of the sum.
        """
        self.keys = keys.fieldNames()
        self.measures = dict(measures)
        fields = [T.StructField(GROUP, T.StringType()), *keys.fields, T.StructField(ROWS, T.LongType())]
        for name, dtype in self.measures.items():
            fields += [T.StructField(name, dtype), T.StructField(_known(name), T.LongType())]
        schema = T.StructType([*fields, T.StructField(UPTO, T.LongType())])
        self.table = KeyedTable.create(spark, path, schema, GROUP, UPTO)

    def upto(self) -> int | None:
        """The commit of the source that the sums stand for; None before the first refresh."""
        found = self.table.snapshot().where(F.col(GROUP) == MARKER).select(UPTO).first()
        return None if found is None else found[0]

    def rows(self) -> DataFrame:
        """Keys and sums of all groups that have rows; a sum of nulls only is null."""
        sums = [F.when(F.col(_known(m)) > 0, F.col(m)).alias(m) for m in self.measures]
        return self.table.snapshot().where(F.col(GROUP) != MARKER).select(*self.keys, *sums)

    def differences(
        self, source: KeyedTable, shape: Shape, begin: int | None, end: int, before: DataFrame | None = None
    ) -> DataFrame:
        """What commits after ``begin`` add to every group: rows, sums, and values that are there.

        ``before``: the images that they replace, where the caller has them.
        """
        before = source.before_images(begin, end) if before is None else before
        new = shape(source.incremental(begin, end)).withColumn("_sign", F.lit(1))
        old = shape(before).withColumn("_sign", F.lit(-1))
        sums = [F.sum("_sign").alias(ROWS)]
        for name, dtype in self.measures.items():
            value = F.coalesce(F.col(name), F.lit(0)).cast(dtype)
            sums.append(F.sum(F.when(F.col("_sign") > 0, value).otherwise(-value)).cast(dtype).alias(name))
            sums.append(F.sum(F.when(F.col(name).isNotNull(), F.col("_sign")).otherwise(0)).alias(_known(name)))
        found = new.unionByName(old).groupBy(*self.keys).agg(*sums)
        parts = [c for name in self.measures for c in (name, _known(name))]
        return found.where(functools.reduce(Column.__or__, [F.col(c) != 0 for c in (ROWS, *parts)]))

    def refresh(self, source: KeyedTable, shape: Shape, rebuild: bool = False) -> int | None:
        """Bring the sums up to the last commit of ``source``; the commit, or None if they are.

        ``rebuild`` sums the whole source anew, as is needed when ``shape`` has changed or the
        source no longer keeps the commits since.
        """
        begin, end = None if rebuild else self.upto(), source.last_commit()
        if end is None or begin == end:
            return None
        return self.advance(source, shape, begin, end, rebuild=rebuild)

    def advance(
        self,
        source: KeyedTable,
        shape: Shape,
        begin: int | None,
        end: int,
        before: DataFrame | None = None,
        rebuild: bool = False,
    ) -> int | None:
        """Bring sums that stand for commit ``begin`` up to ``end``, see :meth:`differences`."""
        parts = [ROWS, *(c for name in self.measures for c in (name, _known(name)))]
        change = self.differences(source, shape, begin, end, before)
        group = F.to_json(F.struct(*self.keys))
        change = change.select(group.alias(GROUP), *self.keys, *parts)
        stored = self.table.snapshot().where(F.col(GROUP) != MARKER)
        if rebuild:
            gone = stored.join(change, GROUP, "left_anti").select(change.columns)
            total = change.withColumn(OP, F.lit(UPSERT)).unionByName(gone.withColumn(OP, F.lit(DELETE)))
        else:
            before = stored.select(F.col(GROUP).alias("_before"), *[F.col(c).alias(f"_before_{c}") for c in parts])
            both = change.join(before, F.col(GROUP) == F.col("_before"), "left")
            added = [(F.coalesce(F.col(f"_before_{c}"), F.lit(0)) + F.col(c)).alias(c) for c in parts]
            total = both.select(GROUP, *self.keys, *added)
            total = total.withColumn(OP, F.when(F.col(ROWS) == 0, DELETE).otherwise(UPSERT))
        types = {f.name: f.dataType for f in self.table.schema}
        mark = {GROUP: F.lit(MARKER), OP: F.lit(UPSERT)}
        marker = self.table.spark.range(1).select(
            *[(mark[c] if c in mark else F.lit(None).cast(types[c])).alias(c) for c in total.columns], F.lit(end).alias(UPTO)
        )
        return self.table.upsert(total.withColumn(UPTO, F.lit(end)).unionByName(marker), unique=True)


def _known(measure: str) -> str:
    return f"_n_{measure}"
