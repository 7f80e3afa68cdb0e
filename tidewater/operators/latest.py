"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


# as change records mark them
OP, SEQ, DELETE = "_op", "_seq", "D"


def place(seq: Column) -> Column:
    """What sequence numbers of digits order by, null for null."""
    digits = F.ltrim(seq, F.lit("0"))
    return F.when(seq.isNotNull(), F.struct(F.length(digits).alias("n"), digits.alias("digits")))


def newest_first(df: DataFrame, keys: Sequence[str], precombine: Sequence[str]) -> list[Column]:
    """Precombine columns descending, then every other column as a tie-break.

    The order is total, so a retried task picks the same winner.  A ``_seq`` of digits
    goes before all else.  Without it a delete wins over changes that nothing puts after
    it: it has their precombine values, or none at all, as when it carries keys only.
    """
    used = {*keys, *precombine, SEQ, OP}
    rest = [f.name for f in df.schema if f.name not in used and orderable(f.dataType)]
    order = []
    if SEQ in df.columns:
        order.append(F.desc_nulls_last(place(F.col(SEQ))))
    if OP in df.columns:
        gone = F.coalesce(F.col(OP) == DELETE, F.lit(False))
        for c in precombine:
            gone = gone & F.col(c).isNull()
        order.append(F.desc(gone))
    order += [F.desc_nulls_last(c) for c in precombine]
    if OP in df.columns:
        order += [F.desc(F.coalesce(F.col(OP) == DELETE, F.lit(False))), F.desc_nulls_last(OP)]
    return order + [F.desc_nulls_last(c) for c in rest]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], few: bool = False
) -> DataFrame:
    """Keep the first row of each key in the given order.

    ``row_number() = 1`` plans a WindowGroupLimit before the exchange: every map
    task sends at most one row per key, so a key that holds a third of all rows
    does not pile up in one reducer.  That costs a sort before the exchange; with ``few``
    rows of each key it would take next to none away, and is left out: the first row is
    found as the one that none goes before.
    """
    ordered = Window.partitionBy(*keys).orderBy(*order)
    if few:
        before = F.lag(F.lit(True)).over(ordered)
        return df.withColumn("_before", before).where(F.col("_before").isNull()).drop("_before")
    rank = F.row_number().over(ordered)
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
