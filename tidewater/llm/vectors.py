"""What the two vector searches share: usable vectors, and the grid of shards and blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

FOUND = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def finite(vector: str) -> Column:
    """Whether the vector is there, not empty, and all its components are finite numbers."""
    def good(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))

    return F.coalesce((F.size(vector) > 0) & F.forall(vector, good), F.lit(False))


def matrix(vectors: pd.Series, width: int, kind: type = np.float64) -> np.ndarray:
    """Rows of equal width; shorter vectors are filled up with zeros."""
    out = np.zeros((len(vectors), width), kind)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def nearest_first(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query by score, ties to the smaller id, with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )


def answers(found: DataFrame, asked: DataFrame) -> DataFrame:
    """``found`` with the ids of the queries in place of the numbers that they were asked under."""
    ids = asked.select(F.col("ask").alias("query_id"), F.col("vec_id").alias("of"))
    return found.join(ids, "query_id").select(F.col("of").alias("query_id"), "rank", "vec_id", "score")


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best scores, ties to the smaller id, best first."""
    if len(scores) > 4 * k:
        low = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= low)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]
