"""Exact top-k by inner product, by aggregation of sorted lists without random access.

Each task holds one list of (value, row) for every component, sorted once.  A query reads
all lists in parallel from the end that favours it, a stretch at a time.  A row's lower
bound is what has been read of it plus the least that the unread lists can add, its upper
bound the same with the most.  Reading stops once no unread row can reach the k-th lower
bound; the few rows whose upper bound does are then resolved to final scores.  All
arithmetic is on integers that double precision holds exactly.  Where components are so
large that sums may not be held, all rows are resolved, in integers of 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import parts, stored
from tidewater.llm.vectors import FOUND, answers, best, finite, matrix, nearest_first

#: Rows and queries that one task gets.
SHARD_ROWS, BLOCK_QUERIES = 10_000, 500
#: Share of a list that is read between two tests.
STRETCH = 16


class Lists:
    """Sorted lists over the components of integer vectors."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids = x, ids
        width = x.shape[1]
        order = np.argsort(x, axis=0, kind="stable")
        # the lists from their low ends, then the same from their high ends
        self.order = np.vstack([order.T, order[::-1].T])
        self.value = np.vstack([np.take_along_axis(x.T, self.order[:width], axis=1), np.take_along_axis(x.T, self.order[width:], axis=1)])
        # where each row stands in each list: what a bound needs to know of the reading so far
        self.place = np.empty((2 * width, len(x)), np.int32)
        np.put_along_axis(self.place, self.order, np.arange(len(x), dtype=np.int32)[None, :], axis=1)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows but those of id ``own``."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        weight = query[used]
        lists = np.where(weight > 0, used + self.x.shape[1], used)  # from the end that favours the query
        last = self.value[lists, -1] * weight  # the least that each list can give
        low = np.full(n, last.sum())
        others = self.ids != own
        alive = np.flatnonzero(others)
        at, step = 0, max(32, n // STRETCH)
        while at < n and len(used):
            end = min(n, at + step)
            read = self.value[lists, at:end] * weight[:, None] - last[:, None]
            low += np.bincount(self.order[lists, at:end].ravel(), read.ravel(), n)
            at = end
            candidates = low[others]
            if at == n or len(candidates) < k:
                continue
            most = self.value[lists, at] * weight  # the most that each list still can give
            kth = np.partition(candidates, len(candidates) - k)[len(candidates) - k]
            if most.sum() >= kth:
                continue  # a row that no list has shown may still qualify
            gain = most - last
            near = np.flatnonzero(others & (low + gain.sum() >= kth))
            if len(near) > n // 2:
                continue
            unread = self.place[np.ix_(lists, near)] >= at
            alive = near[low[near] + gain @ unread >= kth]
            if len(alive) <= max(4 * k, n // 8):
                break
        scores = self.x[alive] @ query
        keep = best(scores, self.ids[alive], k)
        return self.ids[alive][keep], scores[keep]


def top_of_all(x: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``Lists.top`` with 64-bit integers, every row resolved."""
    others = np.flatnonzero(ids != own)
    scores = x[others] @ query
    keep = best(scores, ids[others], k)
    return ids[others][keep], scores[keep]


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` rows with the largest inner product.

    vectors, queries: ``vec_id, components`` (array of long).  A row is no result of the
    query with its own id; ties go to the smaller id.  Null or empty vectors, such with null
    components and rows with a null id take no part; shorter vectors count as filled up with
    zeros.  With at most ``k`` candidates all are returned.  Equal query rows are asked once;
    rows of one id with different vectors are each answered.  Scores are exact at any size
    of the components; where one may not fit in 64 bits the search is refused.

    The rows are dealt out in shards and the queries in blocks of bounded size; each pair
    of them is one group.
    """
    def usable(df: DataFrame) -> DataFrame:
        good = (F.size("components") > 0) & F.forall("components", lambda x: x.isNotNull())
        return df.select(F.col("vec_id").cast("long"), "components").where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)))

    vectors = stored(usable(vectors), "components")
    queries = stored(usable(queries).distinct().withColumn("ask", F.monotonically_increasing_id()), "asked")
    largest = F.max(F.array_max(F.transform("components", lambda x: F.abs(x.cast("double")))))
    (wide, high), (_, factor) = (df.agg(F.max(F.size("components")), largest).first() for df in (vectors, queries))
    bound = (wide or 0) * (high or 0.0) * (factor or 0.0)
    if bound >= 2.0**63 or max(high or 0.0, factor or 0.0) >= 2.0**62:
        raise ValueError("components are so large that scores may not fit in 64 bits")
    in_doubles = bound < 2.0**53
    shards, blocks = parts(vectors.count(), SHARD_ROWS), parts(queries.count(), BLOCK_QUERIES)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda n, c: F.pmod(F.xxhash64(c, F.lit(1)), F.lit(n)).cast("int")
    have = vectors.select(part(shards, "vec_id").alias("shard"), every(blocks).alias("block"), F.lit(False).alias("asks"), F.lit(0).cast("long").alias("ask"), "vec_id", "components")
    ask = queries.select(every(shards).alias("shard"), part(blocks, "ask").alias("block"), F.lit(True).alias("asks"), "ask", "vec_id", "components")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy(bool)
        mine, theirs = pdf[asks], pdf[~asks]
        found = []
        if len(mine) and len(theirs):
            width = int(pdf["components"].str.len().max())
            kind = np.float64 if in_doubles else np.int64
            x, asked = matrix(theirs["components"], width, kind), matrix(mine["components"], width, kind)
            ids = theirs["vec_id"].to_numpy(np.int64)
            lists = Lists(x, ids) if in_doubles else None
            for number, own, vector in zip(mine["ask"].tolist(), mine["vec_id"].tolist(), asked):
                near, scores = lists.top(vector, own, k) if lists else top_of_all(x, ids, vector, own, k)
                found += [(number, int(i), int(s)) for i, s in zip(near, scores)]
        return pd.DataFrame(found, columns=FOUND.names, dtype="int64")

    found = have.unionAll(ask).groupBy("shard", "block").applyInPandas(run, "query_id long, vec_id long, score long")
    return answers(nearest_first(found, k), queries)


def scaled(vectors: DataFrame, factor: int = 1024) -> DataFrame:
    """``vec_id, components``: each usable ``embedding`` as floor(factor * x)."""
    components = F.transform("embedding", lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))
    return vectors.where(finite("embedding")).select("vec_id", components.alias("components"))
