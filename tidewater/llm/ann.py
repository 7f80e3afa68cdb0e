"""Approximate nearest neighbours by cosine over low-dimensional stable projections.

Vectors are scaled to length 1, so the largest cosine is the least Euclidean distance, and
projected on a few Gaussian directions.  For two vectors at distance d the squared distance
of their projections is d squared times a chi-square variable of that many degrees of
freedom.  The projections are indexed by a kd-tree; a query meets its neighbours in the
order of projected distance and verifies them on the whole vectors.  It stops once a
neighbour as near as its k-th best would by now have been met with probability
``confidence``.  That bound does not depend on the data.

The upper levels of the tree are cut from a bounded sample and deal the rows out to tasks;
every row is indexed, and each task grows the lower levels over its own rows.  A query first
searches the leaf it falls into, then, with that bound, the leaves whose boxes the same test
leaves open.  Leaves with many rows are dealt on by a hash, queries come in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tidewater.llm.common import parts, stored
from tidewater.llm.vectors import FOUND, answers, best, finite, matrix, nearest_first

#: Rows of a leaf in one task, queries in one block, rows that the upper tree is cut from,
#: boxes that a query is held against at a time.
SHARD_ROWS, BLOCK_QUERIES, SAMPLE_ROWS, BLOCK_BOXES = 20_000, 500, 8192, 256
#: Rows in a bottom leaf of a task's tree.
BOTTOM = 256


def chi_square_below(x: float, freedom: int) -> float:
    """Chi-square distribution function, by the series of the lower incomplete gamma."""
    if x <= 0:
        return 0.0
    a, x = freedom / 2, x / 2
    if x > a + 40 * math.sqrt(a) + 60:
        return 1.0
    term = total = 1 / a
    n = 0
    while term > total * 1e-12:
        n += 1
        term *= x / (a + n)
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi_square_point(p: float, freedom: int) -> float:
    low, high = 0.0, 10.0 * freedom + 100
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_below(mid, freedom) < p else (low, mid)
    return high


def cut(points: np.ndarray, rows: np.ndarray, size: int) -> list[np.ndarray]:
    """Leaves of a kd-tree: halves along the widest side until ``size`` rows are left."""
    todo, leaves = [rows], []
    while todo:
        part = todo.pop()
        if len(part) <= size:
            leaves.append(part)
            continue
        sub = points[part]
        axis = int(np.ptp(sub, axis=0).argmax())
        order = np.argpartition(sub[:, axis], len(part) // 2)
        todo += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    return leaves


class Tree:
    """Points of one task, in the order of the bottom leaves, with a box around each leaf."""

    def __init__(self, low: np.ndarray, full: np.ndarray, ids: np.ndarray):
        leaves = cut(low, np.arange(len(low)), BOTTOM)
        order = np.concatenate(leaves)
        self.low, self.full, self.ids = low[order], full[order], ids[order]
        self.start = np.concatenate([[0], np.cumsum([len(x) for x in leaves])])
        self.lo = np.array([low[x].min(axis=0) for x in leaves])
        self.hi = np.array([low[x].max(axis=0) for x in leaves])

    def search(self, low: np.ndarray, full: np.ndarray, own: int, k: int, bound: float, point: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the ``k`` nearest; ``bound``: squared distance already known
        for the k-th."""
        outside = np.maximum(0, np.maximum(self.lo - low, low - self.hi))
        reach = (outside * outside).sum(axis=1)
        order = np.argsort(reach, kind="stable")
        waiting, gaps = np.empty(0, np.int64), np.empty(0)
        ids, scores = np.empty(0, np.int64), np.empty(0)
        at, step = 0, 1
        while True:
            # every row nearer than the frontier has been met; those beyond the limit are not needed
            frontier = reach[order[at]] if at < len(order) else math.inf
            limit = point * bound
            ready = waiting[gaps <= min(frontier, limit)]
            later = (gaps > frontier) & (gaps <= limit)
            waiting, gaps = waiting[later], gaps[later]
            ready = ready[self.ids[ready] != own]
            if len(ready):
                rough = self.full[ready] @ full
                least = scores[-1] if len(ids) == k else np.partition(rough, len(rough) - k)[len(rough) - k] if len(rough) > k else -2.0
                ready = ready[rough >= least - 1e-9]
                # row sums in a fixed order, so equal vectors get equal scores anywhere
                found = (self.full[ready] * full).sum(axis=1)
                ids, scores = np.concatenate([ids, self.ids[ready]]), np.concatenate([scores, found])
                keep = best(scores, ids, k)
                ids, scores = ids[keep], scores[keep]
                if len(ids) == k:
                    bound = min(bound, max(0.0, 2 - 2 * float(scores[-1])) + 1e-12)
            # the stopping test: a neighbour that near would have been met by now
            if frontier > point * bound:
                return ids, scores
            near = order[at : at + step]
            rows = np.concatenate([np.arange(self.start[x], self.start[x + 1]) for x in near])
            gap = self.low[rows] - low
            waiting, gaps = np.concatenate([waiting, rows]), np.concatenate([gaps, (gap * gap).sum(axis=1)])
            at, step = at + len(near), min(8, 2 * step)


class Splits:
    """The upper levels: heap-ordered nodes that compare one projected component each."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.depth = max(0, (leaves - 1).bit_length())
        self.axis = np.zeros(1 << self.depth, np.int64)
        self.at = np.zeros(1 << self.depth)
        groups = {1: sample}
        for node in range(1, 1 << self.depth):
            part = groups.pop(node)
            axis = int(np.ptp(part, axis=0).argmax()) if len(part) else 0
            at = float(np.median(part[:, axis])) if len(part) else 0.0
            self.axis[node], self.at[node] = axis, at
            groups[2 * node], groups[2 * node + 1] = part[part[:, axis] < at], part[part[:, axis] >= at]

    def leaf(self, low: np.ndarray) -> np.ndarray:
        node = np.ones(len(low), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (low[np.arange(len(low)), self.axis[node]] >= self.at[node])
        return node - (1 << self.depth)


def neighbours(
    vectors: DataFrame, queries: DataFrame, *, k: int = 5, directions: int = 16, confidence: float = 0.97, seed: int = 5
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows found for each query.

    vectors, queries: ``vec_id, embedding``.  A row is no neighbour of the query with its
    own id.  Score: cosine in double precision; ties go to the smaller id.  Vectors that are
    null, empty, zero or hold null or non-finite components, and rows with a null id, take
    no part; shorter vectors count as filled up with zeros.  With at most ``k`` candidates
    all are returned.  Rows that repeat an id are candidates each.  Equal query rows are
    asked once; rows of one id with different vectors each get their neighbours.
    """
    spark = vectors.sparkSession
    as_double = F.transform("embedding", lambda x: x.cast("double")).alias("embedding")

    def usable(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long"), as_double)
        return df.where(F.col("vec_id").isNotNull() & finite("embedding") & F.exists("embedding", lambda x: x != 0))

    vectors, queries = usable(vectors), usable(queries)
    widths = [w for w in (df.agg(F.max(F.size("embedding"))).first()[0] for df in (vectors, queries)) if w]
    if len(widths) < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = max(widths)
    axes = np.random.default_rng(seed).standard_normal((width, directions))
    placed = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("unit", T.ArrayType(T.DoubleType())),
            T.StructField("low", T.ArrayType(T.DoubleType())),
            T.StructField("leaf", T.LongType()),
        ]
    )

    def project(df: DataFrame, splits: Splits) -> DataFrame:
        def run(batches):
            for batch in batches:
                if not len(batch):
                    continue
                x = matrix(batch["embedding"], width)
                # by the largest component first: squares of very small or large ones stay in range
                x /= np.abs(x).max(axis=1, keepdims=True)
                unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                low = unit @ axes
                yield pd.DataFrame({"vec_id": batch["vec_id"], "unit": list(unit), "low": list(low), "leaf": splits.leaf(low)})

        return df.mapInPandas(run, placed)

    rows = vectors.count()
    # a bounded sample, the same on each run, cuts the upper levels
    sample = project(vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS), Splits(np.empty((0, directions)), 1)).select("low").toPandas()
    splits = Splits(np.vstack(sample["low"].to_numpy()), parts(rows, SHARD_ROWS))
    index = stored(project(vectors, splits), "projected")
    asked = stored(project(queries.distinct(), splits).withColumn("ask", F.monotonically_increasing_id()), "asked")
    sides = [f(F.col("low")[i]).alias(f"{n}{i}") for n, f in (("lo", F.min), ("hi", F.max)) for i in range(directions)]
    leaves = index.groupBy("leaf").agg(F.count("*").alias("n"), *sides)
    leaves = stored(
        leaves.select(
            "leaf", F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("shards"),
            F.array(*[f"lo{i}" for i in range(directions)]).alias("lo"), F.array(*[f"hi{i}" for i in range(directions)]).alias("hi"),
        ),
        "leaves",
    )
    point = chi_square_point(confidence, directions)

    def searched(routes: DataFrame) -> DataFrame:
        """routes: ask, vec_id, unit, low, bound, leaf, shards; the query_id found is the ask"""
        sizes = routes.groupBy("leaf").agg(F.count("*").alias("m")).select("leaf", F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("blocks"))
        ask = (
            routes.join(sizes, "leaf")
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
            .select("leaf", "shard", F.pmod(F.xxhash64("ask"), "blocks").cast("int").alias("block"), F.lit(True).alias("asks"), "ask", "vec_id", "unit", "low", "bound")
        )
        have = (
            index.join(leaves.select("leaf", "shards"), "leaf").join(sizes, "leaf")
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("leaf", F.pmod(F.xxhash64("vec_id", F.lit(1)), "shards").cast("int").alias("shard"), "block", F.lit(False).alias("asks"), F.lit(0).cast("long").alias("ask"), "vec_id", "unit", "low", F.lit(4.0).alias("bound"))
        )

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            asks = pdf["asks"].to_numpy(bool)
            mine, theirs = pdf[asks], pdf[~asks]
            found = []
            if len(mine) and len(theirs):
                tree = Tree(np.vstack(theirs["low"].to_numpy()), np.vstack(theirs["unit"].to_numpy()), theirs["vec_id"].to_numpy(np.int64))
                rows = zip(mine["ask"].tolist(), mine["vec_id"].tolist(), mine["unit"], mine["low"], mine["bound"].tolist())
                for ask, own, unit, low, bound in rows:
                    ids, scores = tree.search(low, unit, own, k, bound, point)
                    found += [(ask, int(i), float(s)) for i, s in zip(ids, scores)]
            return pd.DataFrame(found, columns=FOUND.names).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

        return ask.unionAll(have).groupBy("leaf", "shard", "block").applyInPandas(run, FOUND)

    everything = F.lit(4.0)  # the largest squared distance of two vectors of length 1
    home = stored(searched(asked.withColumn("bound", everything).join(leaves.select("leaf", "shards"), "leaf")), "found")
    bounds = nearest_first(home.distinct(), k).groupBy("query_id").agg(
        F.when(F.count("*") == k, F.greatest(F.lit(0.0), 2 - 2 * F.min("score")) + 1e-12).otherwise(everything).alias("bound")
    )
    known = asked.join(bounds.withColumnRenamed("query_id", "ask"), "ask", "left").select(
        "ask", "vec_id", "unit", "low", F.coalesce("bound", everything).alias("bound"), F.col("leaf").alias("home")
    )
    outside = "aggregate(zip_with(low, zip_with(lo, hi, (a, b) -> struct(a, b)), (x, s) -> greatest(0D, s.a - x, x - s.b)), 0D, (t, d) -> t + d * d)"
    # each query is held against the boxes in blocks; there is one box for SHARD_ROWS rows of the index
    box_blocks = parts(leaves.count(), BLOCK_BOXES)
    boxes = leaves.withColumn("box", F.pmod("leaf", F.lit(box_blocks)).cast("long"))
    open_leaves = (
        known.withColumn("box", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(box_blocks - 1).cast("long")))).join(boxes, "box")
        .where((F.col("leaf") != F.col("home")) & (F.expr(outside) <= F.lit(point) * F.col("bound")))
    )
    away = searched(open_leaves.select("ask", "vec_id", "unit", "low", "bound", "leaf", "shards"))
    return answers(nearest_first(home.unionAll(away), k), asked)
