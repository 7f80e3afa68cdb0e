"""Centroid clustering by Lloyd's rounds over shards of the dimensions.

Vectors lie in blocks of rows, cut into shards of columns.  A task on a shard of a block
computes exact partial distances against the shard's slice of the centroids; a reduction by
block adds the shards and takes the nearest centroid.  The assignment goes back to the
blocks, each shard sums its own columns by cluster, and the sums replace its slice.  All
arithmetic is on integers.

The blocks are a table bucketed and sorted by block: vectors don't move between rounds, and
the shards of a block stand side by side, so a task adds what it has of a block before the
shuffle.  Per round one matrix of partial distances for each block is shuffled, and
assignments of a few bytes for each vector.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidewater.llm.common import slices as pieces, stored
from tidewater.session import shared_dir

#: Vectors in a block.
BLOCK_ROWS = 1024
#: Components stay below this, so that a distance over 64 of them fits in a long.
LARGEST = 2**27
#: Numbers in all centroids together, 64 MB at most, which every task gets.
MOST_NUMBERS = 8_000_000


def first_centroids(points: DataFrame, k: int, salt: str, width: int, shards: int) -> DataFrame:
    """``shard, cluster, dim, value`` of the ``k`` points whose ``salt:vec_id`` has the smallest
    sha256, in that order; equal ids by components, null ids last."""
    drawn = points.select(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256).alias("draw"), "components")
    order = [F.col("draw").asc_nulls_last(), F.col("components")]
    drawn = drawn.orderBy(*order).limit(k)
    # a window over k rows
    drawn = drawn.withColumn("cluster", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)) - 1)
    rows = drawn.select("cluster", F.posexplode("components").alias("dim", "value"))
    return rows.select(F.floor(F.col("dim") * shards / width).cast("int").alias("shard"), "cluster", "dim", "value")


def _blocks(points: DataFrame, width: int, shards: int) -> tuple[str, str]:
    """The blocks as a bucketed table: its name and its folder."""
    ends = [-(-s * width // shards) for s in range(shards + 1)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = TaskContext.get().partitionId() << 32
        for part in pieces(batches, BLOCK_ROWS):
            x = np.stack(part["components"].to_list()).astype(np.int64)
            if np.abs(x).max() >= LARGEST:
                raise ValueError(f"a component is {LARGEST} or more in size")
            ids = part["id"].to_numpy(np.int64).tobytes()
            known = part["known"].to_numpy(bool).tobytes()
            cut = [x[:, a:b].astype(np.int32).tobytes() for a, b in zip(ends, ends[1:])]
            first = [True] + [False] * (shards - 1)
            yield pd.DataFrame(
                {
                    "block": block, "shard": range(shards), "n": len(x), "x": cut,
                    "ids": [ids if f else None for f in first], "known": [known if f else None for f in first],
                }
            )
            block += 1

    spark = points.sparkSession
    rows = points.select(F.coalesce("vec_id", F.lit(0)).cast("long").alias("id"), F.col("vec_id").isNotNull().alias("known"), "components")
    blocks = rows.mapInPandas(run, "block long, shard int, n int, x binary, ids binary, known binary")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"tidewater_blocks_{uuid.uuid4().hex}", shared_dir(spark, "blocks")
    # written first, as the numbers of blocks are those of tasks
    blocks = stored(blocks, "cut")
    (
        blocks.repartition(buckets, "block").write.option("path", path)
        .bucketBy(buckets, "block").sortBy("block", "shard").saveAsTable(name)
    )
    return name, path


def _assign(blocks: DataFrame, slices: DataFrame) -> DataFrame:
    """``block, cluster, distance``: for each block its vectors' nearest centroids."""
    # k * width numbers at most, checked by lloyd
    packed = slices.groupBy("shard").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("cluster", "dim", "value"))), lambda v: v["value"]).alias("slice")
    )
    rows = blocks.select("block", "shard", "n", "x").join(F.broadcast(packed), "shard")

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, total = None, None
        for batch in batches:
            for block, n, x, piece in zip(batch["block"].tolist(), batch["n"], batch["x"], batch["slice"]):
                x = np.frombuffer(x, np.int32).reshape(n, -1).astype(np.int64)
                c = np.asarray(piece, np.int64).reshape(-1, x.shape[1])
                distance = np.empty((n, len(c)), np.int64)
                for i, centre in enumerate(c):
                    gap = x - centre
                    distance[:, i] = np.einsum("ij,ij->i", gap, gap)
                if block == at:
                    total += distance
                    continue
                if at is not None:
                    yield pd.DataFrame({"block": [at], "n": len(total), "partial": [total.tobytes()]})
                at, total = block, distance
        if at is not None:
            yield pd.DataFrame({"block": [at], "n": len(total), "partial": [total.tobytes()]})

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].iloc[0])
        distance = sum(np.frombuffer(p, np.int64) for p in pdf["partial"]).reshape(n, -1)
        cluster = distance.argmin(axis=1)
        least = distance[np.arange(n), cluster]
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "cluster": [cluster.astype(np.int32).tobytes()], "distance": [least.tobytes()]})

    sums = rows.mapInPandas(partial, "block long, n int, partial binary")
    return sums.groupBy("block").applyInPandas(nearest, "block long, cluster binary, distance binary")


def _update(blocks: DataFrame, nearest: DataFrame, slices: DataFrame, width: int, shards: int) -> DataFrame:
    """The slices after each shard has replaced its own: floor of the mean, or as it was."""
    starts = [-(-s * width // shards) for s in range(shards)]
    rows = blocks.select("block", "shard", "n", "x").join(nearest.select("block", F.col("cluster").alias("clusters")), "block")

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple[int, int], list] = {}
        for batch in batches:
            for shard, n, x, clusters in zip(batch["shard"].tolist(), batch["n"], batch["x"], batch["clusters"]):
                x = np.frombuffer(x, np.int32).reshape(n, -1).astype(np.int64)
                clusters = np.frombuffer(clusters, np.int32)
                for c in np.unique(clusters).tolist():
                    mine = x[clusters == c]
                    total = totals.setdefault((shard, c), [np.zeros(x.shape[1], np.int64), 0])
                    total[0] += mine.sum(axis=0)
                    total[1] += len(mine)
        for (shard, c), (total, members) in totals.items():
            dims = np.arange(starts[shard], starts[shard] + len(total))
            yield pd.DataFrame({"shard": shard, "cluster": c, "dim": dims, "total": total, "members": members})

    key = ["shard", "cluster", "dim"]
    totals = (
        rows.mapInPandas(sums, "shard int, cluster int, dim int, total long, members long")
        .groupBy(*key).agg(F.sum("total").alias("total"), F.sum("members").alias("members"))
    )
    mean = F.expr("(total - pmod(total, members)) div members")
    return slices.join(totals, key, "left").select(*key, F.coalesce(mean, F.col("value")).alias("value"))


def lloyd(
    points: DataFrame, *, k: int = 16, rounds: int = 3, width: int = 64, shards: int = 4, salt: str = "1"
) -> tuple[DataFrame, DataFrame]:
    """Assignment ``vec_id, cluster, distance`` and centroids ``cluster, components``.

    points: ``vec_id, components`` (array of ``width`` longs below 2**27 in size; others raise).
    The first centroids are the points of the smallest hashes of ``salt:vec_id``.  ``rounds``
    times all points go to the nearest centroid (squared Euclidean distance, ties to the
    smaller number) and each centroid becomes the floor of its points' mean, an empty one
    stays; then the points are assigned once more.  Rows that repeat an id are points of
    their own; rows with a null id are clustered like others, and drawn last as first
    centroids.  With fewer than ``k`` points there are as many clusters as points, of an
    empty table none.  Extra columns are ignored.
    """
    if k * width > MOST_NUMBERS:
        raise ValueError(f"{k} centroids of {width} components are more than {MOST_NUMBERS} numbers")
    spark = points.sparkSession
    shards = min(shards, width)
    points = stored(points.select(F.col("vec_id").cast("long"), "components"), "points")
    name, path = _blocks(points, width, shards)
    blocks = spark.table(name)
    slices = stored(first_centroids(points, k, salt, width, shards), "slices")
    for _ in range(rounds):
        nearest = stored(_assign(blocks, slices), "nearest")
        slices = stored(_update(blocks, nearest, slices, width, shards), "slices")
    nearest = stored(_assign(blocks, slices), "nearest")

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, known, cluster, distance in zip(batch["ids"], batch["known"], batch["cluster"], batch["distance"]):
                yield pd.DataFrame(
                    {
                        "id": np.frombuffer(ids, np.int64), "known": np.frombuffer(known, bool),
                        "cluster": np.frombuffer(cluster, np.int32), "distance": np.frombuffer(distance, np.int64),
                    }
                )

    found = blocks.where("shard = 0").select("block", "ids", "known").join(nearest, "block")
    found = stored(found.mapInPandas(expand, "id long, known boolean, cluster int, distance long"), "assigned")
    spark.sql(f"DROP TABLE {name}")
    ordered = F.array_sort(F.collect_list(F.struct("dim", "value")))
    centroids = slices.groupBy("cluster").agg(F.transform(ordered, lambda v: v["value"]).alias("components"))
    return found.select(F.when(F.col("known"), F.col("id")).alias("vec_id"), "cluster", "distance"), centroids


def with_totals(assigned: DataFrame, centroids: DataFrame) -> DataFrame:
    """The assignment with its cluster's and all clusters' inertia and the centroid's digest."""
    per_cluster = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # one row for each centroid from here on
    per_cluster = per_cluster.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy(F.lit(0))))
    digest = F.sha2(F.array_join(F.col("components").cast("array<string>"), ","), 256)
    facts = per_cluster.join(centroids.select("cluster", digest.alias("centroid_sha256")), "cluster")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
