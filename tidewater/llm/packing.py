"""Conflict-constrained best-fit packing of documents into bins of one capacity.

Pieces are placed from large to small.  Open bins are kept in the order of their residual
room; the search starts at the first bin with enough room, the tightest, and goes on to its
successors until one is compatible.  A bin carries two bitmaps: the duplicate clusters in
it (at most one piece each) and the sources in it (at most ``per_source`` pieces each, one
bitmap for each number).  Without a compatible bin a new one is opened.

Pieces are dealt to tasks round robin, in equal numbers, so neither a hot source nor a large
cluster makes a task longer; each task packs bins of its own.  Only ids and sizes travel.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewater.llm.common import n_words, parts, stored

#: Pieces that one task packs, about.
SHARD_ROWS = 20_000
_BIN = 1 << 24


class Bits:
    """A bitmap for each bin over dense numbers of keys; keys that can't conflict have none."""

    def __init__(self, keys: np.ndarray, limit: int):
        _, codes, counts = np.unique(keys, return_inverse=True, return_counts=True)
        often = counts > limit
        dense = np.where(often, np.cumsum(often) - 1, -1)
        self.of = dense[codes]
        self.planes = [np.zeros((64, max(1, -(-int(often.sum()) // 64))), np.uint64) for _ in range(limit)]

    def place(self, item: int) -> tuple[int, np.uint64] | None:
        code = int(self.of[item])
        return None if code < 0 else (code >> 6, np.uint64(1) << np.uint64(code & 63))

    def blocked(self, place: tuple[int, np.uint64] | None, bins: np.ndarray) -> np.ndarray | bool:
        return False if place is None else (self.planes[-1][bins, place[0]] & place[1]) != 0

    def mark(self, place: tuple[int, np.uint64] | None, b: int) -> None:
        for i, plane in enumerate(self.planes):
            if b >= len(plane):
                self.planes[i] = plane = np.vstack([plane, np.zeros_like(plane)])
        if place is not None:
            for plane in self.planes:
                if not plane[b, place[0]] & place[1]:
                    plane[b, place[0]] |= place[1]
                    break


def best_fit(sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int, per_source: int = 4) -> np.ndarray:
    """The bin of each piece; pieces come from large to small, none above the capacity."""
    source_bits, cluster_bits = Bits(sources, per_source), Bits(clusters, 1)
    order: list[int] = []  # residual * _BIN + bin, ascending
    out = np.zeros(len(sizes), np.int64)
    opened = 0
    for item, size in enumerate(sizes.tolist()):
        at_source, at_cluster = source_bits.place(item), cluster_bits.place(item)
        at, step, chosen = bisect_left(order, size * _BIN), 16, -1
        while at < len(order):
            keys = order[at : at + step]
            bins = np.array(keys, np.int64) % _BIN
            free = ~(source_bits.blocked(at_source, bins) | cluster_bits.blocked(at_cluster, bins) | np.zeros(len(bins), bool))
            if free.any():
                chosen = at + int(free.argmax())
                break
            at, step = at + step, min(4096, step * 2)
        if chosen < 0:
            room, b = capacity, opened
            opened += 1
        else:
            room, b = divmod(order.pop(chosen), _BIN)
        insort(order, (room - size) * _BIN + b)
        source_bits.mark(at_source, b)
        cluster_bits.mark(at_cluster, b)
        out[item] = b
    return out


def copy_cluster(text: str = "text") -> Column:
    """Cluster of documents that differ in case, punctuation and white space only."""
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\s\p{Punct}]+", " ")
    return F.xxhash64(F.trim(plain))


def pack(
    docs: DataFrame, *, capacity: int = 2048, per_source: int = 4, cluster: Column | None = None,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``doc_id, piece, start, n_words, source, cluster, bin_id, bin_words`` of every piece.

    docs: doc_id, text, source.  A document longer than ``capacity`` words is cut into full
    pieces and a rest; a text without words (null, blank) is one piece of none.  Every word
    is in exactly one piece and every piece in exactly one bin.  Rows that repeat an id are
    packed each; a null source is a source.  An empty table gives no rows.
    """
    sized = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), n_words("text").alias("size"),
        (copy_cluster() if cluster is None else cluster).cast("long").alias("cluster"),
    )
    pieces = stored(
        sized.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("size") / capacity) - 1).cast("int"))))
        .withColumn("start", F.col("piece").cast("long") * capacity)
        .withColumn("n_words", F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("start")))
        .drop("size"),
        "pieces",
    )
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("bin_id", T.LongType()), T.StructField("bin_words", T.LongType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        if not frames or not (n := sum(map(len, frames))):
            return
        if n >= _BIN:
            raise ValueError("too many pieces for one task")
        rows = pd.concat(frames, ignore_index=True)
        rows["doc_id"] = rows["doc_id"].astype("Int64")
        rows = rows.sort_values(["n_words", "cluster", "source", "doc_id", "piece"], ascending=[False, True, True, True, True], ignore_index=True)
        sources = pd.factorize(rows["source"], use_na_sentinel=False)[0]
        bins = best_fit(rows["n_words"].to_numpy(np.int64), sources, rows["cluster"].to_numpy(np.int64), capacity, per_source)
        rows["bin_id"] = bins + (TaskContext.get().partitionId() << 32)
        rows["bin_words"] = np.bincount(bins, rows["n_words"].to_numpy()).astype(np.int64)[bins]
        yield rows

    return pieces.repartition(parts(pieces.count(), shard_rows)).mapInPandas(run, schema)
