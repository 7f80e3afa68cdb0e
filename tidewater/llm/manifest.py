"""Merkle manifest of a data set: an append log of tree nodes in postorder.

Rows are hashed to leaves, numbered within their tree, and dealt out in aligned blocks of
2**SIDE leaves.  A builder takes a block, hashes it up to its own root, and writes the nodes
in the order in which they are completed.  Block roots are the leaves of the next tier,
until one node is left.  Where a node stands in its tree's log follows from subtree sizes
alone, so the sibling that a proof needs is addressed, not searched: a builder's part of
the log is read beside its leaves, and the path above the block's root comes from the tier
above, once for each block.

A node's children are two consecutive nodes; the last one of an odd level is a child alone.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewater.llm.common import stored, whole_columns

#: Levels that a builder adds; it holds 2**SIDE leaves and as many nodes above them.
SIDE = 12
#: A level of a path without a sibling.
ALONE = "-"
NODES = "tree long, n long, level int, index long, at long, hash string, is_root boolean"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*columns: Column) -> Column:
    """sha256 of the values: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""

    def field(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    return F.sha2(F.concat(*map(field, columns)), 256)


# ---- the closed form -------------------------------------------------------------------


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return max(0, (n - 1).bit_length())


def subtree_size(leaves: np.ndarray, level: int) -> np.ndarray:
    """Nodes under and with a node of this level over so many leaves."""
    return sum(-(-leaves // (1 << k)) for k in range(level + 1))


def position(n: int, level: int, index: np.ndarray) -> np.ndarray:
    """Where nodes of a level stand in the postorder log of a tree of ``n`` leaves.

    Before a node's subtree stand all nodes completed by its first leaf ``a``, that is
    ``a + a // 2 + a // 4 + ...``; the node is the last of its own subtree.
    """
    first = np.asarray(index, np.int64) << level
    before = sum(first >> k for k in range(max(1, height(n) + 1)))
    return before + subtree_size(np.minimum(n - first, 1 << level), level) - 1


# ---- numbering -------------------------------------------------------------------------


def numbered(rows: DataFrame, group: str | None, order: list[str]) -> DataFrame:
    """``rows`` with ``index``, their place in the group by ``order``, and ``n``, its rows.

    A range sort over all rows, so a group with a third of them is spread; only the first
    place of each group in each range is summed in a window.  Nulls come first.
    """
    rows = rows.withColumn("__tie", F.monotonically_increasing_id())
    rows = rows.withColumn("__group", F.col(group) if group else F.lit(0))
    keys = [F.col(c).asc_nulls_first() for c in ("__group", *order, "__tie")]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(placed.withColumn("__place", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("__range", F.shiftright("__place", 33))
    spans = placed.groupBy("__group", "__range").agg(F.min("__place").alias("__first"), F.count("*").alias("__rows"))
    earlier = Window.partitionBy("__group").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col("__group").alias("__g"), F.col("__range").alias("__r"), "__first",
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__rows").over(Window.partitionBy("__group")).alias("n"),
    )
    same = F.col("__group").eqNullSafe(F.col("__g")) & (F.col("__range") == F.col("__r"))
    found = placed.join(spans, same).withColumn("index", F.col("__place") - F.col("__first") + F.col("__before"))
    return found.drop("__tie", "__group", "__place", "__range", "__g", "__r", "__first", "__before")


# ---- log and paths ---------------------------------------------------------------------


@dataclass
class Log:
    """The nodes of some trees, and how many tiers of builders made them."""

    nodes: DataFrame
    tiers: int

    def roots(self) -> DataFrame:
        return self.nodes.where("is_root").select("tree", "n", F.col("hash").alias("root"))


def _builder(base: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("index")
        tree, n, first = int(pdf["tree"].iloc[0]), int(pdf["n"].iloc[0]), int(pdf["index"].iloc[0])
        hashes, level, top = pdf["hash"].tolist(), base, height(n)
        made = []
        while True:
            # the leaves of a tier above are in the log already
            if level > base or base == 0:
                index = np.arange(first, first + len(hashes), dtype=np.int64)
                made += zip([level] * len(hashes), index.tolist(), position(n, level, index).tolist(), hashes)
            if level == min(base + SIDE, top):
                break
            hashes = [digest(*hashes[i : i + 2]) for i in range(0, len(hashes), 2)]
            level, first = level + 1, first >> 1
        made.sort(key=lambda node: node[2])
        nodes = pd.DataFrame(made, columns=["level", "index", "at", "hash"], dtype=object)
        return nodes.assign(tree=tree, n=n, is_root=nodes["level"] == top)[[c.split()[0] for c in NODES.split(", ")]]

    return build


def write_log(leaves: DataFrame) -> Log:
    """The log of the trees that ``leaves`` (tree, n, index, hash) are of."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    tiers = max(1, -(-height(most) // SIDE))
    nodes, current = None, leaves.select("tree", "n", "index", "hash")
    for tier in range(tiers):
        block = F.shiftright("index", SIDE)
        made = stored(current.withColumn("block", block).groupBy("tree", "block").applyInPandas(_builder(tier * SIDE), NODES), "nodes")
        nodes = made if nodes is None else nodes.unionAll(made)
        current = made.where((F.col("level") == (tier + 1) * SIDE) & ~F.col("is_root")).select("tree", "n", "index", "hash")
    return Log(nodes, tiers)


def _reader(base: int, out: list[str]):
    def read(children: pd.DataFrame, beside: pd.DataFrame) -> pd.DataFrame:
        """Siblings of every child up to the block's root, then the path above that."""
        if not len(children):
            return pd.DataFrame({c: [] for c in out})
        above = list(beside[beside["path"].notna()]["path"].iloc[0])
        inner = beside[beside["path"].isna()]
        n = int(children["n"].iloc[0])
        index = children["index"].to_numpy(np.int64)
        at = np.concatenate([position(n, base, index), inner["at"].to_numpy(np.int64)])
        hashes = np.concatenate([children["hash"].to_numpy(object), inner["hash"].to_numpy(object)])
        order = np.argsort(at)
        at, hashes = at[order], hashes[order]
        levels = []
        for level in range(base, min(base + SIDE, height(n))):
            sibling = (index >> (level - base)) ^ 1
            there = sibling < -(-n // (1 << level))
            found = np.full(len(index), ALONE, object)
            place = np.searchsorted(at, position(n, level, sibling[there]))
            found[there] = np.where(sibling[there] & 1, "R", "L").astype(object) + hashes[place]
            levels.append(found)
        own = np.stack(levels, axis=1).tolist() if levels else [[] for _ in index]
        return whole_columns(children).assign(path=[p + above for p in own])[out]

    return read


def paths(log: Log, leaves: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """``leaves`` (tree, n, index, hash and more text columns) with ``path``.

    The path holds one entry for each level from the leaf up: ``L`` or ``R``, the side that
    the sibling stands on, and its digest, or ``-`` where the node has none.  ``above``
    (tree, path): entries that follow those of a tree's own levels.
    """
    roots = log.roots()
    if above is None:
        above = roots.select("tree", F.lit(None).cast("array<string>").alias("path"))
    empty = F.array().cast("array<string>")
    # the tier whose builder made the root: a tree of n leaves has as many levels as n - 1 has bits
    levels = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
    tops = roots.withColumn("tier", F.greatest(F.lit(0), F.floor((levels - 1) / SIDE)).cast("int")).drop("root")
    tops = tops.join(above, "tree").select("tree", "tier", F.lit(0).cast("long").alias("block"), F.coalesce("path", empty).alias("path"))
    found = None
    for tier in reversed(range(log.tiers)):
        base = tier * SIDE
        if tier:
            children = log.nodes.where((F.col("level") == base) & ~F.col("is_root")).select("tree", "n", "index", "hash")
        else:
            children = leaves
        # columns of their own, as both sides of the grouping may come from the log
        children = children.select([F.col(c).alias(c) for c in children.columns])
        inner = log.nodes.where((F.col("level") > base) & (F.col("level") < base + SIDE))
        # a block's number is its root's at the level where the tier ends
        inner = inner.select("tree", F.expr(f"shiftright(index, {base + SIDE} - level)").alias("block"), "at", "hash", F.lit(None).cast("array<string>").alias("path"))
        entry = tops.where(F.col("tier") == tier).drop("tier")
        if found is not None:
            entry = entry.unionAll(found.select("tree", F.col("index").alias("block"), "path"))
        entry = entry.select("tree", "block", F.lit(None).cast("long").alias("at"), F.lit(None).cast("string").alias("hash"), "path")
        schema = T.StructType([*children.schema.fields, T.StructField("path", T.ArrayType(T.StringType()))])
        found = (
            children.withColumn("block", F.shiftright("index", SIDE)).groupBy("tree", "block")
            .cogroup(inner.unionAll(entry).groupBy("tree", "block"))
            .applyInPandas(_reader(base, schema.names), schema)
        )
        found = stored(found, "paths") if tier else found
    return found


def siblings(path: Column) -> Column:
    """The digests of a path, from the leaf up."""
    return F.transform(F.filter(path, lambda s: s != ALONE), lambda s: F.substring(s, 2, 64))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""

    def step(node: Column, s: Column) -> Column:
        other = F.substring(s, 2, 64)
        both = F.when(s == ALONE, node).when(F.startswith(s, F.lit("L")), F.concat(other, node)).otherwise(F.concat(node, other))
        return F.sha2(both, 256)

    return F.aggregate(path, start, step)


@dataclass
class Manifest:
    """``leaves``: tree, n, index, hash and the columns kept; ``trees``: tree, n, group,
    subroot, root and the path of the subroot; the logs of the groups' trees and of the tree
    over them."""

    leaves: DataFrame
    trees: DataFrame
    log: Log
    top: Log

    def proofs(self) -> DataFrame:
        """Every leaf's kept columns with ``hash, path, subroot, root``: its path to the root."""
        kept = [c for c in self.leaves.columns if c not in ("tree", "n", "index")]
        found = paths(self.log, self.leaves, self.trees.select("tree", "path"))
        # one row for each group
        return found.select("tree", *kept, "path").join(self.trees.select("tree", "subroot", "root"), "tree").drop("tree")


def build(rows: DataFrame, group: str, order: list[str]) -> Manifest:
    """The manifest of ``rows``: ``hash`` (a leaf), a group, and columns of text to keep.

    One tree for each value of the group (null is a value, and the first), its leaves by
    ``order`` (columns or expressions' names, nulls first) and equal ones by hash; over the
    trees' roots in the order of their groups, one tree.  Equal rows are leaves side by side.
    An empty table has no trees.
    """
    placed = stored(numbered(rows, group, [*order, "hash"]), "leaves")
    names = placed.groupBy(group).agg(F.max("n").alias("leaves"))
    names = stored(numbered(names, None, [group]).select(F.col(group).alias("__name"), F.col("index").alias("tree")), "groups")
    placed = placed.join(names, F.col(group).eqNullSafe(F.col("__name"))).drop("__name", group, *order)
    placed = stored(placed, "leaves")
    log = write_log(placed)
    subroots = stored(log.roots().select(F.lit(0).cast("long").alias("zero"), F.col("tree").alias("index"), F.col("root").alias("hash")), "subroots")
    n = subroots.count()
    subroots = subroots.select(F.col("zero").alias("tree"), F.lit(n).cast("long").alias("n"), "index", "hash")
    top = write_log(subroots)
    proofs = paths(top, subroots)
    trees = proofs.join(top.roots().select("tree", "root"), "tree").select(F.col("index").alias("tree"), F.col("hash").alias("subroot"), "root", "path")
    return Manifest(placed, stored(trees.join(names, "tree").withColumnRenamed("__name", "group"), "trees"), log, top)


def document_manifest(docs: DataFrame) -> Manifest:
    """The manifest of ``documents``, by lang and doc_id.

    Kept columns: ``doc_id`` (as text) and ``tampered``, the leaf with 1 added to n_chars
    where 7 divides the unsigned crc32 of the decimal doc_id, else the leaf.  Null ids come
    first and are not tampered with; a null n_chars stays.  Rows that repeat an id are leaves
    of their own, in the order of their hashes.
    """
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    plain = leaf(*columns)
    columns[3] = F.col("n_chars") + 1
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    rows = docs.select(
        F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("by"), F.col("doc_id").cast("string").alias("doc_id"),
        plain.alias("hash"), F.when(hit, leaf(*columns)).otherwise(plain).alias("tampered"),
    )
    return build(stored(rows, "hashed"), "lang", ["by"])


def verified(manifest: Manifest) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every document."""
    proofs = manifest.proofs()
    return proofs.select(
        F.col("doc_id").cast("long"), F.col("hash").alias("leaf"), "subroot", "root",
        F.sha2(F.array_join(siblings(F.col("path")), ""), 256).alias("proof_sha256"),
        fold(F.col("tampered"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
