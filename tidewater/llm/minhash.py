"""MinHash near-duplicate detection by an inverted join over signature coordinates.

Documents with equal shingle sets form a class and are handled as one row from then on.
Each class has a signature of ``coords`` minima and is posted under its coordinate-value
pairs.  A pair of classes must collide in at least ``least_matches`` coordinates:

* prefix: pairs are ordered from rare to frequent over the whole corpus; two classes with
  that many collisions share one of the first ``coords - least_matches + 1`` of each.  Only
  these are posted, so values that very many documents share are mostly never posted;
* skip: classes already known to hang together are not counted again.  A first pass counts
  each member of a posting against one hub; only postings that still hold several groups
  are counted exhaustively, large ones in blocks of bounded size.

Counting yields groups of classes, a superset of the true ones.  Inside a group the links
are then confirmed on full shingle sets, again in blocks, most collisions first, leaving
out pairs that are already connected; between blocks, hubs come first.  No cap drops a pair, no group is held whole in a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewater.llm.common import not_broadcast, parts, stored
from tidewater.paths import delete
from tidewater.session import shared_dir

#: Classes in one block of an exhaustive count, and rows that one task gets at a time.
BLOCK, TASK_ROWS = 512, 1500
SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("signature", T.ArrayType(T.IntegerType())),
    ]
)
EDGES = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:  # bounds the memory of a task; hashes are simply made anew
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """64-bit hashes of the distinct word shingles of a text, sorted."""

    def __init__(self, width: int):
        self.width, self.words = width, _Words()

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes: lower() touches A-Z only, split() cuts at ASCII white space only
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < self.width:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
        hashes = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        n = len(words) - self.width + 1
        mixed = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
        for i in range(self.width):
            mixed ^= hashes[i : i + n]
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


class Signer:
    def __init__(self, coords: int, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.a = draw.integers(0, 2**63, coords, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 2**63, coords, np.uint64)[:, None]

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        low = None
        for start in range(0, len(shingles), 2048):
            part = (self.a * shingles[start : start + 2048][None, :] + self.b).min(axis=1)
            low = part if low is None else np.minimum(low, part)
        return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def least_matches(coords: int, similarity: float) -> int:
    """Five standard deviations below the collisions expected at the similarity."""
    spread = math.sqrt(coords * similarity * (1 - similarity))
    return max(1, math.floor(coords * similarity - 5 * spread))


def text_key(text: str) -> Column:
    """What tells the texts of a repeated id apart; null for a null text."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def sign(docs: DataFrame, width: int, coords: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, signer = Shingler(width), Signer(coords)
        for batch in batches:
            rows = []
            for doc_id, key, text in zip(batch["doc_id"], batch["key"], batch["text"]):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                if len(found := shingle(text)):
                    rows.append((doc_id, key, len(found), xxhash.xxh3_128_digest(found.tobytes()), signer(found)))
                else:
                    rows.append((doc_id, key, 0, None, None))
            out = pd.DataFrame(rows, columns=SIGNED.names)
            yield out.astype({"doc_id": "Int64"})

    return docs.mapInPandas(run, SIGNED)


# ---- connected components --------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of an edge ``u, v``.

    Alternating large and small stars: each round links nodes to the least neighbour; hubs
    only meet their minimum in a join that AQE can split.  Each round is written, the round
    before is removed.
    """
    spark = edges.sparkSession
    # a node and a neighbour are few bytes: an eighth of the usual partitions holds them
    files = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    path = None
    while True:
        new = shared_dir(spark, "stars")
        pairs.coalesce(files).write.parquet(new)
        known = spark.read.schema(EDGES).parquet(new)
        if path:
            delete(spark, path)
        path = new
        # done when each node has one neighbour and none of those has another itself
        named = known.select("u", F.lit(1).alias("n")).unionAll(known.select("v", F.lit(2)).distinct())
        if named.groupBy("u").agg(F.count("*").alias("times")).where("times > 1").isEmpty():
            break
        both = known.unionAll(known.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
    roots = known.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return known.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


# ---- counting inside tasks -------------------------------------------------------------


class _Sets(dict):
    """Union-find over the groups met in a task."""

    def root(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = x = self.get(up, up)
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self[max(x, y)] = min(x, y)


def _links(part: pd.DataFrame, least: int, shingles, similarity: float) -> Iterator[tuple[int, int]]:
    """Links within one group, or between its two sides, that join different components."""
    nodes, sides = part["node"].to_numpy(), part["side"].to_numpy()
    groups = part["component"].to_numpy()
    marks = np.vstack(part["signature"].to_numpy())
    left = np.flatnonzero(sides <= 0)
    right = np.flatnonzero(sides != 0) if (sides > 0).any() else left
    near = []
    for i in left:
        others = right[right > i] if right is left else right
        others = others[groups[others] != groups[i]]
        others = others[(marks[others] == marks[i]).sum(axis=1) >= least]
        if len(others):
            near.append((i, others))
    if not near:
        return
    # a count is all that is asked for, or full sets confirm it
    linked = _Overlap(part["text"], near, shingles, similarity) if shingles else lambda i, others: others
    sets = _Sets()
    for i, others in near:
        mine = sets.root(groups[i])
        for j in linked(i, np.array([j for j in others if sets.root(groups[j]) != mine], int)):
            if sets.root(groups[i]) != sets.root(groups[j]):
                sets.join(groups[i], groups[j])
                yield int(nodes[i]), int(nodes[j])


class _Overlap:
    """Which of some rows overlap enough with one, on full shingle sets, all at once."""

    def __init__(self, texts: pd.Series, near: list, shingles, similarity: float):
        rows = np.unique(np.concatenate([np.append(others, i) for i, others in near]))
        found = [shingles(texts.iat[i]) for i in rows]
        self.percent = round(similarity * 100)  # so that 0.85 means 85 of 100 exactly
        self.at = {int(i): k for k, i in enumerate(rows)}
        self.size = np.array([len(f) for f in found])
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        distinct, codes = np.unique(np.concatenate(found), return_inverse=True)
        self.codes = codes.astype(np.uint32)
        self.held = np.zeros(len(distinct), bool)

    def __call__(self, i: int, others: np.ndarray) -> np.ndarray:
        k = self.at[int(i)]
        them = np.array([self.at[int(j)] for j in others], int)
        # sizes too far apart can't overlap enough
        low, high = np.minimum(self.size[them], self.size[k]), np.maximum(self.size[them], self.size[k])
        keep = 100 * low >= self.percent * high
        others, them = others[keep], them[keep]
        own = self.codes[self.start[k] : self.start[k + 1]]
        self.held[own] = True
        common = np.array([np.count_nonzero(self.held[self.codes[self.start[t] : self.start[t + 1]]]) for t in them], int)
        self.held[own] = False
        return others[100 * common >= self.percent * (self.size[them] + self.size[k] - common)]


def count_links(members: DataFrame, least: int, width: int | None = None, similarity: float = 0) -> DataFrame:
    """Edges that connect the components met in each group of ``members``.

    members: ``gid, node, component, signature`` and, to confirm on sets, ``text``.  Groups
    of up to ``BLOCK`` rows share a task; larger ones are cut into blocks, each pair of
    which is a group of its own.  A component of ``BLOCK`` rows or more has its own blocks,
    which don't meet each other.
    """
    sizes = stored(
        members.groupBy("gid").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo < hi").select("gid", "n"),
        "sizes",
    )
    names = ["gid", "side", "node", "component", "signature"] + ["text"] * (width is not None)
    # many small groups make one task group of bounded size
    small, large = sizes.where(F.col("n") <= BLOCK), sizes.where(F.col("n") > BLOCK)
    tasks = parts(small.agg(F.sum("n")).first()[0] or 0, TASK_ROWS)
    cut = members.join(small.select("gid"), "gid").withColumn("side", F.lit(0)).select(
        F.pmod("gid", F.lit(tasks)).alias("task"), F.lit(-1).cast("long").alias("partner"), *names
    )
    if not large.isEmpty():
        cut = cut.unionAll(_block_pairs(members.join(large.select("gid"), "gid")).select("task", "partner", *names))
    return _counted(cut, least, width, similarity)


def _block_pairs(members: DataFrame) -> DataFrame:
    """Each row once for each block that its own has to meet: ``task, partner, side`` are added.

    side 0: both blocks are the same.
    """
    met = members.groupBy("gid", "component").agg(F.count("*").alias("n")).withColumn(
        "owner", F.when(F.col("n") >= BLOCK, F.col("component"))
    )
    met = stored(met, "met")
    shares = stored(
        met.groupBy("gid", "owner").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks")), "shares"
    )
    # 'at' is kept in a written table, so it never changes
    blocks = stored(
        shares.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("at", F.monotonically_increasing_id()),
        "blocks",
    )
    others = blocks.select("gid", F.col("owner").alias("other_owner"), F.col("at").alias("other"))
    meet = F.coalesce(F.col("owner") != F.col("other_owner"), F.lit(True))
    pairs = blocks.join(others, "gid").where(meet).select(F.col("gid").alias("g"), F.col("owner").alias("o"), "blocks", "block", "at", "other")
    owned = members.join(not_broadcast(met.select("gid", "component", "owner")), ["gid", "component"])
    sized = shares.select(F.col("gid").alias("g"), F.col("owner").alias("o"), F.col("blocks").alias("of"))
    same = (F.col("gid") == F.col("g")) & F.col("owner").eqNullSafe(F.col("o"))
    placed = owned.join(sized, same).drop("g", "o").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("of")).cast("int"))
    side = F.when(F.col("at") == F.col("other"), 0).when(F.col("at") < F.col("other"), -1).otherwise(1)
    return placed.join(pairs, same & (F.col("mine") == F.col("block"))).withColumns(
        {"side": side, "task": F.least("at", "other"), "partner": F.greatest("at", "other")}
    )


def _hub_links(members: DataFrame, sizes: DataFrame, least: int, width: int, similarity: float) -> DataFrame:
    """Edges between the rows of a large group and one hub of each of its blocks.

    members: as for ``count_links``; sizes: ``gid, n``.  A group of rows is a block and the
    hubs, ``BLOCK`` of them at most; what hubs don't link is left to ``count_links``.
    """
    names = ["gid", "side", "node", "component", "signature", "text"]
    blocks = F.ceil(F.col("n") / BLOCK)
    placed = members.join(sizes, "gid").withColumn("partner", F.pmod(F.xxhash64("node"), blocks).cast("long"))
    seat = F.pmod(F.xxhash64("node"), F.least(blocks, F.lit(BLOCK)))
    chosen = members.select("gid", "node").join(sizes, "gid").groupBy("gid", seat.alias("seat")).agg(
        F.min_by("node", F.xxhash64("node", F.lit(1))).alias("node")
    )
    hubs = members.join(stored(chosen.select("node"), "hubs"), "node")
    slices = sizes.select("gid", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("partner"))
    cut = placed.withColumn("side", F.lit(1)).select(F.col("gid").alias("task"), "partner", *names).unionAll(
        hubs.withColumn("side", F.lit(-1)).join(slices, "gid").select(F.col("gid").alias("task"), "partner", *names)
    )
    return _counted(cut, least, width, similarity)


def _counted(cut: DataFrame, least: int, width: int | None, similarity: float) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        shingles = Shingler(width) if width is not None else None
        out = [e for _, part in pdf.groupby("gid", sort=False) if len(part) > 1 for e in _links(part, least, shingles, similarity)]
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return cut.groupBy("task", "partner").applyInPandas(run, EDGES)


def _merged(known: DataFrame, more: DataFrame) -> DataFrame:
    """``known`` (node, component) with the components made one that edges ``more`` join."""
    edges = (
        more.join(not_broadcast(known.select(F.col("node").alias("u"), F.col("component").alias("cu"))), "u", "left")
        .join(not_broadcast(known.select(F.col("node").alias("v"), F.col("component").alias("cv"))), "v", "left")
        .select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    )
    into = components(edges).select(F.col("node").alias("component"), F.col("component").alias("into"))
    renamed = known.join(into, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    # nodes that had no link yet
    added = into.select(F.col("component").alias("node"), F.col("into").alias("component")).join(known.select("node"), "node", "left_anti")
    return stored(renamed.unionAll(added), "known")


def near_duplicates(
    docs: DataFrame, *, width: int = 5, similarity: float = 0.8, coords: int = 64
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text).

    Words are cut at ASCII white space, A-Z count as a-z.  A text with fewer words than
    ``width`` is one shingle; null or blank texts have none and are linked with nothing.
    ``component_id`` is the smallest id reachable over links of at least ``similarity``
    (Jaccard, on full sets).  Repeated rows are each returned.  A row with a null id keeps a
    null component if nothing with an id has its shingles, else it takes that component; it
    can't link two different texts.  Other columns are ignored.
    """
    found = keyed_duplicates(docs, width=width, similarity=similarity, coords=coords)
    return found.select("doc_id", "n_shingles", "component_id").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keyed_duplicates(
    docs: DataFrame, *, width: int = 5, similarity: float = 0.8, coords: int = 64
) -> DataFrame:
    """``doc_id, key, n_shingles, component_id, kept`` for every row of ``docs``.

    As ``near_duplicates``, but ``kept`` tells the texts of a repeated id apart by their
    ``text_key``: of a component one pair of id and key is kept, the smallest.
    """
    least = least_matches(coords, similarity)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key("text").alias("key"), "text")
    signed = stored(sign(texts, width, coords), "signed")
    # the id is kept in 'node' of a written table, so it never changes
    classes = stored(
        signed.where("n_shingles > 0").groupBy("digest")
        .agg(
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "key"))).alias("least"),
            F.first("signature").alias("signature"),
        )
        .select("digest", F.col("least.doc_id").alias("least_id"), F.col("least.key").alias("least_key"), "signature")
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    marks = not_broadcast(classes.select("node", "signature"))
    tokens = classes.select("node", F.posexplode("signature").alias("at", "value")).select(
        "node", (F.col("at").cast("long") * F.lit(1 << 32) + F.col("value").cast("long")).alias("gid")
    )
    shared = tokens.groupBy("gid").agg(F.count("*").alias("n")).where("n > 1")
    prefix = coords - least + 1
    posted = stored(
        tokens.join(not_broadcast(shared), "gid").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "gid"))).alias("own"))
        # values that nothing else has come first in the order and use up the prefix
        .where(F.size("own") > coords - prefix)
        .select("node", F.explode(F.expr(f"slice(own, 1, size(own) - {coords - prefix})")).alias("own"))
        .select("node", "own.gid"),
        "posted",
    )
    hubs = posted.groupBy("gid").agg(F.min_by("node", F.xxhash64("node")).alias("hub"), F.count("*").alias("n"))
    spokes = posted.join(not_broadcast(hubs.where("n > 1")), "gid").where("node <> hub").select("node", "hub").distinct()
    counted = (
        spokes.join(marks, "node")
        .join(not_broadcast(classes.select(F.col("node").alias("hub"), F.col("signature").alias("hub_signature"))), "hub")
        .where(F.expr(f"size(filter(zip_with(signature, hub_signature, (a, b) -> a = b), x -> x)) >= {least}"))
    )
    near_hub = stored(counted.select(F.col("node").alias("u"), F.col("hub").alias("v")), "near_hub")
    groups = components(near_hub)
    placed = (
        posted.join(groups, "node", "left")
        .select("gid", "node", F.coalesce("component", "node").alias("component"))
    )
    open_groups = placed.groupBy("gid").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    left_over = stored(placed.join(open_groups.select("gid"), "gid", "left_semi").join(marks, "node"), "left_over")
    candidates = components(near_hub.unionAll(count_links(left_over, least)))

    # full sets, for members of candidate groups only; keys tell texts of a repeated id apart
    members = (
        candidates.join(classes, "node")
        .join(texts.select(F.col("doc_id").alias("least_id"), F.col("key").alias("least_key"), "text"), ["least_id", "least_key"])
        .select(F.col("component").alias("gid"), "node", "signature", "text")
    )
    members = stored(members.dropDuplicates(["node"]), "members")
    inner = members.groupBy("gid").agg(F.count("*").alias("n"))
    first = members.join(inner, "gid").select(
        # within blocks first, then between them, where most are known to hang together
        F.xxhash64("gid", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK))).alias("gid"),
        "node", F.col("node").alias("component"), "signature", "text",
    )
    links = stored(count_links(first, least, width, similarity), "links")
    known = components(links)
    large = stored(inner.where(F.col("n") > BLOCK), "large")
    if not large.isEmpty():
        held = members.join(large.select("gid"), "gid", "left_semi")

        def second() -> DataFrame:
            return held.join(not_broadcast(known), "node", "left").select(
                "gid", "node", F.coalesce("component", "node").alias("component"), "signature", "text"
            )

        # hubs join most, so that only members of different components are exchanged
        known = _merged(known, _hub_links(second(), large, least, width, similarity))
        known = _merged(known, count_links(second(), least, width, similarity))
    nodes = classes.select("node", "digest", "least_id", "least_key").join(not_broadcast(known), "node", "left")
    named = nodes.select("digest", "least_id", "least_key", F.coalesce("component", "node").alias("component"))
    ids = named.groupBy("component").agg(F.min(F.struct("least_id", "least_key")).alias("first"))
    of_class = named.join(ids, "component").select(
        "digest", F.col("first.least_id").alias("component_id"), F.col("first.least_key").alias("kept_key")
    )
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("key").eqNullSafe(F.col("kept_key"))
    blank = F.col("n_shingles") == 0
    return signed.join(of_class, "digest", "left").select(
        "doc_id", "key", "n_shingles",
        F.when(blank, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (blank | kept).alias("kept"),
    )
