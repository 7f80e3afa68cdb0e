"""Repeated passages, the Merkle manifest and clustering against brute force, and on awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LONG, awkward_rows
from tests.llm.test_vectors_and_pages import VECTORS, awkward_vectors
from tidewater.llm import centroids, manifest, passages, queries, topk
from tidewater.llm.common import stored

# ---- passages --------------------------------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_passages(texts, width):
    """Per text: words, removed words, the others."""
    places = defaultdict(list)
    for t, text in enumerate(texts):
        words = words_of(text)
        for p in range(len(words) - width + 1):
            places[tuple(words[p : p + width])].append((t, p))
    gone = {(t, p + i) for found in places.values() if len(found) > 1 for t, p in found for i in range(width)}
    out = []
    for t, text in enumerate(texts):
        words = words_of(text)
        left = [w for i, w in enumerate(words) if (t, i) not in gone]
        out.append((len(words), len(words) - len(left), " ".join(left)))
    return out


def passages_of(spark, texts, width, **options):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = passages.repeated_windows(frame, width=width, **options)
    return [tuple(r)[1:] for r in passages.remove_repeated(found, width=width).select("doc_id", "n_words", "n_removed", "kept").orderBy("doc_id").collect()]


@pytest.mark.parametrize("part_bytes, shard_bits", [(4_000_000, 24), (300, 6)])
def test_passages_like_brute_force(spark, part_bytes, shard_bits):
    """Also with a sketch so small that most cells hold several windows, over many parts."""
    rng = random.Random(5)
    shared = [" ".join(f"s{k}w{i}" for i in range(12)) for k in range(4)]
    texts = [None, "", " \t\n", "a b c", "x " * 40]
    for i in range(60):
        own = [f"t{rng.randrange(30)}" for _ in range(rng.randrange(60))]
        at = rng.randrange(len(own) + 1)
        texts.append(" ".join([*own[:at], *([shared[i % 9]] if i % 9 < 4 else []), *own[at:]]))
    texts += [texts[7], texts[8] + " end", "ein Wort \x1c und\x1cein"]
    got = passages_of(spark, texts, 8, part_bytes=part_bytes, shard_bits=shard_bits)
    assert got == brute_passages(texts, 8)
    assert sum(n for _, n, _ in got) > 200


def test_windows_that_overlap_themselves_and_a_hot_passage(spark):
    hot = " ".join(f"h{i}" for i in range(40))
    texts = ["z " * 35, "z " * 36, *(f"own{i} {hot} end{i}" for i in range(300)), "alone " + " ".join(f"q{i}" for i in range(50))]
    got = passages_of(spark, texts, 35, part_bytes=2000)
    assert got == brute_passages(texts, 35)
    assert got[0][1] == 35 and got[1][1] == 36 and got[5] == (42, 40, "own3 end3") and got[-1][1] == 0


def keys_of(windows, texts, which=0):
    counts, hashes = windows.words(texts)
    return windows.windows(counts, passages.mixed(hashes, 1) if which else hashes)


def test_keys_tell_order_and_place():
    keys = passages.Keys(3)
    for which in (0, 1):
        at, a = keys_of(keys, [b"a b c a b c", b"", b"x y", b" c\tb\x0b a\n", b"ab c d"], which)
        assert at.tolist() == [0, 1, 2, 3, 8, 11] and a[0] == a[3] and len(set(a.tolist())) == 5
    at, a = keys_of(keys, [b" ".join(b"w%d" % (i % 50) for i in range(20_000))])
    assert a[0] == a[19_950] and len(set(a.tolist())) == 50


def test_keys_of_slabs(monkeypatch):
    """Texts that are hashed together, alone and in pieces have the same keys."""
    rng = random.Random(1)
    texts = [b" ".join(b"v%d" % rng.randrange(90) for _ in range(n)) for n in (5, 70, 300, 0, 1, 40)] + [b"x" * 300 + b" y", b" \n"]
    whole = keys_of(passages.Keys(4), texts)
    monkeypatch.setattr(passages, "SLAB", 64)
    cut = keys_of(passages.Keys(4), texts)
    assert all((x == y).all() for x, y in zip(whole, cut))
    assert passages.Keys(4).words(texts)[0].tolist() == [len(t.split()) for t in texts]


def test_packed_numbers():
    for values in ([], [0], [5, 6, 300], [0, 70_000], [1, 2**40, 2**40 + 1]):
        assert passages.unpacked(passages.packed(np.array(values, np.int64))).tolist() == values


def test_texts_are_not_shuffled(spark, monkeypatch):
    """The second pass finds the texts in their buckets."""
    plans = []
    monkeypatch.setattr(passages, "stored", lambda df, name: plans.append(df) or stored(df, name))
    from pyspark.sql import DataFrame
    from pyspark.sql.pandas.group_ops import PandasCogroupedOps

    made = PandasCogroupedOps.applyInPandas
    monkeypatch.setattr(PandasCogroupedOps, "applyInPandas", lambda *a: plans.append(made(*a)) or plans[-1])
    frame = spark.createDataFrame([(i, f"some text {i}") for i in range(30)], "doc_id long, text string")
    passages.repeated_windows(frame, width=2)
    for column in ("keys", "starts"):
        grouped = next(p for p in plans if isinstance(p, DataFrame) and column in p.columns)
        plan = grouped._jdf.queryExecution().executedPlan().toString()
        assert "CoGroup" in plan and "Bucketed: true" in plan


def test_passages_on_awkward_tables(spark, clashing, no_documents):
    frame = clashing.withColumns({c: F.lit(1) for c in ("part", "ord", "shard", "cells", "twice", "starts", "high", "low", "alone", "is_text")})
    rows = passages.remove_repeated(passages.repeated_windows(frame)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in awkward_rows())
    # three equal texts of 12 words are too short; the long one repeats itself throughout
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].n_removed == 0 and by_id[3].n_words == 0 and by_id[3].kept == ""
    assert by_id[6].n_words == by_id[6].n_removed == len(LONG.split())
    assert passages.remove_repeated(passages.repeated_windows(no_documents)).collect() == []


# ---- manifest --------------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def steps(levels, i):
    """Siblings from the leaf up: whether on the left, and the digest, or None."""
    out = []
    for level in levels[:-1]:
        other = i ^ 1
        out.append((other < i, level[other]) if other < len(level) else None)
        i >>= 1
    return out


def brute_manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: tree([m[2] for m in sorted(groups[g], key=lambda m: m[:3])]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, (_, _, digest, row) in enumerate(sorted(groups[g], key=lambda m: m[:3])):
            path = [*steps(trees[g], i), *steps(top, k)]
            node = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                node = leaf((*row[:3], row[3] + 1, row[4]))
            for s in path:
                node = h(node) if s is None else h(s[1], node) if s[0] else h(node, s[1])
            root = top[-1][0]
            out.append((row[0], digest, trees[g][-1][0], root, h(*(s[1] for s in path if s)), node, node == root))
    return sorted(out, key=repr)


def verified(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return sorted((tuple(r) for r in manifest.verified(manifest.document_manifest(frame)).collect()), key=repr)


@pytest.mark.parametrize("side", [12, 2])
def test_manifest_like_brute_force(spark, monkeypatch, side):
    """Trees of 1 to 37 leaves, in builders of all their levels, of two, and of one."""
    monkeypatch.setattr(manifest, "SIDE", side)
    rng = random.Random(side)
    rows = []
    for k, size in enumerate((1, 2, 3, 8, 9, 37)):
        lang = (None, "", "de", "\U0001f600", "é", "en")[k]
        rows += [(rng.randrange(10**6), "s", lang, rng.choice((None, 7)), f"text {k} {i}") for i in range(size)]
    rows += [rows[-1], rows[-1], (None, None, "en", 3, None), (None, "x", "en", None, "y")]
    found = verified(spark, rows)
    assert found == brute_manifest(rows)
    assert any(not r[-1] for r in found) and any(r[-1] for r in found)


def test_positions_are_those_of_a_postorder_walk():
    for n in range(1, 40):
        order, top = [], manifest.height(n)

        def walk(level, i):
            if level:
                for child in (2 * i, 2 * i + 1):
                    if child << (level - 1) < n:
                        walk(level - 1, child)
            order.append((level, i))

        walk(top, 0)
        for at, (level, i) in enumerate(order):
            assert manifest.position(n, level, np.array([i]))[0] == at


def test_log_is_in_postorder(spark, monkeypatch):
    monkeypatch.setattr(manifest, "SIDE", 2)
    frame = spark.createDataFrame([(i, None, "en", None, str(i)) for i in range(11)], "doc_id long, source string, lang string, n_chars long, text string")
    made = manifest.document_manifest(frame)
    nodes = sorted(made.log.nodes.collect(), key=lambda r: r["at"])
    assert [r["at"] for r in nodes] == list(range(11 + 6 + 3 + 2 + 1)) and nodes[-1].is_root
    leaves = [r.hash for r in nodes if r.level == 0]
    assert [r.hash for r in nodes] == sum_postorder(tree(leaves))


def sum_postorder(levels):
    out = []

    def walk(level, i):
        if level:
            for child in (2 * i, 2 * i + 1):
                if child < len(levels[level - 1]):
                    walk(level - 1, child)
        out.append(levels[level][i])

    walk(len(levels) - 1, 0)
    return out


def test_manifest_on_awkward_tables(spark, clashing, no_documents):
    frame = clashing.withColumns({c: F.lit(1) for c in ("tree", "n", "index", "hash", "at", "level", "path", "block", "by", "tampered", "root", "group")})
    found = sorted((tuple(r) for r in manifest.verified(manifest.document_manifest(frame)).collect()), key=repr)
    assert found == brute_manifest([(i, source, lang, n, text) for i, text, lang, source, n in awkward_rows()])
    assert manifest.verified(manifest.document_manifest(no_documents)).collect() == []


# ---- centroids -------------------------------------------------------------------------


def brute_lloyd(rows, k, rounds):
    """rows: id, list of integers."""
    def draw(row):
        return (row[0] is None, hashlib.sha256(f"1:{row[0]}".encode()).hexdigest(), row[1])

    centres = [list(r[1]) for r in sorted(rows, key=draw)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, x in rows:
            groups[nearest(x)[1]].append(x)
        for i, members in groups.items():
            centres[i] = [sum(column) // len(members) for column in zip(*members)]
    found = sorted(((i, nearest(x)[1], nearest(x)[0]) for i, x in rows), key=repr)
    return found, centres


@pytest.mark.parametrize("shards, block", [(4, 1024), (3, 7)])
def test_lloyd_like_brute_force(spark, monkeypatch, shards, block):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", block)
    rng = random.Random(shards)
    rows = [(rng.randrange(10**9), [rng.randrange(-40, 40) for _ in range(10)]) for _ in range(90)]
    rows += [rows[0], rows[0], (rows[1][0], [5] * 10), (None, [1] * 10), (2**60 + 1, [-100_000_000] * 10)]
    frame = spark.createDataFrame(rows, "vec_id long, components array<long>")
    found, centres = centroids.lloyd(frame, k=7, rounds=3, width=10, shards=shards)
    expected, brute = brute_lloyd(rows, 7, 3)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    assert [list(r.components) for r in centres.orderBy("cluster").collect()] == brute


def test_ties_and_empty_clusters(spark):
    """Equal first centroids: the smaller number takes all, the other stays empty and as it was."""
    rows = [(i, [3, 4]) for i in range(5)]
    frame = spark.createDataFrame(rows, "vec_id long, components array<long>")
    found, centres = centroids.lloyd(frame, k=3, rounds=2, width=2, shards=2)
    assert {tuple(r)[1:] for r in found.collect()} == {(0, 0)}
    assert [list(r.components) for r in centres.orderBy("cluster").collect()] == [[3, 4]] * 3


def test_centroids_on_awkward_tables(spark):
    frame = awkward_vectors(spark).withColumns({c: F.lit(1) for c in ("block", "shard", "cluster", "distance", "dim", "value", "components")})
    points = topk.scaled(frame, 64).where(F.size("components") == 2)
    found, centres = centroids.lloyd(points, k=16, width=2)
    totals = centroids.with_totals(found, centres).collect()
    # as many clusters as points
    assert Counter(r.vec_id for r in totals) == {0: 1, 50: 2, 350: 1, None: 1, 7: 1} and centres.count() == 6
    assert all(r.inertia == sum(x.distance for x in totals) for r in totals)
    none = topk.scaled(frame.limit(0), 64)
    assert centroids.with_totals(*centroids.lloyd(none)).collect() == []


def test_large_components_and_too_many_centroids(spark):
    frame = spark.createDataFrame([(1, [2**27])], "vec_id long, components array<long>")
    with pytest.raises(Exception, match="or more in size"):
        centroids.lloyd(frame, width=1)
    with pytest.raises(ValueError, match="numbers"):
        centroids.lloyd(frame, k=10**7, width=1)


def test_vectors_stay_where_they_are(spark, folder):
    """Bucketed blocks: no exchange of vectors, neither for distances nor for sums."""
    points = spark.createDataFrame([(i, [i, -i, i % 3]) for i in range(40)], "vec_id long, components array<long>")
    name, _ = centroids._blocks(points, 3, 3)
    blocks = spark.table(name)
    slices = centroids.first_centroids(points, 4, "1", 3, 3)
    nearest = centroids._assign(blocks, slices)
    plan = nearest._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in line and " x#" in line for line in plan.splitlines())
    spark.sql(f"DROP TABLE {name}")


def test_queries_keep_the_intended_rows(spark):
    sf = "/root/testdata/sf0.001"
    embeddings = spark.read.parquet(f"{sf}/embeddings.parquet")
    found = queries.op13_centroids(spark, sf)
    assert found.count() == embeddings.count() and found.select("inertia").distinct().count() == 1
    assert VECTORS.startswith("vec_id")
