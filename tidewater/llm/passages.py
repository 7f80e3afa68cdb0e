"""Removal of word windows that occur more than once, behind a count-min prefilter.

Every part of the documents sketches its windows: for each of two rows of counters the
cells that its windows fall into, once or more often.  The sketches are merged shard by
shard of the counters, and each part gets back which of its cells hold more than one window
in all.  A window is estimated repeated if its cells are so in both rows; as counters never
come out too low, no repeated window is lost.  A second pass groups exactly the windows that
are estimated repeated, and a third clears those that stand alone.

The sketch has as many cells as the windows need, in shards of fixed size, and is never
gathered: it is dealt out by shard, and what comes back by part.  The exact groups go the
same way, by shards of the keys.  A part sends a window once however often it holds it, so
a passage that a third of all rows hold makes no hot group, and answers are bits in the
order of what was sent.  The texts lie in a table bucketed by part and are not shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import parts, stored, whole_columns
from tidewater.session import shared_dir

#: Rows of counters, and cells in each of them for a byte of text: about 16 for a window.
ROWS, CELLS_PER_BYTE = 2, 2.5
#: Bytes of text whose words are hashed at once, and whose keys one exact group holds at most.
SLAB, GROUP_BYTES = 1 << 20, 16_000_000
TEXTS = "part long, ord int, doc_id string, text string"
FACTOR = np.uint64(0x9E3779B97F4A7C15)
MIXERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class Keys:
    """Two 64-bit keys for windows of words.

    A word is the sum of random numbers of its bytes by powers of an odd number, mixed; a
    window the sum of its words by such powers, and for the second key of its words mixed
    once more.  Both are differences of running sums.
    """

    def __init__(self, width: int):
        self.width = width
        self.bytes = np.random.default_rng(35).integers(1 << 64, size=256, dtype=np.uint64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.up):
            n = 1 << n.bit_length()
            inverse = np.uint64(pow(int(FACTOR), -1, 1 << 64))
            self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, FACTOR))])
            self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, inverse))])

    def _words(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where the words of a text begin, and their hashes."""
        b = np.frombuffer(text, np.uint8)
        edge = np.flatnonzero(np.diff(SPACE[b], prepend=True, append=True))
        start, end = edge[::2], edge[1::2]
        self._powers(len(b) + 1)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.bytes[b] * self.down[: len(b)], out=sums[1:])
        return start, mixed((sums[end] - sums[start]) * self.up[start], 0)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of words of each text, and the hashes of all of them in a row."""
        counts = np.zeros(len(texts), np.int64)
        found: list[np.ndarray] = [np.empty(0, np.uint64)]
        at = 0
        while at < len(texts):
            # short texts together, a long one in pieces that end at white space
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= SLAB):
                size, stop = size + len(texts[stop]) + 1, stop + 1
            if stop == at + 1:
                for piece in _pieces(texts[at]):
                    start, hashes = self._words(piece)
                    counts[at] += len(start)
                    found.append(hashes)
            else:
                start, hashes = self._words(b"\n".join(texts[at:stop]))
                begins = np.cumsum([0, *(len(t) + 1 for t in texts[at:stop])])
                counts[at:stop] = np.diff(np.searchsorted(start, begins))
                found.append(hashes)
            at = stop
        return counts, np.concatenate(found)

    def windows(self, counts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows within texts begin in the row of all words, and their keys."""
        n = len(hashes) - self.width + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        self._powers(len(hashes))
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.down[: len(hashes)], out=sums[1:])
        keys = (sums[self.width :] - sums[:n]) * self.up[:n]
        inside = np.ones(len(hashes), bool)
        for end in np.cumsum(counts).tolist():
            inside[max(0, end - self.width + 1) : end] = False
        at = np.flatnonzero(inside[:n])
        return at, keys[at]


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > SLAB:
        spaces = np.flatnonzero(SPACE[np.frombuffer(text, np.uint8, SLAB, at)])
        # a word longer than a slab stays whole
        end = at + int(spaces[-1]) + 1 if len(spaces) else _next_space(text, at + SLAB)
        yield text[at:end]
        at = end
    yield text[at:]


def _next_space(text: bytes, at: int) -> int:
    while at < len(text) and not SPACE[text[at]]:
        at += 1
    return at


def mixed(keys: np.ndarray, row: int) -> np.ndarray:
    k = keys ^ (keys >> np.uint64(31))
    k *= MIXERS[row]
    k ^= k >> np.uint64(29)
    k *= FACTOR
    return k


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each key in a row of 2**bits counters."""
    return mixed(keys, row) >> np.uint64(64 - bits)


def packed(cell: np.ndarray) -> bytes:
    """Sorted numbers as gaps of as many bytes as the largest needs; the first byte tells."""
    if not len(cell):
        return b""
    gaps = np.diff(cell, prepend=cell.dtype.type(0)).astype("<u8")
    width = max(1, -(-int(gaps.max()).bit_length() // 8))
    return bytes([width]) + gaps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, np.int64)
    width = data[0]
    gaps = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    gaps[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(gaps.view("<i8").ravel())


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def sketch(keys: np.ndarray, bits: int, shard_bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """The sketch of a part: shard, cells that are hit, and for each whether more than once."""
    for row in range(ROWS):
        every = np.sort(cells(keys, row, bits))
        starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        cell, twice = every[starts].view(np.int64), np.diff(starts, append=len(every)) > 1
        shard = cell >> shard_bits
        first = np.flatnonzero(np.diff(shard, prepend=-1))
        for a, b in zip(first, [*first[1:], len(cell)]):
            number = int(shard[a])
            yield (number << 1) | row, packed(cell[a:b] - (number << shard_bits)), np.packbits(twice[a:b]).tobytes()


def merger(shard_bits: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        """One shard of all parts' sketches: for each part its cells with more than one window."""
        seen, repeated = np.zeros(1 << shard_bits, bool), np.zeros(1 << shard_bits, bool)
        for data, bits in zip(pdf["cells"], pdf["twice"]):
            cell = unpacked(data)
            repeated[cell[seen[cell] | _bits(bits, len(cell))]] = True
            seen[cell] = True
        back = [packed((cell := unpacked(data))[repeated[cell]]) for data in pdf["cells"]]
        out = pd.DataFrame({"part": pdf["part"], "shard": pdf["shard"], "cells": back})
        return out[out["cells"].str.len() > 0]

    return merge


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys (two columns), and where in it each distinct one begins."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    sorted_keys = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], (sorted_keys[1:] != sorted_keys[:-1]).any(axis=1)]))


def group_exactly(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard of the keys of all parts: for each part which of its keys stand alone."""
    sent = [np.frombuffer(data, np.uint64).reshape(-1, 2) for data in pdf["keys"]]
    twice = np.concatenate([_bits(bits, len(k)) for bits, k in zip(pdf["twice"], sent)])
    order, starts = _distinct(np.concatenate(sent))
    alone = np.zeros(len(order), bool)
    single = np.diff(starts, append=len(order)) == 1
    alone[order[starts[single]]] = True
    alone &= ~twice
    ends = np.cumsum([0, *map(len, sent)])
    back = [np.packbits(alone[a:b]).tobytes() for a, b in zip(ends, ends[1:])]
    return pd.DataFrame({"part": pdf["part"], "shard": pdf["shard"], "alone": back})


class _Member:
    """Whether numbers are in a sorted set; a small table of bits answers for most that are not."""

    def __init__(self, members: np.ndarray):
        self.members = members
        self.mask = np.int64((1 << max(10, (8 * len(members)).bit_length())) - 1)
        self.hint = np.zeros(int(self.mask) + 1, bool)
        self.hint[members & self.mask] = True

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        """Places of those that are."""
        if not len(self.members):
            return np.empty(0, np.int64)
        near = np.flatnonzero(self.hint[numbers & self.mask])
        found = numbers[near]
        place = np.minimum(np.searchsorted(self.members, found), len(self.members) - 1)
        return near[self.members[place] == found]


class Estimate:
    """The windows of a part that are estimated repeated, and their distinct keys by shard."""

    def __init__(self, texts: list[bytes], hits: pd.DataFrame, width: int, bits: int, shard_bits: int, groups: int):
        keys = Keys(width)
        self.counts, hashes = keys.words(texts)
        self.at, high = keys.windows(self.counts, hashes)
        for row in range(ROWS):
            mine = hits[hits["shard"] % 2 == row] if len(hits) else hits
            near = [unpacked(d) + ((int(s) >> 1) << shard_bits) for s, d in zip(mine["shard"], mine["cells"])]
            full = _Member(np.unique(np.concatenate(near)) if near else np.empty(0, np.int64))
            kept = full(cells(high, row, bits).view(np.int64))
            self.at, high = self.at[kept], high[kept]
        low = np.empty(0, np.uint64)
        if len(self.at):
            at, low = keys.windows(self.counts, mixed(hashes, 1))
            low = low[np.searchsorted(at, self.at)]
        both = np.stack([high, low], axis=1)
        self.order, self.starts = _distinct(both) if len(both) else (np.empty(0, np.int64), np.empty(0, np.int64))
        self.keys = both[self.order[self.starts]]
        self.twice = np.diff(self.starts, append=len(self.order)) > 1
        # distinct keys stand in order; a shard is a range of them
        self.shard = ((self.keys[:, 0] >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)

    def sent(self) -> Iterator[tuple[int, bytes, bytes]]:
        for a, b in self._shards():
            yield int(self.shard[a]), self.keys[a:b].tobytes(), np.packbits(self.twice[a:b]).tobytes()

    def _shards(self) -> list[tuple[int, int]]:
        first = np.flatnonzero(np.diff(self.shard, prepend=-1))
        return list(zip(first, [*first[1:], len(self.shard)]))

    def repeated(self, alone: dict[int, bytes]) -> list[np.ndarray]:
        """For each text where its repeated windows begin, less those that stand alone."""
        gone = np.zeros(len(self.keys), bool)
        for a, b in self._shards():
            gone[a:b] = _bits(alone[int(self.shard[a])], b - a)
        of = np.zeros(len(self.order), np.int64)
        of[self.starts] = 1
        key_of = np.empty(len(self.order), np.int64)
        key_of[self.order] = np.cumsum(of) - 1
        at = self.at[~gone[key_of]]
        ends = np.cumsum(self.counts)
        cut = np.searchsorted(at, ends)
        return [(at[a:b] - (e - n)).astype(np.int32) for a, b, e, n in zip([0, *cut], cut, ends, self.counts)]


def covered(n_words: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which words a window that starts at one of these places covers."""
    edge = np.zeros(n_words + 1, np.int64)
    edge[starts] += 1
    edge[starts + width] -= 1
    return np.cumsum(edge[:-1]) > 0


def _encoded(texts: pd.Series) -> list[bytes]:
    return [(t or "").encode() for t in texts]


def repeated_windows(docs: DataFrame, *, width: int = 35, part_bytes: int = 4_000_000, shard_bits: int = 24) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``doc_id, text, starts``, the places (from 0) of
    windows of ``width`` words that also start anywhere else, the same document included.

    Words are what ASCII white space separates, unchanged.  Null and empty texts, and those
    of fewer words, have no windows; rows that repeat an id are documents of their own, so
    equal rows repeat each other.  Extra columns are ignored; an empty table gives no rows.
    Windows count as equal if their 128-bit keys are.

    A part of the texts ends at ``part_bytes`` (a longer text is a part alone); a shard of
    the sketch has 2**shard_bits cells, two bytes each where it is merged.  Both bound what a
    task holds.  Above a hundred terabytes take more of both (64 MB, 28 bits), so that a part
    has some windows in every shard.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(shard_bits, int(n_bytes * CELLS_PER_BYTE).bit_length())
    groups = parts(n_bytes, GROUP_BYTES)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, filled, order = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            at = []
            for length in batch["text"].str.len().fillna(0):
                if filled and filled + length > part_bytes:
                    part, filled, order = part + 1, 0, 0
                at.append((part, order))
                filled, order = filled + length, order + 1
            yield whole_columns(batch).assign(part=[p for p, _ in at], ord=[o for _, o in at])

    # ids go through pandas as text, which keeps nulls and large numbers apart
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(dealt, TEXTS)
    name = f"tidewater_texts_{uuid.uuid4().hex}"
    (
        rows.write.option("path", shared_dir(spark, "texts")).option("compression", "zstd")
        .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").sortBy("part", "ord").saveAsTable(name)
    )
    texts = spark.table(name)

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, keys = None, [], Keys(width)

        def close() -> Iterator[pd.DataFrame]:
            counts, hashes = keys.words(held)
            found = keys.windows(counts, hashes)[1]
            if len(found):
                shard, cell, twice = zip(*sketch(found, bits, shard_bits))
                yield pd.DataFrame({"part": part, "shard": shard, "cells": cell, "twice": twice})

        for batch in batches:
            for at, text in zip(batch["part"].tolist(), _encoded(batch["text"])):
                # rows of a part stand together; where a part comes in pieces, so does its sketch
                if at != part:
                    yield from close()
                    part, held = at, []
                held.append(text)
        yield from close()

    sketches = texts.select("part", "text").mapInPandas(sketched, "part long, shard long, cells binary, twice binary")
    repeated = stored(sketches.groupBy("shard").applyInPandas(merger(shard_bits), "part long, shard long, cells binary"), "repeated")

    def estimated(key: tuple, docs: pd.DataFrame, hits: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values("ord")
        estimate = Estimate(_encoded(docs["text"]), hits, width, bits, shard_bits, groups)
        sent = pd.DataFrame(list(estimate.sent()), columns=["shard", "keys", "twice"], dtype=object)
        return sent.assign(part=key[0])

    by_part = texts.select("part", "ord", "text").groupBy("part").cogroup(repeated.groupBy("part"))
    sent = by_part.applyInPandas(estimated, "part long, shard long, keys binary, twice binary")
    alone = sent.groupBy("shard").applyInPandas(group_exactly, "part long, shard long, alone binary")
    nothing = F.lit(None).cast("binary")
    answers = repeated.withColumn("alone", nothing).unionAll(
        stored(alone, "alone").select("part", "shard", nothing.alias("cells"), "alone")
    )

    def cleared(key: tuple, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values("ord")
        hits = answers[answers["alone"].isna()]
        exact = answers[answers["alone"].notna()]
        estimate = Estimate(_encoded(docs["text"]), hits, width, bits, shard_bits, groups)
        starts = estimate.repeated(dict(zip(exact["shard"], exact["alone"])))
        return whole_columns(docs[["doc_id", "text"]]).assign(starts=starts)

    found = texts.groupBy("part").cogroup(answers.groupBy("part")).applyInPandas(cleared, "doc_id string, text string, starts array<int>")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def remove_repeated(found: DataFrame, *, width: int = 35) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the texts of ``repeated_windows`` without the words
    that a repeated window covers; the others are joined by one space."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, starts in zip(_encoded(batch["text"]), batch["starts"]):
                # bytes are split at ASCII white space only
                words = left = text.split()
                if len(starts):
                    gone = covered(len(words), np.asarray(starts, np.int64), width)
                    left = [w for w, out in zip(words, gone) if not out]
                rows.append((len(words), len(words) - len(left), b" ".join(left).decode()))
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"]).assign(doc_id=batch["doc_id"].to_numpy(object))

    found = found.withColumn("doc_id", F.col("doc_id").cast("string"))
    found = found.mapInPandas(run, "doc_id string, n_words long, n_removed long, kept string")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
