"""Token counts through a cache of digests.

Contents are looked up by digest and tokenizer version in a stored table of counts; only
distinct contents that it lacks are encoded, and their counts are appended to it.  Two
contents share a digest only if they are equal: this tokenizer has no normaliser, so the
normal form of a text is the text, and of null the empty text.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewater.llm.common import stored
from tidewater.paths import exists
from tidewater.session import shared_dir

#: Distinct pieces whose counts a task remembers; older ones are encoded again.
REMEMBERED = 300_000
COUNTS = T.StructType(
    [
        T.StructField("digest", T.BinaryType()),
        T.StructField("version", T.StringType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def version(tokenizer_file: str) -> str:
    with open(tokenizer_file, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class Counter:
    """Counts tokens with the library's tokenizer.

    Byte-level tokenizers never merge across the pieces that their pattern cuts, so a piece
    is encoded once and its count remembered.  Special strings are cut out first and are a
    token each, as the library does by default.
    """

    def __init__(self, tokenizer_file: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces = regex.compile(pattern).findall
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.known: dict[str, int] = {}

    def _plain(self, text: str) -> int:
        pieces = self.pieces(text)
        known = self.known
        try:
            return sum(map(known.__getitem__, pieces))
        except KeyError:
            new = list({p for p in pieces if p not in known})
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(set(pieces))
        for piece, code in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            known[piece] = len(code)
        return sum(map(known.__getitem__, pieces))

    def __call__(self, text: str) -> int:
        if self.special is None or not (cuts := list(self.special.finditer(text))):
            return self._plain(text)
        total, at = len(cuts), 0
        for m in cuts:
            total += self._plain(text[at : m.start()])
            at = m.end()
        return total + self._plain(text[at:])


def count_tokens(
    docs: DataFrame, *, tokenizer_file: str, pattern: str, cache: str | None = None, limit: int = 512
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs`` (doc_id, text).

    ``cache``: folder of stored counts, made when missing; by default a new one.  A run that
    breaks off leaves it as it was or with a whole new append.  Null counts as the empty
    text, which has no tokens.  Repeated rows are each returned, and encoded once.
    """
    spark = docs.sparkSession
    cache = cache or shared_dir(spark, "token_counts")
    label = version(tokenizer_file)
    digest = content_digest(F.col("text"))
    keys = stored(
        docs.select(
            F.col("doc_id").cast("long"), digest.alias("digest"),
            F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n_bytes"),
        ),
        "digests",
    )
    texts = docs.select(digest.alias("digest"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    if exists(spark, cache):
        stored_counts = spark.read.schema(COUNTS).parquet(cache).where(F.col("version") == label)
        texts = texts.join(stored_counts.select("digest"), "digest", "left_anti")
    misses = texts.groupBy("digest").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = Counter(tokenizer_file, pattern)
        for batch in batches:
            yield pd.DataFrame(
                {"digest": batch["digest"], "version": label, "n_tokens": [count(t) for t in batch["text"]]}
            )

    misses.mapInPandas(run, COUNTS).write.mode("append").parquet(cache)
    # a content may be there twice when two runs appended side by side
    counts = (
        spark.read.schema(COUNTS).parquet(cache).where(F.col("version") == label)
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    )
    return keys.join(counts, "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
