"""Language of texts in two steps: the family, then one against one within it.

Texts are counted as hashed two- and three-byte runs of their lower-cased form, over the
whole text.  A linear support vector machine for each family says which one it is; within
the family one machine for each pair of languages votes.  All are fitted with squared hinge
loss on a bounded sample of the labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

BUCKETS = 1 << 12
#: Texts of each language that are learned from, at most.
PER_LANGUAGE = 500
#: Parts in which the ids of a language are ranked first.
PARTS = 64
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
# Families of common languages by their two-letter codes
FAMILIES = {
    "germanic": "af da de en is lb nl no nb nn sv fy yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr uz",
    "indo_aryan": "bn gu hi mr ne pa ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "austronesian": "id jv mg ms tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    """Family of a language; one that isn't listed is a family of its own."""
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], lang)


def counts(text: str) -> np.ndarray:
    """Root of the share of each bucket, so that long runs of one word weigh less."""
    out = np.zeros(BUCKETS, np.int64)
    data = text.lower().encode("utf-8", "surrogatepass")
    for start in range(0, max(1, len(data) - 1), 1 << 18):  # bounds what a very long text needs
        b = np.frombuffer(data, np.uint8, min(len(data) - start, (1 << 18) + 2), start).astype(np.uint32)
        two = (b[:-1] << np.uint32(8)) | b[1:]
        three = (two[:-1] << np.uint32(8)) | b[2:]
        for grams, salt in ((two[: 1 << 18], 0x85EBCA6B), (three[: 1 << 18], 0x9E3779B1)):
            out += np.bincount((grams * np.uint32(salt)) >> np.uint32(20), minlength=BUCKETS)
    total = out.sum()
    return np.sqrt(out / total).astype(np.float32) if total else out.astype(np.float32)


def machine(x: np.ndarray, y: np.ndarray, rounds: int = 150, cost: float = 4.0) -> np.ndarray:
    """Weights of a linear machine, the last one the bias; y is 1 or -1, classes weigh alike."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), np.float32(0)
    ahead_w, ahead_b = w.copy(), b
    rate = 0.5 / (0.01 + 2 * cost * 2)
    for i in range(rounds):  # accelerated gradient steps
        slack = np.maximum(0, 1 - y * (x @ ahead_w + ahead_b)) * share * y
        new_w = ahead_w + rate * (2 * cost * (x.T @ slack) - 0.01 * ahead_w)
        new_b = ahead_b + rate * 2 * cost * slack.sum()
        pull = i / (i + 3)
        ahead_w, ahead_b = new_w + pull * (new_w - w), new_b + pull * (new_b - b)
        w, b = new_w, new_b
    return np.append(w, b).astype(np.float32)


class Model:
    def __init__(self, x: np.ndarray, langs: list[str]):
        langs = np.array(langs, dtype=object)
        self.families = sorted({family(lang) for lang in langs})
        self.members = {f: sorted({lang for lang in langs if family(lang) == f}) for f in self.families}
        of = np.array([family(lang) for lang in langs], dtype=object)
        self.pairs = [(a, b) for f in self.families for a, b in combinations(self.members[f], 2)]
        columns = [machine(x, np.where(of == f, 1, -1).astype(np.float32)) for f in self.families]
        for a, b in self.pairs:
            rows = (langs == a) | (langs == b)
            columns.append(machine(x[rows], np.where(langs[rows] == a, 1, -1).astype(np.float32)))
        self.weights = np.stack(columns, axis=1) if columns else np.zeros((BUCKETS + 1, 0), np.float32)

    def __call__(self, text: str | None) -> tuple[str, float]:
        if not self.families or not text or not LETTER.search(text):
            return UNKNOWN, 0.0
        margins = counts(text) @ self.weights[:-1] + self.weights[-1]
        chance = 1 / (1 + np.exp(-4 * margins.astype(float)))
        n = len(self.families)
        first = int(margins[:n].argmax())
        members = self.members[self.families[first]]
        score = float(chance[first]) if n > 1 else 1.0
        votes = dict.fromkeys(members, 0.0)
        for (a, b), p in zip(self.pairs, chance[n:]):
            if a in votes:
                votes[a] += p
                votes[b] += 1 - p
        # ties go to the first by name
        lang = min(votes, key=lambda x: (-votes[x], x))
        if len(members) > 1:
            score *= votes[lang] / (len(members) - 1)
        return lang, min(1.0, max(0.0, score))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model of ``labelled`` (doc_id, text, lang); at most ``per_language`` ids of each
    language, those with the least hash, come to the driver as counts of one text each: the
    least, where an id is repeated.  Rows without an id, a text or a language teach nothing."""
    usable = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text"
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    # ids first: the windows then read no text; a frequent language is ranked in parts, so the
    # last window sees per_language ids of each part, however many rows and tasks there are
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTS)).alias("part")
    in_part, in_all = Window.partitionBy("lang", "part").orderBy(*order), Window.partitionBy("lang").orderBy(*order)
    chosen = (
        usable.where("doc_id is not null").select("doc_id", "lang").distinct().select("*", part)
        .withColumn("at", F.row_number().over(in_part)).where(F.col("at") <= per_language)
        .withColumn("at", F.row_number().over(in_all)).where(F.col("at") <= per_language)
        .select("doc_id", "lang")
    )

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("counts", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[[bool(LETTER.search(t)) for t in batch["text"]]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang": batch["lang"], "counts": [counts(t) for t in batch["text"]]})

    # at most per_language ids of each language are broadcast, and as many texts come back
    texts = usable.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    sample = texts.mapInPandas(run, schema).toPandas()
    sample = sample.sort_values(["lang", "doc_id"], ignore_index=True)
    x = np.vstack(sample["counts"].to_numpy()).astype(np.float32) if len(sample) else np.zeros((0, BUCKETS), np.float32)
    return Model(x, sample["lang"].tolist())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs`` (doc_id, text).

    A text that is null or has no letter, or any text when nothing was learned, is ``und``
    with score 0.  Rows are independent; repeated ones give equal results.
    """
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [model(t) for t in batch["text"]]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].astype("Int64"), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, schema)
