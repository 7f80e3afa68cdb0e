"""Documents to packed training bins: quality, near duplicates, personal data, mix, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows of the stage before, and
returns the columns of ``documents``; the last returns the pieces and their bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.llm import minhash, mixing, packing, pii, quality
from tidewater.llm.common import read, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, does not reject."""
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


# above every id that a table has; rows without one get numbers from here downwards
LAST = 2**63 - 1


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8.

    Rows with equal id and text count as one document, the least of them stays; different
    texts of a repeated id stay or go on their own links.  Rows with a null id are documents
    each; of a group they stay only if none of it has an id.
    """
    number = F.col("doc_id").cast("long")
    if docs.where("doc_id is null").isEmpty():
        rows = docs.withColumn("__id", number)
    else:
        # written, so that a row keeps its number
        rows = stored(docs.withColumn("__id", F.coalesce(number, F.lit(LAST) - F.monotonically_increasing_id())), "numbered")
    texts = rows.select(F.col("__id").alias("doc_id"), "text")
    found = minhash.keyed_duplicates(texts).withColumnsRenamed({"doc_id": "__number", "key": "__of"})
    keyed = rows.withColumn("__key", minhash.text_key("text"))
    same = (F.col("__id") == F.col("__number")) & F.col("__key").eqNullSafe(F.col("__of"))
    found = stored(
        found.groupBy("__number", "__of").agg(F.max("kept").alias("kept"), F.count("*").alias("times")).where("not kept or times > 1"),
        "repeated",
    )
    # of what goes or is there twice; all else is left as it is
    left = keyed.join(found.where("not kept"), same, "left_anti")
    twice = found.where("kept").select("__number", "__of")
    if twice.isEmpty():
        return left.select(*docs.columns)
    row = F.struct("text", *[c for c in docs.columns if c != "text"])
    once = left.join(twice, same, "left_semi").groupBy("__id", "__key").agg(F.min(row).alias("__row")).select("__row.*")
    return left.join(twice, same, "left_anti").select(*docs.columns).unionAll(once.select(*docs.columns))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in the text replaced by its kind; n_chars follows."""
    clean = pii.redact_text(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in mixed order, each as often as the target of its source asks for."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with the bin that holds it."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", dedup_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

# fitted models and hashed draws: no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline_" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
