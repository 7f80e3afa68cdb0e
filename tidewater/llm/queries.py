"""One query for each operator, over its whole table, and their results in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.llm import (
    ann, centroids, html_text, language, manifest, minhash, mixing, packing, passages, pii, quality, tokens, topk,
)
from tidewater.llm.common import held_out, read

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(read(spark, sf_dir, "documents")))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return ann.neighbours(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.served(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "first_finish")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.scaled(read(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = held_out("doc_id", 3, 1)
    model = language.fit(docs.where(~out))
    return language.predict(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), width=3, similarity=0.85)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    field = quality.fit(docs, read(spark, sf_dir, "labels").where(~out))
    return quality.score(docs, field).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(
        read(spark, sf_dir, "documents"),
        tokenizer_file=public_tokenizers.path("byte_bpe_50k.json"), pattern=public_tokenizers.PATTERN,
    )


def op11_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.repeated_windows(read(spark, sf_dir, "documents"), width=35)
    left = passages.remove_repeated(found, width=35)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verified(manifest.document_manifest(read(spark, sf_dir, "documents")))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = topk.scaled(read(spark, sf_dir, "embeddings"), factor=64).where(F.size("components") == 64)
    return centroids.with_totals(*centroids.lloyd(points, k=16, rounds=3, width=64, salt="1"))


def registered() -> dict[str, Query]:
    own = (
        op1_packing, op2_pii, op3_neighbours, op4_mixing, op5_html, op6_topk, op7_language, op8_near_duplicates,
        op9_quality, op10_tokens, op11_passages, op12_manifest, op13_centroids,
    )
    return {f.__name__: f for f in own}
