"""Registered queries of this package: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opdiag.llm import (
    byte_bpe,
    decontamination,
    jaccard_join,
    language_id,
    piece_bpe,
    pii,
    prefix_trie,
    quality_model,
    quality_rules,
    structure_repair,
    token_counts,
    toxicity,
    warc,
)
from opdiag.llm.samples import remainder

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = token_counts.counter(spark, RANKS)
    counted = table(spark, sf_dir, "documents").select("doc_id", count("text").alias("counted"))
    return counted.select("doc_id", "counted.*")


def byte_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    encode = byte_bpe.encoder(spark, RANKS, public_tokenizers.PATTERN)
    encoded = table(spark, sf_dir, "documents").select("doc_id", encode("text").alias("encoded"))
    return encoded.select("doc_id", "encoded.*")


def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judged(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
    return judged.withColumnRenamed("id", "doc_id")


def held_out(divisor: int, left: int):
    """Whether a row is kept from training; a row without an id is not, but has no label either."""
    return F.coalesce(remainder("doc_id", divisor) == left, F.lit(False))


def language_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = language_id.train(docs, remainder("doc_id", 4) != 2)
    name = language_id.namer(spark, network)
    named = docs.select("doc_id", held_out(4, 2).alias("held_out"), name("text").alias("named"))
    return named.select("doc_id", "held_out", "named.*")


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def ratings(labels: DataFrame) -> DataFrame:
    """Grades from the labels: 0 for low quality, 1 for good but toxic, 2 for good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, 2 - F.col("toxic"))
    return labels.select("doc_id", grade.cast("int").alias("grade"))


def quality_model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, ratings(table(spark, sf_dir, "labels")))
    score = quality_model.scorer(spark, model, selected_from=1)
    scored = docs.select("doc_id", score("text").alias("scored")).select("doc_id", "scored.*")
    return scored.withColumn("selected", F.col("tail") >= 0.5)


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0)
    score = toxicity.scorer(spark, toxicity.train(docs, labels))
    scored = docs.select("doc_id", held_out(5, 0).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(F.col("id").alias("doc_id"), "item_id", "n_shingles", "n_shared")


def jaccard_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.similar_documents(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "copy_id", "n_links")


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def piece_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    encode = piece_bpe.encoder(spark, PIECES)
    encoded = table(spark, sf_dir, "documents").select("doc_id", encode("text").alias("encoded"))
    return encoded.select("doc_id", "encoded.*")


def prefix_trie_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def structure_repair_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = structure_repair.damaged(table(spark, sf_dir, "conversations"))
    return structure_repair.summaries(turns)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": token_counts_query,
    "op2_byte_bpe": byte_bpe_query,
    "op3_quality_rules": quality_rules_query,
    "op4_language_id": language_id_query,
    "op5_pii": pii_query,
    "op6_quality_model": quality_model_query,
    "op7_decontamination": decontamination_query,
    "op8_warc": warc_query,
    "op9_toxicity": toxicity_query,
    "op10_jaccard_join": jaccard_join_query,
    "op11_piece_bpe": piece_bpe_query,
    "op12_prefix_trie": prefix_trie_query,
    "op13_structure_repair": structure_repair_query,
}
