"""The corpus pipeline: documents in, encoded clean documents out.

Every stage works on all that the one before it kept; results are written between stages, so that a
lost executor costs at most the stage at hand.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opdiag.llm import byte_bpe, decontamination, jaccard_join, pii, quality_model
from opdiag.llm.queries import RANKS, ratings
from opdiag.session import scratch_path

MIN_GRADE = 1
MIN_TAIL = 0.5


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier expects to be rated ``MIN_GRADE`` or better."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_model.train(docs, ratings(labels))
    score = quality_model.scorer(spark, model, selected_from=MIN_GRADE)
    scored = docs.withColumn("__quality", score("text"))
    return scored.filter(f"coalesce(__quality.tail, 1.0) >= {MIN_TAIL}").select(*docs.columns)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return jaccard_join.one_per_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away replaced; ``n_chars`` follows the text."""
    clean = pii.sanitised(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    encoded = byte_bpe.encoder(spark, RANKS, public_tokenizers.PATTERN, with_ids=True)
    rows = docs.select("doc_id", "lang", "source", encoded("text").alias("encoded"))
    return rows.select("doc_id", "lang", "source", "encoded.*")


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_copy),
    ("benchmark decontamination", drop_benchmark),
    ("PII", sanitise),
    ("byte-level BPE", encode),
]
#: A trained classifier and token ids are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies every stage to ``documents``, each to what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{STAGES.index((name, stage))}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
