"""A corpus pipeline of five stages over the operators in merchant_ledger.llm.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_ledger.llm import mixing, ngram_join, packing, quality_classifier, secret_scan
from merchant_ledger.llm.common import materialize
from merchant_ledger.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.accepted(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, a similarity of 0.8 or more."""
    return ngram_join.without_near_duplicates(docs, size=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are taken out of the texts; every document stays."""
    clean = secret_scan.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources reach their weights."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1,024 tokens."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality_classifier", quality),
    ("ngram_join", near_duplicates),
    ("secret_scan", secrets),
    ("mix_sources", mixture),
    ("pack_sequences", sequences),
]

#: Training, hashing and tokenizing are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
