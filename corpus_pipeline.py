"""The corpus pipeline: toxic documents go, then exact copies, then near copies; the rest is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faremill.llm.common import prepare, table
from faremill.llm.dart_minhash import drop_near_duplicates
from faremill.llm.exact_dedup import drop_copies
from faremill.llm.packing import pack_documents
from faremill.llm.toxicity import drop_toxic, train_model
from faremill.session import workspace


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is trained on the labelled ones of ``docs``."""
    return drop_toxic(docs, train_model(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    prepare(spark)
    return drop_copies(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    prepare(spark)
    return drop_near_duplicates(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces in sequences of at most 1024 tokens."""
    prepare(spark)
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", minhash_near_dedup),
    ("best-fit packing", best_fit_packing),
]

# the stages include a trained classifier and a tokenizer, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's result is written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = workspace(spark, f"pipeline-{name.replace(' ', '-')}".lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
