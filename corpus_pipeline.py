"""The corpus pipeline: documents through five stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs; all but the last keep the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import ftrl, mixing, packing, pii, simhash
from eventide.llm.common import save, table
from eventide.llm.tokens import vocabulary


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; every label may be learned from."""
    model = ftrl.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return ftrl.drop_toxic(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses become pseudonyms."""
    return pii.pseudonymised(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights, by repeating or cutting."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in windows of 2048."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("pii", private_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Fingerprints, learned weights and tokens are beyond SQL; tests hold the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
