"""A training corpus from ``documents``: quality rules, near-duplicates, secrets, mix, packing.

``run(spark, sf_dir)`` applies ``STAGES`` in order. Each stage reads what its predecessor
kept, as Parquet in the folder that driver and executors share, so a lost executor costs at
most its stage's unfinished work. All stages but the last return the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickflow.llm import mixing, packing, quality_rules, secrets, weighted_minhash
from clickflow.llm.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return weighted_minhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secrets.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: one row for each pass over a document."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their sequence and offset."""
    import public_tokenizers  # the only stage that needs the vocabulary files

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("source mix", mix),
    ("packing", pack),
]

#: Sampling, hashing and tokenizing have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
