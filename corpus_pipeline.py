"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns
of documents, n_chars brought up to date where a text was changed. What the operators say about nulls, empty texts,
repeated rows and other columns holds here too; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import packing, quality, repeats, secrets, simhash
from shelfmark.scratch import staged


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.passing(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least doc_id stays."""
    return simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that stood earlier go; the document stays."""
    return _counted(repeats.without_repeats(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a placeholder."""
    return _counted(secrets.without_secrets(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash dedup", simhash_dedup),
    ("substring dedup", substring_dedup),
    ("secret scan", secret_scan),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# Tokenizers, hashes and learnt models are beyond SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None

QUERIES = {"pipeline": (run, ORACLE_SQL)}
