"""Documents to packed training sequences, in stages that are written and read again.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import exact_dedup, packing, perplexity, secrets, simhash
from siltstone.llm.queries import WORD_TOKENIZER
from siltstone.session import scratch_path, ship_package


def likely(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is not above their language's threshold, without runs of repeated words."""
    return perplexity.drop_unlikely(docs, perplexity.trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by near fingerprints, the one with the smallest doc_id."""
    return simhash.drop_near(docs)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return secrets.mask_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, WORD_TOKENIZER)


STAGES = [
    ("quality classifier", likely),
    ("exact dedup", exact_copies),
    ("simhash near-dedup", near_copies),
    ("secret scans", masked),
    ("best-fit packing", packed),
]

# No SQL: the language model, the fingerprints and the packing are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on the documents of ``sf_dir``, each written as Parquet and read by the next."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
