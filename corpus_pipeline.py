"""The corpus pipeline over ``documents``: drop toxic documents, keep one
document of each near-duplicate class, mask secrets, pack token sequences.

Each stage reads what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stockflow.llm import packing, secrets, simhash, toxicity
from stockflow.llm.common import table
from stockflow.llm.queries import tokenizer_path
from stockflow.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar, learned from ``labels``, accepts."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints linked at four bits or fewer."""
    return simhash.keep_one(docs, words=4, max_bits=4)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with secrets masked and ``n_chars`` corrected for it."""
    return secrets.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their sequence and offset."""
    return packing.best_fit_pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]

# Learned scores, fingerprints and token ids are beyond SQL; the tests hold each
# stage's decisions and run()'s pieces against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the whole ``documents`` table. Every call writes into
    a folder of its own, so an earlier call's result can still be read."""
    docs = table(spark, sf_dir, "documents")
    folder = f"corpus_pipeline/{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"{folder}/{k}_{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
