"""The corpus operators as named queries (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm import (
    collocations,
    licences,
    neighbours,
    oracle,
    packing,
    pieces,
    pii,
    quality,
    secrets,
    sharding,
    simhash,
    spelling,
    spotsigs,
    toxicity,
)
from stockflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file as installed beside the libraries."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def count_kind(kind: str | int) -> Column:
    """How many base spans are of the kind."""
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spotsigs.fingerprint_edits(docs, spotsigs.common_words(docs))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of their source: source/language/hundred/id."""
    docs = table(spark, sf_dir, "documents")
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
    path = F.concat_ws("/", part("source"), part("lang"), F.floor(F.col("doc_id") / 100), part("doc_id"))
    return licences.licence_scan(docs.select("doc_id", path.alias("path"), "text"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(pieces.encode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model")))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = sharding.assign_shards(sharding.shard_records(table(spark, sf_dir, "documents")), shards=16)
    return plan.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    counts = [count_kind(k).alias(f"n_{k}") for k in secrets.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    counts = [count_kind(n).alias(f"n_{k}") for n, k in enumerate(pii.KINDS)]
    no_terms = F.slice("terms", 1, 0)
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.span_text(pii.all_spans(F.col("base"), no_terms)), 256).alias("base_sha256"),
        pii.span_text(pii.all_spans(F.col("base"), F.col("terms"))).alias("spans"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), with_text=False)
    return judged.select("doc_id", *quality.Base._fields, "base_failed", "kept")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_licence_scan": op5_licence_scan,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_sharding": op8_sharding,
    "op9_secret_scan": op9_secret_scan,
    "op10_personal_data": op10_personal_data,
    "op11_collocations": op11_collocations,
    "op12_quality_rules": op12_quality_rules,
    "op13_spelling_variants": op13_spelling_variants,
}

# DuckDB SQL per query, where SQL can express it.
ORACLE_SQL: dict[str, str] = dict(oracle.ORACLE_SQL)
