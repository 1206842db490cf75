"""A training-data pipeline over ``documents``: each stage works on all its predecessor kept.

Rejected by quality, then all but one of each group of near duplicates, then documents with a
benchmark item leave; what stays is mixed to the target weights of its sources, so a document
may occur several times, and is stored as token ids.  The last stage returns a row for each
document in the store, read back from its files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from crestline.llm import decontam, minhash, mixing, quality, token_store
from crestline.llm.common import materialize, read_table, release


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, on shingles of five words."""
    release(spark)
    return minhash.keep_one(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mix(docs)


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids in indexed shards, and where each of them is."""
    store = token_store.write_store(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read_store(store, docs).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality", keep_good),
    ("near_dedup", keep_one_of_each),
    ("decontaminate", keep_uncontaminated),
    ("mix", mix_sources),
    ("tokens", store_tokens),
]

# Language models, Newton steps and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
