"""Corpus pipeline over ``documents``: quality classifier, language ID,
near-duplicates, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet below the shared checkpoint folder and hands
the reread table to the next stage. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colloquy.llm import langid, minhash, mixing, packing, quality
from colloquy.llm.common import documents, read_table, stored
from colloquy.session import ship_package


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose top grade is likelier than not (operator 6)."""
    ship_package(spark)
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence (operator 4)."""
    ship_package(spark)
    return langid.keep_known(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, on 5-word shingles (operator 2)."""
    ship_package(spark)
    return minhash.keep_one(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their budgets; repeats are rows of their own (operator 1)."""
    ship_package(spark)
    return mixing.apply_mix(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their ids (operator 8)."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("language ID", keep_known_language),
    ("MinHash near-dedup", keep_one_of_each_group),
    ("mixing sources to target weights", mix_to_weights),
    ("packing", pack_sequences),
]

# Hashed features, learned models and a tokenizer: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + "-".join(name.lower().split()))
    return docs
