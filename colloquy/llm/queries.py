"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from colloquy.llm import (capdedup, chatfmt, langid, linededup, minhash, mixing, packing, quality, repair, spelling,
                          suffix_tree, topk, wordpiece)
from colloquy.llm.common import documents, read_table
from colloquy.llm.sql import OP2_SQL, OP10_SQL


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op1_query(documents(spark, sf_dir))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.op2_query(documents(spark, sf_dir))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.op3_query(read_table(spark, sf_dir, "embeddings"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op4_query(documents(spark, sf_dir))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chatfmt.op5_query(read_table(spark, sf_dir, "conversations"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op6_query(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.op7_query(documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op8_query(documents(spark, sf_dir))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.op9_query(documents(spark, sf_dir))


def op10_cap_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capdedup.op10_query(read_table(spark, sf_dir, "embeddings"))


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.op11_query(documents(spark, sf_dir))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.op12_query(read_table(spark, sf_dir, "conversations"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.op13_query(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = (op1_mix_sources, op2_minhash_dedup, op3_exact_topk, op4_language_id, op5_chat_format, op6_quality,
           op7_suffix_tree, op8_packing, op9_token_counts, op10_cap_dedup,
           op11_spelling_groups, op12_repair, op13_line_dedup)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    return {"op1_mix_sources": mixing.OP1_SQL, "op2_minhash_dedup": OP2_SQL, "op3_exact_topk": topk.OP3_SQL,
            "op10_cap_dedup": OP10_SQL, "op11_spelling_groups": spelling.OP11_SQL, "op12_repair": repair.OP12_SQL,
            "op13_line_dedup": linededup.OP13_SQL}
