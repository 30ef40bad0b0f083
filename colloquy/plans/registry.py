"""Query registry: name -> (spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@lru_cache(maxsize=1)
def load_all():
    """Import every query module once so the registry is complete."""
    import importlib

    for mod in MODULES:
        importlib.import_module(f"colloquy.plans.{mod}")
    return QUERIES, ORACLES


MODULES = ["chat_queries", "eval_queries", "metric_queries", "mcq_queries", "token_queries",
           "misc_queries"]
