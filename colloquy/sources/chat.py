"""Chat datasets in long form ``(conv_id, turn, role, text)`` or
nested form ``messages ARRAY<STRUCT<role, content>>``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators.select import rows_between
from colloquy.schemas import MESSAGE


def read_chat(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Load a whole chat dataset (parquet or JSON lines)."""
    reader = spark.read
    return reader.parquet(path) if fmt == "parquet" else reader.json(path)


def nest_messages(long: DataFrame, conv: str = "conv_id", order: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """Long turns -> one row per conversation with ordered ``messages``.

    One shuffle on ``conv``; the row of a conversation is the unit the
    chat operators work on, so each conversation is gathered exactly once.
    """
    return (long.groupBy(conv)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"),
                                                      F.col(role).alias("role"),
                                                      F.col(text).alias("content")))).alias("_m"))
            .select(conv, F.transform("_m", lambda m: F.struct(m["role"].alias("role"),
                                                               m["content"].alias("content")))
                    .cast(f"array<{MESSAGE}>").alias("messages")))


def unnest_messages(nested: DataFrame, conv: str = "conv_id", messages: str = "messages") -> DataFrame:
    """Nested -> long: ``turn`` is the 0-based message position."""
    return (nested.select(conv, F.posexplode(messages).alias("turn", "m"))
            .select(conv, F.col("turn").cast("long").alias("turn"),
                    F.col("m.role").alias("role"), F.col("m.content").alias("text")))


def parse_slice(spec: str) -> tuple[int, int | None]:
    """``"[:N]"`` / ``"[a:b]"`` / ``"[a:]"`` -> (start, stop)."""
    s = spec.strip()
    if "[" in s:
        s = s[s.index("[") + 1: s.rindex("]")]
    a, _, b = s.partition(":")
    start = int(a) if a.strip() else 0
    stop = int(b) if b.strip() else None
    if start < 0 or (stop is not None and stop < 0):
        raise ValueError(f"negative slice bounds are not supported: {spec}")
    return start, stop


def slice_split(df: DataFrame, spec: str, key) -> DataFrame:
    """Split slice such as ``train[:20000]`` in ``key`` order, returned in
    that order. The keys at both ends are found on the key columns alone."""
    start, stop = parse_slice(spec)
    keys = [key] if isinstance(key, str) else list(key)
    return rows_between(df, [F.col(k) for k in keys], start, stop).orderBy(*keys)


def row_at(df: DataFrame, n: int, key) -> DataFrame:
    """S3: the row at 0-based position ``n`` in ``key`` order."""
    keys = [key] if isinstance(key, str) else list(key)
    return rows_between(df, [F.col(k) for k in keys], n, n + 1)


def save_dataset(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Persist a prepared dataset as parquet."""
    df.write.mode(mode).parquet(path)
