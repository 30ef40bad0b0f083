"""Joins to a lookup whose keys repeat very unevenly on the other side.

A key that holds more than 1 / ``HEAVY_PARTS`` of all rows is heavy; there
are fewer than ``HEAVY_PARTS`` of them whatever the data, so their lookup rows
are broadcast (a bound that holds by counting, not by hope). Every other key
holds a small share, so the rest is an ordinary shuffle join that no key can
overload; rows that a heavy key has answered are dealt evenly in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_PARTS = 1_000


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: list[str], weight: str, spread: Column) -> DataFrame:
    """``rows`` left-joined to ``lookup`` (one row per key) on ``keys``, nulls
    equal to nulls.

    ``weight``: the lookup column that counts the rows of each key (it is not
    returned). ``spread``: any expression over ``rows`` that differs within a
    heavy key. ``lookup`` is read three times, so it should be a stored table.
    The other lookup columns are added, null where no key matches.
    """
    values = [c for c in lookup.columns if c not in keys and c != weight]
    total = lookup.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    named = lookup.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(v).alias(f"_v_{v}") for v in values],
                          weight, F.lit(True).alias("_hit"))
    is_heavy = F.col(weight) * HEAVY_PARTS > F.lit(total)

    def on(left: DataFrame, right: DataFrame):
        cond = F.lit(True)
        for k in keys:
            cond = cond & left[k].eqNullSafe(right[f"_k_{k}"])
        return cond

    heavy = named.where(is_heavy).drop(weight).withColumnRenamed("_hit", "_heavy")
    first = rows.join(F.broadcast(heavy), on(rows, heavy), "left").drop(*[f"_k_{k}" for k in keys])
    first = first.select(*rows.columns, *[F.col(f"_v_{v}").alias(f"_h_{v}") for v in values], "_heavy",
                         F.when(F.col("_heavy"), F.xxhash64(spread)).otherwise(F.lit(0)).alias("_salt"))
    rest = named.where(~is_heavy).drop(weight).withColumn("_zero", F.lit(0).cast("long"))
    both = first.join(rest, on(first, rest) & (first["_salt"] == rest["_zero"]) & first["_heavy"].isNull(), "left")
    return both.select(*rows.columns, *[F.coalesce(F.col(f"_h_{v}"), F.col(f"_v_{v}")).alias(v) for v in values])
