"""Lookup joins with heavy, rare, null and missing keys."""

from pyspark.sql import functions as F

from colloquy.operators.skew import lookup_join


def test_lookup_join_equals_a_plain_join(spark):
    keys = [7] * 4000 + [None] * 3000 + list(range(100, 2100)) * 2 + [9]
    rows = spark.createDataFrame([(i, k, "x") for i, k in enumerate(keys)], "id long, k long, name string").repartition(5)
    counts = rows.where("k is null or k <> 9").groupBy("k").agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("low"))
    got = {r.id: (r.k, r.name, r.low) for r in lookup_join(rows, counts, ["k"], "w", F.col("id")).collect()}
    first = {}
    for i, k in enumerate(keys):
        first.setdefault(k, i)
    assert got == {i: (k, "x", None if k == 9 else first[k]) for i, k in enumerate(keys)}


def test_lookup_join_on_empty_sides(spark):
    rows = spark.createDataFrame([(1, 2)], "id long, k long")
    none = spark.createDataFrame([], "k long, w long, low long")
    assert lookup_join(rows, none, ["k"], "w", F.col("id")).collect() == [(1, 2, None)]
    assert lookup_join(rows.limit(0), none, ["k"], "w", F.col("id")).count() == 0
