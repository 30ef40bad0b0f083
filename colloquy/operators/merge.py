"""Linear weighted merge of parameter vectors.

Parameters are ``(model, tensor, chunk, values ARRAY<FLOAT>)`` in fixed-size
chunks. Elements are summed by (tensor, chunk, pos) with partial aggregates;
no chunk is gathered over its models or rows, only the merged chunk itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weights_frame(spark, recipe: Sequence[tuple[str, float]]) -> DataFrame:
    """Merge recipe (model, weight) as a small DataFrame."""
    return spark.createDataFrame([(m, float(w)) for m, w in recipe], "model string, weight double")


def _merged(params: DataFrame, weights: DataFrame, normalize: bool) -> DataFrame:
    """(tensor, chunk, pos, value of doubles): weighted elements added per
    position. ``pos`` is null for an empty chunk, and for one with a null array
    (which merges to null), whose other rows have no position either."""
    per = _chunks(params, weights)
    bad = per.where(_rejected(weights)).select("tensor").distinct()
    lost = per.where("_nulls > 0").select("tensor", "chunk", F.lit(True).alias("_lost"))
    p = (params.join(weights, "model").join(bad, "tensor", "left_anti")
         .join(lost, ["tensor", "chunk"], "left")
         .withColumn("values", F.when(F.col("_lost").isNull(), F.col("values"))))
    v = F.col("weight") * F.coalesce(F.col("v").cast("double"), F.lit(0.0))
    sums = (p.select("tensor", "chunk", "weight", "_lost", F.posexplode_outer("values").alias("pos", "v"))
            .groupBy("tensor", "chunk", "pos").agg(F.sum(v).alias("_s"), F.sum("weight").alias("_w"), F.max("_lost").alias("_lost")))
    value = F.try_divide("_s", "_w") if normalize else F.col("_s")
    return sums.select("tensor", "chunk", "pos", value.alias("value"), "_lost")


def merge_linear_long(params: DataFrame, weights: DataFrame, normalize: bool = True) -> DataFrame:
    """(tensor, chunk, pos, value) of the weighted combination."""
    return _merged(params, weights, normalize).where("pos is not null").select(
        "tensor", "chunk", F.col("pos").cast("long").alias("pos"), "value")


def merge_linear(params: DataFrame, weights: DataFrame, normalize: bool = True) -> DataFrame:
    """Merged ``(tensor, chunk, values ARRAY<FLOAT>)``; tensors that a
    recipe model lacks or that differ in length are left to ``merge_rejects``."""
    item = F.when(F.col("pos").isNotNull(), F.struct("pos", F.col("value").cast("float").alias("value")))
    chunks = _merged(params, weights, normalize).groupBy("tensor", "chunk").agg(
        F.array_sort(F.collect_list(item)).alias("_v"), F.max("_lost").alias("_lost"))
    return chunks.select("tensor", "chunk", F.when(F.col("_lost").isNull(), F.col("_v")["value"]).alias("values"))


def _chunks(params: DataFrame, weights: DataFrame) -> DataFrame:
    return (params.join(weights.select("model"), "model")
            .groupBy("tensor", "chunk")
            .agg(F.countDistinct("model").alias("n_models"),
                 F.min(F.size("values")).alias("min_len"), F.max(F.size("values")).alias("max_len"),
                 F.count_if(F.col("values").isNull()).alias("_nulls")))


def _rejected(weights: DataFrame):
    n_models = weights.agg(F.countDistinct("model")).scalar()
    return (F.col("n_models") != n_models) | (F.col("min_len") != F.col("max_len"))


def merge_rejects(params: DataFrame, weights: DataFrame) -> DataFrame:
    """Tensors missing in a recipe model or with unequal chunk lengths."""
    return _chunks(params, weights).where(_rejected(weights)).drop("_nulls")
