"""Training-metric logs: A13 run summary, M2 loss reduction, J5, N8.

First / last are taken by the log order key with ``min_by`` / ``max_by``
restricted to non-null values of each metric: partial aggregates, so a run
with many steps is pre-aggregated map-side and no window is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.text import elapsed_seconds_exact


def summary_aggs(order: Column, loss: str = "loss", grad_norm: str = "grad_norm",
                 learning_rate: str = "learning_rate", timestamp: str = "timestamp") -> list[Column]:
    def first(c):
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order))

    def last(c):
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order))

    return [
        first(loss).alias("initial_loss"), last(loss).alias("final_loss"),
        F.min(loss).alias("min_loss"), F.max(loss).alias("max_loss"),
        first(learning_rate).alias("first_lr"), last(learning_rate).alias("last_lr"),
        last(grad_norm).alias("last_grad_norm"), F.avg(grad_norm).alias("mean_grad_norm"),
        F.count(F.lit(1)).alias("logged_steps"),
        F.min(timestamp).alias("_t0"), F.max(timestamp).alias("_t1"),
    ]


def finish_summary(df: DataFrame) -> DataFrame:
    """M2 and elapsed time from the aggregated columns."""
    return (df.withColumn("loss_reduction_pct",
                          F.try_divide(F.col("initial_loss") - F.col("final_loss"), F.col("initial_loss")) * 100)
            .withColumn("elapsed_s", elapsed_seconds_exact("_t0", "_t1"))
            .drop("_t0", "_t1"))


def run_summary(metrics: DataFrame, run: str = "run", order=None, **cols) -> DataFrame:
    """Per run initial / final / min / max loss, loss reduction %, first
    and last learning rate, last and mean gradient norm, logged steps, run time.

    ``order`` is the log order (default: ``step``, then ``timestamp``).
    """
    order = order if order is not None else F.struct(F.col("step"), F.col(cols.get("timestamp", "timestamp")))
    return finish_summary(metrics.groupBy(run).agg(*summary_aggs(order, **cols)))


def runs_with_metrics(configs: DataFrame, summary: DataFrame, run: str = "run") -> DataFrame:
    """Configuration beside the run's metrics (equi join on the run name;
    AQE broadcasts whichever side is small at run time)."""
    return configs.join(summary, run, "inner")


def flatten_config(df: DataFrame, sections=None, sep: str = "_") -> DataFrame:
    """Nested config sections -> prefixed columns; ``lora_alpha = r * alpha_multiplier``."""
    from pyspark.sql.types import StructType

    keep, flat = [], []
    for f in df.schema.fields:
        if isinstance(f.dataType, StructType) and (sections is None or f.name in sections):
            prefix = f.name.removesuffix("_config")
            for g in f.dataType.fields:
                flat.append(F.col(f"`{f.name}`.`{g.name}`").alias(f"{prefix}{sep}{g.name}"))
        else:
            keep.append(F.col(f"`{f.name}`"))
    out = df.select(*keep, *flat)
    if {"lora_r", "lora_alpha_multiplier"} <= set(out.columns):
        out = out.withColumn("lora_alpha", F.col("lora_r") * F.col("lora_alpha_multiplier"))
    return out
