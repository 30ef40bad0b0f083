"""The evaluation result store as files.

Long form ``(model_path, model_name, task, score, seconds, score_numeric)``.
Nested form: one row per model with ``tasks MAP<task, STRUCT<...>>``.
Keys of ``models`` / ``tasks`` are data, so the readers always give the map
schema (an inferred schema would turn every model into a column).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.text import model_name as model_name_col
from colloquy.functions.text import parse_score
from colloquy.schemas import MODEL_RESULT, RESULT_DOCUMENT, TASK_RESULT

COMBINED = "all_results.json"


def nest_results(long: DataFrame, version=None) -> DataFrame:
    """Long -> one row per model (model_path, model_name, tasks map).

    Rows without a score or a time are dropped (P7). Of several rows of a
    (model, task) the last one stays: the one of greatest ``version`` (a
    column), of greatest (seconds, score) when equal or not given. Each group
    is one model's tasks, bounded by the task catalogue.
    """
    valid = long.where(F.col("score").isNotNull() & F.col("seconds").isNotNull())
    if "model_name" not in valid.columns:
        valid = valid.withColumn("model_name", model_name_col("model_path"))
    keys = ["model_path", "model_name", "task"]
    ver = F.lit(None) if version is None else F.col(version) if isinstance(version, str) else version
    valid = (valid.groupBy(*keys).agg(F.max_by(F.struct("score", "seconds"), F.struct(ver.alias("v"), "seconds", "score")).alias("_r"))
             .select(*keys, "_r.score", "_r.seconds"))
    entry = F.struct(F.col("task").alias("key"), F.struct(
        F.col("score").alias("score"), F.col("seconds").cast("int").alias("execution_time_seconds"),
        parse_score("score").alias("score_numeric")).cast(TASK_RESULT).alias("value"))
    return (valid.groupBy("model_path", "model_name")
            .agg(F.map_from_entries(F.collect_list(entry)).alias("tasks")))


def flatten_results(models: DataFrame) -> DataFrame:
    """Nested model rows -> long (explode of the task map)."""
    return (models.select("model_path", "model_name", F.explode("tasks").alias("task", "r"))
            .select("model_path", "model_name", "task", F.col("r.score").alias("score"),
                    F.col("r.execution_time_seconds").alias("seconds"),
                    F.col("r.score_numeric").alias("score_numeric")))


def write_results(long: DataFrame, path: str, combined: bool = False, version: str = "1.0", last_by=None) -> None:
    """Per-model documents (JSON lines under ``models/``) and, on request,
    the combined document with ``metadata``.

    The combined document is a single JSON value, so it is written by one
    task; it is meant for result stores of catalogue size.
    """
    nested = nest_results(long, last_by)
    dup = nested.groupBy("model_name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if dup.limit(1).count():
        raise ValueError("two model paths share one model name")
    nested.write.mode("overwrite").json(f"{path}/models")
    if combined:
        doc = nested.agg(
            F.struct(F.lit(datetime.now().isoformat()).alias("timestamp"),
                     F.count(F.lit(1)).cast("int").alias("total_models"),
                     F.lit(version).alias("version")).alias("metadata"),
            F.map_from_entries(F.collect_list(F.struct(F.col("model_name").alias("key"),
                                                       F.struct("model_path", "model_name", "tasks")
                                                       .alias("value")))).alias("models"))
        doc.coalesce(1).write.mode("overwrite").json(f"{path}/{COMBINED}")
    else:
        _remove(long.sparkSession, f"{path}/{COMBINED}")  # an older one would be read instead


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The combined document if present, else one document per model.

    Accepts both our layout and the reference's pretty-printed files
    (``all_results.json`` and ``*_results.json``).
    """
    combined = f"{path}/{COMBINED}"
    if _exists(spark, combined):
        doc = spark.read.schema(RESULT_DOCUMENT).option("multiLine", True).json(combined)
        return doc.select(F.explode("models").alias("_k", "m")).select("m.*")
    models_dir = f"{path}/models"
    if _exists(spark, models_dir):
        return spark.read.schema(MODEL_RESULT).json(models_dir)
    return spark.read.schema(MODEL_RESULT).option("multiLine", True).json(f"{path}/*_results.json")


def export_scores_csv(wide: DataFrame, path: str) -> None:
    """Wide CSV ``Model, task...`` with header."""
    wide.write.mode("overwrite").option("header", True).csv(path)
