"""Metric CSV logs and run configurations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.schemas import METRIC_COLUMNS, METRIC_EVENT, RUN_CONFIG

# Python isoformat(): microseconds are present unless zero
# M6: ISO local timestamps are typed by the reader (TIMESTAMP_NTZ), never parsed per row.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def read_metrics(spark: SparkSession, path: str, run_from_path: str | None = r"run=([^/]+)/",
                 run_column: str | None = None) -> DataFrame:
    """Metric CSV files with header, fixed schema; ``run`` from the file
    path (per-run layout) or from a ``run_column`` of the given type."""
    schema = METRIC_EVENT
    if run_column:
        from pyspark.sql.types import StructField, StructType
        schema = StructType(METRIC_EVENT.fields + [StructField("run", _type(run_column))])
        run_from_path = None
    df = (spark.read.schema(schema).option("header", True)
          .option("timestampNTZFormat", TS_FORMAT).option("recursiveFileLookup", True).csv(path))
    if run_from_path:
        df = df.withColumn("run", F.regexp_extract(F.input_file_name(), run_from_path, 1))
    return df


def _type(name: str):
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(name)


def drop_empty_metrics(df: DataFrame) -> DataFrame:
    """S15 filter: skip rows where loss, grad_norm and learning_rate are all null."""
    return df.na.drop(how="all", subset=["loss", "grad_norm", "learning_rate"])


def append_metrics(df: DataFrame, path: str, run: str | None = "run", per_run_files: bool = True,
                   rows_per_file: int = 1_000_000) -> None:
    """Append metric rows.

    ``per_run_files``: one CSV directory per run (the reference's file per
    run); rows are clustered by (run, step chunk) so a run of up to
    ``rows_per_file`` steps lands in one file while a very long run is still
    spread over many tasks. Otherwise ``run`` stays a column and the files
    hold many runs, the better layout for very many short runs.
    """
    out = drop_empty_metrics(df)
    cols = METRIC_COLUMNS + ([run] if run else [])
    out = out.select(*cols)
    if run and per_run_files:
        out = out.repartition(F.col(run), F.floor(F.col("step") / F.lit(rows_per_file)))
    w = out.write.mode("append").option("header", True).option("timestampNTZFormat", TS_FORMAT)
    if run and per_run_files:
        w = w.partitionBy(run)
    w.csv(path)


def read_run_configs(spark: SparkSession, path: str, multi_line: bool = True, run: str | None = None) -> DataFrame:
    """Nested run configuration JSON with an explicit schema, plus
    ``alpha``; ``run``: DDL of a column that names the run, if there is one."""
    fields = [*(T.StructType.fromDDL(run).fields if run else []), *RUN_CONFIG.fields]
    df = spark.read.schema(T.StructType(fields)).option("multiLine", multi_line).json(path)
    return df.withColumn("alpha", F.col("lora_config.r") * F.col("lora_config.alpha_multiplier"))
