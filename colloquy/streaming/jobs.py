"""Metric events and evaluation results as file streams.

* G1 ``stream_metrics``: a file stream with the fixed D11 schema (CSV or
  Parquet) and the S15 null filter; optional de-duplication of re-sent
  steps within a watermark.
* G2 ``stream_run_summary``: A13's aggregates as a streaming aggregation;
  ``write_summary`` publishes the runs that a micro-batch changed.
* G3 ``stream_results``: each micro-batch is upserted (U2) into a keyed
  table (``store``); a restart continues from the checkpoint.

All state lives in the checkpoint location (shared storage in production).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.operators.metrics import finish_summary, summary_aggs
from colloquy.sources.metrics import TS_FORMAT, drop_empty_metrics
from colloquy.streaming.store import read_store, upsert

__all__ = ["read_store", "stream_metrics", "stream_results", "stream_run_summary", "write_summary"]


def stream_metrics(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                   glob: str | None = None, max_files_per_trigger: int | None = None,
                   dedupe: Sequence[str] | None = None, delay: str = "10 minutes",
                   event_time: str = "timestamp") -> DataFrame:
    """G1: stream of metric events (S15 filter applied)."""
    r = spark.readStream.schema(schema)
    if fmt == "csv":
        r = r.option("header", True).option("timestampNTZFormat", TS_FORMAT)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.format(fmt).load(path)
    if {"loss", "grad_norm", "learning_rate"} <= set(df.columns):
        df = drop_empty_metrics(df)
    if dedupe:
        df = df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(dedupe))
    return df


def stream_run_summary(stream: DataFrame, run: str = "run", order=None) -> DataFrame:
    """The run summary over all events so far (streaming aggregation)."""
    order = order if order is not None else F.struct(F.col("step"), F.col("timestamp"))
    return finish_summary(stream.groupBy(run).agg(*summary_aggs(order)))


def write_summary(agg: DataFrame, target: str, checkpoint: str, keys: Sequence[str] = ("run",), **options) -> None:
    """Run an aggregation to the end of the available input, in update mode:
    each micro-batch publishes the groups it changed in the keyed table
    ``target`` (``read_store``), the others are not written again."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, batch_id, target, keys, **options)

    q = (agg.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def stream_results(stream: DataFrame, store: str, checkpoint: str, keys: Sequence[str], version, **options) -> None:
    """Upsert every micro-batch into the keyed table ``store`` (U2: the
    row of the highest ``version`` of each key stays). A batch adds to the
    buckets it touches; a replayed batch changes nothing."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, batch_id, store, keys, version, **options)

    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
