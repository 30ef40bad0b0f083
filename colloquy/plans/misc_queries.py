"""Registered source/sink and streaming queries: S4-S6, U1, S11-S13, N6, N7, G1-G3."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions import text as tx
from colloquy.operators import evals, metrics
from colloquy.plans.eval_queries import MODEL_SQL, RESULTS_CTE, TASKS, model_col, results
from colloquy.plans.metric_queries import SUMMARY_SQL, rounded
from colloquy.plans.registry import register, table
from colloquy.session import scratch_path
from colloquy.sources import parts, results as rsrc
from colloquy.sources.byte_files import write_streams
from colloquy.streaming import jobs


# ----------------------------------------------------------------- S4, S5
@register("parts_missing", """
WITH e AS (SELECT 'shards/o' || CAST(o_orderkey AS VARCHAR) || '-' || printf('%05d', i) || '-of-00007.parquet' AS path
           FROM orders, range(1, 8) AS r(i)),
l AS (SELECT DISTINCT 'shards/o' || CAST(l_orderkey AS VARCHAR) || '-' || printf('%05d', l_linenumber)
             || '-of-00007.parquet' AS path FROM lineitem)
SELECT path FROM e WHERE path NOT IN (SELECT path FROM l)""")
def q_parts_missing(spark, d):
    first = table(spark, d, "orders").select(
        F.concat(F.lit("shards/o"), F.col("o_orderkey").cast("string"), F.lit("-00001-of-00007.parquet")).alias("path"))
    listing = table(spark, d, "lineitem").select(
        F.concat(F.lit("shards/o"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 parts.zero_pad5("l_linenumber"), F.lit("-of-00007.parquet")).alias("path"))
    return parts.missing_parts(first, listing)


ARTIFACT_PARTS = 3


@register("artifact_sizes", f"""
SELECT 'set-' || CAST(doc_id % 8 AS VARCHAR) AS artifact, count(DISTINCT doc_id // 8 % {ARTIFACT_PARTS}) AS n_files,
       sum(strlen(coalesce(text, '')) + 1)::BIGINT AS bytes FROM documents GROUP BY 1""")
def q_artifact_sizes(spark, d):
    """Documents written as eight sets of up to three part files, a zero
    byte behind each text, and the sizes of the sets from the file listing."""
    path = scratch_path(spark, "artifacts")
    docs = table(spark, d, "documents")
    part = F.format_string("set-%d-%05d-of-%05d", F.col("doc_id") % 8, (F.floor(F.col("doc_id") / 8) % ARTIFACT_PARTS + 1), F.lit(ARTIFACT_PARTS))
    pieces = docs.select(part.alias("stream"), F.concat(F.coalesce("text", F.lit("")), F.lit("\0")).cast("binary").alias("data"))
    write_streams(pieces.repartition("stream").sortWithinPartitions("stream"), path)
    sizes = parts.artifact_sizes(spark, path, F.regexp_extract("path", "stream=([^/]+)", 1))
    return sizes.select("artifact", "n_files", "bytes")


@register("records_union", """
SELECT doc_id, lang, CAST(NULL AS VARCHAR) AS source, n_chars FROM documents
UNION ALL
SELECT doc_id, CAST(NULL AS VARCHAR) AS lang, source, n_chars FROM documents""")
def q_records_union(spark, d):
    """S6 + U1: the same records as a Parquet part and as JSON array parts
    with other columns, read back by extension and unioned by name."""
    docs = table(spark, d, "documents")
    base = scratch_path(spark, "records")
    pq_path, js_path = f"{base}/part-a.parquet", f"{base}/part-b.json"
    docs.select("doc_id", "lang", "n_chars").write.parquet(pq_path)
    parts.write_json_array(docs.select("doc_id", "source", "n_chars"), js_path)
    rec = parts.read_records(spark, [pq_path, js_path])
    return rec.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source",
                      F.col("n_chars").cast("long").alias("n_chars"))


# ----------------------------------------------------------------- S11, S12, N6, N7, S13
def result_store(spark, d):
    """Long store: latest event per (model, task) as the stored result."""
    ev = table(spark, d, "events")
    latest = (ev.groupBy("user_id", "event_type")
              .agg(F.max_by(F.struct("value", "event_id"), F.struct("ts", "event_id")).alias("r")))
    return latest.select(
        F.concat(F.lit("gguf/"), model_col(), F.lit("-q8_0.gguf")).alias("model_path"),
        F.col("event_type").alias("task"),
        F.format_string("%.4f +/- %.4f", F.col("r.value"), F.col("r.value") / 10).alias("score"),
        F.col("r.value").cast("int").alias("seconds"))


RESULT_STORE_SQL = f"""
WITH lt AS (SELECT user_id, event_type, value FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
SELECT {MODEL_SQL} || '-q8_0' AS model_name, event_type AS task,
       printf('%.4f +/- %.4f', value, value / 10) AS score, CAST(trunc(value) AS INTEGER) AS seconds,
       TRY_CAST(printf('%.4f', value) AS DOUBLE) AS score_numeric
FROM lt"""


def _flat(df):
    return rsrc.flatten_results(df).select("model_name", "task", "score", "seconds", "score_numeric")


@register("results_roundtrip", RESULT_STORE_SQL)
def q_results_roundtrip(spark, d):
    path = scratch_path(spark, "results")
    rsrc.write_results(result_store(spark, d), path)
    return _flat(rsrc.read_results(spark, path))


@register("results_last_write", RESULT_STORE_SQL)
def q_results_last_write(spark, d):
    """N7 + S12: every event is written as a result; of a (model, task) the last one stays."""
    path = scratch_path(spark, "results")
    every = table(spark, d, "events").select(
        F.concat(F.lit("gguf/"), model_col(), F.lit("-q8_0.gguf")).alias("model_path"), F.col("event_type").alias("task"),
        F.format_string("%.4f +/- %.4f", F.col("value"), F.col("value") / 10).alias("score"), F.col("value").cast("int").alias("seconds"),
        "ts", "event_id")
    rsrc.write_results(every, path, last_by=F.struct("ts", "event_id"))
    return _flat(rsrc.read_results(spark, path))


@register("results_combined", RESULT_STORE_SQL)
def q_results_combined(spark, d):
    path = scratch_path(spark, "results")
    rsrc.write_results(result_store(spark, d), path, combined=True)
    return _flat(rsrc.read_results(spark, path))


@register("scores_csv", f"""WITH {RESULTS_CTE}
SELECT model AS "Model", {", ".join(f"coalesce(max(score) FILTER (WHERE task = '{t}'), 0.0) AS \"{t}\"" for t in TASKS)}
FROM res GROUP BY model""")
def q_scores_csv(spark, d):
    path = scratch_path(spark, "scores-csv")
    rsrc.export_scores_csv(evals.wide_scores(results(spark, d), TASKS).withColumnRenamed("model", "Model"), path)
    schema = "Model string, " + ", ".join(f"`{t}` double" for t in TASKS)
    return spark.read.schema(schema).option("header", True).csv(path)


# ----------------------------------------------------------------- G1-G3
EVENTS_A_FILE = 20_000
EVENT_FILES = 16               # of a larger table: a micro-batch grows with it, for each costs a few seconds whatever it holds
MOST_EVENTS_A_FILE = 5_000_000  # but no micro-batch grows without end


def event_files(events):
    """``events`` by time as the files of a stream; returns their folder."""
    src = scratch_path(events.sparkSession, "events-files")
    n = events.count()
    a_file = min(max(EVENTS_A_FILE, -(-n // EVENT_FILES)), MOST_EVENTS_A_FILE)
    # ranges are sampled, so a file may be larger than its share, but not by much; equal times are cut too
    (events.repartitionByRange(max(1, -(-n // a_file)), "ts").write
     .option("maxRecordsPerFile", a_file if a_file == EVENTS_A_FILE else 2 * a_file).parquet(src))
    return src


@register("stream_summary", SUMMARY_SQL)
def q_stream_summary(spark, d):
    """G1 + G2: the events in several files, one per micro-batch, update mode."""
    events = table(spark, d, "events")
    src = event_files(events)
    ev = jobs.stream_metrics(spark, src, events.schema, fmt="parquet", max_files_per_trigger=2)
    log = ev.select(
        F.col("user_id").alias("run"), "event_id", F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("loss"),
        F.when(F.col("event_type").isin("click", "view"), F.col("value") / 10).alias("grad_norm"),
        (F.get_json_object("props", "$.k").cast("double") / 100000).alias("learning_rate"))
    agg = jobs.stream_run_summary(log, order=F.struct("timestamp", "event_id"))
    target = scratch_path(spark, "stream-summary")
    jobs.write_summary(agg, target, scratch_path(spark, "stream-summary-ckpt"))
    return rounded(jobs.read_store(spark, target))


@register("stream_results", f"""
SELECT {MODEL_SQL} AS model, event_type AS task, value AS score, event_id
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def q_stream_results(spark, d):
    """The events in several files, some of them per micro-batch."""
    events = table(spark, d, "events")
    src = event_files(events)
    stream = jobs.stream_metrics(spark, src, events.schema, fmt="parquet", max_files_per_trigger=2)
    rows = stream.select(model_col().alias("model"), F.col("event_type").alias("task"),
                         F.col("value").alias("score"), "event_id", "ts")
    store = scratch_path(spark, "result-store")
    jobs.stream_results(rows, store, scratch_path(spark, "result-store-ckpt"), ["model", "task"],
                        F.struct("ts", "event_id"))
    return jobs.read_store(spark, store).select("model", "task", "score", "event_id")
