"""Registered metric-log queries: A13, M2, J5, S14-S16, N8.

Metric log stand-in = ``events``: run = ``user_id``, log order = (ts,
event_id), loss = value (NULL on ``error`` rows), gradient norm = value / 10
on ``click`` and ``view`` rows, learning rate = props.k / 100000.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.operators import metrics
from colloquy.operators.running import lay_out, running
from colloquy.operators.skew import lookup_join
from colloquy.plans.registry import register, table
from colloquy.session import scratch_path
from colloquy.sources import metrics as msrc


def metric_log(spark, d):
    ev = table(spark, d, "events")
    return ev.select(
        F.col("user_id").alias("run"), "event_id", F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("loss"),
        F.when(F.col("event_type").isin("click", "view"), F.col("value") / 10).alias("grad_norm"),
        (F.get_json_object("props", "$.k").cast("double") / 100000).alias("learning_rate"))


SUMMARY_COLS = ["run", "initial_loss", "final_loss", "min_loss", "max_loss", "loss_reduction_pct",
                "first_lr", "last_lr", "last_grad_norm", "mean_grad_norm", "logged_steps", "elapsed_s"]


def rounded(df):
    return df.select(*[F.round(c, 9).alias(c) if c in ("loss_reduction_pct", "mean_grad_norm") else F.col(c)
                       for c in SUMMARY_COLS])


def summary(spark, d):
    log = metric_log(spark, d)
    return rounded(metrics.run_summary(log, order=F.struct("timestamp", "event_id")))


METRIC_CTE = """
ml AS (
  SELECT user_id AS run, event_id, ts AS timestamp,
         CASE WHEN event_type <> 'error' THEN value END AS loss,
         CASE WHEN event_type IN ('click', 'view') THEN value / 10 END AS grad_norm,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100000 AS learning_rate
  FROM events
),
sm AS (
  SELECT run,
    arg_min(loss, (timestamp, event_id)) FILTER (WHERE loss IS NOT NULL) AS initial_loss,
    arg_max(loss, (timestamp, event_id)) FILTER (WHERE loss IS NOT NULL) AS final_loss,
    min(loss) AS min_loss, max(loss) AS max_loss,
    arg_min(learning_rate, (timestamp, event_id)) FILTER (WHERE learning_rate IS NOT NULL) AS first_lr,
    arg_max(learning_rate, (timestamp, event_id)) FILTER (WHERE learning_rate IS NOT NULL) AS last_lr,
    arg_max(grad_norm, (timestamp, event_id)) FILTER (WHERE grad_norm IS NOT NULL) AS last_grad_norm,
    avg(grad_norm) AS mean_grad_norm, count(*) AS logged_steps,
    date_diff('microsecond', min(timestamp), max(timestamp)) / 1000000.0::DOUBLE AS elapsed_s
  FROM ml GROUP BY run
)"""

SUMMARY_SQL = f"""WITH {METRIC_CTE}
SELECT run, initial_loss, final_loss, min_loss, max_loss,
  round(CASE WHEN initial_loss = 0 THEN NULL ELSE (initial_loss - final_loss) / initial_loss END * 100, 9)
    AS loss_reduction_pct,
  first_lr, last_lr, last_grad_norm, round(mean_grad_norm, 9) AS mean_grad_norm, logged_steps, elapsed_s
FROM sm"""


@register("run_summary", SUMMARY_SQL)
def q_run_summary(spark, d):
    return summary(spark, d)


@register("runs_with_metrics", f"""WITH {METRIC_CTE}
SELECT c_custkey AS run, c_mktsegment, c_nationkey, logged_steps, final_loss
FROM customer JOIN sm ON c_custkey = run""")
def q_runs_with_metrics(spark, d):
    cfg = table(spark, d, "customer").select(F.col("c_custkey").alias("run"), "c_mktsegment", "c_nationkey")
    return metrics.runs_with_metrics(cfg, summary(spark, d)).select(
        "run", "c_mktsegment", "c_nationkey", "logged_steps", "final_loss")


def metric_rows(spark, d):
    """D11 rows: step = log position per run, epoch = step / steps of the run."""
    log = metric_log(spark, d).withColumn("one", F.lit(1).cast("long"))
    order = ["timestamp", "event_id"]
    laid = lay_out(log, "run", order)
    placed = running(laid, "run", order, sums={"one": "before"})
    steps = laid.groupBy("run").agg(F.count(F.lit(1)).alias("steps"), F.count(F.lit(1)).alias("weight"))
    step = F.col("before") + 1
    return (lookup_join(placed, steps, ["run"], "weight", F.col("event_id"))
            .select("run", step.cast("int").alias("step"), (step / F.col("steps")).alias("epoch"), "loss", "grad_norm", "learning_rate", "timestamp"))


@register("metrics_roundtrip", SUMMARY_SQL)
def q_metrics_roundtrip(spark, d):
    # S15 append -> S14 read -> A13; the log order is the step column
    path = scratch_path(spark, "metrics-csv")
    msrc.append_metrics(metric_rows(spark, d), path, per_run_files=False)
    back = msrc.read_metrics(spark, path, run_column="bigint")
    return rounded(metrics.run_summary(back, order=F.col("step")))


def run_configs(spark, d):
    cu = table(spark, d, "customer")
    lora = F.struct((F.col("c_nationkey") + 1).alias("r"),
                    F.when(F.col("c_mktsegment") == "BUILDING", 4).otherwise(2).alias("alpha_multiplier"),
                    F.lit(0.0).alias("dropout"), F.lit("none").alias("bias"),
                    F.array(F.lit("q_proj"), F.lit("v_proj")).alias("target_modules"))
    train = F.struct((F.abs(F.col("c_acctbal")) / 1e8).alias("learning_rate"),
                     F.lit(2).alias("per_device_train_batch_size"))
    data = F.struct(F.concat(F.lit("train[:"), F.col("c_custkey").cast("string"), F.lit("]")).alias("dataset_split"))
    return cu.select(F.col("c_custkey").alias("run"), lora.alias("lora_config"),
                     train.alias("training_config"), data.alias("dataset_config"))


CONFIG_SQL = """
SELECT c_custkey AS run, c_nationkey + 1 AS lora_r,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 4 ELSE 2 END AS lora_alpha_multiplier,
       (c_nationkey + 1) * CASE WHEN c_mktsegment = 'BUILDING' THEN 4 ELSE 2 END AS lora_alpha,
       abs(c_acctbal) / 100000000.0::DOUBLE AS training_learning_rate,
       'train[:' || CAST(c_custkey AS VARCHAR) || ']' AS dataset_dataset_split
FROM customer"""


@register("config_flatten", CONFIG_SQL)
def q_config_flatten(spark, d):
    flat = metrics.flatten_config(run_configs(spark, d))
    return flat.select("run", F.col("lora_r").cast("int"), F.col("lora_alpha_multiplier").cast("int"),
                       F.col("lora_alpha").cast("int"), "training_learning_rate", "dataset_dataset_split")


@register("config_roundtrip", CONFIG_SQL)
def q_config_roundtrip(spark, d):
    # write configs as JSON lines, read back with the D12 schema
    path = scratch_path(spark, "run-configs")
    run_configs(spark, d).write.json(path)
    back = msrc.read_run_configs(spark, path, multi_line=False, run="run bigint")
    flat = metrics.flatten_config(back.select("run", "lora_config", "training_config", "dataset_config"))
    return flat.select("run", "lora_r", "lora_alpha_multiplier", "lora_alpha", "training_learning_rate",
                       "dataset_dataset_split")
