"""Registered evaluation-analytics queries.

Scores = ``events``: model = ``user_id``, task = ``event_type``, score =
mean value (exact, from integer cents), seconds = events per pair. A run whose
last value fell below its first one has failed and stores no result, so the
zero-fill and anti-join paths see missing pairs. All events are read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions import text as tx
from colloquy.operators import evals
from colloquy.plans.registry import register, table
from colloquy.plans.sqlbits import NL, strip
from colloquy.session import scratch_path
from colloquy.sources import parts

TASKS = ["click", "error", "purchase", "signup", "view"]

# Scorer log formats per task (fixed values of the stand-in catalogue):
# view = percentage with interval, click = named final score, purchase and
# signup = "Final result", error = a crashed run without the marker.
LEFT_MARKERS = {
    "view": ["\n400\t"],
    "click": ["Final Winogrande score", "): "],
    "purchase": ["Final result: "],
    "signup": ["Final result: "],
    "error": ["Final result: "],
}

MODEL_ARGS = ["red:--ctx 2048", "bolt:-np 8", "red:-fa on", "plate:-t 4", "widget:--mlock"]


# ----------------------------------------------------------------- shared inputs
def model_col(c="user_id"):
    # zero-padded, never truncated (lpad would cut ids >= 1000)
    return F.format_string("u%03d", F.col(c))


MODEL_SQL = "printf('u%03d', user_id)"


def user_task(spark, d):
    """One partial aggregate of ``events`` per (user, event type).

    ``results``, ``models`` and ``model_sizes`` all derive from this same
    plan, so a query using several of them scans and shuffles ``events``
    once (the exchange is reused); later steps work on the aggregate.
    """
    ev = table(spark, d, "events")
    return (ev.groupBy("user_id", "event_type")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"),
                 (F.max_by("value", "event_id") >= F.min_by("value", "event_id")).alias("done")))


def results(spark, d):
    """Result store (model, task, score, seconds) of stored pairs."""
    g = user_task(spark, d)
    return (g.where("done")
            .select(model_col().alias("model"), F.col("event_type").alias("task"),
                    (F.col("cents").cast("double") / (F.lit(100.0) * F.col("n"))).alias("score"),
                    F.col("n").alias("seconds")))


def models(spark, d):
    """Model dimension: every user with at least one event."""
    return user_task(spark, d).select(model_col().alias("model")).distinct()


def matrix(spark, d):
    return evals.score_matrix(results(spark, d), models(spark, d), TASKS)


RESULTS_CTE = f"""
res AS (
  SELECT {MODEL_SQL} AS model, event_type AS task,
         sum(CAST(round(value * 100) AS BIGINT))::DOUBLE / (100.0::DOUBLE * count(*)) AS score,
         count(*) AS seconds
  FROM events GROUP BY user_id, event_type HAVING arg_max(value, event_id) >= arg_min(value, event_id)
),
mdl AS (SELECT DISTINCT {MODEL_SQL} AS model FROM events),
tsk AS (SELECT unnest({TASKS!r}) AS task),
mat AS (
  SELECT mdl.model, tsk.task, coalesce(res.score, 0.0) AS score
  FROM mdl JOIN tsk ON true LEFT JOIN res ON res.model = mdl.model AND res.task = tsk.task
),
tmax AS (SELECT task, max(score) AS mx, min(score) AS mn FROM mat GROUP BY task)"""


# ----------------------------------------------------------------- score text
def scorer_logs(spark, d):
    """One synthetic scorer log per event, in the format of its task."""
    ev = table(spark, d, "events")
    v = F.format_string("%.4f", F.col("value"))
    m = F.format_string("%.4f", F.col("value") / 10)
    lo = F.format_string("%.4f", F.col("value") * 0.9)
    hi = F.format_string("%.4f", F.col("value") * 1.1)
    t = F.col("event_type")
    body = (F.when(t == "view", F.concat(F.lit("400\t"), v, F.lit("%\t["), lo, F.lit("%, "), hi, F.lit("%]")))
            .when(t == "click", F.concat(F.lit("Final Winogrande score("), F.col("user_id").cast("string"),
                                         F.lit(" tasks): "), v, F.lit(" +/- "), m))
            .when(t.isin("purchase", "signup"), F.concat(F.lit("Final result: "), v, F.lit(" +/- "), m))
            .otherwise(F.concat(F.lit("error: scorer stopped after "), F.col("user_id").cast("string"),
                                F.lit(" tasks"))))
    log = F.concat(t, F.lit(" run "), F.col("event_id").cast("string"), F.lit("\n"), body,
                   F.lit("\nllama_perf_context_print: total time"))
    return ev.select("event_id", "event_type", log.alias("log"))


def _split_expr():
    t = F.col("event_type")
    e = None
    for task, left in LEFT_MARKERS.items():
        s = tx.marker_split("log", left=left, first_line_only=True)
        e = F.when(t == task, s) if e is None else e.when(t == task, s)
    return e


LOGS_CTE = f"""
lg AS (
  SELECT event_id, event_type,
    event_type || ' run ' || CAST(event_id AS VARCHAR) || {NL} ||
    CASE WHEN event_type = 'view' THEN '400' || chr(9) || printf('%.4f', value) || '%' || chr(9) || '['
              || printf('%.4f', value * 0.9) || '%, ' || printf('%.4f', value * 1.1) || '%]'
         WHEN event_type = 'click' THEN 'Final Winogrande score(' || CAST(user_id AS VARCHAR) || ' tasks): '
              || printf('%.4f', value) || ' +/- ' || printf('%.4f', value / 10)
         WHEN event_type IN ('purchase', 'signup') THEN 'Final result: ' || printf('%.4f', value)
              || ' +/- ' || printf('%.4f', value / 10)
         ELSE 'error: scorer stopped after ' || CAST(user_id AS VARCHAR) || ' tasks' END
    || {NL} || 'llama_perf_context_print: total time' AS log
  FROM events
),
sp AS (
  SELECT event_id, string_split(CASE
      WHEN event_type = 'view' THEN CASE WHEN contains(log, {NL} || '400' || chr(9))
           THEN {strip(f"string_split(log, {NL} || '400' || chr(9))[-1]")} END
      WHEN event_type = 'click' THEN CASE WHEN contains(log, 'Final Winogrande score')
           AND contains(string_split(log, 'Final Winogrande score')[-1], '): ')
           THEN {strip("string_split(string_split(log, 'Final Winogrande score')[-1], '): ')[-1]")} END
      ELSE CASE WHEN contains(log, 'Final result: ') THEN {strip("string_split(log, 'Final result: ')[-1]")} END
    END, {NL})[1] AS split
  FROM lg
)"""

PARSE_SQL = f"""
ps AS (
  SELECT event_id, split,
    CASE WHEN split IS NULL THEN -1.0 ELSE TRY_CAST(
      CASE WHEN ends_with(tok, '%') THEN left(tok, length(tok) - 1) ELSE tok END AS DOUBLE) END AS score_numeric
  FROM (SELECT event_id, split,
          regexp_extract({strip("CASE WHEN contains(split, 'tasks):') THEN string_split(split, 'tasks):')[-1] ELSE split END")},
                         '^(\\S*)', 1) AS tok FROM sp)
)"""


@register("marker_split", f"WITH {LOGS_CTE} SELECT event_id, split FROM sp")
def q_marker_split(spark, d):
    return scorer_logs(spark, d).select("event_id", _split_expr().alias("split"))


@register("score_parse", f"WITH {LOGS_CTE}, {PARSE_SQL} SELECT event_id, score_numeric FROM ps")
def q_score_parse(spark, d):
    s = scorer_logs(spark, d).select("event_id", _split_expr().alias("split"))
    return s.select("event_id", tx.parse_score("split").alias("score_numeric"))


@register("score_margin", f"""WITH {LOGS_CTE}
SELECT event_id,
  TRY_CAST(regexp_extract(split, '\\+/-\\s*([^\\s%]+)', 1) AS DOUBLE) AS margin,
  TRY_CAST(regexp_extract(split, '\\[\\s*([^,%\\]\\s]+)%?\\s*,\\s*([^,%\\]\\s]+)%?\\s*\\]', 1) AS DOUBLE) AS ci_low,
  TRY_CAST(regexp_extract(split, '\\[\\s*([^,%\\]\\s]+)%?\\s*,\\s*([^,%\\]\\s]+)%?\\s*\\]', 2) AS DOUBLE) AS ci_high
FROM sp""")
def q_score_margin(spark, d):
    s = scorer_logs(spark, d).select("event_id", _split_expr().alias("split"))
    lo, hi = tx.parse_interval("split")
    return s.select("event_id", tx.parse_margin("split").alias("margin"), lo.alias("ci_low"),
                    hi.alias("ci_high"))


@register("log_scores", f"WITH {LOGS_CTE}, {PARSE_SQL} SELECT event_id, score_numeric FROM ps")
def q_log_scores(spark, d):
    """S18 + X8 + X9 end to end: every scorer log is written as one record,
    read back whole, identified by its first line, split and parsed."""
    path = scratch_path(spark, "scorer-logs")
    parts.write_logs(scorer_logs(spark, d), path)
    logs = parts.read_logs(spark, path, record_sep=parts.LOG_RECORD_SEP)
    head = F.substring_index("log", "\n", 1)
    ident = logs.select(F.regexp_extract(head, r" run (\d+)$", 1).cast("long").alias("event_id"),
                        F.substring_index(head, " ", 1).alias("event_type"), "log")
    s = ident.select("event_id", _split_expr().alias("split"))
    return s.select("event_id", tx.parse_score("split").alias("score_numeric"))


# ----------------------------------------------------------------- model names
def model_paths(spark, d):
    p = table(spark, d, "part")
    quant = (F.when(F.col("p_size") <= 12, "F32").when(F.col("p_size") <= 25, "F16")
             .when(F.col("p_size") <= 37, "BF16").otherwise("Q8_0"))
    shard = F.when(F.col("p_retailprice") >= 950, F.lit("-00001-of-00003")).otherwise(F.lit(""))
    base = F.concat(F.lit("gguf/"), F.lower("p_type"), F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("-")))
    path = F.concat(base, F.lit("-"), F.lower(quant), shard, F.lit(".gguf"))
    return p.select("p_partkey", "p_name", quant.alias("quant"), path.alias("path"))


PATHS_CTE = """
mp AS (
  SELECT p_partkey, p_name,
    CASE WHEN p_size <= 12 THEN 'F32' WHEN p_size <= 25 THEN 'F16' WHEN p_size <= 37 THEN 'BF16' ELSE 'Q8_0' END AS quant,
    'gguf/' || lower(p_type) || '/' || replace(p_name, ' ', '-') || '-' ||
    lower(CASE WHEN p_size <= 12 THEN 'F32' WHEN p_size <= 25 THEN 'F16' WHEN p_size <= 37 THEN 'BF16' ELSE 'Q8_0' END)
    || CASE WHEN p_retailprice >= 950 THEN '-00001-of-00003' ELSE '' END || '.gguf' AS path
  FROM part
)"""


@register("marker_split_right", f"""WITH {PATHS_CTE}
SELECT p_partkey, {strip("string_split(string_split(path, '/')[-1], '.')[1]")} AS stem,
       CASE WHEN contains(string_split(path, '/')[-1], '-00001-of-')
            THEN {strip("string_split(string_split(string_split(path, '/')[-1], '-00001-of-')[1], '-')[1]")} END AS word FROM mp""")
def q_marker_split_right(spark, d):
    """X8 with right-hand markers, one and several in a row; NULL where one is missing."""
    return model_paths(spark, d).select("p_partkey", tx.marker_split("path", left="/", right=".").alias("stem"),
                                        tx.marker_split("path", left="/", right=["-00001-of-", "-"]).alias("word"))


@register("model_name", f"""WITH {PATHS_CTE}
SELECT p_partkey, path,
  regexp_replace(regexp_replace(string_split(path, '/')[-1], '\\.[^.]*$', ''), '^(.*)-00001-of-.*$', '\\1') AS model_name
FROM mp""")
def q_model_name(spark, d):
    return model_paths(spark, d).select("p_partkey", "path", tx.model_name("path").alias("model_name"))


@register("artifact_kind", f"""WITH {PATHS_CTE}
SELECT p_partkey,
  replace(p_name, ' ', '-') || '-' || lower(quant) || '.gguf' AS artifact,
  regexp_extract(lower(regexp_replace(regexp_replace(string_split(path, '/')[-1], '\\.[^.]*$', ''),
                 '^(.*)-00001-of-.*$', '\\1')), '-(f32|f16|bf16|q8_0)$', 1) AS quantisation
FROM mp""")
def q_artifact_kind(spark, d):
    mp = model_paths(spark, d)
    return mp.select("p_partkey",
                     tx.artifact_name(F.replace("p_name", F.lit(" "), F.lit("-")), F.col("quant")).alias("artifact"),
                     tx.artifact_quantisation(tx.model_name("path")).alias("quantisation"))


@register("model_args_match", f"""WITH {PATHS_CTE}
SELECT p_partkey, CASE
  WHEN contains(path, 'red') THEN '--ctx 2048 -fa on'
  WHEN contains(path, 'bolt') THEN '-np 8'
  WHEN contains(path, 'plate') THEN '-t 4'
  WHEN contains(path, 'widget') THEN '--mlock'
  ELSE '' END AS model_args FROM mp""")
def q_model_args_match(spark, d):
    return evals.match_model_args(model_paths(spark, d), MODEL_ARGS).select("p_partkey", "model_args")


@register("model_args_join", f"""WITH {PATHS_CTE}
SELECT p_partkey, CASE
  WHEN contains(path, 'red') THEN '--ctx 2048 -fa on'
  WHEN contains(path, 'bolt') THEN '-np 8'
  WHEN contains(path, 'plate') THEN '-t 4'
  WHEN contains(path, 'widget') THEN '--mlock'
  ELSE '' END AS model_args FROM mp""")
def q_model_args_join(spark, d):
    pats = spark.createDataFrame([(i, p, a) for i, (p, a) in enumerate(evals.parse_model_args(MODEL_ARGS))],
                                 "ord int, pattern string, args string")
    return evals.match_model_args(model_paths(spark, d), pats).select("p_partkey", "model_args")


# ----------------------------------------------------------------- J1, J2, U2, A19
@register("score_matrix", f"WITH {RESULTS_CTE} SELECT model, task, score FROM mat")
def q_score_matrix(spark, d):
    return matrix(spark, d)


@register("pending_work", f"""WITH {RESULTS_CTE}
SELECT mdl.model, tsk.task FROM mdl JOIN tsk ON true
WHERE NOT EXISTS (SELECT 1 FROM res WHERE res.model = mdl.model AND res.task = tsk.task)""")
def q_pending_work(spark, d):
    return evals.pending_work(models(spark, d), TASKS, results(spark, d))


@register("valid_results", f"WITH {RESULTS_CTE} SELECT model, task, score, seconds FROM res")
def q_valid_results(spark, d):
    return evals.valid_results(results(spark, d))


@register("valid_results_gaps", """
SELECT event_id, value AS score, 1 + event_id % 90 AS seconds FROM events WHERE event_type <> 'error' AND event_id % 5 <> 0""")
def q_valid_results_gaps(spark, d):
    """P7 on a store in which some results lack the score, the time or both."""
    ev = table(spark, d, "events")
    store = ev.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("score"),
                      F.when(F.col("event_id") % 5 != 0, 1 + F.col("event_id") % 90).alias("seconds"))
    return evals.valid_results(store)


@register("elapsed", """
SELECT user_id, datesub('second', min(ts), max(ts))::BIGINT AS seconds,
       date_diff('microsecond', min(ts), max(ts)) / 1000000.0::DOUBLE AS exact FROM events GROUP BY user_id""")
def q_elapsed(spark, d):
    """M3: whole seconds from the first to the last event of a user."""
    ends = table(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return ends.select("user_id", tx.elapsed_seconds("a", "b").cast("long").alias("seconds"), tx.elapsed_seconds_exact("a", "b").alias("exact"))


@register("upsert_latest", f"""
SELECT {MODEL_SQL} AS model, event_type AS task, value AS score, event_id
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def q_upsert_latest(spark, d):
    ev = table(spark, d, "events").select(model_col().alias("model"), F.col("event_type").alias("task"),
                                          F.col("value").alias("score"), "event_id", "ts")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    old = evals.upsert_results(ev.where(F.col("ts") < cut), ev.limit(0), ["model", "task"],
                               F.struct("ts", "event_id"))
    new = ev.where(F.col("ts") >= cut)
    return (evals.upsert_results(old, new, ["model", "task"], F.struct("ts", "event_id"))
            .select("model", "task", "score", "event_id"))


@register("count_models", f"WITH {RESULTS_CTE} SELECT count(DISTINCT model) AS total_models FROM res")
def q_count_models(spark, d):
    return evals.count_models(results(spark, d), "model")


# ----------------------------------------------------------------- A9-A12, W2, W3, W5, T5, S13
@register("task_winner", f"""WITH {RESULTS_CTE}
SELECT task, arg_min(model, (-score, model)) AS winner, max(score) AS best_score FROM mat GROUP BY task""")
def q_task_winner(spark, d):
    return evals.task_winner(matrix(spark, d))


@register("normalised_score", f"""WITH {RESULTS_CTE}
SELECT model, round(sum(CASE WHEN score > 0 THEN score / mx ELSE 0.0 END) / {len(TASKS)}.0, 9) AS norm_score
FROM mat JOIN tmax USING (task) GROUP BY model""")
def q_normalised_score(spark, d):
    n = evals.normalised_score(matrix(spark, d), n_tasks=len(TASKS))
    return n.select("model", F.round("norm_score", 9).alias("norm_score"))


@register("cap_normalise", f"""WITH {RESULTS_CTE}
SELECT model, task, CASE WHEN mx > 0 THEN score * (100.0::DOUBLE / mx) ELSE score END AS score
FROM mat JOIN tmax USING (task)""")
def q_cap_normalise(spark, d):
    return evals.cap_normalise(matrix(spark, d)).select("model", "task", "score")


@register("range_normalise", f"""WITH {RESULTS_CTE}
SELECT model, task, CASE WHEN mx > 0 THEN coalesce(CASE WHEN mx - mn = 0 THEN NULL
       ELSE 100.0::DOUBLE * (score - mn) / (mx - mn) END, 0.0) ELSE score END AS score
FROM mat JOIN tmax USING (task)""")
def q_range_normalise(spark, d):
    return evals.range_normalise(matrix(spark, d)).select("model", "task", "score")


@register("total_score", f"""WITH {RESULTS_CTE},
cap AS (SELECT model, CASE WHEN mx > 0 THEN score * (100.0::DOUBLE / mx) ELSE score END AS score
        FROM mat JOIN tmax USING (task))
SELECT model, round(sum(score), 6) AS total_score FROM cap GROUP BY model""")
def q_total_score(spark, d):
    t = evals.total_score(evals.cap_normalise(matrix(spark, d)))
    return t.select("model", F.round("total_score", 6).alias("total_score"))


_WIDE_COLS = ", ".join(f"coalesce(max(score) FILTER (WHERE task = '{t}'), 0.0) AS \"{t}\"" for t in TASKS)


@register("leaderboard", f"""WITH {RESULTS_CTE},
nrm AS (SELECT model, round(sum(CASE WHEN score > 0 THEN score / mx ELSE 0.0 END) / {len(TASKS)}.0, 9) AS norm_score
        FROM mat JOIN tmax USING (task) GROUP BY model),
wide AS (SELECT model, {_WIDE_COLS} FROM mat GROUP BY model)
SELECT row_number() OVER (ORDER BY norm_score DESC, model) AS rank, *
FROM nrm JOIN wide USING (model)""")
def q_leaderboard(spark, d):
    lb = evals.leaderboard(matrix(spark, d), TASKS)
    return lb.select("rank", "model", "norm_score", *[F.col(f"`{t}`") for t in TASKS])


@register("wide_scores", f"""WITH {RESULTS_CTE}
SELECT model AS "Model", {", ".join(f"coalesce(max(score) FILTER (WHERE task = '{t}'), 0.0) AS \"{t}\"" for t in TASKS)}
FROM res GROUP BY model""")
def q_wide_scores(spark, d):
    return evals.wide_scores(results(spark, d), TASKS).withColumnRenamed("model", "Model")


@register("model_time", f"WITH {RESULTS_CTE} SELECT model, sum(seconds)::BIGINT AS seconds FROM res GROUP BY model")
def q_model_time(spark, d):
    return evals.model_time(results(spark, d))


@register("task_select", """
SELECT event_type AS task, count(*) AS n_events FROM events
WHERE lower(event_type) IN ('click', 'view') GROUP BY event_type""")
def q_task_select(spark, d):
    cat = table(spark, d, "events").groupBy(F.col("event_type").alias("task")).agg(
        F.count(F.lit(1)).alias("n_events"))
    return evals.select_tasks(cat, "Click,VIEW", name="task")


@register("task_difference", """
SELECT event_type AS task, count(*) AS n_events FROM events
WHERE lower(event_type) NOT IN ('error', 'signup') GROUP BY event_type""")
def q_task_difference(spark, d):
    cat = table(spark, d, "events").groupBy(F.col("event_type").alias("task")).agg(
        F.count(F.lit(1)).alias("n_events"))
    neg, names = evals.parse_task_spec("except:error,SIGNUP")
    excluded = spark.createDataFrame([(n,) for n in sorted(names)], "task string")
    return evals.task_difference(cat, excluded, name="task")


@register("size_order", """
SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars DESC, doc_id DESC) AS rank FROM documents""")
def q_size_order(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    from colloquy.operators.indexing import dense_index
    ranked = dense_index(evals.order_by_size(docs, "n_chars", "doc_id"),
                         [F.desc("n_chars"), F.desc("doc_id")], "rank")
    return ranked.withColumn("rank", F.col("rank") + 1)


# ----------------------------------------------------------------- A14-A16, M4
from colloquy.plans.polysql import moments_sql, predicted  # noqa: E402


@register("poly_time", f"""WITH {moments_sql('lineitem', 'l_returnflag', 'l_quantity', 'l_extendedprice')},
tg AS (SELECT DISTINCT l_returnflag, l_quantity FROM lineitem)
SELECT l_returnflag, l_quantity,
       round(CASE WHEN coalesce(m_n, 0) >= 2 THEN {predicted('l_quantity')} ELSE 1.0 END, 2) AS predicted
FROM tg LEFT JOIN cf USING (l_returnflag)""")
def q_poly_time(spark, d):
    li = table(spark, d, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    targets = li.select("l_returnflag", "l_quantity").distinct()
    p = evals.predict_time(li, targets, ["l_returnflag"], "l_quantity", "l_extendedprice")
    return p.select("l_returnflag", "l_quantity", F.round("predicted", 2).alias("predicted"))


@register("fallback_time", """
WITH r AS (SELECT CASE WHEN sum(l_quantity) > 0 THEN sum(l_extendedprice) / sum(l_quantity) END AS rate FROM lineitem),
tg AS (SELECT DISTINCT l_quantity FROM lineitem)
SELECT l_quantity, round(coalesce((SELECT rate FROM r) * l_quantity, 1.0), 2) AS predicted FROM tg""")
def q_fallback_time(spark, d):
    li = table(spark, d, "lineitem").select("l_quantity", "l_extendedprice")
    p = evals.fallback_time(li, li.select("l_quantity").distinct(), "l_quantity", "l_extendedprice")
    return p.select("l_quantity", F.round("predicted", 2).alias("predicted"))


def model_sizes(spark, d):
    """Model dimension with a size: the customer balance of the same key."""
    ev = user_task(spark, d).select("user_id").distinct()
    cu = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("size"))
    return ev.join(cu, "user_id").select(model_col().alias("model"), "size")


@register("model_eta", f"""WITH {RESULTS_CTE},
sz AS (SELECT DISTINCT {MODEL_SQL} AS model, c_acctbal AS size FROM events JOIN customer ON c_custkey = user_id),
pairs AS (SELECT model, size, task FROM sz JOIN tsk ON true),
pts AS (SELECT res.task, sz.size AS x, res.seconds::DOUBLE AS y FROM res JOIN sz USING (model)),
rate AS (SELECT CASE WHEN sum(x) > 0 THEN sum(y) / sum(x) END AS r FROM pts),
{moments_sql('pts', 'task', 'x', 'y')},
pred AS (SELECT pairs.model, pairs.task,
           CASE WHEN coalesce(cf.m_n, 0) >= 2 THEN {predicted('pairs.size')}
                ELSE coalesce((SELECT r FROM rate) * pairs.size, 1.0) END AS predicted
         FROM pairs LEFT JOIN cf USING (task))
SELECT model, round(sum(coalesce(res.seconds::DOUBLE, predicted)), 2) AS eta_seconds,
       bool_and(res.seconds IS NOT NULL) AS exact
FROM pred LEFT JOIN res USING (model, task) GROUP BY model""")
def q_model_eta(spark, d):
    eta = evals.model_eta(model_sizes(spark, d), TASKS, results(spark, d))
    return eta.select("model", F.round("eta_seconds", 2).alias("eta_seconds"), "exact")
