"""File formats, metric summaries, streams."""

import json
import os
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from colloquy.operators import metrics
from colloquy.session import local_path, scratch_path
from colloquy.sources import metrics as msrc
from colloquy.sources import parts, results as rsrc
from colloquy.streaming import jobs
from colloquy.streaming.store import _committed


def metric_pdf(n=40, runs=3):
    rows, t0 = [], datetime(2025, 9, 9, 12, 22, 12, 213543)
    for r in range(runs):
        for s in range(1, n + 1):
            loss = None if s % 7 == 0 else 4.0 / s + r
            gn = None if s % 5 == 0 else 30.0 / s
            lr = None if s == 3 else s * 1e-6
            rows.append((f"run{r}", s, s / n, loss, gn, lr, t0 + timedelta(seconds=1.2 * s + r)))
    rows.append(("run0", n + 1, 1.0, None, None, None, t0 + timedelta(seconds=999)))  # all-null row
    return pd.DataFrame(rows, columns=["run", "step", "epoch", "loss", "grad_norm", "learning_rate", "timestamp"])


def brute_summary(pdf):
    out = {}
    for run, g in pdf.sort_values("step").groupby("run"):
        loss, lr, gn = g["loss"].dropna().tolist(), g["learning_rate"].dropna().tolist(), g["grad_norm"].dropna().tolist()
        out[run] = dict(initial_loss=loss[0], final_loss=loss[-1], min_loss=min(loss), max_loss=max(loss),
                        loss_reduction_pct=(loss[0] - loss[-1]) / loss[0] * 100, first_lr=lr[0], last_lr=lr[-1],
                        last_grad_norm=gn[-1], mean_grad_norm=sum(gn) / len(gn), logged_steps=len(g),
                        elapsed_s=(g["timestamp"].max() - g["timestamp"].min()).total_seconds())
    return out


def check(summary_rows, want, drop_null_rows=False):
    got = {r["run"]: r.asDict() for r in summary_rows}
    assert set(got) == set(want)
    for run, w in want.items():
        for k, v in w.items():
            assert got[run][k] == pytest.approx(v, rel=1e-9), (run, k)


def test_run_summary_matches_brute_force(spark):
    pdf = metric_pdf()
    df = spark.createDataFrame(pdf).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    check(metrics.run_summary(df).collect(), brute_summary(pdf))


def test_metric_csv_roundtrip_per_run_files(spark):
    pdf = metric_pdf()
    df = spark.createDataFrame(pdf).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    path = scratch_path(spark, "test-metrics")
    msrc.append_metrics(df, path)
    msrc.append_metrics(df.limit(0), path)  # appending nothing keeps the data
    back = msrc.read_metrics(spark, path)
    assert sorted(d for d in os.listdir(local_path(path)) if d.startswith("run=")) == ["run=run0", "run=run1",
                                                                                       "run=run2"]
    kept = pdf.dropna(how="all", subset=["loss", "grad_norm", "learning_rate"])
    assert back.count() == len(kept)
    check(metrics.run_summary(back).collect(), brute_summary(kept))
    # the reference's own file layout: header line, ISO timestamps
    ref = os.path.join(local_path(path), "ref.csv")
    with open(ref, "w") as f:
        f.write("step,epoch,loss,grad_norm,learning_rate,timestamp\n1,0.5,4.0,34.4,0.0,2025-09-09T12:22:12.213543\n"
                "2,1.0,3.0,,1e-05,2025-09-09T12:22:13\n")
    r = msrc.read_metrics(spark, ref, run_from_path=None).orderBy("step").collect()
    assert r[1]["grad_norm"] is None and r[1]["timestamp"] == datetime(2025, 9, 9, 12, 22, 13)


def test_stream_equals_batch(spark):
    pdf = metric_pdf()
    src = scratch_path(spark, "test-stream-src")
    df = spark.createDataFrame(pdf).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    df.repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = jobs.stream_metrics(spark, src, schema, fmt="parquet", max_files_per_trigger=1)
    target = scratch_path(spark, "test-stream-out")
    jobs.write_summary(jobs.stream_run_summary(stream), target, scratch_path(spark, "test-stream-ckpt"))
    kept = pdf.dropna(how="all", subset=["loss", "grad_norm", "learning_rate"])
    check(jobs.read_store(spark, target).collect(), brute_summary(kept))


def test_stream_results_upsert(spark):
    src = scratch_path(spark, "test-results-src")
    rows = [("m", "a", float(v), v) for v in range(6)] + [("n", "a", 9.0, 1)]
    spark.createDataFrame(rows, "model string, task string, score double, v int").repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = jobs.stream_metrics(spark, src, schema, fmt="parquet", max_files_per_trigger=1)
    store = scratch_path(spark, "test-results-store")
    jobs.stream_results(stream, store, scratch_path(spark, "test-results-ckpt"), ["model", "task"], "v")
    got = {r["model"]: r["score"] for r in jobs.read_store(spark, store).collect()}
    assert got == {"m": 5.0, "n": 9.0}
    assert len(_committed(spark, store)) == 2


def test_results_store_roundtrip(spark):
    long = spark.createDataFrame([
        ("gguf/gm3-270m-code-bf16.gguf", "MMLU", "28.553 +/- 1.1483", 155),
        ("gguf/gm3-270m-code-bf16.gguf", "Hellaswag", "36.75\t[32.1721%, 41.5799%]", 77),
        ("gguf/m-00001-of-00002.gguf", "MMLU", None, 3)], "model_path string, task string, score string, seconds int")
    for combined in (False, True):
        path = scratch_path(spark, "test-results")
        rsrc.write_results(long, path, combined=combined)
        flat = rsrc.flatten_results(rsrc.read_results(spark, path)).collect()
        assert sorted((r["model_name"], r["task"], r["score_numeric"]) for r in flat) == [
            ("gm3-270m-code-bf16", "Hellaswag", 36.75), ("gm3-270m-code-bf16", "MMLU", 28.553)]
    # the reference's single-model file layout (pretty-printed JSON)
    path = local_path(scratch_path(spark, "test-results-ref"))
    os.makedirs(path)
    doc = {"model_path": "gguf/x.gguf", "model_name": "x",
           "tasks": {"MMLU": {"score": "29.1 +/- 1.1", "execution_time_seconds": 70, "score_numeric": 29.1}}}
    with open(os.path.join(path, "x_results.json"), "w") as f:
        json.dump(doc, f, indent=2)
    (r,) = rsrc.flatten_results(rsrc.read_results(spark, path)).collect()
    assert (r["model_name"], r["seconds"], r["score_numeric"]) == ("x", 70, 29.1)


def test_collision_raises(spark):
    long = spark.createDataFrame([("a/x.gguf", "t", "1", 1), ("b/x.gguf", "t", "2", 1)],
                                 "model_path string, task string, score string, seconds int")
    with pytest.raises(ValueError):
        rsrc.write_results(long, scratch_path(spark, "test-collide"))


def test_parts_and_records(spark):
    base = local_path(scratch_path(spark, "test-parts"))
    os.makedirs(base)
    pdf = pd.DataFrame({"a": [1, 2]})
    for i in range(3):
        pdf.assign(a=pdf.a + 10 * i).to_parquet(os.path.join(base, f"v-0000{i}-of-00003.parquet"))
    df = parts.read_parts(spark, os.path.join(base, "v-00000-of-00003.parquet"))
    assert sorted(r[0] for r in df.collect()) == [1, 2, 11, 12, 21, 22]
    with open(os.path.join(base, "r.json"), "w") as f:
        json.dump([{"a": 5, "b": "x"}], f)
    rec = parts.read_records(spark, [os.path.join(base, "v-00000-of-00003.parquet"), os.path.join(base, "r.json")])
    assert rec.count() == 3 and "b" in rec.columns
    with pytest.raises(ValueError):
        parts.read_records(spark, ["x.csv"])
    sizes = parts.artifact_sizes(spark, os.path.join(base, "*.parquet")).collect()
    assert len(sizes) == 1 and sizes[0]["n_files"] == 3
    listing = spark.createDataFrame([(os.path.join(base, f"v-0000{i}-of-00003.parquet"),) for i in (0, 2)], "path string")
    first = listing.limit(1)
    miss = [r[0] for r in parts.missing_parts(first, listing).collect()]
    assert miss == [os.path.join(base, "v-00001-of-00003.parquet")]


def test_read_logs(spark):
    base = local_path(scratch_path(spark, "test-logs"))
    os.makedirs(base)
    for name, body in [("m1_MMLU.log", "x\nFinal result: 29.3 +/- 1.1\n"), ("m1_Wino.log", "Final Winogrande score(3 tasks): 5\n")]:
        with open(os.path.join(base, name), "w") as f:
            f.write(body)
    logs = parts.read_logs(spark, os.path.join(base, "*.log"))
    assert logs.count() == 2 and all("\n" in r["log"] for r in logs.collect())


def test_logs_record_separated_roundtrip(spark):
    """Many whole logs per file: each comes back as one record, blank lines kept."""
    logs = ["MMLU run 1\nFinal result: 29.3 +/- 1.1\n", "Wino run 2\n\nFinal Winogrande score(3 tasks): 5",
            "ARC run 3\nerror: stopped\n\n"]
    df = spark.createDataFrame([(x,) for x in logs], "log string").repartition(2)
    path = scratch_path(spark, "test-log-records")
    parts.write_logs(df, path)
    back = parts.read_logs(spark, path, record_sep=parts.LOG_RECORD_SEP)
    assert sorted(r["log"] for r in back.collect()) == sorted(logs)


def test_json_array_files_are_documents(spark):
    """Each written file is one JSON array; with Parquet parts they read back
    through read_records with a by-name union."""
    import glob

    df = spark.createDataFrame([(i, f"s{i}", None if i % 3 else 1.5) for i in range(20)],
                               "id long, s string, x double").repartition(4)
    empty = spark.createDataFrame([], "id long, s string, x double")
    base = scratch_path(spark, "test-json-array")
    parts.write_json_array(df, f"{base}/a.json")
    parts.write_json_array(empty.repartition(2), f"{base}/e.json")
    files = glob.glob(os.path.join(local_path(f"{base}/a.json"), "part-*"))
    docs = [json.load(open(f)) for f in files]
    assert all(isinstance(d, list) for d in docs) and sum(len(d) for d in docs) == 20
    assert spark.read.option("multiLine", True).json(f"{base}/e.json").count() == 0
    df.select("id", "s").write.parquet(f"{base}/b.parquet")
    rec = parts.read_records(spark, [f"{base}/b.parquet", f"{base}/a.json"])
    assert rec.count() == 40 and set(rec.columns) == {"id", "s", "x"}
    assert rec.where("x = 1.5").count() == 7


def test_flatten_config(spark):
    from colloquy.schemas import RUN_CONFIG
    path = local_path(scratch_path(spark, "test-config"))
    os.makedirs(path)
    cfg = {"model_config": {"max_seq_length": 1024}, "dataset_config": {"dataset_split": "train[:20000]"},
           "lora_config": {"r": 128, "alpha_multiplier": 2, "loftq_config": None, "target_modules": ["q_proj", "k_proj"]},
           "training_config": {"learning_rate": 5e-5}}
    with open(os.path.join(path, "algebra.json"), "w") as f:
        json.dump(cfg, f, indent=2)
    df = msrc.read_run_configs(spark, path)
    assert df.schema["lora_config"].dataType == RUN_CONFIG["lora_config"].dataType
    (r,) = metrics.flatten_config(df).collect()
    assert (r["alpha"], r["lora_alpha"], r["lora_r"], r["training_learning_rate"]) == (256, 256, 128, 5e-5)
    assert r["lora_target_modules"] == ["q_proj", "k_proj"] and r["lora_loftq_config"] is None


def test_event_files_grow_with_the_table(spark, monkeypatch):
    from colloquy.plans import misc_queries as mq

    monkeypatch.setattr(mq, "EVENTS_A_FILE", 10)
    monkeypatch.setattr(mq, "EVENT_FILES", 4)
    for n, most in ((0, 1), (25, 5), (2000, 6)):  # 200 files of ten events each before
        events = spark.range(n).selectExpr("id as event_id", "timestamp_seconds(id) as ts")
        got = spark.read.schema(events.schema).parquet(mq.event_files(events))
        assert sorted(r.event_id for r in got.collect()) == list(range(n))
        assert len(got.inputFiles()) <= most
