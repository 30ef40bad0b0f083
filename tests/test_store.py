"""The keyed table of the streams: touched buckets, replay, failure, clean-up."""

import os
import random

import pytest

from colloquy.session import local_path, scratch_path
from colloquy.streaming import jobs, store

SCHEMA = "model string, task string, score double, v int"


def files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-") and f.endswith(".parquet")}


def rows_of(df):
    return {(r.model, r.task): (r.score, r.v) for r in df.collect()}


def test_upserts_equal_one_dictionary(spark):
    rng, path, want = random.Random(1), scratch_path(spark, "test-store"), {}
    for batch in range(9):
        rows = [(rng.choice([None, "a", "b", "c", "d"]), rng.choice("xyz"), round(rng.random(), 3), rng.choice([None, batch, 100 - batch, 5]))
                for _ in range(12)]
        unique = {}
        for r in rows:  # one row per (key, version) of a batch, so that it has one winner
            unique.setdefault((r[0], r[1], r[3]), r)
        store.upsert(spark.createDataFrame(list(unique.values()), SCHEMA), batch, path, ["model", "task"], "v", n_buckets=4, max_parts=3)
        for m, t, s, v in unique.values():
            old = want.get((m, t))
            if old is None or (v is not None, v or 0) >= (old[1] is not None, old[1] or 0):
                want[m, t] = (s, v)
        assert rows_of(store.read_store(spark, path)) == want
    assert len(store._committed(spark, path)) == store.KEPT
    parts = store._manifest(spark, path, store._committed(spark, path)[-1])
    assert all(len(p) < 3 for p in parts.values())
    data = {f.rsplit(os.sep, 1)[0] for f in files(os.path.join(local_path(path), "data"))}
    named = {f"{p}{os.sep}bucket={b}" for n in store._committed(spark, path) for b, ps in store._manifest(spark, path, n).items() for p in ps}
    assert data == named  # nothing else is left


def test_a_batch_writes_the_buckets_it_touches(spark):
    path = scratch_path(spark, "test-store")
    many = [(f"m{i}", "t", float(i), 1) for i in range(200)]
    store.upsert(spark.createDataFrame(many, SCHEMA), 0, path, ["model", "task"], n_buckets=16)
    before = files(local_path(path) + "/data")
    store.upsert(spark.createDataFrame([("m3", "t", -1.0, 2)], SCHEMA), 1, path, ["model", "task"], n_buckets=16)
    added = files(local_path(path) + "/data") - before
    assert len(added) == 1 and before <= files(local_path(path) + "/data")
    assert rows_of(store.read_store(spark, path))["m3", "t"] == (-1.0, 2) and store.read_store(spark, path).count() == 200
    with pytest.raises(ValueError):
        store.upsert(spark.createDataFrame(many, SCHEMA), 2, path, ["model"], n_buckets=16)


def test_replay_and_failure_leave_the_table(spark):
    path = scratch_path(spark, "test-store")
    one = spark.createDataFrame([("a", "t", 1.0, 1)], SCHEMA)
    store.upsert(one, 0, path, ["model", "task"])
    before = files(local_path(path))
    store.upsert(spark.createDataFrame([("a", "t", 9.0, 9)], SCHEMA), 0, path, ["model", "task"])  # batch 0 again
    assert files(local_path(path)) == before and rows_of(store.read_store(spark, path)) == {("a", "t"): (1.0, 1)}
    bad = spark.createDataFrame([("a", "t", 2.0, 2)], SCHEMA).selectExpr("model", "task", "score", "raise_error('stop') as v")
    with pytest.raises(Exception, match="stop"):
        store.upsert(bad, 1, path, ["model", "task"])
    assert rows_of(store.read_store(spark, path)) == {("a", "t"): (1.0, 1)}
    # a batch that failed before its manifest is written again
    store.upsert(spark.createDataFrame([("b", "t", 3.0, 1)], SCHEMA), 1, path, ["model", "task"])
    assert rows_of(store.read_store(spark, path)) == {("a", "t"): (1.0, 1), ("b", "t"): (3.0, 1)}
    store.upsert(one.limit(0), 2, path, ["model", "task"])  # an empty batch
    assert store.read_store(spark, path).count() == 2
    assert store.read_store(spark, scratch_path(spark, "test-none")) is None


def test_stream_goes_on_after_a_restart(spark):
    src, path, ckpt = (scratch_path(spark, f"test-{n}") for n in ("src", "store", "ckpt"))
    for part in range(4):
        spark.createDataFrame([(f"m{k}", "t", float(part * 10 + k), part) for k in range(part + 1)], SCHEMA).coalesce(1).write.mode("append").parquet(src)
        if part in (1, 3):  # two runs over the same checkpoint
            stream = jobs.stream_metrics(spark, src, spark.read.parquet(src).schema, fmt="parquet", max_files_per_trigger=1)
            jobs.stream_results(stream, path, ckpt, ["model", "task"], "v", n_buckets=3, max_parts=2)
    assert rows_of(jobs.read_store(spark, path)) == {("m0", "t"): (30.0, 3), ("m1", "t"): (31.0, 3), ("m2", "t"): (32.0, 3), ("m3", "t"): (33.0, 3)}


def test_compaction_leaves_large_old_parts(spark):
    path = scratch_path(spark, "test-store")
    rewritten = 0
    for batch in range(14):  # batch k brings key k, so a part holds as many rows as it took in batches
        store.upsert(spark.createDataFrame([(f"m{batch}", "t", float(batch), batch)], SCHEMA), batch, path, ["model", "task"], "v", n_buckets=1, max_parts=4)
        parts = store._manifest(spark, path, store._committed(spark, path)[-1])[0]
        assert len(parts) < 4 and sum(map(store._deltas, parts)) == batch + 1
        rewritten += store._deltas(parts[-1]) if parts[-1].startswith(f"{batch:010d}-") else 0
    assert rewritten == 4 + 3 + 2 + 10 + 3  # one part of everything every third batch: 4 + 7 + 10 + 13
    assert rows_of(store.read_store(spark, path)) == {(f"m{k}", "t"): (float(k), k) for k in range(14)}
