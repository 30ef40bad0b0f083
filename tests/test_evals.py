
import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.operators import evals

TASKS = ["Hellaswag", "Winogrande", "MMLU", "TruthfulQA", "ARC-Combined", "ARC-Challenge"]
# Published scores per model, tasks in catalogue order; sum; A10; seconds.
PUBLISHED = [
    ("gemma-3-270m-it-q8_0", [38.0, 53.6701, 29.3928, 25.0918, 41.1968, 27.7592], 215.1107, 0.98333, 197),
    ("gemma-3-270m-tulu-3-sft-personas-code-q8_0", [38.0, 53.6701, 29.3928, 25.0918, 41.1968, 27.7592], 215.1107, 0.98333, 227),
    ("gemma-3-270m-tulu-3-sft-personas-instruction-following-q8_0", [38.0, 53.6701, 29.3928, 25.0918, 41.1968, 27.7592], 215.1107, 0.98333, 199),
    ("gemma-3-270m-it-bf16", [38.25, 54.1437, 29.2636, 24.847, 40.046, 26.4214], 212.9717, 0.97088, 340),
    ("gemma-3-270m-tulu-3-sft-personas-code-bf16", [38.25, 54.1437, 29.2636, 24.847, 40.046, 26.4214], 212.9717, 0.97088, 340),
    ("gemma-3-270m-tulu-3-sft-personas-instruction-following-bf16", [38.25, 54.1437, 29.2636, 24.847, 40.046, 26.4214], 212.9717, 0.97088, 340),
    ("gm3-270m-code-bf16", [36.75, 53.9858, 28.553, 26.1934, 39.3556, 26.087], 210.9248, 0.96349, 402),
    ("gm3-270m-albebra-q8_0", [34.75, 55.8011, 28.6176, 26.5606, 40.1611, 25.4181], 211.3085, 0.96211, 240),
    ("gm3-270m-code-q8_0", [36.5, 53.4333, 28.876, 26.3158, 38.8953, 24.7492], 208.7696, 0.95345, 241),
    ("gm3-270m-math-bf16", [34.75, 54.9329, 28.4884, 24.235, 39.4707, 26.4214], 208.2984, 0.94742, 329),
    ("gm3-270m-math-q8_0", [35.25, 54.2226, 28.6822, 24.4798, 39.931, 25.0836], 207.6492, 0.94394, 192),
]
MAXIMA = {"Hellaswag": 38.25, "Winogrande": 55.8011, "MMLU": 29.3928, "TruthfulQA": 26.5606,
          "ARC-Combined": 41.1968, "ARC-Challenge": 27.7592}


@pytest.fixture(scope="module")
def scores(spark):
    rows = [(m, t, s) for m, ss, *_ in PUBLISHED for t, s in zip(TASKS, ss)]
    return spark.createDataFrame(rows, "model string, task string, score double")


def test_task_max_and_normalised(spark, scores):
    mx = {r["task"]: r["task_max"] for r in evals.task_stats(scores).collect()}
    assert mx == MAXIMA
    norm = {r["model"]: r["norm_score"] for r in evals.normalised_score(scores, n_tasks=6).collect()}
    for m, _, _, a10, _ in PUBLISHED:
        assert round(norm[m], 5) == a10


def test_total_and_rank(spark, scores):
    tot = evals.total_score(scores)
    got = {r["model"]: r["total_score"] for r in tot.collect()}
    for m, _, s, _, _ in PUBLISHED:
        assert round(got[m], 4) == s
    ranked = evals.rank_models(tot.withColumn("total_score", F.round("total_score", 6)), "total_score")
    order = [r["model"] for r in ranked.orderBy("rank").collect()]
    assert order[:3] == sorted(m for m, *_ in PUBLISHED[:3])  # tie broken by model name
    assert order[-1] == "gm3-270m-math-q8_0"


def test_winner_ties(spark, scores):
    w = {r["task"]: r["winner"] for r in evals.task_winner(scores).collect()}
    assert w["Winogrande"] == "gm3-270m-albebra-q8_0"
    assert w["MMLU"] == "gemma-3-270m-it-q8_0"  # three-way tie, first by name
    size_first = [(-F.col("size")).alias("k1"), F.col("model").alias("k2")]
    sized = scores.withColumn("size", F.when(F.col("model").contains("tulu-3-sft-personas-code"), 2).otherwise(1))
    w2 = {r["task"]: r["winner"] for r in evals.task_winner(sized, tiebreak=size_first).collect()}
    assert w2["MMLU"] == "gemma-3-270m-tulu-3-sft-personas-code-q8_0"


def test_cap_and_range_documented_example(spark):
    df = spark.createDataFrame([("a", "t", 0.1), ("b", "t", 0.2), ("c", "t", 0.3),
                                ("a", "u", 5.0), ("b", "u", 5.0), ("a", "v", -1.0), ("b", "v", 0.0)],
                               "model string, task string, score double")
    cap = {(r["model"], r["task"]): r["score"] for r in evals.cap_normalise(df).collect()}
    rng = {(r["model"], r["task"]): r["score"] for r in evals.range_normalise(df).collect()}
    assert [round(cap[(m, "t")], 2) for m in "abc"] == [33.33, 66.67, 100.0]
    assert [round(rng[(m, "t")], 6) for m in "abc"] == [0.0, 50.0, 100.0]
    assert rng[("a", "u")] == 0.0 and cap[("a", "u")] == 100.0
    assert cap[("a", "v")] == -1.0 and rng[("b", "v")] == 0.0  # max <= 0: untouched


def test_matrix_zero_fill_and_pending(spark):
    res = spark.createDataFrame([("m1", "a", 1.0), ("m2", "b", 2.0)], "model string, task string, score double")
    models = spark.createDataFrame([("m1",), ("m2",), ("m3",)], "model string")
    mat = {(r["model"], r["task"]): r["score"] for r in evals.score_matrix(res, models, ["a", "b"]).collect()}
    assert mat == {("m1", "a"): 1.0, ("m1", "b"): 0.0, ("m2", "a"): 0.0, ("m2", "b"): 2.0,
                   ("m3", "a"): 0.0, ("m3", "b"): 0.0}
    pend = {(r["model"], r["task"]) for r in evals.pending_work(models, ["a", "b"], res).collect()}
    assert pend == {("m1", "b"), ("m2", "a"), ("m3", "a"), ("m3", "b")}
    assert len(evals.pending_work(models, ["a", "b"], res, recalc=True).collect()) == 6


def test_task_spec(spark):
    cat = spark.createDataFrame([(t,) for t in TASKS], "name string")
    names = lambda spec: sorted(r[0] for r in evals.select_tasks(cat, spec).collect())
    assert names("all") == sorted(TASKS)
    assert names("except:all") == []
    assert names("mmlu,HELLASWAG") == ["Hellaswag", "MMLU"]
    for unknown in ("mmlu,unknown", "except:unknown", "EXCEPT:mmlu"):  # the prefix is case-sensitive
        with pytest.raises(ValueError):
            names(unknown)
    assert names("except:mmlu") == sorted(t for t in TASKS if t != "MMLU")
    ex = spark.createDataFrame([("mmlu",), ("winogrande",)], "name string")
    assert sorted(r[0] for r in evals.task_difference(cat, ex).collect()) == sorted(
        t for t in TASKS if t not in ("MMLU", "Winogrande"))


def test_model_args(spark):
    margs = ["gm3:--a", "code:--b", "gm3:--c"]
    assert evals.parse_model_args(margs) == [("gm3", "--a --c"), ("code", "--b")]
    models = spark.createDataFrame([("x/gm3-code.gguf",), ("x/gemma-code.gguf",), ("x/other.gguf",)], "path string")
    got = {r["path"]: r["model_args"] for r in evals.match_model_args(models, margs).collect()}
    assert got == {"x/gm3-code.gguf": "--a --c", "x/gemma-code.gguf": "--b", "x/other.gguf": ""}
    pats = spark.createDataFrame([(i, p, a) for i, (p, a) in enumerate(evals.parse_model_args(margs))],
                                 "ord int, pattern string, args string")
    got2 = {r["path"]: r["model_args"] for r in evals.match_model_args(models, pats).collect()}
    assert got2 == got


def test_model_args_table_matches_brute_force(spark):
    """Pattern table: an index on each pattern's rarest gram."""
    import random

    rnd = random.Random(7)
    alpha = "abcde-/"
    paths = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    pats = [("".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 4))), f"a{i}") for i in range(60)] + [("abcdea", "long"), ("zz", "none")]
    mdf = spark.createDataFrame(list(enumerate(paths)), "id int, path string")
    pdf = spark.createDataFrame([(i, p, a) for i, (p, a) in enumerate(pats)], "ord int, pattern string, args string")
    joined = {p: " ".join(a for q, a in pats if q == p) for p, _ in pats}
    want = {i: next((joined[p] for p, _ in pats if p in path), "") for i, path in enumerate(paths)}
    got = {r.id: r.model_args for r in evals.match_model_args(mdf, pdf).collect()}
    assert got == want


def test_equal_patterns_of_a_table_join_their_args(spark):
    models = spark.createDataFrame([("x/red.gguf",)], "path string")
    pats = spark.createDataFrame([(0, "red", "-a"), (1, "red", "-b")], "ord int, pattern string, args string")
    assert evals.match_model_args(models, pats).collect()[0]["model_args"] == "-a -b"


def test_upsert_keeps_rows_without_a_version(spark):
    old = spark.createDataFrame([("m", "a", "1", None), ("m", "b", "2", None)], "model string, task string, score string, v int")
    new = spark.createDataFrame([("m", "b", "3", 1)], "model string, task string, score string, v int")
    got = {r["task"]: r["score"] for r in evals.upsert_results(old, new, ["model", "task"], "v").collect()}
    assert got == {"a": "1", "b": "3"}


@pytest.mark.parametrize("base,step", [(1e9, 1e6), (1e9, 1e5), (7e9, 5e5)])
def test_poly_fit_of_nearly_equal_sizes(spark, base, step):
    pts = spark.createDataFrame([("t", base + i * step, 10.0 + (i - 2) ** 2) for i in range(6)], "task string, x double, y double")
    tg = spark.createDataFrame([("t", base + 5 * step)], "task string, x double")
    assert evals.predict_time(pts, tg, ["task"], "x", "y").collect()[0]["predicted"] == pytest.approx(19.0, rel=1e-6)


def test_rows_without_a_time_are_no_points(spark):
    models = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "model string, size double")
    res = spark.createDataFrame([("a", "t", 10), ("b", "t", None)], "model string, task string, seconds int")
    eta = {r["model"]: r["eta_seconds"] for r in evals.model_eta(models, ["t"], res).collect()}
    assert eta == {"a": 10.0, "b": pytest.approx(20.0), "c": pytest.approx(30.0)}


def test_upsert_last_write_wins(spark):
    old = spark.createDataFrame([("m", "a", "1", 10, 1), ("m", "b", "2", 20, 1)],
                                "model string, task string, score string, seconds int, v int")
    new = spark.createDataFrame([("m", "a", "3", 30, 2)], "model string, task string, score string, seconds int, v int")
    got = {r["task"]: r["score"] for r in evals.upsert_results(old, new, ["model", "task"], "v").collect()}
    assert got == {"a": "3", "b": "2"}


@pytest.mark.parametrize("n,deg", [(12, 2), (2, 1), (3, 2)])
def test_poly_fit_matches_numpy(spark, n, deg):
    rng = np.random.default_rng(n)
    x = rng.uniform(1e8, 2e9, n)
    y = 3e-9 * x + 2e-19 * x ** 2 + rng.normal(0, 1, n) + 20
    pts = spark.createDataFrame([("t", float(a), float(b)) for a, b in zip(x, y)], "task string, x double, y double")
    tg = spark.createDataFrame([("t", 1.5e9)], "task string, x double")
    got = evals.predict_time(pts, tg, ["task"], "x", "y").collect()[0]["predicted"]
    want = max(0.0, float(np.polyval(np.polyfit(x, y, min(2, n - 1)), 1.5e9)))
    assert got == pytest.approx(want, rel=1e-6)


def test_poly_degenerate_and_fallback(spark):
    pts = spark.createDataFrame([("t", 5.0, 10.0), ("t", 5.0, 20.0), ("u", 4.0, 8.0)], "task string, x double, y double")
    tg = spark.createDataFrame([("t", 7.0), ("u", 2.0), ("w", 1.0)], "task string, x double")
    fb = F.lit(-9.0)
    got = {r["task"]: r["predicted"] for r in evals.predict_time(pts, tg, ["task"], "x", "y", fallback=fb).collect()}
    assert got == {"t": 15.0, "u": -9.0, "w": -9.0}  # one distinct size -> mean; < 2 points -> fallback
    f = {r["x"]: r["predicted"] for r in evals.fallback_time(pts, tg.select("x"), "x", "y").collect()}
    assert f[7.0] == pytest.approx(38.0 / 14.0 * 7.0)
    empty = pts.limit(0)
    assert evals.fallback_time(empty, tg.select("x"), "x", "y").collect()[0]["predicted"] == 1.0


def test_model_eta(spark):
    models = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "model string, size double")
    res = spark.createDataFrame([("a", "t", 10), ("b", "t", 20), ("a", "u", 5)], "model string, task string, seconds int")
    eta = {r["model"]: (round(r["eta_seconds"], 6), r["exact"]) for r in evals.model_eta(models, ["t", "u"], res).collect()}
    # t: line through (1,10),(2,20) -> c: 30; u: one point -> fallback 35/4 per size unit
    assert eta["a"] == (15.0, True)
    assert eta["b"] == (round(20 + 35 / 4 * 2, 6), False)
    assert eta["c"] == (round(30 + 35 / 4 * 3, 6), False)
