"""A17 without gathering a chunk over its models or rows."""

import numpy as np
import pytest

from colloquy.operators import merge


def test_merge_sums_elements_without_gathering_arrays(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(-8, 8, (400, 5)).astype(float)
    rows = [(f"m{i % 2}", "hot", 0, v.tolist()) for i, v in enumerate(x)]
    rows += [("m0", "empty", 0, []), ("m1", "empty", 0, []), ("m0", "null", 0, None), ("m1", "null", 0, [1.0]),
             ("m0", "part", 0, [None, 2.0]), ("m1", "part", 0, [4.0, 6.0]), ("m0", "lone", 0, [1.0])]
    params = spark.createDataFrame(rows, "model string, tensor string, chunk int, values array<float>")
    w = merge.weights_frame(spark, [("m0", 1.0), ("m1", 3.0)])
    long = merge.merge_linear_long(params, w)
    assert "collect_list" not in long._jdf.queryExecution().toString()  # no group of whole arrays
    got = {(r.tensor, r.pos): r.value for r in long.collect()}
    want = np.average(x, axis=0, weights=np.tile([1.0, 3.0], 200))
    assert {k for k in got if k[0] != "hot"} == {("part", 0), ("part", 1)} and got["part", 0] == 3.0 and got["part", 1] == 5.0
    assert [got["hot", i] for i in range(5)] == pytest.approx(list(want))
    whole = {r.tensor: r["values"] for r in merge.merge_linear(params, w).collect()}
    assert whole["hot"] == pytest.approx(list(want), rel=1e-6) and whole["empty"] == [] and whole["null"] is None and "lone" not in whole
