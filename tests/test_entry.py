"""Driver contract: entry() and every registered query on sf0.001."""

import os

import pytest

import __spark_entry__ as E
from colloquy.plans.registry import load_all

CORE = load_all()[0]

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"pattern", "n_conversations", "rendered_chars", "trained_chars"}
    assert sum(r["n_conversations"] for r in rows) == spark.read.parquet(f"{SF}/conversations.parquet") \
        .select("conv_id").distinct().count()


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    assert len(CORE) >= 80 and set(CORE) <= set(q) and set(o) <= set(q)
    assert not any(n.startswith("op") and n[2:3].isdigit() for n in CORE)


# plan shapes no registered query may use: cross joins, row-at-a-time Python UDFs
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_runs(spark, name):
    df = E.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    assert len(df.columns) == len(set(df.columns))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [k for k in FORBIDDEN if k in plan]
