"""Registered queries and the pipeline on the smallest tables."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_one_query_for_each_operator():
    names = E.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names


def test_native_mix_has_no_python(spark):
    df = E.queries()["op1_mix_sources"](spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert not any(k in plan for k in ("Python", "Pandas", "Arrow"))


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, docs, SF)
        rows = kept.collect()
        assert kept.columns == columns and 0 < len(rows) <= len(seen)
        assert all(seen[r.doc_id] == r.text for r in rows)  # what stays is unchanged
        docs, seen = spark.createDataFrame(rows, kept.schema), {r.doc_id: r.text for r in rows}
    mixed = corpus_pipeline.mix_to_weights(spark, docs, SF)
    assert mixed.columns == columns
    total = sum(len((t or "").encode().split()) for t in seen.values())
    words = sum(len((r.text or "").encode().split()) for r in mixed.collect())
    assert abs(words - 1.5 * total) <= 40
    assert corpus_pipeline.run(spark, SF).count() > 0
