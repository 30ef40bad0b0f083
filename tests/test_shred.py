"""Shredded records against the nested form."""

import random

import pytest
from pyspark.sql import functions as F

from colloquy.operators import mcq, shred

SCHEMA = ("rid long, document struct<id:string, summary:struct<text:string>, title:string, start:string>, question struct<text:string>, "
          "answers array<struct<text:string, notes:array<struct<a:string, b:string>>>>")


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(1)
    maybe = lambda p=.7: f"v{rng.randrange(100)} " if rng.random() < p else None
    rows = []
    for rid in range(80):
        answers = [(maybe(), [(maybe(.5), maybe(.5)) for _ in range(rng.randrange(3))]) for _ in range(rng.randrange(5))]
        rows.append((rid, (maybe(), (maybe(),), maybe(.5), maybe(.5)), (maybe(),), rng.choice([answers, answers, None])))
    rows.append((100, ("id", ("s",), "hot", None), ("q?",), [(f"a{i}", [(f"n{i}", None)]) for i in range(2500)]))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("path", ["answers.text", "document.title", "document.title or start", "document.summary.text",
                                  "answers.notes.a", "answers.notes.a or b"])
def test_path_rows_equal_the_nested_form(records, path):
    got = {(r.rid, r.idx): r.value for r in shred.path_rows(shred.shred(records, "rid"), path, "rid").collect()}
    want = {(r.rid, r.idx): r.value for r in mcq.path_table(records, path, keep=["rid"]).collect()}
    assert got == want and got


@pytest.mark.parametrize("fmt", ["{question.text} => {answers.text}", "{document.title or start}: {answers.text}\\n{answers.notes.b}", "<{answers.text}>"])
def test_template_rows_equal_the_nested_form(records, fmt):
    some = records.where("rid < 100")
    got = {(r.rid, r.idx): r.expansion for r in shred.template_rows(shred.shred(some, "rid"), fmt, "rid").collect()}
    want = {(r.rid, r.idx): r.expansion for r in mcq.template_table(some, fmt, keep=["rid"]).collect()}
    assert got == want and got


def test_answer_rows_equal_exploded_records(records):
    q, a = "{document.title or start}? {question.text}", " {answers.text} "
    got = {tuple(r) for r in shred.answer_rows(shred.shred(records, "rid"), q, a, "rid").collect()}
    nested = mcq.explode_mcq(mcq.to_mcq(records, q, a, keep=["rid"]), keep=["rid"])
    assert got == {tuple(r) for r in nested.select("rid", "question", "kind", "idx", "answer", "label").collect()}


def test_shredded_rows_of_nothing(records):
    rows = shred.shred(records.limit(0), "rid")
    assert shred.path_rows(rows, "answers.text", "rid").count() == 0
    with pytest.raises(ValueError):
        shred.template_rows(rows, "no placeholder", "rid")
    assert rows.select(F.size("at")).columns
