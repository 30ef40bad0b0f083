"""Stages on repeated ids and on columns with the names used inside them."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from colloquy.llm import langid, minhash, mixing, packing, quality, wordpiece

NAMES = ["_size", "_taken", "_take", "_row", "_text", "_told", "_tail", "_grade", "_keep", "_id", "_t1", "_d", "_s", "_z", "_h",
         "n_tokens", "n_words", "size", "taken", "kept", "rep", "fp", "component_id", "h"]


def docs(spark, rows):
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(n).alias(n) for n in NAMES])


EN = "the a cat dog went home with some other very old men who had no house or hat".split()
DE = "der die das ein hund ging nach hause mit anderen sehr alten leuten und ohne hut".split()


def prose(rng, n=40, words=EN):
    return " ".join(rng.choices(words, k=n))


def test_stages_keep_clashing_columns(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, words=(EN, DE)[i % 2]) + " junk" * (i % 10 == 0), ["en", "de"][i % 2], f"s{i % 3}") for i in range(60)] + [(60, None, None, None), (61, "", "en", "s0")]
    df = docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 10 > 0), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    stages = [quality.keep_good(df, labels), langid.keep_known(df), minhash.keep_one(df), mixing.apply_mix(df, mixing.mix(df))]
    for out in stages:
        assert out.columns == df.columns
        got = out.collect()
        assert got and all(r[n] == n for r in got for n in NAMES)
    assert packing.pack(df).count() > 0
    counted = wordpiece.token_counts(df.limit(3))  # its own columns replace those of the same names
    assert all(isinstance(r.n_tokens, int) for r in counted.collect()) and counted.columns.count("n_tokens") == 1


def test_near_dedup_keeps_other_texts_of_an_id(spark):
    rng = random.Random(2)
    a, b, c = (" ".join(f"{k}{rng.randrange(10**6)}" for _ in range(40)) for k in "abc")
    near = a.rsplit(" ", 1)[0] + " changed"
    rows = [(1, a, "en", "s"), (1, b, "en", "s"), (2, a, "en", "s"), (3, near, "en", "s"), (4, c, "en", "s"), (4, c, "en", "s"),
            (5, "", "en", "s"), (6, None, "en", "s"), (None, a, "en", "s"), (7, a, "en", "t"), (7, b, "en", "t")]
    kept = sorted(((r.doc_id, r.text) for r in minhash.keep_one(docs(spark, rows)).collect()), key=repr)
    assert kept == sorted([(1, a), (1, b), (4, c), (5, ""), (6, None), (None, a)], key=repr)
    found = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs(spark, rows), shingle=5).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 6), (None, None), (7, 1)}


def test_quality_reads_one_text_of_an_id(spark):
    rng = random.Random(3)
    rows = [(i % 30, prose(rng) + f" tail {i % 2}", "en", "s") for i in range(90)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    one, two = (quality.train(docs(spark, r).repartition(n), labels) for r, n in ((rows, 2), (rows[::-1], 5)))
    assert (one.weights == two.weights).all() and (one.thresholds == two.thresholds).all()


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "MinHash near-dedup",
                                                      "mixing sources to target weights", "packing"]


def test_quality_driver_gets_the_model_alone(spark, monkeypatch):
    rows = [(i, f"a good and calm text {i}" if i % 2 else f"bad noise zzz {i}", "en", "s") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    whole = quality.train(docs(spark, rows), labels)

    def here(*_):
        raise AssertionError("the sample came to the driver")

    monkeypatch.setattr(quality, "fit", here)
    got = quality.train(docs(spark, rows), labels)
    assert (got.weights == whole.weights).all() and (got.thresholds == whole.thresholds).all()
    assert quality.train(docs(spark, rows), labels.limit(0)) is None


def test_quality_fit_holds_little_beside_its_cells():
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(0)
    rows = [(np.arange(s, s + 500, dtype="<i4"), rng.random(500).astype("<f4")) for s in rng.integers(0, 500, 2000)]
    tracemalloc.start()
    quality.fit(rows, rng.integers(0, 3, 2000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * 8 * 2000 * 500  # an int32 column and a float32 value a cell


def test_minhash_frees_driver_state_between_steps(spark, monkeypatch):
    freed = []
    collect = minhash.free_shuffles
    monkeypatch.setattr(minhash, "free_shuffles", lambda s: (freed.append(1), collect(s)))
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[:40 - i % 2] + [f"x{i // 4}"] * (i % 4 == 3)), "en", "s") for i in range(12)]
    found = minhash.near_duplicates(docs(spark, rows), 2, 0.8).collect()
    assert len(found) == 12 and {r.component_id for r in found} == {0}
    assert len(freed) >= 2 * minhash.STAR_ROUNDS + 4
