"""Places where an operator once did less than the whole job."""

import base64
import math
import random
import zlib

import pytest

from colloquy.llm import common, langid, suffix_tree

DOCS = "doc_id long, text string, lang string, source string"


# ------------------------------------------------------------------ 7
def test_rare_contexts_stay_in_a_large_corpus(spark):
    """A context seen 6 times keeps its edges beside 800,000 other tokens."""
    ids = {h: [i for i in range(200) if (zlib.crc32(str(i).encode()) % 7 == 2) == h] for h in (False, True)}
    rows = [(i, "p q", "en", "s") for i in ids[False][:6]] + [(ids[False][6], "f " * 800_000, "en", "s"), (ids[True][0], "p q", "en", "s")]
    got = {r.doc_id: r for r in suffix_tree.op7_query(spark.createDataFrame(rows, DOCS)).collect()}[ids[True][0]]
    total = 6 * 3 + 800_001
    assert got.train_tokens == total and got.held_out
    assert got.score == pytest.approx(math.log10((6 - 0.5) / total) + 2 * math.log10((6 - suffix_tree.DISCOUNT) / 6), rel=1e-9)


def test_tree_keeps_little_beside_the_tokens(spark, monkeypatch):
    """Tables written on the way stay small beside the text, as many levels as there are."""
    written = []

    def stored(df, name):
        table = common.stored(df, name)
        files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._scratch)
        written.append(files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(files).getLength())
        return table

    monkeypatch.setattr(suffix_tree, "stored", stored)
    rng = random.Random(3)
    chain = {w: [rng.randrange(400) for _ in range(12)] for w in range(400)}
    rows, size = [], 0
    for i in range(300):
        w, text = rng.randrange(400), []
        for _ in range(400):
            w = chain[w][min(int(rng.expovariate(0.5)), 11)]
            text.append(f"w{w}")
        rows.append((i, " ".join(text), "en", "s"))
        size += len(rows[-1][1])
    assert suffix_tree.op7_query(spark.createDataFrame(rows, DOCS)).count() == 300
    assert sum(written) < 2 * size


# ------------------------------------------------------------------ 4, pipeline
def test_noise_and_unlearned_languages_go(spark):
    rng = random.Random(1)
    prose = {"en": "the cat and dog went with them to that old house where nobody had been for years".split(),
             "de": "der hund und die katze gingen mit ihnen zu dem alten haus wo seit jahren niemand war".split(),
             "es": "el gato y perro fueron con ellos a la casa vieja donde nadie estuvo desde hace muchos meses".split()}
    clean = [(i, " ".join(rng.choices(prose[k], k=30)), k, "s") for i, k in enumerate(["en", "de", "es"] * 100)]
    letters = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(60)) for _ in range(5)]
    noise = letters + [base64.b64encode(rng.randbytes(300)).decode() for _ in range(5)] + [
        "Все люди рождаются свободными и равными в своем достоинстве и правах " * 3,
        "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swojej godności i swych praw", "12 !!", "", None]
    odd = [(1000 + i, t, None, "s") for i, t in enumerate(noise)]
    kept = langid.keep_known(spark.createDataFrame(clean + odd, DOCS))
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in clean]
    assert langid.keep_known(spark.createDataFrame([(1, "abc", None, "s"), (2, "12", None, "s")], DOCS)).count() == 0
