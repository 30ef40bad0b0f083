"""X6-X11, X15, S4 against the golden rows of FIXTURES.md."""

from colloquy.functions import text as tx
from colloquy.sources.parts import expand_parts, expand_parts_py


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"c {dtype}")
    return df.select(expr).collect()[0][0]


def test_parse_score(spark):
    from pyspark.sql import functions as F
    cases = [("38.00000000%\t[33.3787%, 42.8495%]", 38.0), ("53.6701 +/- 1.4015", 53.6701), ("78.5%", 78.5),
             ("x (9 tasks): 53.9858 +/- 1.4", 53.9858), (None, -1.0), ("garbage", None), ("", None)]
    df = spark.createDataFrame(cases, "c string, want double")
    for r in df.select(tx.parse_score(F.col("c")).alias("got"), "want").collect():
        assert r["got"] == r["want"]


def test_margin_and_interval(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("38.00000000%\t[33.3787%, 42.8495%]",), ("53.6701 +/- 1.4015",), ("78.5%",)], "c string")
    lo, hi = tx.parse_interval(F.col("c"))
    got = [tuple(r) for r in df.select(tx.parse_margin(F.col("c")), lo, hi).collect()]
    assert got == [(None, 33.3787, 42.8495), (1.4015, None, None), (None, None, None)]


def test_marker_split(spark):
    from pyspark.sql import functions as F
    c = F.col("c")
    assert one(spark, tx.marker_split(c, "/", "."), "/models/my-model-q8_0.gguf") == "my-model-q8_0"
    log = "head\n400\t38.0%\t[1%, 2%]\nrest"
    assert one(spark, tx.marker_split(c, "\n400\t", first_line_only=True), log) == "38.0%\t[1%, 2%]"
    wino = "x\nFinal Winogrande score(400 tasks): 53.9 +/- 1.4"
    assert one(spark, tx.marker_split(c, ["Final Winogrande score", "): "]), wino) == "53.9 +/- 1.4"
    assert one(spark, tx.marker_split(c, "): "), "no marker here") is None
    assert one(spark, tx.marker_split(c), "  kept as is ") == "  kept as is "


def test_model_name_and_artifact(spark):
    from pyspark.sql import functions as F
    c = F.col("c")
    assert one(spark, tx.model_name(c), "gguf/gm3-270m-code-bf16.gguf") == "gm3-270m-code-bf16"
    assert one(spark, tx.model_name(c), "a/b-00001-of-00003.gguf") == "b"
    assert one(spark, tx.model_name(c), "plain") == "plain"
    assert one(spark, tx.artifact_quantisation(c), "gm3-270m-math-q8_0") == "q8_0"
    assert one(spark, tx.artifact_quantisation(c), "model") == ""
    df = spark.createDataFrame([("gm3", "BF16")], "b string, q string")
    assert df.select(tx.artifact_name("b", "q")).collect()[0][0] == "gm3-bf16.gguf"


def test_preview_continuation(spark):
    from pyspark.sql import functions as F
    long = "x" * 250
    assert one(spark, tx.preview(F.col("c"), 200), long) == "x" * 200 + "..."
    assert one(spark, tx.preview(F.col("c"), 200), "short") == "short"
    assert one(spark, tx.preview(F.col("c"), 100, always=True), "short") == "short..."
    df = spark.createDataFrame([("PROMPT answer \n", "PROMPT")], "g string, p string")
    assert df.select(tx.continuation("g", "p")).collect()[0][0] == "answer"


def test_percent_rounding_and_null(spark):
    df = spark.createDataFrame([(1, 3), (1, 0)], "n long, t long")
    got = [r[0] for r in df.select(tx.percent("n", "t", 2)).collect()]
    assert got == [33.33, None]


def test_expand_parts(spark):
    cases = {"d/validation-00000-of-00003.parquet": ["d/validation-00000-of-00003.parquet",
                                                     "d/validation-00001-of-00003.parquet",
                                                     "d/validation-00002-of-00003.parquet"],
             "m-00001-of-00002.gguf": ["m-00001-of-00002.gguf", "m-00002-of-00002.gguf"],
             "plain.json": ["plain.json"],
             "x-00001-of-abcde.gguf": ["x-00001-of-abcde.gguf"],
             "z-00000-of-00000.bin": []}
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    got = {r[0]: r[1] for r in df.select("c", expand_parts("c")).collect()}
    for k, want in cases.items():
        assert got[k] == want, k
        assert expand_parts_py(k) == want, k


def test_strip_and_scores_follow_python(spark):
    from colloquy.functions.text import parse_score, strip

    texts = [" a ", "　b", "\x1cc\x1f", " d \n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strip("t")).collect()] == [t.strip() for t in texts]
    scores = spark.createDataFrame([("12.5f",), ("1e3d",), ("1e3",), ("12.5%",), (" .5 x",)], "t string")
    assert [r[0] for r in scores.select(parse_score("t")).collect()] == [None, None, 1000.0, 12.5, 0.5]


def test_path_alternatives_above_the_leaf(spark):
    from colloquy.functions.nested import path_values

    df = spark.createDataFrame([(("A",), None), (None, ("B",))], "a struct<t:string>, b struct<t:string>")
    assert [r[0] for r in df.select(path_values(df.schema, "a or b.t")).collect()] == [["A"], ["B"]]


def test_margins_are_numbers_as_scores_are(spark):
    """What only Java reads as a number (``1.4f``, ``2d``) is none."""
    texts = ["1 +/- 1.4f", "1 +/- 1.5", "3 +/- 1e2", "x [1d%, 2f%]", "x [1.5%, 2%]", "x [ 1 , .5 ]", "none", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    lo, hi = tx.parse_interval("t")
    got = {r.i: (r.m, r.lo, r.hi) for r in df.select("i", tx.parse_margin("t").alias("m"), lo.alias("lo"), hi.alias("hi")).collect()}
    none = (None, None, None)
    assert got == {0: none, 1: (1.5, None, None), 2: (100.0, None, None), 3: none, 4: (None, 1.5, 2.0), 5: (None, 1.0, 0.5), 6: none, 7: none}


def test_markers_of_both_sides(spark):
    df = spark.createDataFrame([("a/b/ c-d.e.f",), ("no",), (None,)], "t string")
    both = [r[0] for r in df.select(tx.marker_split("t", left=["/"], right=[".", "-"])).collect()]
    assert both == ["c", None, None]
    assert [r[0] for r in df.select(tx.marker_split("t", right="/")).collect()] == ["a", None, None]


def test_score_parse_plan_reads_its_input_once(spark):
    df = spark.createDataFrame([("x tasks): 12.5%",)], "t string").select(tx.parse_score("t").alias("s"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") <= 1 and df.first().s == 12.5
