"""Benchmark-dataset import: N1-N5, P6.

Records are nested rows; question and answer templates are compiled
against the record schema into Column expressions (see functions/nested).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.nested import expand_template, path_values, unescape_template
from colloquy.functions.text import strip
from colloquy.schemas import ANSWERS


def empty_answers():
    return F.struct(F.array().cast("array<string>").alias("answers"),
                    F.array().cast("array<int>").alias("labels")).cast(ANSWERS)


def to_mcq(records: DataFrame, question_format: str, answer_format: str, keep: list[str] | None = None,
           multiple_choice: bool = True, unescape: bool = True) -> DataFrame:
    """N3 (+P6): question = first expansion, stripped; answers = all
    expansions, stripped, every label 1; ``single_correct`` empty.

    Records whose question template yields nothing are skipped.
    """
    if not multiple_choice:
        raise NotImplementedError("only the multiple-correct mode exists")
    qf = unescape_template(question_format) if unescape else question_format
    af = unescape_template(answer_format) if unescape else answer_format
    schema = records.schema
    q = F.try_element_at(expand_template(schema, qf), F.lit(1))
    answers = F.transform(expand_template(schema, af), strip)
    out = records.select(*(keep or []), strip(q).alias("question"), answers.alias("_a"))
    out = drop_missing_questions(out)
    return out.select(*(keep or []), "question", empty_answers().alias("single_correct"),
                      F.struct(F.col("_a").alias("answers"),
                               F.array_repeat(F.lit(1), F.size("_a")).alias("labels")).cast(ANSWERS)
                      .alias("multiple_correct"))


def drop_missing_questions(df: DataFrame, question: str = "question") -> DataFrame:
    """Skip records without a question."""
    return df.where(F.col(question).isNotNull())


def validate_mcq(df: DataFrame) -> DataFrame:
    """``valid`` = every answer block has as many labels as answers."""
    def ok(block):
        return F.coalesce(F.size(F.col(f"{block}.answers")) == F.size(F.col(f"{block}.labels")), F.lit(True))
    return df.withColumn("valid", ok("single_correct") & ok("multiple_correct") & F.col("question").isNotNull())


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects)."""
    v = validate_mcq(df)
    return v.where("valid").drop("valid"), v.where("NOT valid").drop("valid")


def explode_mcq(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per (record, kind, index) with answer and label.

    Answers and labels are paired by position (J6: ``arrays_zip`` +
    ``posexplode``, never ``zipWithIndex``).
    """
    keep = keep or []
    blocks = F.array(
        F.struct(F.lit("single_correct").alias("kind"),
                 F.arrays_zip(F.col("single_correct.answers").alias("answer"),
                              F.col("single_correct.labels").alias("label")).alias("items")),
        F.struct(F.lit("multiple_correct").alias("kind"),
                 F.arrays_zip(F.col("multiple_correct.answers").alias("answer"),
                              F.col("multiple_correct.labels").alias("label")).alias("items")))
    b = df.select(*keep, "question", F.explode(blocks).alias("b"))
    e = b.select(*keep, "question", F.col("b.kind").alias("kind"), F.posexplode("b.items").alias("idx", "it"))
    return e.select(*keep, "question", "kind", F.col("idx").cast("long").alias("idx"),
                    F.col("it.answer").alias("answer"), F.col("it.label").cast("long").alias("label"))


def path_table(df: DataFrame, path: str, keep: list[str] | None = None, name: str = "value") -> DataFrame:
    """N1 as a table: (keep..., idx, value) for every value at ``path``."""
    vals = path_values(df.schema, path)
    return (df.select(*(keep or []), F.posexplode(vals).alias("idx", name))
            .withColumn("idx", F.col("idx").cast("long")))


def template_table(df: DataFrame, fmt: str, keep: list[str] | None = None, name: str = "expansion") -> DataFrame:
    """N2 as a table: (keep..., idx, expansion)."""
    vals = expand_template(df.schema, unescape_template(fmt))
    return (df.select(*(keep or []), F.posexplode(vals).alias("idx", name))
            .withColumn("idx", F.col("idx").cast("long")))
