"""N1, N2, N3, N5 on shredded records: one row per value, none per record.

A shredded record is a set of rows (record, path, at, value): the dotted path
of a value, and for every component of the path the index of the array element
there (-1 where there is no array). Records of any size are handled by rows:
path values are filtered and numbered by running counts, alternatives are
settled by an aggregate per place, templates are joins on the record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions.nested import parse_template, unescape_template
from colloquy.functions.text import strip
from colloquy.operators.running import lay_out, running
from colloquy.operators.skew import lookup_join

NO_ARRAY = -1


def shred(df: DataFrame, record: str) -> DataFrame:
    """Nested rows (``record`` and any structs, arrays, scalars) as shredded
    rows; nulls have none."""
    def leaves(value: Column, kind: T.DataType, path: str, at: Column) -> Column:
        if isinstance(kind, T.ArrayType):
            size = F.size(at)
            inner = F.transform(value, lambda x, i: leaves(x, kind.elementType, path, F.concat(
                F.slice(at, 1, F.greatest(size - 1, F.lit(0))), F.array(i.cast("long")))))
            return F.coalesce(F.flatten(inner), F.array().cast(_LEAVES))
        if isinstance(kind, T.StructType):
            parts = [leaves(value.getField(f.name), f.dataType, f"{path}.{f.name}" if path else f.name, F.concat(at, F.array(F.lit(NO_ARRAY).cast("long"))))
                     for f in kind.fields]
            return F.concat(*parts)
        one = F.array(F.struct(F.lit(path).alias("path"), at.alias("at"), value.cast("string").alias("value")).cast(_LEAF))
        return F.when(value.isNotNull(), one).otherwise(F.array().cast(_LEAVES))

    fields = T.StructType([f for f in df.schema.fields if f.name != record])
    row = F.struct(*[F.col(f"`{f.name}`") for f in fields.fields])
    return df.select(record, F.inline(leaves(row, fields, "", F.array().cast("array<long>"))))


_LEAF = "struct<path:string,at:array<bigint>,value:string>"
_LEAVES = f"array<{_LEAF}>"


def path_rows(rows: DataFrame, path: str, record: str = "record", with_n: bool = False) -> DataFrame:
    """(record, idx, value) for the values at ``path``, in the order of
    their places, and their number n if asked for. Of a component ``a or b`` the first
    alternative that has a value, at each place of its own, counts."""
    now, prefixes = rows.select(record, "path", "at", "value"), [""]
    for level, component in enumerate(path.split(".")):
        names = [a.strip() for a in component.split(" or ")]
        rank = F.lit(None).cast("int")
        for i, name in reversed(list(enumerate(names))):
            for prefix in prefixes:
                full = prefix + name
                rank = F.when((F.col("path") == full) | F.col("path").startswith(full + "."), F.lit(i)).otherwise(rank)
        now = now.withColumn("_rank", rank).where("_rank is not null")
        if len(names) > 1:
            now = now.withColumn("_place", F.slice("at", 1, level))
            best = now.groupBy(record, "_place").agg(F.min("_rank").alias("_best"), F.count(F.lit(1)).alias("_n"))
            now = lookup_join(now, best, [record, "_place"], "_n", F.col("at")).where("_rank = _best").drop("_place", "_best")
        now = now.drop("_rank")
        prefixes = [f"{p}{n}." for p in prefixes for n in names]
    found = now.where(F.col("path").isin([p[:-1] for p in prefixes])).select(record, "at", "value", F.lit(1).cast("long").alias("_one"))
    laid = lay_out(found, record, ["at"])
    placed = running(laid, record, ["at"], sums={"_one": "idx"})
    if not with_n:
        return placed.select(record, "idx", "value")
    counts = laid.groupBy(record).agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("_n"))
    return lookup_join(placed, counts, [record], "_n", F.col("at")).select(record, "idx", "value", "n")


def template_rows(rows: DataFrame, fmt: str, record: str = "record", unescape: bool = True) -> DataFrame:
    """(record, idx, expansion), every combination of the placeholders'
    values, the first placeholder outermost. A record without a value for a
    placeholder has none. A template without placeholders is not tied to a
    record and raises."""
    literals, paths = parse_template(unescape_template(fmt) if unescape else fmt)
    if not paths:
        raise ValueError("a template needs a placeholder")
    out = None
    for k, path in enumerate(paths):
        own = path_rows(rows, path, record, with_n=k > 0)
        if out is None:
            out = own.select(record, "idx", F.concat(F.lit(literals[0]), "value", F.lit(literals[1])).alias("expansion"))
            continue
        slot = own.select(F.col(record).alias("_r"), F.col("idx").alias("_i"), "n", "value")
        out = (out.join(slot, out[record].eqNullSafe(slot["_r"]))
               .select(record, (F.col("idx") * F.col("n") + F.col("_i")).alias("idx"),
                       F.concat("expansion", "value", F.lit(literals[k + 1])).alias("expansion")))
    return out


def questions(rows: DataFrame, fmt: str, record: str = "record") -> DataFrame:
    """(record, question), the first expansion; records without one have no row."""
    return template_rows(rows, fmt, record).where("idx = 0").select(record, strip(F.col("expansion")).alias("question"))


def answer_rows(rows: DataFrame, question_format: str, answer_format: str, record: str = "record") -> DataFrame:
    """N3 + N5: (record, question, kind, idx, answer, label) straight from the
    shredded records, a row per answer; what ``explode_mcq`` of ``to_mcq`` gives."""
    answers = template_rows(rows, answer_format, record).select(record, "idx", strip(F.col("expansion")).alias("answer"))
    asked = questions(rows, question_format, record)
    counts = answers.groupBy(record).agg(F.count(F.lit(1)).alias("_n"))
    asked = asked.join(counts, asked[record].eqNullSafe(counts[record])).select(asked[record], "question", "_n")
    return (lookup_join(answers, asked, [record], "_n", F.col("idx")).where("question is not null")
            .select(record, "question", F.lit("multiple_correct").alias("kind"), "idx", "answer", F.lit(1).cast("long").alias("label")))
