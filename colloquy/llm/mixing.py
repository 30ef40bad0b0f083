"""Mixing sources to target weights (operator 1), DataFrame functions only.

Every document gets a hash-random key; the rows are range-sorted by key
within their source; distributed prefix sums of sizes place each document
on its source's line of words; the line is cut at the source's exact budget.
A budget above the source's size first takes whole epochs.

Defined results: a null or empty text has size 0 and takes 0; null sources
form one source, ranked last; a null doc_id is an ordinary value; rows equal
in doc_id, source and size are one run on the line and share what it takes
(whole words, rounded down); an empty table gives an empty mix. Other
columns are ignored, so clashing names cannot arise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import WORD_PATTERN, cut, n_words, prefix_sums

WEIGHTS = (5, 2, 1)
BUDGET_RATIO = 1.5
MAX_EPOCHS = 2
SEED = "mix"


def source_targets(sizes: DataFrame, weights=WEIGHTS, ratio: float = BUDGET_RATIO,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target: shares of ``ratio`` times all words.

    ``weights`` repeat over the sources by code point, null last. A target
    stops at ``max_epochs`` times its source's size and the excess is shared
    again by weight. With the sources sorted by cap / weight, the level of
    that fill is the largest of (budget - caps before) / (weights from here
    on): the fill is concave in the level and each term bounds it. One row
    per source passes the two windows (the dimension of the mixture).
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    ranked = per.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.col("_rank"), F.lit(len(weights))) + 1).cast("int"))
    caps = ranked.withColumn("_w", w).withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
    by_fill = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    everything = Window.partitionBy()
    filled = (caps
              .withColumn("_before", F.coalesce(F.sum("_cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)),
                                                F.lit(0.0)))
              .withColumn("_rest", F.sum("_w").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("_budget", F.sum("source_size").over(everything) * F.lit(float(ratio)))
              .withColumn("_level", F.max((F.col("_budget") - F.col("_before")) / F.col("_rest")).over(everything)))
    return filled.select("source", "source_size", F.least("_cap", F.col("_w") * F.col("_level")).alias("target"))


def _group_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def mix(df: DataFrame, weights=WEIGHTS, ratio: float = BUDGET_RATIO, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """One row per distinct (doc_id, source, size) with copies, source_size,
    target and taken (words per row, over all epochs)."""
    narrow = df.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    rows = cut(narrow.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")))
    targets = source_targets(rows, weights, ratio, max_epochs).withColumn("_g", _group_key(F.col("source")))
    keyed = (rows.withColumn("_g", _group_key(F.col("source")))
             .withColumn("_key", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
             .withColumn("_run", F.col("size") * F.col("copies")))
    placed = prefix_sums(keyed, "_g", [F.col("_key"), F.col("doc_id"), F.col("size")], {"_run": "_start"})
    joined = placed.join(targets.drop("source"), "_g")
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    part = F.greatest(F.lit(0).cast("long"),
                      F.least(F.col("_run"), budget - epochs * F.col("source_size") - F.col("_start")))
    taken = epochs * F.col("size") + F.floor(part / F.col("copies")).cast("long")
    return joined.select("doc_id", "source", "size", "copies", "source_size", "target",
                         epochs.alias("epochs"), taken.alias("taken"))


def mix_rows(mixed: DataFrame) -> DataFrame:
    """One row per input document."""
    return (mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .drop("_copy", "copies"))


def apply_mix(df: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mixed documents: each one repeated for its whole epochs, then, for
    a document at the cut, its first words once more. Same columns as ``df``;
    ``n_chars``, where there is one, follows a cut text."""
    row = df.select(F.struct(*df.columns).alias("_row"), n_words(F.col("text")).alias("_size"))  # a struct: no name can clash
    right = mixed.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"),
                         F.col("taken").alias("_taken")).where("_taken > 0")
    joined = row.join(right, F.col("_row.doc_id").eqNullSafe(F.col("_d")) & F.col("_row.source").eqNullSafe(F.col("_s"))
                      & (F.col("_size") == F.col("_z")))
    whole = F.floor(F.col("_taken") / F.col("_size")).cast("int")
    rest = (F.col("_taken") - whole * F.col("_size")).cast("int")
    lengths = F.concat(F.array_repeat(F.lit(-1), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    copies = joined.select("_row", F.explode(lengths).alias("_take"))
    pieces = F.regexp_extract_all(F.col("_row.text"), F.lit(r"[\x20\x09-\x0D]*" + WORD_PATTERN), F.lit(0))
    text = F.when(F.col("_take") < 0, F.col("_row.text")).otherwise(F.array_join(F.slice(pieces, 1, F.greatest(F.col("_take"), F.lit(1))), ""))
    cut_row = copies.select("_row", "_take", text.alias("_text"))
    own = {"text": F.col("_text")}
    if "n_chars" in df.columns:
        own["n_chars"] = F.when(F.col("_take") < 0, F.col("_row.n_chars")).otherwise(F.length("_text").cast("long"))
    return cut_row.select(*[own.get(c, F.col("_row").getField(c)).alias(c) for c in df.columns])


OP1_SQL = r"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
per AS (
  SELECT source, sum(size)::DOUBLE AS total FROM s GROUP BY source),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS r, total * 2 AS cap
  FROM per),
filled AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         sum(total) OVER () * 1.5 AS budget
  FROM ranked),
targets AS (
  SELECT source, total, least(cap, w * max((budget - before) / rest) OVER ()) AS target FROM filled),
line AS (
  SELECT s.*, t.total, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, '')), doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, total::BIGINT AS source_size, target,
       (CASE WHEN total > 0 THEN floor(budget / total)::BIGINT ELSE 0 END * size
        + greatest(0, least(size, budget - CASE WHEN total > 0 THEN floor(budget / total)::BIGINT * total::BIGINT ELSE 0 END - start)))::BIGINT AS taken
FROM line
"""


def op1_query(docs: DataFrame) -> DataFrame:
    return mix_rows(mix(docs)).select("doc_id", "size", "source_size", "target", "taken")
