"""Registered benchmark-import queries: N1-N5, P6, S7-S10.

Nested source records are derived from ``conversations``: ``origin``
(id, heading = first system text, label, opening.body = first user text),
``ask.body`` = last user text, ``replies`` = assistant texts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.operators import mcq, shred
from colloquy.plans.chat_queries import conversations, nested
from colloquy.plans.registry import register
from colloquy.plans.sqlbits import NL, strip
from colloquy.session import scratch_path
from colloquy.sources import mcq as msrc
from colloquy.sources.byte_files import WINDOW, read_windows, write_streams

QUESTION_FORMAT = "About {origin.heading or label}: {origin.opening.body}\\n\\nAsked: {ask.body}"
ANSWER_FORMAT = "{replies.body}"
PAIR_FORMAT = "{ask.body} => {replies.body}"


def records(spark, d):
    n = nested(spark, d)
    msgs = F.col("messages")

    def pick(role, i):
        return F.try_element_at(F.filter(msgs, lambda m: m["role"] == role), F.lit(i))["content"]

    doc = F.struct(F.col("conv_id").cast("string").alias("id"), pick("system", 1).alias("heading"),
                   F.concat(F.lit("conversation "), F.col("conv_id").cast("string")).alias("label"),
                   F.struct(pick("user", 1).alias("body")).alias("opening"))
    answers = F.transform(F.filter(msgs, lambda m: m["role"] == "assistant"),
                          lambda m: F.struct(m["content"].alias("body")))
    return n.select("conv_id", doc.alias("origin"), F.struct(pick("user", -1).alias("body")).alias("ask"),
                    answers.alias("replies"))


def shredded(spark, d):
    """The same records as one row per value, without gathering a conversation."""
    c = conversations(spark, d)
    pick = lambda by, role: by(F.col("text"), F.when(F.col("role") == role, F.col("turn")))
    one = c.groupBy("conv_id").agg(pick(F.min_by, "system").alias("title"), pick(F.min_by, "user").alias("first"), pick(F.max_by, "user").alias("last"))
    none = F.lit(shred.NO_ARRAY).cast("long")
    leaf = lambda path, value: F.struct(F.lit(path).alias("path"), F.array(*[none] * (path.count(".") + 1)).alias("at"),
                                        value.alias("value"))
    fields = F.array(leaf("origin.id", F.col("conv_id").cast("string")), leaf("origin.heading", F.col("title")),
                     leaf("origin.label", F.concat(F.lit("conversation "), F.col("conv_id").cast("string"))),
                     leaf("origin.opening.body", F.col("first")), leaf("ask.body", F.col("last")))
    answers = c.where("role = 'assistant'").select("conv_id", F.lit("replies.body").alias("path"), F.array("turn", none).alias("at"),
                                                   F.col("text").alias("value"))
    return one.select("conv_id", F.inline(fields)).where("value is not null").unionByName(answers.where("value is not null"))


def imported(spark, d):
    return mcq.to_mcq(records(spark, d), QUESTION_FORMAT, ANSWER_FORMAT, keep=["conv_id"])


def flat(df, keep=("conv_id",)):
    return df.select(*keep, "question",
                     F.array_join("multiple_correct.answers", " || ").alias("answers"),
                     F.array_join(F.transform("multiple_correct.labels", lambda x: x.cast("string")), ",")
                     .alias("labels"),
                     F.size("single_correct.answers").cast("long").alias("n_single"))


RECORDS_CTE = """
rec AS (
  SELECT conv_id,
         arg_min(text, turn) FILTER (WHERE role = 'system') AS title,
         'conversation ' || CAST(conv_id AS VARCHAR) AS start,
         arg_min(text, turn) FILTER (WHERE role = 'user') AS summary,
         arg_max(text, turn) FILTER (WHERE role = 'user') AS q,
         list(text ORDER BY turn) FILTER (WHERE role = 'assistant') AS answers
  FROM conversations GROUP BY conv_id
)"""

IMPORT_SELECT = f"""
SELECT {{keep}} {strip(f"'About ' || coalesce(title, start) || ': ' || summary || {NL} || {NL} || 'Asked: ' || q")} AS question,
  coalesce(array_to_string(list_transform(answers, lambda a: {strip('a')}), ' || '), '') AS answers,
  coalesce(array_to_string(list_transform(answers, lambda a: '1'), ','), '') AS labels,
  0::BIGINT AS n_single
FROM rec WHERE coalesce(title, start) IS NOT NULL AND summary IS NOT NULL AND q IS NOT NULL"""


@register("mcq_import", f"WITH {RECORDS_CTE} {IMPORT_SELECT.format(keep='conv_id,')}")
def q_mcq_import(spark, d):
    return flat(imported(spark, d))


@register("mcq_explode", f"""WITH {RECORDS_CTE},
u AS (SELECT conv_id, unnest(answers) AS a, generate_subscripts(answers, 1) AS i FROM rec)
SELECT conv_id, 'multiple_correct' AS kind, (i - 1)::BIGINT AS idx, {strip('a')} AS answer, 1::BIGINT AS label
FROM u""")
def q_mcq_explode(spark, d):
    e = shred.answer_rows(shredded(spark, d), QUESTION_FORMAT, ANSWER_FORMAT, "conv_id")
    return e.select("conv_id", "kind", "idx", "answer", "label")


@register("mcq_validate", f"""WITH {RECORDS_CTE}
SELECT count(*) AS n_records, count(*) FILTER (NOT (conv_id % 5 = 0 AND len(answers) > 0)) AS n_valid,
       count(*) FILTER (conv_id % 5 = 0 AND len(answers) > 0) AS n_rejected FROM rec
WHERE coalesce(title, start) IS NOT NULL AND summary IS NOT NULL AND q IS NOT NULL""")
def q_mcq_validate(spark, d):
    """N4 on records of which some lack their last label."""
    labels = F.col("multiple_correct.labels")
    short = F.when(F.col("conv_id") % 5 == 0, F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0)))).otherwise(labels)
    v = mcq.validate_mcq(imported(spark, d).withColumn("multiple_correct", F.col("multiple_correct").withField("labels", short)))
    return v.agg(F.count(F.lit(1)).alias("n_records"), F.count_if("valid").alias("n_valid"),
                 F.count_if(~F.col("valid")).alias("n_rejected"))


@register("path_values", f"""WITH {RECORDS_CTE},
u AS (SELECT conv_id, unnest(answers) AS a, generate_subscripts(answers, 1) AS i FROM rec)
SELECT conv_id, (i - 1)::BIGINT AS idx, a AS value FROM u""")
def q_path_values(spark, d):
    return shred.path_rows(shredded(spark, d), "replies.body", "conv_id").select("conv_id", "idx", "value")


@register("path_alternatives", f"""WITH {RECORDS_CTE}
SELECT conv_id, 0::BIGINT AS idx, coalesce(title, start) AS value FROM rec""")
def q_path_alternatives(spark, d):
    return shred.path_rows(shredded(spark, d), "origin.heading or label", "conv_id").select("conv_id", "idx", "value")


@register("template_expand", f"""WITH {RECORDS_CTE},
u AS (SELECT conv_id, q, unnest(answers) AS a, generate_subscripts(answers, 1) AS i FROM rec)
SELECT conv_id, (i - 1)::BIGINT AS idx, q || ' => ' || a AS expansion FROM u WHERE q IS NOT NULL""")
def q_template_expand(spark, d):
    return shred.template_rows(shredded(spark, d), PAIR_FORMAT, "conv_id")


@register("shred_records", f"""WITH {RECORDS_CTE},
v AS (SELECT conv_id, 'origin.id' AS path, CAST(conv_id AS VARCHAR) AS value, 0 AS i FROM rec
      UNION ALL SELECT conv_id, 'origin.heading', title, 0 FROM rec UNION ALL SELECT conv_id, 'origin.label', start, 0 FROM rec
      UNION ALL SELECT conv_id, 'origin.opening.body', summary, 0 FROM rec UNION ALL SELECT conv_id, 'ask.body', q, 0 FROM rec
      UNION ALL SELECT conv_id, 'replies.body', unnest(answers), unnest(range(len(answers))) FROM rec)
SELECT conv_id, path, i::BIGINT AS idx, value FROM v WHERE value IS NOT NULL""")
def q_shred_records(spark, d):
    """Nested records to shredded rows by their schema."""
    rows = shred.shred(records(spark, d), "conv_id")
    return rows.select("conv_id", "path", F.greatest(F.array_max("at"), F.lit(0).cast("long")).alias("idx"), "value")


@register("mcq_bin_roundtrip", f"WITH {RECORDS_CTE} {IMPORT_SELECT.format(keep='')}")
def q_mcq_bin_roundtrip(spark, d):
    """S8 write, files closed after 64 records, S7 read (conv_id is not part of the format)."""
    path = scratch_path(spark, "mcq-bin")
    msrc.write_mcq_bin(imported(spark, d), path, shard_records=64)
    return flat(msrc.read_mcq_bin(spark, path), keep=())


@register("mcq_bin_files", f"WITH {RECORDS_CTE} {IMPORT_SELECT.format(keep='')}")
def q_mcq_bin_files(spark, d):
    """S8 with one file per set (conversation mod 8), S7 read of the folder of all sets."""
    path = scratch_path(spark, "mcq-bin")
    part = F.col("conv_id") % 8
    sets = imported(spark, d).repartition(part).sortWithinPartitions(part)
    msrc.write_mcq_bin_sets(sets.withColumn("part", part.cast("string")), "part", path)
    return flat(msrc.read_mcq_bin(spark, path), keep=())


@register("mcq_bin_windows", f"WITH {RECORDS_CTE} {IMPORT_SELECT.format(keep='')}")
def q_mcq_bin_windows(spark, d):
    """S7 with windows smaller than most records: records are put together from several."""
    path = scratch_path(spark, "mcq-bin")
    msrc.write_mcq_bin(imported(spark, d), path, shard_records=64)
    return flat(msrc.read_mcq_bin(spark, path, window=512), keep=())


@register("mcq_bin_rejects", f"""WITH {RECORDS_CTE},
ok AS (SELECT conv_id % 16 AS part, count(*) AS n FROM rec
       WHERE coalesce(title, start) IS NOT NULL AND summary IS NOT NULL AND q IS NOT NULL GROUP BY 1)
SELECT part, CASE part % 4 WHEN 1 THEN 'truncated' WHEN 2 THEN 'header' END AS reason,
       CASE WHEN part % 4 IN (1, 2) THEN 0 ELSE n END AS n_read,
       CASE part % 4 WHEN 1 THEN n - 1 END AS first_bad FROM ok""")
def q_mcq_bin_rejects(spark, d):
    """One set of records per part (conv_id mod 16), some sets cut: in the last
    record, or inside the offset table. S7 returns whole sets and the rejects."""
    whole, path = scratch_path(spark, "mcq-whole"), scratch_path(spark, "mcq-cut")
    part = F.col("conv_id") % 16
    sets = imported(spark, d).repartition(part).sortWithinPartitions(part)
    msrc.write_mcq_bin_sets(sets.withColumn("part", part.cast("string")), "part", whole)
    windows = read_windows(spark, whole).withColumn("stream", F.regexp_extract("file", "stream=([0-9]+)", 1))
    kind = F.col("stream").cast("int") % 4
    left = F.when(kind == 1, F.col("size") - 5).when(kind == 2, F.lit(7)).otherwise(F.col("size")) - F.col("w") * WINDOW
    cut = windows.where(left > 0).select("stream", "w", F.substring("data", F.lit(1), F.least(left, F.octet_length("data")).cast("int")).alias("data"))
    write_streams(cut.repartition("stream").sortWithinPartitions("stream", "w"), path)
    records, rejects = msrc.scan_mcq_bin(spark, path)
    of = F.regexp_extract("file", "stream=([0-9]+)", 1).cast("long").alias("part")
    none = F.lit(None)
    got = records.groupBy(of).agg(none.cast("string").alias("reason"), F.count(F.lit(1)).alias("n_read"), none.cast("long").alias("first_bad"))
    return got.unionAll(rejects.select(of, "reason", F.lit(0).cast("long").alias("n_read"), "first_bad"))


@register("mcq_json_roundtrip", f"WITH {RECORDS_CTE} {IMPORT_SELECT.format(keep='')}")
def q_mcq_json_roundtrip(spark, d):
    path = scratch_path(spark, "mcq-json")
    msrc.write_mcq_json(imported(spark, d), path)
    return flat(msrc.read_mcq_json(spark, path), keep=())
