"""Registered queries on ``conversations`` / ``documents``: P1-P4, X1-X7, W4,
A1-A8, T1-T3, S2, S3, N9, K7 and the flagship slice (SURVEY §7.2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions import templates as tpl
from colloquy.functions import text as tx
from colloquy.operators import chat, masks, profile, tokens
from colloquy.plans.registry import TABLES, register, table
from colloquy.plans.sqlbits import (GEMMA_CTE, INSTRUCTION, NL, RESPONSE, SFT_CTE, SFT_PROMPT,
                                    SFT_RENDER, strip)
from colloquy.session import scratch_path
from colloquy.sources.chat import nest_messages, read_chat, row_at, save_dataset, slice_split

ROLE_TAG_EOS = tpl.DEFAULT_EOS


def conversations(spark, d):
    return table(spark, d, "conversations")


def nested(spark, d):
    return nest_messages(conversations(spark, d))


def sft(spark, d):
    return chat.to_sft_columns_long(conversations(spark, d))


def sft_turns(spark, d):
    return chat.to_chat_turns(sft(spark, d))


def full_render(spark, d):
    return chat.render_gemma(nested(spark, d))


# --------------------------------------------------------------- P1-P4
@register("sft_columns", f"WITH {SFT_CTE} SELECT conv_id, input, output, system FROM sft")
def q_sft_columns(spark, d):
    return sft(spark, d).select("conv_id", "input", "output", "system")


def _explode_turns(df, col):
    return (df.select("conv_id", F.posexplode(col).alias("pos", "m"))
            .select("conv_id", F.col("pos").cast("long").alias("pos"),
                    F.col("m.role").alias("role"), F.col("m.content").alias("content")))


@register("chat_turns", f"""WITH {SFT_CTE}
SELECT conv_id, 0::BIGINT AS pos, 'system' AS role, system AS content FROM sft
UNION ALL SELECT conv_id, 1::BIGINT, 'user', input FROM sft
UNION ALL SELECT conv_id, 2::BIGINT, 'assistant', output FROM sft""")
def q_chat_turns(spark, d):
    return _explode_turns(sft_turns(spark, d), "conversations")


@register("prompt_turns", f"""WITH {SFT_CTE}
SELECT conv_id, 0::BIGINT AS pos, 'system' AS role, system AS content FROM sft
UNION ALL SELECT conv_id, 1::BIGINT, 'user', input FROM sft""")
def q_prompt_turns(spark, d):
    return _explode_turns(chat.prompt_turns(sft_turns(spark, d)), "conversations")


# --------------------------------------------------------------- X1-X3, W4
@register("render_gemma", f"WITH {GEMMA_CTE} SELECT conv_id, valid, text FROM gemma")
def q_render_gemma(spark, d):
    return full_render(spark, d).select("conv_id", "valid", "text")


@register("render_gemma_sft", f"WITH {SFT_CTE} SELECT conv_id, {SFT_RENDER} AS text FROM sft")
def q_render_gemma_sft(spark, d):
    return chat.render_gemma(sft_turns(spark, d), "conversations").select("conv_id", "text")


@register("render_role_tags", f"""
WITH t AS (
  SELECT conv_id, turn, role, text, turn = max(turn) OVER (PARTITION BY conv_id) AS is_last
  FROM conversations)
SELECT conv_id, string_agg(CASE role
    WHEN 'system' THEN '<|system|>' || {NL} || text || {NL}
    WHEN 'user' THEN '<|user|>' || {NL} || text || {NL}
    WHEN 'assistant' THEN '<|assistant|>' || {NL} || text || '{ROLE_TAG_EOS}' || CASE WHEN is_last THEN '' ELSE {NL} END
    ELSE '' END, '' ORDER BY turn) AS text
FROM t GROUP BY conv_id""")
def q_render_role_tags(spark, d):
    return chat.render_role_tags(nested(spark, d), eos=ROLE_TAG_EOS).select("conv_id", "text")


@register("generation_prompt", f"WITH {SFT_CTE} SELECT conv_id, {SFT_PROMPT} AS text FROM sft")
def q_generation_prompt(spark, d):
    df = chat.prompt_turns(sft_turns(spark, d))
    return chat.render_gemma(df, "conversations", add_generation_prompt=True).select("conv_id", "text")


@register("remove_bos", f"""WITH {SFT_CTE}
SELECT conv_id, CASE WHEN conv_id % 3 = 2 THEN '{tpl.GEMMA_BOS}' ELSE '' END || {SFT_RENDER} AS text FROM sft""")
def q_remove_bos(spark, d):
    """Texts of a renderer that emits <bos> for some conversations only
    (twice for others: one stays)."""
    df = chat.render_gemma(sft_turns(spark, d), "conversations")
    emitted = F.concat(F.repeat(F.lit(tpl.GEMMA_BOS), (F.col("conv_id") % 3).cast("int")), "text")
    return df.select("conv_id", tx.remove_prefix(emitted, tpl.GEMMA_BOS).alias("text"))


@register("turn_positions", """
SELECT conv_id, turn, turn = min(turn) OVER (PARTITION BY conv_id) AS is_first,
       turn = max(turn) OVER (PARTITION BY conv_id) AS is_last
FROM conversations""")
def q_turn_positions(spark, d):
    return chat.turn_positions(conversations(spark, d)).select("conv_id", "turn", "is_first", "is_last")


# --------------------------------------------------------------- X4, X5, K7
_SPANS_SQL = f"""WITH {GEMMA_CTE},
sp AS (SELECT conv_id, string_split(text, {RESPONSE}) AS parts FROM gemma WHERE valid)
SELECT conv_id, (i - 1)::BIGINT AS span_idx, string_split(parts[i + 1], {INSTRUCTION})[1] AS span
FROM sp, range(1, len(parts)) AS r(i)"""


@register("span_starts", f"""WITH {GEMMA_CTE},
sp AS (SELECT conv_id, string_split(text, {RESPONSE}) AS parts FROM gemma WHERE valid)
SELECT conv_id, (i - 1)::BIGINT AS span_idx,
       list_sum(list_transform(parts[:i], lambda p: length(p) + length({RESPONSE})))::BIGINT AS start,
       length(string_split(parts[i + 1], {INSTRUCTION})[1])::BIGINT AS n_chars
FROM sp, range(1, len(parts)) AS r(i)""")
def q_span_starts(spark, d):
    """X4 as places: where the trained spans lie in each rendered text."""
    spans = masks.span_table(masks.rendered_pieces(conversations(spark, d)))
    return spans.select("conv_id", "span_idx", "start", F.length("span").cast("long").alias("n_chars"))


@register("response_spans", _SPANS_SQL)
def q_response_spans(spark, d):
    return masks.span_table(masks.rendered_pieces(conversations(spark, d))).select("conv_id", "span_idx", "span")


@register("masked_text", f"""WITH {GEMMA_CTE},
sp AS (SELECT conv_id, string_split(text, {RESPONSE}) AS parts FROM gemma WHERE valid)
SELECT conv_id,
  repeat(' ', length(parts[1])) || coalesce(array_to_string(list_transform(parts[2:],
     lambda p: repeat(' ', length({RESPONSE})) || string_split(p, {INSTRUCTION})[1]
               || repeat(' ', length(p) - length(string_split(p, {INSTRUCTION})[1]))), ''), '') AS masked
FROM sp""")
def q_masked_text(spark, d):
    return masks.masked_texts(masks.rendered_pieces(conversations(spark, d)))


@register("trained_share", f"""WITH {GEMMA_CTE},
sp AS (SELECT conv_id, text, string_split(text, {RESPONSE}) AS parts FROM gemma WHERE valid),
t AS (SELECT conv_id, length(text)::BIGINT AS total_chars,
        coalesce(list_sum(list_transform(parts[2:], lambda p: length(string_split(p, {INSTRUCTION})[1]))), 0)::BIGINT
          AS trained_chars FROM sp)
SELECT conv_id, total_chars, trained_chars,
       CASE WHEN total_chars = 0 THEN NULL ELSE trained_chars / total_chars END AS trained_share FROM t""")
def q_trained_share(spark, d):
    return masks.trained_shares(masks.rendered_pieces(conversations(spark, d)))


# --------------------------------------------------------------- X6, X7
@register("preview", """
SELECT doc_id,
  CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS preview_200,
  left(text, 100) || '...' AS preview_100
FROM documents""")
def q_preview(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", tx.preview("text", 200).alias("preview_200"),
                       tx.preview("text", 100, always=True).alias("preview_100"))


@register("continuation", f"""WITH {SFT_CTE}
SELECT conv_id, {strip(f"substr({SFT_RENDER}, length({SFT_PROMPT}) + 1)")} AS continuation FROM sft""")
def q_continuation(spark, d):
    turns = sft_turns(spark, d)
    full = chat.render_gemma(turns, "conversations", text="generated", valid="_v1")
    prompt = chat.render_gemma(chat.prompt_turns(full, name="_p"), "_p", add_generation_prompt=True,
                               text="prompt", valid="_v2")
    return prompt.select("conv_id", tx.continuation("generated", "prompt").alias("continuation"))


# --------------------------------------------------------------- A2-A8, W1, M1, T2
@register("role_distribution", """
WITH r AS (SELECT role, row_number() OVER (ORDER BY conv_id, turn) AS seq FROM conversations),
g AS (SELECT role, count(*) AS n, min(seq) AS first_seq FROM r GROUP BY role)
SELECT role, n, 100.0::DOUBLE * n / sum(n) OVER () AS pct,
       row_number() OVER (ORDER BY n DESC, first_seq) AS rank
FROM g""")
def q_role_distribution(spark, d):
    return profile.role_distribution(conversations(spark, d)).select("role", "n", "pct", "rank")


@register("message_lengths", """
SELECT count(*) AS n_messages, avg(length(text)) AS avg_chars,
       min(length(text))::BIGINT AS min_chars, max(length(text))::BIGINT AS max_chars
FROM conversations""")
def q_message_lengths(spark, d):
    return profile.message_length_stats(conversations(spark, d))


@register("conversation_lengths", """
WITH s AS (SELECT conv_id, count(*) AS n_messages FROM conversations GROUP BY conv_id)
SELECT count(*) AS n_conversations, avg(n_messages) AS avg_messages,
       min(n_messages) AS min_messages, max(n_messages) AS max_messages FROM s""")
def q_conversation_lengths(spark, d):
    return profile.conversation_length_stats(conversations(spark, d))


@register("length_histogram", """
WITH s AS (SELECT conv_id, count(*) AS n_messages FROM conversations GROUP BY conv_id),
h AS (SELECT n_messages, count(*) AS n_conversations FROM s GROUP BY n_messages)
SELECT n_messages, n_conversations, 100.0::DOUBLE * n_conversations / sum(n_conversations) OVER () AS pct
FROM h ORDER BY n_messages LIMIT 10""")
def q_length_histogram(spark, d):
    return profile.conversation_length_histogram(conversations(spark, d), k=10)


_PATTERN_SQL = """
WITH p AS (SELECT conv_id, string_agg(role, ' -> ' ORDER BY turn) AS pattern FROM conversations GROUP BY conv_id),
g AS (SELECT pattern, count(*) AS n, min(conv_id) AS rep FROM p GROUP BY pattern)
SELECT pattern, n, 100.0::DOUBLE * n / (SELECT count(*) FROM p) AS pct,
       row_number() OVER (ORDER BY n DESC, rep) AS rank
FROM g ORDER BY n DESC, rep LIMIT 10"""


@register("role_patterns", _PATTERN_SQL)
def q_role_patterns(spark, d):
    return profile.role_patterns(conversations(spark, d), k=10)


@register("system_rate", """
WITH s AS (SELECT conv_id, bool_or(role = 'system') AS has_sys FROM conversations GROUP BY conv_id)
SELECT count(*) FILTER (WHERE has_sys) AS with_system, count(*) AS total,
       100.0::DOUBLE * count(*) FILTER (WHERE has_sys) / count(*) AS pct FROM s""")
def q_system_rate(spark, d):
    return profile.system_message_rate(conversations(spark, d))


@register("template_success", f"""WITH {GEMMA_CTE}
SELECT count(*) FILTER (WHERE valid) AS n_ok, count(*) FILTER (WHERE NOT valid) AS n_error,
       100.0::DOUBLE * count(*) FILTER (WHERE valid) / count(*) AS success_rate FROM gemma""")
def q_template_success(spark, d):
    # counts only: validity from partial aggregates on the long table
    return profile.template_success_rate(chat.gemma_validity_long(conversations(spark, d)))


@register("template_success_cut", """
WITH c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS p FROM conversations WHERE (conv_id + turn) % 7 <> 0),
s AS (SELECT conv_id, bool_or(p = 0 AND role = 'system') AS sys FROM c GROUP BY conv_id),
v AS (SELECT conv_id, bool_and(CASE WHEN sys THEN p = 0 OR (role = 'user') = (p % 2 = 1) ELSE (role = 'user') = (p % 2 = 0) END) AS ok
      FROM c JOIN s USING (conv_id) GROUP BY conv_id)
SELECT count(*) FILTER (WHERE ok) AS n_ok, count(*) FILTER (WHERE NOT ok) AS n_error,
       100.0::DOUBLE * count(*) FILTER (WHERE ok) / count(*) AS success_rate FROM v""")
def q_template_success_cut(spark, d):
    """A8 on conversations that lack some turns, so that roles no longer alternate."""
    cut = conversations(spark, d).where((F.col("conv_id") + F.col("turn")) % 7 != 0)
    return profile.template_success_rate(chat.gemma_validity_long(cut))


@register("template_success_tags", """
SELECT count(DISTINCT conv_id) AS n_ok, 0::BIGINT AS n_error, 100.0::DOUBLE AS success_rate FROM conversations
WHERE (conv_id + turn) % 7 <> 0""")
def q_template_success_tags(spark, d):
    """A8 for the role-tag template, which takes any order of roles: the same
    conversations, all of them rendered."""
    cut = conversations(spark, d).where((F.col("conv_id") + F.col("turn")) % 7 != 0)
    rendered = chat.render_role_tags(nest_messages(cut), eos=ROLE_TAG_EOS)
    return profile.template_success_rate(rendered.withColumn("valid", F.col("text").isNotNull()))


@register("rendered_tokens", f"""WITH {GEMMA_CTE},
c AS (SELECT length(text)::BIGINT AS n_chars, len(regexp_extract_all(text, '{tokens.TOKEN_PATTERN}'))::BIGINT AS n_tokens FROM gemma WHERE valid)
SELECT count(*) AS n_rows, sum(n_tokens)::BIGINT AS total_tokens, avg(n_tokens) AS avg_tokens, min(n_tokens) AS min_tokens,
       max(n_tokens) AS max_tokens, sum(n_chars)::BIGINT AS total_chars FROM c""")
def q_rendered_tokens(spark, d):
    """K2: characters and tokens of every rendered conversation, summed up."""
    c = conversations(spark, d)
    counts = chat.gemma_token_counts_long(c, tokens.TOKEN_PATTERN).where("valid").select("conv_id", "n_tokens")
    chars = masks.trained_shares(masks.rendered_pieces(c)).select("conv_id", F.col("total_chars").alias("n_chars"))
    return tokens.token_count_stats(counts.join(chars, "conv_id"))


@register("save_load", f"WITH {SFT_CTE} SELECT conv_id, input, output, system FROM sft")
def q_save_load(spark, d):
    """S17 + S1: the prepared columns saved as a dataset and loaded again."""
    path = scratch_path(spark, "sft-dataset")
    save_dataset(sft(spark, d).select("conv_id", "input", "output", "system"), path)
    return read_chat(spark, path)


# --------------------------------------------------------------- T1, T3, S2, S3, A1, N9
@register("first_n", """
SELECT conv_id, turn, role, text FROM conversations
WHERE conv_id IN (SELECT DISTINCT conv_id FROM conversations ORDER BY conv_id LIMIT 10)""")
def q_first_n(spark, d):
    return profile.first_n(conversations(spark, d), 10).select("conv_id", "turn", "role", "text")


@register("slice_split", """
SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 150 OFFSET 100""")
def q_slice_split(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return slice_split(docs, "train[100:250]", "doc_id")


@register("sample_rows", """
SELECT doc_id, lang, n_chars FROM documents
ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id LIMIT 25""")
def q_sample_rows(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return profile.sample_rows(docs, 25, 42, key="doc_id")


@register("row_at", """
SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 1 OFFSET 100""")
def q_row_at(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return row_at(docs, 100, "doc_id")


_SCHEMA_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS split, (SELECT count(*) FROM {t}) AS n_rows,
       (SELECT count(*) FROM duckdb_columns() WHERE table_name = '{t}')::BIGINT AS n_columns,
       (SELECT string_agg(column_name, ',' ORDER BY column_index) FROM duckdb_columns()
         WHERE table_name = '{t}') AS columns""" for t in TABLES)


@register("schema_profile", _SCHEMA_SQL)
def q_schema_profile(spark, d):
    # a row count reads no columns and aggregates per split: read as stored
    splits = profile.read_all_tables(spark, d.rstrip("/"), TABLES)
    return profile.profile_schema(splits).select("split", "n_rows", "n_columns", "columns")


@register("special_tokens", "\nUNION ALL\n".join(
    f"""SELECT '{m}' AS marker, coalesce(sum((length(text) - length(replace(text, '{m}', ''))) // {len(m)}), 0)::BIGINT AS occurrences,
       coalesce(sum(CASE WHEN contains(text, '{m}') THEN 1 ELSE 0 END), 0)::BIGINT AS rows_with_marker FROM conversations"""
    for m in profile.SPECIAL_MARKERS))
def q_special_tokens(spark, d):
    return profile.special_token_counts(conversations(spark, d))


MARKED_SQL = "SELECT text || " + " || ".join(
    f"repeat('{m}', (turn % {i + 2})::BIGINT)" for i, m in enumerate(profile.SPECIAL_MARKERS)) + " AS text FROM conversations"


@register("special_tokens_inside", f"WITH marked AS ({MARKED_SQL})" + "\nUNION ALL\n".join(
    f"""{'' if i else ' '}SELECT '{m}' AS marker, coalesce(sum((length(text) - length(replace(text, '{m}', ''))) // {len(m)}), 0)::BIGINT AS occurrences,
       coalesce(sum(CASE WHEN contains(text, '{m}') THEN 1 ELSE 0 END), 0)::BIGINT AS rows_with_marker FROM marked"""
    for i, m in enumerate(profile.SPECIAL_MARKERS)))
def q_special_tokens_inside(spark, d):
    """N9 on texts that do hold markers, some of them several times."""
    extra = [F.repeat(F.lit(m), (F.col("turn") % (i + 2)).cast("int")) for i, m in enumerate(profile.SPECIAL_MARKERS)]
    return profile.special_token_counts(conversations(spark, d).select(F.concat("text", *extra).alias("text")))


# --------------------------------------------------------------- flagship (§7.2)
FLAGSHIP_SQL = f"""WITH {SFT_CTE},
p AS (SELECT conv_id, string_agg(role, ' -> ' ORDER BY turn) AS pattern FROM conversations GROUP BY conv_id),
r AS (SELECT sft.conv_id, length({SFT_RENDER})::BIGINT AS rendered_chars,
             (length({strip('output')}) + 14)::BIGINT AS trained_chars FROM sft)
SELECT pattern, count(*) AS n_conversations, sum(rendered_chars)::BIGINT AS rendered_chars,
       sum(trained_chars)::BIGINT AS trained_chars
FROM p JOIN r USING (conv_id) GROUP BY pattern"""


def flagship(spark, d):
    """conversations -> P1 -> P2 -> P3 -> X1 -> X4 -> per role pattern."""
    long = conversations(spark, d)
    turns = chat.to_chat_turns(chat.to_sft_columns_long(long))
    rendered = chat.render_gemma(turns, "conversations")
    per_conv = rendered.select(
        "conv_id", F.length("text").cast("long").alias("rendered_chars"),
        tpl.trained_chars("text").alias("trained_chars"))
    keys, levels = profile.role_pattern_keys(long, with_levels=True)
    joined = keys.join(per_conv, "conv_id")
    groups = (joined.groupBy("n_messages", "_key")
              .agg(F.count(F.lit(1)).alias("n_conversations"), F.min("conv_id").alias("_rep"),
                   F.sum("rendered_chars").alias("rendered_chars"),
                   F.sum("trained_chars").alias("trained_chars")))
    return (profile.with_pattern_strings(groups, long, levels)
            .select("pattern", "n_conversations", "rendered_chars", "trained_chars"))


register("prep_profile", FLAGSHIP_SQL)(flagship)
