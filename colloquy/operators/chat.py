"""Chat-dataset preparation: P1-P4, W4, X1-X5 applied to tables, K7."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import templates as tpl
from colloquy.functions.text import strip
from colloquy.operators.indexing import dense_index
from colloquy.schemas import MESSAGE

# Fixed value: default system sentence of the reformatting step.
DEFAULT_SYSTEM = "You are a helpful AI assistant."


def default_system(col, default: str = DEFAULT_SYSTEM):
    """Empty or missing system text -> fixed default sentence."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def to_sft_columns_long(long: DataFrame, conv: str = "conv_id", order: str = "turn",
                        role: str = "role", text: str = "text",
                        default: str | None = DEFAULT_SYSTEM) -> DataFrame:
    """P1 (+P2) on the long table: last user / assistant / system text wins.

    ``max_by`` is a partial aggregate, so a conversation with very many turns
    is pre-aggregated on every mapper before the shuffle.
    """
    def last(r):
        return F.max_by(F.col(text), F.when(F.col(role) == r, F.col(order)))

    out = (long.groupBy(conv)
           .agg(F.coalesce(last("user"), F.lit("")).alias("input"),
                F.coalesce(last("assistant"), F.lit("")).alias("output"),
                F.coalesce(last("system"), F.lit("")).alias("system")))
    if default is not None:
        out = out.withColumn("system", default_system("system", default))
    return out


def to_sft_columns(nested: DataFrame, messages: str = "messages",
                   default: str | None = DEFAULT_SYSTEM) -> DataFrame:
    """P1 (+P2) on nested rows; drops ``messages`` like the reference."""
    def last(r):
        return F.coalesce(
            F.try_element_at(F.filter(messages, lambda m: m["role"] == r), F.lit(-1))["content"],
            F.lit(""))

    out = nested.withColumns({"input": last("user"), "output": last("assistant"),
                              "system": last("system")}).drop(messages)
    if default is not None:
        out = out.withColumn("system", default_system("system", default))
    return out


def to_chat_turns(df: DataFrame, system: str = "system", input: str = "input",
                  output: str = "output", name: str = "conversations") -> DataFrame:
    """``input/output/system`` -> three turns: system, user, assistant."""
    turns = F.array(
        F.struct(F.lit("system").alias("role"), F.col(system).alias("content")),
        F.struct(F.lit("user").alias("role"), F.col(input).alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col(output).alias("content")),
    ).cast(f"array<{MESSAGE}>")
    return df.withColumn(name, turns)


def prompt_turns(df: DataFrame, conversations: str = "conversations", name: str | None = None) -> DataFrame:
    """Keep only the system and user turns (generation prompt)."""
    return df.withColumn(name or conversations, F.slice(conversations, 1, 2))


def turn_positions(long: DataFrame, conv: str = "conv_id", order: str = "turn") -> DataFrame:
    """First / last turn flags.

    The per-conversation bounds come from a partial aggregate and are joined
    back on ``conv``; AQE's skew-join splitting handles a hot conversation on
    the long side (no window sorts a whole conversation in one task).
    """
    bounds = long.groupBy(conv).agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
    return (long.join(bounds, conv)
            .withColumn("is_first", F.col(order) == F.col("_first"))
            .withColumn("is_last", F.col(order) == F.col("_last"))
            .drop("_first", "_last"))


def render_gemma(df: DataFrame, messages: str = "messages", add_generation_prompt: bool = False,
                 text: str = "text", valid: str = "valid") -> DataFrame:
    """X1 as a table operator: adds ``valid`` and ``text`` (P8: a row map is
    ``withColumns`` / ``drop``, composed with ``df.transform``)."""
    r = tpl.render_gemma(messages, add_generation_prompt)
    return df.withColumns({valid: r["valid"], text: r["text"]})


def _validity_aggs(order: str, role: str) -> tuple[list, Column]:
    p = F.col(order)
    is_user = F.coalesce(F.col(role) == "user", F.lit(False))
    aggs = [F.bool_or((p == 0) & F.coalesce(F.col(role) == "system", F.lit(False))).alias("_sys"),
            F.bool_and((p == 0) | (is_user == (p % 2 == 1))).alias("_ok_sys"),
            F.bool_and(is_user == (p % 2 == 0)).alias("_ok")]
    return aggs, F.when(F.col("_sys"), F.col("_ok_sys")).otherwise(F.col("_ok"))


def dense_turns(long: DataFrame, conv: str = "conv_id", order: str = "turn") -> DataFrame:
    """``order`` replaced by the 0-based position in the conversation, whatever
    gaps or offset it has: the distributed index over (conversation, order)
    minus its smallest value there, without a window per conversation."""
    indexed = dense_index(long, [F.col(conv), F.col(order)], "_at")
    first = indexed.groupBy(F.col(conv).alias("_fc")).agg(F.min("_at").alias("_first"))
    return (indexed.join(first, F.col(conv).eqNullSafe(F.col("_fc")))
            .withColumn(order, F.col("_at") - F.col("_first")).drop("_at", "_first", "_fc"))


def gemma_validity_long(long: DataFrame, conv: str = "conv_id", order: str = "turn",
                        role: str = "role") -> DataFrame:
    """X1's validity per conversation, from the long table: ``(conv, valid)``.

    ``order`` sorts the messages; gaps do not matter. After an optional leading
    system turn, user turns must sit on even loop positions and only there.
    Both cases (with and without a leading system turn) are checked with
    partial ``bool_and`` aggregates and the right one is picked, so no
    conversation is gathered. Equals ``render_gemma(...).valid`` on the
    nested form.
    """
    aggs, valid = _validity_aggs(order, role)
    long = dense_turns(long.select(conv, order, role), conv, order)
    return long.groupBy(conv).agg(*aggs).select(conv, valid.alias("valid"))


def gemma_token_counts_long(long: DataFrame, pattern: str, conv: str = "conv_id", order: str = "turn",
                            role: str = "role", text: str = "text") -> DataFrame:
    """K2 of X1's rendering per conversation, from the long table:
    ``(conv, valid, n_tokens)``; ``n_tokens`` is NULL when invalid.

    Each turn of the rendering ends in a newline, and a leading system text
    sits between newlines. For a token ``pattern`` that never matches
    white space (the default regex tokeniser) no token crosses those
    boundaries, so the tokens of the whole text are the sum of the tokens of
    each message's piece: a partial aggregate, with validity in the same
    pass. A sub-word tokeniser needs the whole text (``render_gemma``).
    """
    r, t = F.col(role), F.coalesce(F.col(text), F.lit(""))
    piece = F.concat(F.lit(tpl.GEMMA_START), F.when(r == "assistant", F.lit("model")).otherwise(F.coalesce(r, F.lit(""))),
                     F.lit("\n"), strip(t), F.lit(tpl.GEMMA_END))
    count = lambda c: F.size(F.regexp_extract_all(c, F.lit(pattern), 0)).cast("long")
    # counted before the sort, in the form of the message's place; the texts stay behind
    counted = long.select(conv, order, role, F.when(r == "system", count(t)).alias("_bare"), count(piece).alias("_full"))
    placed = dense_turns(counted, conv, order)
    lead_system = (F.col(order) == 0) & F.coalesce(r == "system", F.lit(False))
    aggs, valid = _validity_aggs(order, role)
    return (placed.groupBy(conv).agg(*aggs, F.sum(F.when(lead_system, F.col("_bare")).otherwise(F.col("_full"))).alias("_n"))
            .select(conv, valid.alias("valid"), F.when(valid, F.col("_n")).alias("n_tokens")))


def render_role_tags(df: DataFrame, messages: str = "messages", eos: str = tpl.DEFAULT_EOS,
                     add_generation_prompt: bool = False, text: str = "text") -> DataFrame:
    """X2 as a table operator."""
    return df.withColumn(text, tpl.render_role_tags(messages, eos, add_generation_prompt))


def response_masks(df: DataFrame, text: str = "text",
                   instruction_part: str = tpl.GEMMA_INSTRUCTION_PART,
                   response_part: str = tpl.GEMMA_RESPONSE_PART) -> DataFrame:
    """X4 + X5 + K7: spans, masked text and trained share of rendered text."""
    return df.withColumns({
        "spans": tpl.response_spans(text, instruction_part, response_part),
        "masked": tpl.masked_text(text, instruction_part, response_part),
        "total_chars": F.length(text).cast("long"),
        "trained_chars": tpl.trained_chars(text, instruction_part, response_part),
    }).withColumn("trained_share", F.try_divide(F.col("trained_chars"), F.col("total_chars")))
