"""Chat-dataset profiling: A1-A8, T1-T3, W1, N9.

All statistics run on the long table with partial aggregates (count, sum,
min, max, bool_or) so no conversation is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.functions.text import percent
from colloquy.operators.chat import dense_turns
from colloquy.operators.indexing import dense_index
from colloquy.operators.select import key_at, rows_between
from colloquy.session import checkpoint_root

# Control strings of the two chat formats.
SPECIAL_MARKERS = ["<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>",
                   "<|system|>", "<|user|>", "<|assistant|>", "<|im_end|>", "<|endoftext|>"]


def profile_schema(splits: Mapping[str, DataFrame]) -> DataFrame:
    """A1: per split: row count, column names and types.

    The counts are computed by Spark; the column lists come from each
    split's schema (plan metadata, not data).
    """
    parts = []
    for name, df in splits.items():
        cols = ",".join(f.name for f in df.schema.fields)
        types = ",".join(f.dataType.simpleString() for f in df.schema.fields)
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"))
                     .select(F.lit(name).alias("split"), "n_rows",
                             F.lit(len(df.schema.fields)).cast("long").alias("n_columns"),
                             F.lit(cols).alias("columns"), F.lit(types).alias("types")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def role_distribution(long: DataFrame, role: str = "role", conv: str = "conv_id",
                      order: str = "turn", limit: int | None = None) -> DataFrame:
    """A2 + W1: count and percent by role, most common first.

    Ties keep first-seen order (smallest (conv, turn)), as a Python Counter does.
    """
    g = (long.groupBy(role)
         .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(conv, order)).alias("_first")))
    out = (g.withColumn("pct", percent("n", F.sum("n").over(Window.partitionBy())))
           .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "_first")).cast("long"))
           .drop("_first"))
    if limit is not None:
        out = out.where(F.col("rank") <= limit)
    return out


def message_length_stats(long: DataFrame, text: str = "text") -> DataFrame:
    """A3: average / min / max characters per message (NULL on empty input)."""
    n = F.length(text)
    return long.agg(F.count(F.lit(1)).alias("n_messages"), F.avg(n).alias("avg_chars"),
                    F.min(n).cast("long").alias("min_chars"), F.max(n).cast("long").alias("max_chars"))


def conversation_sizes(long: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Messages per conversation (partial count, one shuffle)."""
    return long.groupBy(conv).agg(F.count(F.lit(1)).alias("n_messages"))


def conversation_length_stats(long: DataFrame, conv: str = "conv_id") -> DataFrame:
    """A4: average / min / max messages per conversation."""
    s = conversation_sizes(long, conv)
    return s.agg(F.count(F.lit(1)).alias("n_conversations"), F.avg("n_messages").alias("avg_messages"),
                 F.min("n_messages").alias("min_messages"), F.max("n_messages").alias("max_messages"))


def conversation_length_histogram(long: DataFrame, conv: str = "conv_id", k: int | None = 10) -> DataFrame:
    """A5: conversations per length with percent; the ``k`` shortest lengths."""
    h = (conversation_sizes(long, conv).groupBy("n_messages")
         .agg(F.count(F.lit(1)).alias("n_conversations")))
    h = h.withColumn("pct", percent("n_conversations", F.sum("n_conversations").over(Window.partitionBy())))
    h = h.orderBy("n_messages")
    return h.limit(k) if k is not None else h


# Roles per chunk of an exact pattern key (see ``role_pattern_keys``).
PATTERN_CHUNK = 128


def role_pattern_keys(long: DataFrame, conv: str = "conv_id", order: str = "turn",
                      role: str = "role", chunk: int = PATTERN_CHUNK, with_levels: bool = False):
    """(conv, n_messages, _key): equal keys exactly when role sequences are equal.

    ``order`` sorts the messages; gaps do not matter. The roles of each block of
    ``chunk`` positions become one string (a bounded group). A conversation
    with at most ``chunk`` messages is keyed by that string. Longer ones
    continue one level up: each distinct chunk string gets an exact dense
    id, and the id sequence is chunked again, until one chunk is left
    (``log_chunk(n)`` levels). No group ever holds more than ``chunk``
    items, so a conversation with a third of all turns is split, never
    gathered; no hashing, so no collisions. A level-0 key is ``"0:"`` plus
    the JSON list of roles. ``with_levels`` also returns the level count.
    """
    long = dense_turns(long.select(conv, order, role), conv, order)
    n_per = long.groupBy(conv).agg(F.count(F.lit(1)).alias("n_messages"))
    max_n = n_per.agg(F.max("n_messages")).first()[0] or 0  # loop bound: one scalar
    cur = long.select(F.col(conv).alias("_c"), F.col(order).cast("long").alias("_p"),
                      F.col(role).cast("string").alias("_v"))
    keys, level, span = [], 0, chunk
    while True:
        carried = ["n_messages"] if level else []
        ch = (cur.groupBy("_c", *carried, F.floor(F.col("_p") / chunk).alias("_q"))
              .agg(F.sort_array(F.collect_list(F.struct("_p", "_v"))).alias("_e"))
              .select("_c", *carried, "_q", F.to_json(F.transform("_e", lambda x: x["_v"])).alias("_s"),
                      F.size("_e").cast("long").alias("_k")))
        if level == 0:
            # all conversations fit in one chunk: n is the chunk size, no join
            ch = (ch.withColumn("n_messages", F.col("_k")) if max_n <= span
                  else ch.join(n_per.withColumnRenamed(conv, "_c"), "_c"))
        keys.append(ch.where(F.col("n_messages") <= span)
                    .select(F.col("_c").alias(conv), "n_messages",
                            F.concat(F.lit(f"{level}:"), F.col("_s")).alias("_key")))
        if max_n <= span:
            break
        rest = ch.where(F.col("n_messages") > span).select("_c", "n_messages", "_q", "_s")
        ids = dense_index(rest.select("_s").distinct(), ["_s"], "_id")
        cur = rest.join(ids, "_s").select("_c", "n_messages", F.col("_q").alias("_p"),
                                          F.col("_id").cast("string").alias("_v"))
        level, span = level + 1, span * chunk
    out = keys[0]
    for k in keys[1:]:
        out = out.unionByName(k)
    return (out, level + 1) if with_levels else out


def pattern_strings(long: DataFrame, convs: DataFrame, conv: str = "conv_id", order: str = "turn",
                    role: str = "role", sep: str = " -> ") -> DataFrame:
    """``"user -> assistant ..."`` for the (few) conversations in ``convs``."""
    picked = long.join(convs.select(conv), conv, "left_semi")
    return (picked.groupBy(conv)
            .agg(F.sort_array(F.collect_list(F.struct(order, role))).alias("_r"))
            .select(conv, F.array_join(F.transform("_r", lambda x: x[role]), sep).alias("pattern")))


def with_pattern_strings(groups: DataFrame, long: DataFrame, levels: int, rep: str = "_rep",
                         key: str = "_key", conv: str = "conv_id", order: str = "turn",
                         role: str = "role", sep: str = " -> ") -> DataFrame:
    """``groups`` (one row per pattern key, ``rep`` = a member conversation)
    plus ``pattern``. A level-0 key holds the roles themselves, so its string
    needs no data; only representatives of longer keys read the long table,
    and only when such keys exist (``levels > 1``)."""
    direct = F.array_join(F.from_json(F.substr(F.col(key), F.lit(3)), "array<string>"), sep)
    if levels <= 1:
        return groups.withColumn("pattern", direct)
    level0 = F.col(key).startswith("0:")
    reps = groups.where(~level0).select(F.col(rep).alias(conv))
    strings = pattern_strings(long, reps, conv, order, role, sep).select(
        F.col(conv).alias("_prep"), F.col("pattern").alias("_ps"))
    return (groups.join(strings, groups[rep] == strings["_prep"], "left")
            .withColumn("pattern", F.when(level0, direct).otherwise(F.col("_ps")))
            .drop("_prep", "_ps"))


def role_patterns(long: DataFrame, k: int = 10, conv: str = "conv_id", order: str = "turn",
                  role: str = "role", chunk: int = PATTERN_CHUNK) -> DataFrame:
    """A6 + T2 + W1: the ``k`` most common role patterns with percent.

    Counting runs on exact pattern keys; ties keep first-seen order (smallest
    conversation id), as ``Counter.most_common`` does. Display strings are
    built only for the ``k`` representatives.
    """
    keys, levels = role_pattern_keys(long, conv, order, role, chunk, with_levels=True)
    counts = (keys.groupBy("n_messages", "_key")
              .agg(F.count(F.lit(1)).alias("n"), F.min(conv).alias("_rep")))
    total = counts.agg(F.sum("n")).scalar()
    top = counts.orderBy(F.desc("n"), "_rep").limit(k)
    return (with_pattern_strings(top, long, levels, "_rep", "_key", conv, order, role)
            .select("pattern", "n", percent("n", total).alias("pct"),
                    F.row_number().over(Window.orderBy(F.desc("n"), "_rep")).cast("long").alias("rank")))


def system_message_rate(long: DataFrame, conv: str = "conv_id", role: str = "role") -> DataFrame:
    """Conversations with at least one system turn: count / total / percent."""
    per = long.groupBy(conv).agg(F.bool_or(F.col(role) == "system").alias("_sys"))
    return (per.agg(F.count_if("_sys").alias("with_system"), F.count(F.lit(1)).alias("total"))
            .withColumn("pct", percent("with_system", "total")))


def template_success_rate(rendered: DataFrame, valid: str = "valid") -> DataFrame:
    """Ok / error counts and success rate of rendering."""
    return (rendered.agg(F.count_if(F.col(valid)).alias("n_ok"),
                         F.count_if(~F.col(valid)).alias("n_error"))
            .withColumn("success_rate", percent("n_ok", F.col("n_ok") + F.col("n_error"))))


def first_n(long: DataFrame, n: int | None, key: str = "conv_id") -> DataFrame:
    """Rows of the first ``n`` keys (``None`` = everything).

    The n-th distinct key is looked up on the key column alone; the rows are
    taken by a range filter, which reaches the scan.
    """
    if n is None:
        return long
    if n <= 0:
        return long.limit(0)
    checkpoint_root(long.sparkSession)
    keys = long.select(F.struct(key).alias("k")).distinct().checkpoint(eager=True)  # read once a round
    found = key_at(keys, n - 1)
    if found is None:
        return long
    last = found[0][0]
    return long.where(F.col(key).isNull() if last is None else F.col(key).isNull() | (F.col(key) <= F.lit(last)))


def top_k(df: DataFrame, k: int, count: str = "n", value: str = "value") -> DataFrame:
    """The ``k`` most common values (count desc, value asc)."""
    return df.orderBy(F.desc(count), F.asc(value)).limit(k)


def sample_rows(df: DataFrame, n: int, seed: int, key: str | None = None) -> DataFrame:
    """``min(n, rows)`` rows without replacement.

    The order is ``md5(key || seed)``, or a hash of the whole row without a
    ``key``; the rows before its n-th place are taken by a filter.
    """
    if key is None:
        order = [F.xxhash64(*df.columns, F.lit(seed))]
    else:
        order = [F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)]
    return rows_between(df, order, 0, n)


def special_token_counts(df: DataFrame, text: str = "text",
                         markers: Sequence[str] = tuple(SPECIAL_MARKERS)) -> DataFrame:
    """How often each control string occurs inside the text.

    One pass: a per-marker occurrence count per row, summed by a partial
    aggregate, then unpivoted to one row per marker.
    """
    t = F.col(text)
    occ = [((F.length(t) - F.length(F.replace(t, F.lit(m), F.lit("")))) / F.lit(len(m)))
           .cast("long").alias(f"_m{i}") for i, m in enumerate(markers)]
    hit = [F.when(F.instr(t, m) > 0, 1).otherwise(0).alias(f"_r{i}") for i, m in enumerate(markers)]
    agg = df.select(*occ, *hit).agg(*[F.sum(f"_m{i}").alias(f"_m{i}") for i in range(len(markers))],
                                    *[F.sum(f"_r{i}").alias(f"_r{i}") for i in range(len(markers))])
    rows = F.array(*[F.struct(F.lit(m).alias("marker"),
                              F.coalesce(F.col(f"_m{i}"), F.lit(0)).cast("long").alias("occurrences"),
                              F.coalesce(F.col(f"_r{i}"), F.lit(0)).cast("long").alias("rows_with_marker"))
                     for i, m in enumerate(markers)])
    return agg.select(F.inline(rows))


def read_all_tables(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}
