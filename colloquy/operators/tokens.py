"""Token operators over whole corpora: K1-K6, A18.

The default tokeniser is a regular expression evaluated JVM-side
(``regexp_extract_all``). A real sub-word tokeniser plugs in through an
Arrow-batched ``pandas_udf`` that builds the tokeniser once per worker.
Vocabulary ids are dense ranks in (count desc, token asc) order, assigned
with a distributed index; encode / decode are equi joins against the
vocabulary, checked per position so no document is re-collected.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.operators.indexing import dense_index
from colloquy.operators.skew import lookup_join
from colloquy.session import scratch_path

# Fixed value: default token pattern (words, or single symbols).
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
UNKNOWN_ID = -1


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text, pattern: str = TOKEN_PATTERN) -> Column:
    """K1: token strings of a text."""
    return F.regexp_extract_all(_c(text), F.lit(pattern), 0)


_TOKENIZERS: dict = {}


def tokenize_with(factory: Callable[[], Callable[[str], list]], key: str = "default",
                  return_type: T.DataType = T.ArrayType(T.StringType())):
    """K1 plug-in: an Arrow ``pandas_udf`` over ``factory()``'s tokeniser.

    ``factory`` runs once per Python worker (cached under ``key``), e.g.
    ``lambda: Tokenizer.from_file(path).encode`` wrapped to return tokens.
    """
    @F.pandas_udf(return_type)
    def _tok(s: pd.Series) -> pd.Series:
        fn = _TOKENIZERS.get(key)
        if fn is None:
            fn = _TOKENIZERS[key] = factory()
        return s.map(lambda t: None if t is None else list(fn(t)))

    return _tok


def token_counts(df: DataFrame, text: str = "text", keep=("doc_id",), pattern: str = TOKEN_PATTERN) -> DataFrame:
    """K2: characters and tokens per row."""
    return df.select(*keep, F.length(text).cast("long").alias("n_chars"),
                     F.size(tokenize(text, pattern)).cast("long").alias("n_tokens"))


def token_count_stats(counts: DataFrame) -> DataFrame:
    """K2 summary: rows, total / average / min / max tokens and characters."""
    return counts.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_tokens").alias("total_tokens"),
                      F.avg("n_tokens").alias("avg_tokens"), F.min("n_tokens").alias("min_tokens"),
                      F.max("n_tokens").alias("max_tokens"), F.sum("n_chars").alias("total_chars"))


def token_rows(df: DataFrame, text: str = "text", keep=("doc_id",), pattern: str = TOKEN_PATTERN) -> DataFrame:
    """Long form (keep..., pos, token)."""
    return (df.select(*keep, F.posexplode(tokenize(text, pattern)).alias("pos", "token"))
            .withColumn("pos", F.col("pos").cast("long")))


def token_frequencies(tokens: DataFrame, token: str = "token") -> DataFrame:
    """Count per token (partial aggregate: hot tokens combine map-side)."""
    return tokens.groupBy(token).agg(F.count(F.lit(1)).alias("n"))


def build_vocab(tokens: DataFrame, token: str = "token") -> DataFrame:
    """(token_id, token, n), ids dense in (count desc, token asc) order."""
    freq = token_frequencies(tokens, token)
    return dense_index(freq, [F.desc("n"), F.asc(token)], "token_id").select("token_id", token, "n")


def vocab_top(tokens: DataFrame, k: int, token: str = "token") -> DataFrame:
    """A18 report: the ``k`` most frequent tokens with their rank.

    A distributed top-k (TakeOrderedAndProject); the rank is a window over
    those ``k`` rows only, bounded by the parameter.
    """
    top = token_frequencies(tokens, token).orderBy(F.desc("n"), F.asc(token)).limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), F.asc(token))) - 1
    return top.select(rank.cast("long").alias("token_id"), token, "n")


def encode(tokens: DataFrame, vocab: DataFrame, token: str = "token", weight: str | None = None) -> DataFrame:
    """K3: token -> id (``UNKNOWN_ID`` for tokens outside the vocabulary).

    The tokens that make up much of the text are few: they meet their ids by
    a broadcast, known or not, the others by a shuffle that no token can
    overload. ``weight``: column that counts occurrences, if a row has several.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    ids = tokens.groupBy(token).agg(n.cast("long").alias("_n")).join(vocab.select(token, "token_id"), token, "left")
    return lookup_join(tokens, ids, [token], "_n", F.struct(*tokens.columns)).withColumn(
        "token_id", F.coalesce(F.col("token_id"), F.lit(UNKNOWN_ID).cast("long")))


def decode(ids: DataFrame, vocab: DataFrame, name: str = "decoded") -> DataFrame:
    """K4: id -> token (NULL for unknown ids, which take no part in the join)."""
    known, unknown = ids.where(F.col("token_id") != UNKNOWN_ID), ids.where(F.col("token_id").isNull() | (F.col("token_id") == UNKNOWN_ID))
    counts = known.groupBy("token_id").agg(F.count(F.lit(1)).alias("_n"))
    named = counts.join(vocab.select("token_id", F.col("token").alias(name)), "token_id", "left")
    found = lookup_join(known, named, ["token_id"], "_n", F.struct(*ids.columns))
    return found.unionByName(unknown.withColumn(name, F.lit(None).cast("string")))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a compressed table in the shared folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def roundtrip_check(tokens: DataFrame, vocab: DataFrame, key: str = "doc_id") -> DataFrame:
    """K3 + K4: per row token count, id checksum, unknowns and whether every
    position decodes back to its token. Equal tokens are counted per row, and
    every distinct one is encoded and decoded once for all rows that hold it;
    its rows meet id and decoded token in one join."""
    counted = _stored(tokens.groupBy(key, "token").agg(F.count(F.lit(1)).alias("n")), "token-counts")
    distinct = counted.groupBy("token").agg(F.count(F.lit(1)).alias("_rows"))
    dec = _stored(decode(_stored(encode(_stored(distinct, "tokens"), vocab), "token-ids"), vocab), "token-decoded")
    dec = lookup_join(counted, dec, ["token"], "_rows", F.struct(*counted.columns))
    return dec.groupBy(key).agg(
        F.sum("n").alias("n_tokens"), F.sum(F.col("token_id") * F.col("n")).alias("id_sum"),
        F.sum(F.when(F.col("token_id") == UNKNOWN_ID, F.col("n")).otherwise(0)).alias("n_unknown"),
        F.bool_and(F.coalesce(F.col("decoded") == F.col("token"), F.lit(False))).alias("roundtrip_ok"))


def list_tokens(tokens: DataFrame, vocab: DataFrame, keep=("doc_id",)) -> DataFrame:
    """K5: (keep..., pos, token_id, token) listing."""
    return encode(tokens, vocab).select(*keep, "pos", "token_id", "token")


def length_flags(df: DataFrame, max_len: int, n_tokens: str = "n_tokens") -> DataFrame:
    """K6 flags from a token count: ``within_limit`` and ``kept_tokens``."""
    n = F.col(n_tokens)
    return df.withColumns({"within_limit": n <= max_len, "kept_tokens": F.least(n, F.lit(max_len)).cast("long")})


def length_filter(df: DataFrame, max_len: int, tokens: str = "tokens", truncate: bool = False) -> DataFrame:
    """K6: rows within ``max_len`` tokens (or truncated to it), with flags."""
    out = length_flags(df.withColumn("n_tokens", F.size(tokens).cast("long")), max_len)
    if truncate:
        return out.withColumn(tokens, F.slice(tokens, 1, max_len))
    return out
