"""Registered token and merge queries: K1-K6, A18, A17."""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.operators import chat, merge, tokens
from colloquy.plans.chat_queries import conversations
from colloquy.plans.registry import register, table
from colloquy.plans.sqlbits import GEMMA_CTE

PAT = tokens.TOKEN_PATTERN
MAX_LEN = 256
TOP_K = 100
# merge recipe over the stand-in models (labels): even labels weight 1.0, odd 0.5
RECIPE = [(str(i), 1.0 if i % 2 == 0 else 0.5) for i in range(10)]


def doc_tokens(spark, d):
    return tokens.token_rows(table(spark, d, "documents"), keep=["doc_id"])


def bench_tokens(spark, d):
    return tokens.token_rows(table(spark, d, "benchmark"), keep=["item_id"])


@register("token_counts", f"""
SELECT doc_id, length(text)::BIGINT AS n_chars, len(regexp_extract_all(text, '{PAT}'))::BIGINT AS n_tokens
FROM documents""")
def q_token_counts(spark, d):
    return tokens.token_counts(table(spark, d, "documents"))


@register("token_stats", f"""
WITH c AS (SELECT length(text)::BIGINT AS n_chars, len(regexp_extract_all(text, '{PAT}'))::BIGINT AS n_tokens
           FROM documents)
SELECT count(*) AS n_rows, sum(n_tokens)::BIGINT AS total_tokens, avg(n_tokens) AS avg_tokens,
       min(n_tokens) AS min_tokens, max(n_tokens) AS max_tokens, sum(n_chars)::BIGINT AS total_chars FROM c""")
def q_token_stats(spark, d):
    return tokens.token_count_stats(tokens.token_counts(table(spark, d, "documents")))


DOC_TOKENS_SQL = f"""
dt AS (SELECT doc_id, unnest(regexp_extract_all(text, '{PAT}')) AS token,
              generate_subscripts(regexp_extract_all(text, '{PAT}'), 1) - 1 AS pos FROM documents),
bt AS (SELECT item_id, unnest(regexp_extract_all(text, '{PAT}')) AS token,
              generate_subscripts(regexp_extract_all(text, '{PAT}'), 1) - 1 AS pos FROM benchmark),
bv AS (SELECT row_number() OVER (ORDER BY n DESC, token) - 1 AS token_id, token, n
       FROM (SELECT token, count(*) AS n FROM bt GROUP BY token))"""


@register("vocab_top", f"""WITH {DOC_TOKENS_SQL}
SELECT row_number() OVER (ORDER BY n DESC, token) - 1 AS token_id, token, n
FROM (SELECT token, count(*) AS n FROM dt GROUP BY token) ORDER BY n DESC, token LIMIT {TOP_K}""")
def q_vocab_top(spark, d):
    return tokens.vocab_top(doc_tokens(spark, d), TOP_K)


@register("vocab_build", f"WITH {DOC_TOKENS_SQL} SELECT token_id, token, n FROM bv")
def q_vocab_build(spark, d):
    return tokens.build_vocab(bench_tokens(spark, d))


@register("encode_decode", f"""WITH {DOC_TOKENS_SQL},
e AS (SELECT dt.doc_id, dt.token, coalesce(bv.token_id, -1) AS token_id FROM dt LEFT JOIN bv USING (token)),
x AS (SELECT e.*, v2.token AS decoded FROM e LEFT JOIN bv v2 ON v2.token_id = e.token_id)
SELECT doc_id, count(*) AS n_tokens, sum(token_id)::BIGINT AS id_sum,
       count(*) FILTER (WHERE token_id = -1) AS n_unknown,
       bool_and(coalesce(decoded = token, false)) AS roundtrip_ok
FROM x GROUP BY doc_id""")
def q_encode_decode(spark, d):
    vocab = tokens.build_vocab(bench_tokens(spark, d))
    return tokens.roundtrip_check(doc_tokens(spark, d), vocab, key="doc_id")


@register("token_listing", f"""WITH {DOC_TOKENS_SQL}
SELECT item_id, pos::BIGINT AS pos, token_id, token FROM bt JOIN bv USING (token)""")
def q_token_listing(spark, d):
    bt = bench_tokens(spark, d)
    return tokens.list_tokens(bt, tokens.build_vocab(bt), keep=["item_id"])


@register("length_filter", f"""WITH {GEMMA_CTE}
SELECT conv_id, len(regexp_extract_all(text, '{PAT}'))::BIGINT AS n_tokens,
       len(regexp_extract_all(text, '{PAT}')) <= {MAX_LEN} AS within_limit,
       least(len(regexp_extract_all(text, '{PAT}')), {MAX_LEN})::BIGINT AS kept_tokens
FROM gemma WHERE valid""")
def q_length_filter(spark, d):
    # token counts of the rendering as partial aggregates over the long table
    counts = chat.gemma_token_counts_long(conversations(spark, d), PAT).where("valid")
    return tokens.length_flags(counts, MAX_LEN).select("conv_id", "n_tokens", "within_limit", "kept_tokens")


@register("length_truncate", f"""
SELECT doc_id, len(regexp_extract_all(text, '{PAT}'))::BIGINT AS n_tokens,
       least(len(regexp_extract_all(text, '{PAT}')), {MAX_LEN})::BIGINT AS kept_tokens,
       array_to_string(regexp_extract_all(text, '{PAT}')[:{MAX_LEN}], ' ') AS kept FROM documents""")
def q_length_truncate(spark, d):
    """K6: documents cut to the maximum sequence length."""
    toks = table(spark, d, "documents").select("doc_id", tokens.tokenize("text").alias("tokens"))
    cut = tokens.length_filter(toks, MAX_LEN, truncate=True)
    return cut.select("doc_id", "n_tokens", "kept_tokens", F.array_join("tokens", " ").alias("kept"))


TENSOR_ROWS = 40  # vectors of a tensor; one that some recipe model lacks is a reject


def params(spark, d):
    emb = table(spark, d, "embeddings")
    return emb.select(F.col("label").cast("string").alias("model"),
                      F.concat(F.lit("t"), F.floor(F.col("vec_id") / TENSOR_ROWS).cast("string")).alias("tensor"),
                      F.lit(0).alias("chunk"), F.col("embedding").alias("values"))


_RECIPE_SQL = " UNION ALL ".join(f"SELECT '{m}' AS model, {w}::DOUBLE AS weight" for m, w in RECIPE)


@register("merge_rejects", f"""
WITH w AS ({_RECIPE_SQL}),
e AS (SELECT 't' || CAST(vec_id // {TENSOR_ROWS} AS VARCHAR) AS tensor, CAST(label AS VARCHAR) AS model, len(embedding) AS k FROM embeddings)
SELECT tensor, 0 AS chunk, count(DISTINCT model) AS n_models, min(k)::INTEGER AS min_len, max(k)::INTEGER AS max_len
FROM e JOIN w USING (model) GROUP BY tensor
HAVING count(DISTINCT model) <> (SELECT count(*) FROM w) OR min(k) <> max(k)""")
def q_merge_rejects(spark, d):
    return merge.merge_rejects(params(spark, d), merge.weights_frame(spark, RECIPE))


@register("merge_linear", f"""
WITH w AS ({_RECIPE_SQL}),
e AS (SELECT 't' || CAST(vec_id // {TENSOR_ROWS} AS VARCHAR) AS tensor, CAST(label AS VARCHAR) AS model, embedding FROM embeddings),
whole AS (SELECT tensor FROM e JOIN w USING (model) GROUP BY tensor
          HAVING count(DISTINCT model) = (SELECT count(*) FROM w) AND min(len(embedding)) = max(len(embedding))),
u AS (SELECT tensor, model, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM e JOIN whole USING (tensor))
SELECT tensor, 0 AS chunk, pos::BIGINT AS pos, round(sum(weight * CAST(v AS DOUBLE)) / sum(weight), 6) AS value
FROM u JOIN w USING (model) GROUP BY tensor, pos""")
def q_merge_linear(spark, d):
    long = merge.merge_linear_long(params(spark, d), merge.weights_frame(spark, RECIPE))
    return long.select("tensor", "chunk", "pos", F.round("value", 6).alias("value"))
