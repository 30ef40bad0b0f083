"""Exact top-k inner products by columnar branch and bound (operator 3).

The integer vectors of a block of candidates lie dimension-major, and scores
are accumulated block of dimensions by block of dimensions. After each block
a candidate can still gain at most the product of both remaining norms
(Cauchy-Schwarz), so whatever cannot reach the query's current k-th score
goes. While many survive, the next block is one dense product; once few are
left, they are compacted to (query, candidate) pairs and only those go on.

Queries and candidates are hashed into blocks; each unit of work is one block
of queries with one block of candidates, and the k best of each unit are
ranked per query at the end. Every query meets every row: this is the stated
query set against all rows.

Defined results: vectors that are null, empty or hold null or non-finite
components, and rows with a null id, take no part; only vectors of equal
length are compared; rows that repeat a query's id are not its candidates,
repeated query rows count once, repeated candidate rows each count. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 64
K = 20
QUERY_EVERY = 20
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192
DIM_BLOCK, TILE_Q, TILE_C = 16, 128, 2048
DENSE_SHARE = 0.2


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, x: floor(64 * component) of the usable vectors."""
    emb = F.col("embedding")
    good = (F.col("vec_id").isNotNull() & (F.size(emb) > 0)
            & F.forall(emb, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return vectors.where(good).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(emb, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long")).alias("x"))


def _number_type(q: np.ndarray, c: np.ndarray):
    """float64 products are exact below 2^53."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    return np.float64 if top < 2**53 else np.int64


def _rest_norms(columns: np.ndarray) -> np.ndarray:
    """Norm of what remains after each block of dimensions; columns is dims x n."""
    cuts = range(DIM_BLOCK, columns.shape[0] + DIM_BLOCK, DIM_BLOCK)
    return np.stack([np.sqrt((columns[c:].astype(float) ** 2).sum(0)) for c in cuts])


def best_of_unit(q_id: np.ndarray, q: np.ndarray, c_id: np.ndarray, c: np.ndarray, k: int):
    """(query row, candidate id, score) of the k best per query row; ties to
    the smaller id. q: queries x dims, c: candidates x dims, int64."""
    kind = _number_type(q, c)
    best_q, best_id, best_s = (np.empty(0, np.int64) for _ in range(3))
    floor_ = np.full(len(q), -np.inf)
    qn = _rest_norms(np.ascontiguousarray(q.T))
    for cs in range(0, len(c), TILE_C):
        cid = c_id[cs:cs + TILE_C]
        vertical = np.ascontiguousarray(c[cs:cs + TILE_C].T.astype(kind))
        cn = _rest_norms(vertical)
        got = [(best_q, best_id, best_s)]
        for qs in range(0, len(q), TILE_Q):
            rows = q[qs:qs + TILE_Q].astype(kind)
            a, b, s = _survivors(rows, vertical, qn[:, qs:qs + TILE_Q], cn, floor_[qs:qs + TILE_Q])
            other = q_id[qs + a] != cid[b]
            got.append((a[other] + qs, cid[b[other]], s[other].astype(np.int64)))
        best_q, best_id, best_s = (np.concatenate(v) for v in zip(*got))
        order = np.lexsort((best_id, -best_s, best_q))
        best_q, best_id, best_s = best_q[order], best_id[order], best_s[order]
        rank = np.arange(len(best_q)) - np.searchsorted(best_q, best_q)
        best_q, best_id, best_s = best_q[rank < k], best_id[rank < k], best_s[rank < k]
        kth = np.flatnonzero(rank[rank < k] == k - 1)
        floor_[best_q[kth]] = best_s[kth]
    return best_q, best_id, best_s


def _survivors(rows, vertical, qn, cn, floor_):
    """Pairs of the tile whose score reaches the query's floor."""
    dims = vertical.shape[0]
    total = np.zeros((len(rows), vertical.shape[1]), rows.dtype)
    pairs = None
    for b, at in enumerate(range(0, dims, DIM_BLOCK)):
        part = slice(at, at + DIM_BLOCK)
        if pairs is None:
            total += rows[:, part] @ vertical[part]
            reach = total + qn[b][:, None] * cn[b][None, :] * (1 + 1e-12) + 1e-6
            alive = reach >= floor_[:, None]
            if at + DIM_BLOCK >= dims or alive.mean() <= DENSE_SHARE:
                x, y = np.nonzero(alive)
                pairs = x, y, total[x, y]
        else:
            x, y, s = pairs
            s = s + np.einsum("id,id->i", rows[x, part], vertical[part].T[y])
            keep = s + qn[b][x] * cn[b][y] * (1 + 1e-12) + 1e-6 >= floor_[x]
            pairs = x[keep], y[keep], s[keep]
    return pairs


def _unit(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["x"].to_numpy()).astype(np.int64)
        is_q, ids, same = pdf["is_query"].to_numpy(bool), pdf["vec_id"].to_numpy(), pdf["print"].to_numpy()
        if not is_q.any() or is_q.all():
            return pd.DataFrame({"query_id": [], "print": [], "vec_id": [], "score": []}).astype("int64")
        row, vec, score = best_of_unit(ids[is_q], x[is_q], ids[~is_q], x[~is_q], k)
        return pd.DataFrame({"query_id": ids[is_q][row], "print": same[is_q][row], "vec_id": vec, "score": score})
    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs as from ``integer_vectors``."""
    n_q = queries.count()
    n_c = candidates.count()
    q_blocks, c_blocks = max(1, -(-n_q // QUERY_BLOCK)), max(1, -(-n_c // CANDIDATE_BLOCK))

    def dealt(df: DataFrame, own: str, own_n: int, other: str, other_n: int, is_query: bool) -> DataFrame:
        return df.select("vec_id", "x", F.xxhash64("x").alias("print"), F.size("x").alias("dim"), F.lit(is_query).alias("is_query"),
                         F.pmod(F.xxhash64("vec_id", "x"), F.lit(own_n).cast("long")).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))).alias(other))

    rows = dealt(queries.dropDuplicates(["vec_id", "x"]), "qb", q_blocks, "cb", c_blocks, True).unionByName(
        dealt(candidates, "cb", c_blocks, "qb", q_blocks, False))
    found = rows.groupBy("qb", "cb", "dim").applyInPandas(_unit(k), "query_id long, print long, vec_id long, score long")
    w = Window.partitionBy("query_id", "print").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op3_query(vectors: DataFrame) -> DataFrame:
    ints = integer_vectors(vectors)
    return top_k(ints.where(F.col("vec_id") % QUERY_EVERY == 0), ints)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""
