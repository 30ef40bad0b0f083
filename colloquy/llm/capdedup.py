"""Near-duplicate embeddings by spherical-cap filters (operator 10).

Vectors are compared only within an equal label. Vectors with equal
components form a class with a weight. Each class is list-decoded to the
filter directions whose caps hold it: the directions are a random product
code (a seeded rotation, then ``BLOCKS`` slices with ``K`` random codewords
each; a direction is one codeword per slice), decoded by combining slice
scores. A fixed cap height lists a thousand directions for some vectors and
none for others, so each vector has its own height, the one that ``LISTED``
directions exceed. ``CODES`` independent codes make a miss rare (measured at
cosine 0.98 on 64 dimensions: below 1 in 10,000 pairs; near copies share
dozens of filters). Classes that share a filter are joined on it and verified
by their cosine in double precision.

The number of directions grows with the rows, so the expected size of a
filter does not.

A pair that shares several filters counts in the first one only, so links
are counted exactly once. Tasks emit counts and spanning edges per vector,
never the pairs of a group; a hot filter is compared in block pairs.

Defined results: a vector that is null, zero, empty or holds null or
non-finite components, and one with a null label or id, links with nothing
(n_links 0, component its own id, kept; a null id has a null component);
vectors of unequal length do not link; rows that repeat an id count as
vectors of their own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import cut, stored
from colloquy.llm.components import connected_components
from colloquy.llm.runs import blocks, local_components, unit_runs

BLOCKS, LISTED, CODES = 4, 14, 2
ROWS_PER_FILTER = 4
BLOCK = 512
PAIRS_AT_ONCE = 16_384


def code_shape(rows: int, dim: int) -> tuple[int, int]:
    """(blocks, codewords per block): about rows / ROWS_PER_FILTER directions,
    65,536 at least, but in few dimensions no more than leave ``LISTED`` of
    them in a cap of 30 degrees (the usual estimate of a cap's share)."""
    share = 0.5 ** (dim - 1) / (np.sqrt(2 * np.pi * dim) * np.cos(np.pi / 6))
    directions = min(max(rows / ROWS_PER_FILTER, 65_536), max(LISTED / share, 16))
    blocks_used = min(BLOCKS, max(1, dim // 8))
    return blocks_used, int(np.ceil(directions ** (1 / blocks_used) - 1e-9))


class ProductCode:
    """Seeded code for one dimension and size."""

    def __init__(self, dim: int, rows: int, seed: int = 0):
        parts, k = code_shape(rows, dim)
        rng = np.random.default_rng([seed, dim, k])
        q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
        self.slices = np.array_split(np.arange(dim), parts)
        words = []
        for s in self.slices:
            w = rng.standard_normal((k, len(s)))
            words.append(w / np.linalg.norm(w, axis=1, keepdims=True) * np.sqrt(len(s) / dim))
        self.project = [q[:, s] @ w.T for s, w in zip(self.slices, words)]

    def _halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [x @ p for p in self.project]

        def combine(ps):
            out = ps[0]
            for p in ps[1:]:
                out = (out[:, :, None] + p[:, None, :]).reshape(len(x), -1)
            return out
        mid = (len(parts) + 1) // 2
        return combine(parts[:mid]), combine(parts[mid:]) if parts[mid:] else np.zeros((len(x), 1))

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Sorted filter ids of each unit vector, one row each: the directions
        at or above its own height (all of them where a code has fewer).

        The ``LISTED`` best sums of two halves only use the ``LISTED`` best
        scores of either half, so these are all that need combining.
        """
        a, b = self._halves(x)
        top_a, top_b = (np.argsort(-h, 1, kind="stable")[:, :LISTED] for h in (a, b))
        sums = np.take_along_axis(a, top_a, 1)[:, :, None] + np.take_along_axis(b, top_b, 1)[:, None, :]
        ids = top_a[:, :, None].astype(np.int64) * b.shape[1] + top_b[:, None, :]
        sums, ids = sums.reshape(len(x), -1), ids.reshape(len(x), -1)
        best = np.argsort(-sums, 1, kind="stable")[:, :LISTED]
        return np.sort(np.take_along_axis(ids, best, 1), 1)


def usable(v) -> np.ndarray | None:
    if v is None or len(v) == 0:
        return None
    x = np.array([np.nan if c is None else c for c in v] if not isinstance(v, np.ndarray) or v.dtype == object else v, float)
    return x if np.isfinite(x).all() and x.any() and np.isfinite(np.linalg.norm(x)) else None


def _valid(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        good = [usable(v) for v in pdf["embedding"]]
        prints = [None if x is None else hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest() for x in good]
        yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "v": good, "fp": prints})


def _listed(n_rows: int):
    codes: dict[int, list[ProductCode]] = {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lists: list = [None] * len(pdf)
            dims = np.array([len(v) for v in pdf["v"]], np.int32)
            for dim in np.unique(dims):
                if dim not in codes:
                    codes[dim] = [ProductCode(int(dim), n_rows, seed) for seed in range(CODES)]
                at = np.flatnonzero(dims == dim)
                for s in range(0, len(at), 512):
                    part = at[s:s + 512]
                    x = np.stack([np.asarray(pdf["v"].iat[i], float) for i in part])
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    ids = np.concatenate([c.decode(x) * CODES + n for n, c in enumerate(codes[dim])], axis=1)
                    for i, row in zip(part, np.sort(ids, 1)):
                        lists[i] = row
            yield pdf.assign(dim=dims, filters=lists)[["rep", "label", "dim", "weight", "v", "filters"]]
    return run


def _counted(threshold: float):
    """Per unit and vector: weighted links counted here, and the smallest
    vector of its local component."""
    key = ["label", "dim", "f", "_i", "_j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in unit_runs(batches, key):
            for _, part in pdf.groupby("dim", sort=False):
                out = _count_units(part, key, threshold)
                if out is not None:
                    yield out
    return run


def _count_units(pdf: pd.DataFrame, key: list[str], threshold: float) -> pd.DataFrame | None:
    v = np.stack([np.asarray(x, float) for x in pdf["v"]])
    norm = np.linalg.norm(v, axis=1)
    rep, weight, f, chunk = (pdf[c].to_numpy() for c in ("rep", "weight", "f", "_c"))
    units = pdf[key].to_numpy()
    starts = np.flatnonzero(np.r_[True, (units[1:] != units[:-1]).any(1)])
    ends = np.r_[starts[1:], len(pdf)]
    width = max(map(len, pdf["filters"]))
    lists = np.full((len(pdf), width), -1, np.int64)
    for i, x in enumerate(pdf["filters"]):
        lists[i, :len(x)] = x
    found_a, found_b = [], []
    for s, e in zip(starts, ends):
        i, j = units[s][-2:]
        left = np.flatnonzero(chunk[s:e] == i) + s
        right = left if i == j else np.flatnonzero(chunk[s:e] == j) + s
        for at in range(0, len(left), 256):
            a = left[at:at + 256]
            cos = (v[a] @ v[right].T) / (norm[a][:, None] * norm[right][None, :])
            ok = cos >= threshold
            if i == j:
                ok &= rep[a][:, None] < rep[right][None, :]
            x, y = np.nonzero(ok)
            for p in range(0, len(x), PAIRS_AT_ONCE):
                xa, ya = a[x[p:p + PAIRS_AT_ONCE]], right[y[p:p + PAIRS_AT_ONCE]]
                la, lb = lists[xa], lists[ya]
                common = (la[:, :, None] == lb[:, None, :]).any(2) & (la >= 0)
                first = la[np.arange(len(la)), common.argmax(1)] == f[s]
                found_a.append(xa[first])
                found_b.append(ya[first])
    if not found_a:
        return None
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    if not len(a):
        return None
    links = np.zeros(len(pdf), np.int64)
    np.add.at(links, a, weight[b])
    np.add.at(links, b, weight[a])
    # rows of one unit only meet rows of that unit, so components are local to it
    root = local_components(len(pdf), a, b)
    low = np.full(len(pdf), np.iinfo(np.int64).max)
    np.minimum.at(low, root, rep)
    hit = np.flatnonzero(links)
    return pd.DataFrame({"rep": rep[hit], "label": pdf["label"].to_numpy()[hit], "links": links[hit], "low": low[root[hit]]})


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``
    (columns vec_id, embedding, label)."""
    stored_as = vectors.schema["embedding"].dataType.elementType.simpleString()
    stored_as = f"array<{stored_as if stored_as in ('float', 'double') else 'double'}>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast(stored_as).alias("embedding"))
    takes_part = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    read = stored(rows.where(takes_part).mapInPandas(_valid, f"vec_id long, label string, v {stored_as}, fp binary"), "caps-read")
    valid = read.where("fp is not null")
    classes = stored(valid.groupBy("label", "fp")
                     .agg(F.min(F.struct("vec_id", "v")).alias("m"), F.count(F.lit(1)).alias("weight"))
                     .select("label", "fp", F.col("m.vec_id").alias("rep"), "weight", F.col("m.v").alias("v")), "caps-classes")
    node = F.struct("rep", "label")
    listed = stored(classes.select("rep", "label", "weight", "v").mapInPandas(
        _listed(classes.count()), f"rep long, label string, dim int, weight long, v {stored_as}, filters array<long>"), "caps-listed")
    keyed = listed.select(node.alias("node"), "label", "dim", F.explode("filters").alias("f"))
    units = blocks(keyed, ["label", "dim", "f"], "node", BLOCK, listed.select(node.alias("node"), "rep", "weight", "v", "filters"))
    counted = cut(units.select("label", "dim", "f", "_i", "_j", "_c", "rep", "weight", "v", "filters")
                  .mapInPandas(_counted(threshold), "rep long, label string, links long, low long"))
    links = counted.groupBy("rep", "label").agg(F.sum("links").alias("links"))
    labels = connected_components(counted.select(F.col("rep").alias("u"), F.col("low").alias("v")))
    named = (classes.select("label", "fp", "rep", "weight").join(links, ["rep", "label"], "left")
             .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
             .select("label", "fp", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    linked = valid.select("vec_id", "label", "fp").join(named, ["label", "fp"]).select("vec_id", "n_links", "component_id")
    none = F.lit(0).cast("long").alias("n_links")
    alone = (read.where("fp is null").select("vec_id").unionAll(rows.where(~takes_part).select("vec_id"))
             .select("vec_id", none, F.col("vec_id").alias("component_id")))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op10_query(vectors: DataFrame) -> DataFrame:
    return near_vectors(vectors)
