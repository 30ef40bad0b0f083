"""Quality classifier (operator 6): ordinal cumulative-link regression on
graded ratings.

A text's whole word list becomes hashed features: each distinct lower-cased
word and word prefix, and shares of word shapes and immediate repeats. One weight
vector is shared by all grades; ordered thresholds t_1 < t_2 < ... cut the
score: P(grade < k) = sigmoid(t_k - w.x). The model gives the expected grade
and the tail probability P(grade >= top), by which documents are selected.

Grades come from ``labels``: 0 for quality 0, 1 for quality 1 but toxic,
2 for quality 1 and not toxic. The fit takes a bounded sample of the rated
rows, the ``SAMPLE_ROWS`` first ones by a hash of their id (a documented
parameter) and runs in one task, so that the driver gets the model alone;
features that fewer than ``MIN_DOCS`` or a ``MIN_SHARE`` of them show are
left out.
Scoring covers every document and whole texts.

Defined results: a rating with a null id or quality is ignored, a null toxic
counts as 0; a document rated several times is learned from each time; null
and empty texts have no features and get the grade that the thresholds alone
give; without ratings the scores are null and every document is kept. Other
columns pass through or are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import append_columns, free_name

BUCKETS = 1 << 18
GRADES = 3
SAMPLE_ROWS = 8_000
MIN_DOCS, MIN_SHARE = 3, 0.001
STEPS, RATE, LASSO = 200, 0.05, 5e-4
PREFIX = 4
SHARE_SCALE = 4.0
KEEP_TAIL = 0.5
MEMO = 100_000
ROWS_AT_ONCE = 256

_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")


def _bucket(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode("utf-8", "surrogatepass")) % BUCKETS


def _shape(word: str) -> str:
    """Runs of letters by case, digits and the symbols themselves: 'Thnd***' -> 'Aa***'."""
    def letters(m):
        run = m.group()
        if len(run) > 1 and run.isupper():
            return "AA"
        return "Aa" if run[0].isupper() else "a"
    return _DIGITS.sub("0", _LETTERS.sub(letters, word))[:12]


class _Features(dict):
    """word -> buckets of the bare word, of its shape and of its prefix."""

    def __missing__(self, word: str):
        if len(self) > MEMO:
            self.clear()
        bare = word.lower().strip(".,;:!?\"'()")
        shape = _shape(word)
        v = self[word] = (_bucket("w:" + bare), _bucket("s:" + shape), _bucket("p:" + bare[:PREFIX]))
        return v


_MEMO = _Features()
_REPEAT, _FEW = _bucket("r:repeat"), _bucket("r:distinct")


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(sorted buckets, values) of a whole text."""
    words = text.split() if text else []
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    pairs = np.array([_MEMO[w] for w in words], np.int64)
    word_ids = np.unique(pairs[:, [0, 2]])
    shape_ids, shape_n = np.unique(pairs[:, 1], return_counts=True)
    repeats = np.mean(pairs[1:, 0] == pairs[:-1, 0]) if len(pairs) > 1 else 0.0
    ids = np.concatenate([word_ids, shape_ids, [_REPEAT, _FEW]])
    values = np.concatenate([np.ones(len(word_ids)), SHARE_SCALE * shape_n / len(pairs),
                             [SHARE_SCALE * repeats, SHARE_SCALE * len(np.unique(pairs[:, 0])) / len(pairs)]])
    order = np.argsort(ids, kind="stable")
    return ids[order], values[order].astype(np.float32)


class Model:
    """Weights by bucket and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights.astype(np.float32), thresholds

    def score(self, texts: list[str | None]):
        """(expected grade, tail probability of the top grade) of each text."""
        eta = np.empty(len(texts))
        for i, text in enumerate(texts):
            ids, values = features(text)
            eta[i] = float(self.weights[ids] @ values)
        above = _sigmoid(eta[:, None] - self.thresholds)  # P(grade >= k), k = 1..
        return above.sum(1).tolist(), above[:, -1].tolist()


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int = GRADES) -> Model:
    """Maximum likelihood with a lasso, which drops words that do not tell
    grades apart; full-batch proximal Adam in numpy on the sample, whose
    products are made for ROWS_AT_ONCE rows at a time."""
    shown = np.zeros(BUCKETS, np.int64)
    for ids, _ in rows:
        shown[ids] += 1
    names = np.flatnonzero(shown >= max(MIN_DOCS, MIN_SHARE * len(rows)))
    number = np.full(BUCKETS, -1, np.int32)
    number[names] = np.arange(len(names))
    sizes = np.array([np.count_nonzero(number[i] >= 0) for i, _ in rows])
    ends = np.r_[0, np.cumsum(sizes)]
    col, values = np.empty(ends[-1], np.int32), np.empty(ends[-1], np.float32)
    for r, (i, v) in enumerate(rows):
        known = number[i] >= 0
        col[ends[r]:ends[r + 1]], values[ends[r]:ends[r + 1]] = number[i][known], v[known]
    parts = [(slice(r, r + ROWS_AT_ONCE), slice(ends[r], ends[min(r + ROWS_AT_ONCE, len(rows))]))
             for r in range(0, len(rows), ROWS_AT_ONCE)]
    w = np.zeros(len(names))
    share = np.array([np.clip(np.mean(grades < k), 1e-3, 1 - 1e-3) for k in range(1, n_grades)])
    first = np.log(share / (1 - share))
    # thresholds as a start and positive steps, so that they stay ordered
    t = np.r_[first[0], np.log(np.maximum(np.diff(first), 1e-2))]
    theta = np.r_[w, t]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, t = theta[:len(names)], theta[len(names):]
        cuts = np.r_[t[0], t[0] + np.cumsum(np.exp(t[1:]))]
        eta = np.empty(len(rows))
        for at, cells in parts:
            n = sizes[at]
            eta[at] = np.bincount(np.repeat(np.arange(len(n)), n), values[cells] * w[col[cells]], minlength=len(n))
        edge = np.c_[np.full(len(rows), -np.inf), np.broadcast_to(cuts, (len(rows), len(cuts))), np.full(len(rows), np.inf)]
        low, high = edge[np.arange(len(rows)), grades] - eta, edge[np.arange(len(rows)), grades + 1] - eta
        p_low, p_high = _sigmoid(low), _sigmoid(high)
        p = np.maximum(p_high - p_low, 1e-9)
        d_low, d_high = p_low * (1 - p_low) / p, p_high * (1 - p_high) / p
        g_eta = (d_high - d_low) / len(rows)  # of the negative log-likelihood
        g_cut = np.array([np.sum(d_low[grades == k + 1]) - np.sum(d_high[grades == k]) for k in range(len(cuts))]) / len(rows)
        g_t = np.r_[g_cut.sum(), [np.exp(t[j]) * g_cut[j:].sum() for j in range(1, len(cuts))]]
        g_w = np.zeros(len(names))
        for at, cells in parts:
            np.add.at(g_w, col[cells], values[cells] * np.repeat(g_eta[at], sizes[at]))
        grad = np.r_[g_w, g_t]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        pace = RATE / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        theta = theta - pace * (m / (1 - 0.9 ** step))
        pull = LASSO * pace[:len(names)]
        theta[:len(names)] = np.sign(theta[:len(names)]) * np.maximum(np.abs(theta[:len(names)]) - pull, 0)
    w, t = theta[:len(names)], theta[len(names):]
    weights = np.zeros(BUCKETS)
    weights[names] = w
    return Model(weights, np.r_[t[0], t[0] + np.cumsum(np.exp(t[1:]))])


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade of every usable rating."""
    quality, toxic = F.col("quality"), F.coalesce(F.col("toxic"), F.lit(0))
    return labels.where("doc_id is not null and quality is not null").select(
        F.col("doc_id").cast("long").alias("_rated"),
        F.when(quality == 0, 0).when(toxic != 0, 1).otherwise(2).cast("int").alias("_grade"))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on the ``sample_rows`` first rated documents by hash of the id; of
    rows that share an id, the text of least hash is read."""
    rated = docs.select("doc_id", "text").join(graded(labels), F.col("doc_id") == F.col("_rated"))
    chosen = (rated.select("doc_id", "_grade", F.xxhash64("doc_id", F.lit(6)).alias("_h"))
              .orderBy("_h", "doc_id", "_grade").limit(sample_rows))
    ids = chosen.select(F.col("doc_id").alias("_id")).distinct()

    def run(batches):
        for pdf in batches:
            got = [features(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "h": pdf["h"], "ids": [g[0].astype("<i4").tobytes() for g in got],
                                "vals": [g[1].astype("<f4").tobytes() for g in got]})

    # at most sample_rows ids are broadcast and as many sparse rows gathered in the task that fits
    sparse = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h")).join(F.broadcast(ids), F.col("doc_id") == F.col("_id"), "left_semi")
              .mapInPandas(run, "doc_id long, h long, ids binary, vals binary")
              .groupBy("doc_id").agg(F.min(F.struct("h", "ids", "vals")).alias("r")).select("doc_id", "r.ids", "r.vals"))
    grades = chosen.select(F.col("doc_id").cast("long").alias("doc_id"), "_grade")
    got = grades.join(sparse, "doc_id").groupBy().applyInPandas(_fitted, "weights binary, thresholds array<double>").collect()
    return Model(np.frombuffer(got[0].weights, "<f4"), np.array(got[0].thresholds)) if got else None


def _fitted(both: pd.DataFrame) -> pd.DataFrame:
    """The model of the gathered sample (doc_id, _grade, ids, vals) as a row."""
    both = both.sort_values(["doc_id", "_grade"])
    rows = [(np.frombuffer(i, "<i4"), np.frombuffer(v, "<f4")) for i, v in zip(both["ids"], both["vals"])]
    model = fit(rows, both["_grade"].to_numpy(np.int64))
    return pd.DataFrame({"weights": [model.weights.astype("<f4").tobytes()], "thresholds": [model.thresholds.tolist()]})


def rate(df: DataFrame, model: Model | None, grade: str = "expected_grade", tail: str = "tail_prob") -> DataFrame:
    """``df`` with the expected grade and the probability of the top grade."""
    if model is None:
        none = F.lit(None).cast("double")
        return df.withColumn(grade, none).withColumn(tail, none)
    shared = df.sparkSession.sparkContext.broadcast(model)
    return append_columns(df, lambda texts: shared.value.score(texts), f"`{grade}` double, `{tail}` double")


def op6_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = rate(docs.select("doc_id", "text"), train(docs, labels))
    return rows.select("doc_id", "expected_grade", "tail_prob",
                       F.coalesce(F.col("tail_prob") >= KEEP_TAIL, F.lit(True)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, min_tail: float = KEEP_TAIL) -> DataFrame:
    """Stage: documents whose top grade is likelier than not."""
    grade, tail = free_name(docs, "_grade"), free_name(docs, "_tail")
    rows = rate(docs, train(docs, labels), grade, tail)
    return rows.where(F.coalesce(F.col(tail) >= min_tail, F.lit(True))).select(*docs.columns)
