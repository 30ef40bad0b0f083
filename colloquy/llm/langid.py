"""Language identification (operator 4): multinomial naive Bayes over hashed
character n-grams.

Texts are lower-cased; every run of characters that are no letters becomes
one space; n-grams of 1 to 3 characters of the whole text are hashed into
``BUCKETS``. Training counts are taken in the tasks and summed by Spark per
(language, bucket); the smoothed log-probability matrix, at most
``MAX_LANGUAGES`` x ``BUCKETS`` numbers, is broadcast and texts are scored in
batches as sparse rows of bucket hits.

Defined results: only rows with a non-null language and text are learned
from; ``und`` with score 0 for a null text, one without letters, or when
nothing was learned; equal posteriors go to the first language by code point;
a null doc_id hashes like the empty text. More languages than
``MAX_LANGUAGES`` raise an error. Other columns pass through or are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import append_columns, crc32_bucket, free_name

BUCKETS = 1 << 15
MAX_N = 3
MAX_LANGUAGES = 1000
SMOOTHING = 0.5
CHARS_AT_ONCE = 500_000
MIN_SCORE = 0.5
#: Evidence a gram: the winner's mean log-probability may lie SLACK nats under the LOW_QUANTILE
#: of its training texts' own means, and must be MARGIN nats over that of the second language.
LOW_QUANTILE, SLACK, MARGIN = 0.05, 2.0, 0.1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of the text, bucket) arrays of all n-grams, order by order."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in lowered])
    letter = _letters()[codes]
    starts = np.r_[True, row[1:] != row[:-1]] if len(row) else np.empty(0, bool)
    keep = letter | np.r_[False, letter[:-1]][:len(letter)] & ~starts
    codes, row = np.where(letter, codes, np.uint32(32))[keep], row[keep]
    h = codes * np.uint32(0x9E3779B1)
    for n in range(1, MAX_N + 1):
        if n > 1:
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + codes[n - 1:] * np.uint32(0xC2B2AE35)
        same = slice(None) if n == 1 else row[:len(h)] == row[n - 1:]
        x = h[same]
        x = (x ^ (x >> np.uint32(13))) * np.uint32(0x27D4EB2F)
        yield row[:len(h)][same], (x >> np.uint32(17)).astype(np.int32)


def _parts(texts: list[str]) -> Iterator[list[int]]:
    """Row numbers in runs of about CHARS_AT_ONCE characters."""
    run, size = [], 0
    for i, t in enumerate(texts):
        run.append(i)
        size += len(t)
        if size >= CHARS_AT_ONCE:
            yield run
            run, size = [], 0
    if run:
        yield run


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: dict[str, np.ndarray] = {}
    for pdf in batches:
        for lang, texts in pdf.groupby("lang")["text"]:
            total = seen.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            texts = texts.tolist()
            total[BUCKETS] += len(texts)
            for run in _parts(texts):
                for _, bucket in _grams([texts[i] for i in run]):
                    total[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
    for lang, total in seen.items():
        at = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": total[at]})


class Model:
    """languages (sorted), log priors, log-probabilities (buckets x languages)."""

    def __init__(self, counts: pd.DataFrame):
        self.languages = sorted(counts["lang"].unique())
        table = np.zeros((BUCKETS + 1, len(self.languages)))
        table[counts["bucket"].to_numpy(), np.searchsorted(self.languages, counts["lang"].to_numpy())] = counts["n"]
        grams = table[:BUCKETS] + SMOOTHING
        self.log_p = np.log(grams / grams.sum(0)) if self.languages else grams
        self.log_prior = np.log(table[BUCKETS] / max(table[BUCKETS].sum(), 1)) if self.languages else table[BUCKETS]

    def _sums(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row of the text, log-likelihood per language, number of n-grams)."""
        shown = [i for i, t in enumerate(texts) if t]
        for run in _parts([texts[i] for i in shown]):
            at = np.array([shown[i] for i in run])
            total, size = np.zeros((len(at), len(self.languages))), np.zeros(len(at), np.int64)
            for row, bucket in _grams([texts[i] for i in at]):
                if not len(row):
                    continue
                first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                total[row[first]] += np.add.reduceat(self.log_p[bucket], first, axis=0)
                size[row[first]] += np.diff(np.r_[first, len(row)])
            yield at[size > 0], total[size > 0], size[size > 0]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        for at, total, _ in self._sums(texts):
            total = total + self.log_prior
            best = total.argmax(1)
            post = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
            for i, b, p in zip(at, best, post):
                names[i], scores[i] = self.languages[b], float(p)
        return names, scores

    def told(self, texts: list[str | None], floors: dict[str, float], min_score: float) -> list[bool]:
        """Whether the language is told with confidence: by the posterior, and
        by the evidence a gram, which does not grow with the text."""
        out = [False] * len(texts)
        if not self.languages:
            return out
        least = np.array([floors.get(k, np.inf) for k in self.languages])
        for at, total, size in self._sums(texts):
            best = (total + self.log_prior).argmax(1)
            post = 1 / np.exp(total + self.log_prior - (total + self.log_prior).max(1, keepdims=True)).sum(1)
            mean, rows = total / size[:, None], np.arange(len(at))
            own = mean[rows, best]
            mean[rows, best] = -np.inf
            sure = (post >= min_score) & (own >= least[best] - SLACK) & (own - mean.max(1) >= MARGIN)
            for i, ok in zip(at, sure):
                out[i] = bool(ok)
        return out

    def own_means(self, texts: list[str], langs: list[str]) -> list[float | None]:
        """Mean log-probability a gram of each text in its own language."""
        out = [None] * len(texts)
        for at, total, size in self._sums(texts):
            col = np.searchsorted(self.languages, [langs[i] for i in at])
            for i, v in zip(at, total[np.arange(len(at)), col] / size):
                out[i] = float(v)
        return out


def train(df: DataFrame) -> Model:
    """Fit on all rows of ``df`` (text, lang) with both non-null."""
    rows = df.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    counts = (rows.mapInPandas(_count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    # one bucket holds the number of texts, so the bound is checked on real counts
    got = counts.limit((BUCKETS + 1) * MAX_LANGUAGES + 1).toPandas()
    if got["lang"].nunique() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return Model(got)


def identify(df: DataFrame, model: Model, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the predicted language and its posterior, from text alone."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return append_columns(df, lambda texts: shared.value.predict(texts), f"`{pred}` string, `{score}` double")


def held_out(docs: DataFrame):
    return crc32_bucket(docs["doc_id"], 5) == 0


def op4_query(docs: DataFrame) -> DataFrame:
    model = train(docs.where(~held_out(docs)).select("text", "lang"))
    rows = docs.select("doc_id", held_out(docs).alias("held_out"), "text")
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def floors(df: DataFrame, model: Model) -> dict[str, float]:
    """Per language the LOW_QUANTILE of the means of all its texts in ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for s in range(0, len(pdf), 512):
                lang = pdf["lang"].iloc[s:s + 512].tolist()
                yield pd.DataFrame({"lang": lang, "mean": pd.Series(shared.value.own_means(pdf["text"].iloc[s:s + 512].tolist(), lang), dtype=float)})

    rows = df.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    means = rows.mapInPandas(run, "lang string, mean double").where("mean is not null and not isnan(mean)")
    return {r.lang: r.low for r in means.groupBy("lang").agg(F.percentile_approx("mean", LOW_QUANTILE).alias("low")).collect()}


def keep_known(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Stage: documents whose language is told with some confidence. Noise and
    languages that were not learned are left out, as are texts without letters;
    when nothing was learned every text is ``und`` and none stays."""
    learned = docs.where(~held_out(docs)).select("text", "lang")
    model = train(learned)
    if not model.languages:
        return docs.limit(0)
    least = floors(learned, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    told = free_name(docs, "_told")
    found = append_columns(docs, lambda texts: [shared.value.told(texts, least, min_score)], f"`{told}` boolean")
    return found.where(F.col(told)).select(*docs.columns)
