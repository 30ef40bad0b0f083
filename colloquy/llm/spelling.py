"""Spelling variants of the words of a corpus (operator 11).

1. Runs of letters are counted over all texts; words below the limits go.
2. Two words that differ by one inserted, deleted or replaced code point
   share their first letters or their last ones. With L the length of the
   longer one and a = (L - 1) // 2, the place of the edit lies before or
   behind position a, so either the first a or the last L - a letters agree.
   A word of length l therefore joins the groups of its prefix and its
   suffix for L = l and for L = l + 1; a group splits into blocks of bounded
   size, and blocks meet in pairs.
3. Inside a block pair, one side is a bit-sliced index: for every (position,
   letter) the set of words with that letter there, as bits of an integer.
   One pass over the letters of a word keeps the set of words without an
   error so far and the set with one error, at the same position (replaced),
   one behind (a letter of the word is missing there) or one ahead (a letter
   is missing in the word); every step handles all words of the block.
4. Counts, the near word of largest n and the chain of forms are aggregates
   and joins on words.

Defined results: a null, empty or letterless text has no runs; a null doc_id
is written as nothing; rows that repeat a doc_id count like others; of near
words with equal n the smallest in code-point order is taken; the length of
runs and words is not limited; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import cut, stored
from colloquy.llm.linededup import LOWER, UPPER
from colloquy.llm.runs import blocks, unit_runs

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10      # a form is at least so many times as frequent
DAMAGED = 31    # of so many (document, run) pairs, one loses a letter
BLOCK = 2048    # words of a group indexed at once
GROUP = ["longer", "side", "affix"]

_NEAR = "word string, n_near long, best_n long, best string"


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damaged: int = DAMAGED) -> DataFrame:
    """(word, n): runs of letters after the damage, over all texts."""
    pattern = rf"[A-Za-zÀ-ÿ]{{{min_length},}}"  # a shorter run cannot become a word
    runs = docs.select(F.col("doc_id"), F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    runs = runs.select("run", F.crc32(named.cast("binary")).alias("h"))
    size = F.char_length("run")
    at = (F.col("h") % size).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, size))
    word = F.when(F.col("h") % damaged == 0, shorter).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).where(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _members(words: DataFrame) -> DataFrame:
    """Every word in the groups where a near word can meet it."""
    size = F.char_length("word")
    spans = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("longer"))
    a = F.floor((F.col("longer") - 1) / 2).cast("int")
    tail = F.col("longer") - a
    sides = F.array(F.struct(F.lit(0).alias("side"), F.substring("word", F.lit(1), a).alias("affix")),
                    F.struct(F.lit(1).alias("side"), F.col("word").substr(F.char_length("word") - tail + 1, tail).alias("affix")))
    return spans.select("word", "n", "longer", F.explode(sides).alias("_s")).select("word", "n", "longer", "_s.side", "_s.affix")


class BitSlices:
    """Bit sets over a list of words: ``at[p, c]`` those with letter c at
    position p, ``sized[l]`` those of length l. Long words come first, so sets of far positions stay short."""

    def __init__(self, words: list[str], counts: list[int]):
        order = sorted(range(len(words)), key=lambda k: -len(words[k]))
        self.words, self.counts = [words[k] for k in order], [counts[k] for k in order]
        self.all = (1 << len(words)) - 1
        self.at: dict = {}
        self.sized: dict[int, int] = {}
        at, sized = self.at, self.sized
        for k, word in enumerate(self.words):
            bit = 1 << k
            sized[len(word)] = sized.get(len(word), 0) | bit
            for key in enumerate(word):
                at[key] = at.get(key, 0) | bit

    def near(self, word: str, longer: int, side: int) -> int:
        """Words of the group (longer, side) that are one edit from ``word``.

        Its first letters (side 0) or last ones (side 1) are equal throughout
        the group, so only the other positions are walked; pairs that agree in
        both parts are left to side 0."""
        at, size = self.at, len(word)
        a = (longer - 1) // 2
        low, high = (a, size) if side == 0 else (0, a)
        exact, changed, fewer, more = self.all, 0, 0, 0
        if size == longer:  # words of this length with a letter replaced, or one letter shorter
            for i in range(low, high):
                c = word[i]
                same = at.get((i, c), 0)
                fewer = fewer & at.get((i - 1, c), 0) | exact
                changed = changed & same | exact & ~same
                exact &= same
                if not (exact or changed or fewer):
                    return 0
            found = changed & self.sized.get(size, 0) | fewer & self.sized.get(size - 1, 0)
        else:               # words one letter longer
            for i in range(low, high):
                c = word[i]
                more = (more | exact) & at.get((i + 1, c), 0)
                exact &= at.get((i, c), 0)
                if not (exact or more):
                    return 0
            if side == 0:
                more |= exact  # the extra letter is the last one
            found = more & self.sized.get(longer, 0)
        return found & ~exact if side else found


def _near_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of every unit (two blocks of a group), per word: near words of the
    other block, the one of largest n."""
    for frame in unit_runs(batches, GROUP + ["_i", "_j"]):
        out = []
        names = ["word", "n", "longer", "side", "_i", "_j", "_c"]
        word, n, longer, side, i, j, c = (frame[x].tolist() for x in names)
        keys = list(zip(longer, side, frame["affix"].tolist(), i, j))
        start = 0
        while start < len(keys):
            stop = start + 1
            while stop < len(keys) and keys[stop] == keys[start]:
                stop += 1
            rows = range(start, stop)
            parts = [list(rows)] if i[start] == j[start] else [[r for r in rows if c[r] == b] for b in (i[start], j[start])]
            for index, asked in ([(parts[0], parts[0])] if len(parts) == 1 else [(parts[0], parts[1]), (parts[1], parts[0])]):
                if not index or not asked or len(rows) < 2:
                    continue
                slices = BitSlices([word[r] for r in index], [n[r] for r in index])
                for r in asked:
                    hits = slices.near(word[r], longer[r], side[r])
                    if hits:
                        count, best = 0, None
                        while hits:
                            k = (hits & -hits).bit_length() - 1
                            hits &= hits - 1
                            count += 1
                            rank = (-slices.counts[k], slices.words[k])
                            best = rank if best is None or rank < best else best
                        out.append((word[r], count, -best[0], best[1]))
            start = stop
        if out:
            yield pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for words with a near word. ``words``:
    distinct ``word`` of at least 7 code points and their ``n``."""
    units = blocks(_members(words), GROUP, "word", BLOCK).select("word", "n", *GROUP, "_i", "_j", "_c")
    partial = units.mapInPandas(_near_words, _NEAR)
    top = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return (partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("_t"))
            .select("word", "n_near", (-F.col("_t.m")).alias("best_n"), F.col("_t.w").alias("best")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form. A chain's counts grow ``RATIO``-fold
    at every step, so it has at most 18 of them and no circle; the reach
    doubles each round."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        now = cut(now.join(onward, F.col("root") == F.col("_w"), "left")
                  .select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("_moved")))
        moved = now.where("_moved").limit(1).count()
        now = now.drop("_moved")
        if not moved:
            return now


def spelling_groups(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the corpus."""
    words = stored(word_counts(docs), "words")
    near = near_words(words)
    told = stored(words.join(near, "word", "left").withColumn("_form", F.col("best_n") >= F.col("n") * ratio)
                  .select("word", F.when(F.col("_form"), F.col("best")).alias("form"), "n",
                          F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("_form"), F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(told.where("form is not null"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_query(docs: DataFrame) -> DataFrame:
    return spelling_groups(docs)


# crc32 byte by byte over a table of 256 remainders; letters up to U+00FF take one or two bytes of UTF-8
OP11_SQL = r"""
WITH RECURSIVE
poly AS (SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], [0,0,0,0,0,0,0,0]),
           lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS tbl),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
seen AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
bytes AS (
  SELECT run, k, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
      lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT]
                     ELSE [192 + (unicode(s) >> 6)::BIGINT, 128 + (unicode(s) & 63)::BIGINT] END)) AS b FROM seen),
hashed AS (
  SELECT run, k, xor(list_reduce(list_concat([4294967295::BIGINT], b),
      lambda c, x: xor(c >> 8, poly.tbl[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, poly),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                   ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
cuts AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS d
         FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS p FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.p = b.p AND a.d = b.d AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON w.word = c.d
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON w.word = c.d),
best AS (SELECT word, count(*)::BIGINT AS n_near, max(other_n) AS top FROM near GROUP BY word),
told AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.top >= 10 * w.n THEN b.top END AS form_n,
         CASE WHEN b.top >= 10 * w.n THEN (SELECT min(x.other) FROM near x WHERE x.word = w.word AND x.other_n = b.top) END AS form
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
  SELECT word, word AS here, 0 AS step FROM told
  UNION ALL
  SELECT c.word, t.form, c.step + 1 FROM chain c JOIN told t ON t.word = c.here WHERE t.form IS NOT NULL),
roots AS (SELECT word, arg_max(here, step) AS root FROM chain GROUP BY word)
SELECT t.word, t.form, r.root, t.n, t.n_near, t.form_n FROM told t JOIN roots r ON r.word = t.word
"""
