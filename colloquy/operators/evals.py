"""Evaluation-result analytics: P5, P7, J1-J4, U2, U3, A9-A16, A19, W2, W3,
W5, T4, T5, S13 (shape only).

Scores are long tables ``(model, task, score)``. Per-task statistics are
partial aggregates joined back on ``task`` (AQE broadcasts the tiny side
at run time), never a window that sorts a whole task in one partition.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.poly import centre_aggs, moment_aggs, poly_coefficients, poly_eval
from colloquy.operators.indexing import dense_index


# ----------------------------------------------------------------- P5, U3
_SPEC = re.compile(r"(?P<without>except:)?(?P<names>.*)", re.S)


def parse_task_spec(spec: str) -> tuple[bool, set[str] | None]:
    """``all`` | ``a,b`` | ``except:a,b`` -> (excluding, lower-case names or None for all).

    ``except:`` counts only in lower case; names are not trimmed.
    """
    m = _SPEC.fullmatch(spec)
    names = set(m["names"].lower().split(","))
    return m["without"] is not None, None if names == {"all"} else names


def select_tasks(catalogue: DataFrame, spec: str, name: str = "name") -> DataFrame:
    """P5: filter a task dimension by a task spec; a name that the catalogue
    lacks raises (the names of the spec bound what is looked up)."""
    excluding, names = parse_task_spec(spec)
    if names is None:
        return catalogue.limit(0) if excluding else catalogue
    hit = F.lower(F.col(name)).isin(sorted(names))
    unknown = names - {r[0] for r in catalogue.where(hit).select(F.lower(F.col(name))).distinct().collect()}
    if unknown:
        raise ValueError(f"no such task: {', '.join(sorted(unknown))}")
    return catalogue.where(~hit if excluding else hit)


def task_difference(catalogue: DataFrame, excluded: DataFrame, name: str = "name") -> DataFrame:
    """All tasks except the ones in ``excluded`` (anti join, case-insensitive)."""
    ex = excluded.select(F.lower(F.col(name)).alias("_ex"))
    return catalogue.join(ex, F.lower(catalogue[name]) == ex["_ex"], "left_anti")


# ----------------------------------------------------------------- P7, U2, A19
def valid_results(store: DataFrame, score: str = "score", seconds: str = "seconds") -> DataFrame:
    """Keep results that carry both a score and a time."""
    return store.where(F.col(score).isNotNull() & F.col(seconds).isNotNull())


def upsert_results(old: DataFrame, new: DataFrame, keys: Sequence[str], version) -> DataFrame:
    """Key overwrite, the row with the highest ``version`` wins.

    ``max_by`` pre-aggregates per key on every mapper, so a hot key costs
    one row per partition in the shuffle.
    """
    keys = list(keys)
    both = old.unionByName(new, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    ver = F.col(version) if isinstance(version, str) else version
    ver = F.struct(ver.isNotNull(), ver)  # a row without a version loses to any other, but is not lost
    return (both.groupBy(*keys).agg(F.max_by(F.struct(*rest), ver).alias("_row"))
            .select(*keys, "_row.*"))


def count_models(store: DataFrame, model: str = "model_name") -> DataFrame:
    """Number of models in the store."""
    return store.agg(F.countDistinct(model).alias("total_models"))


# ----------------------------------------------------------------- J1, J2
def _task_rows(tasks: Sequence[str], score: Column | None = None) -> Column:
    return F.array(*[F.lit(t) for t in tasks])


def wide_scores(results: DataFrame, tasks: Sequence[str], model: str = "model", task: str = "task",
                score: str = "score", fill: float = 0.0) -> DataFrame:
    """S13 shape: one row per model, one column per task, absent score = ``fill``.

    One conditional aggregate per task of the known list: a single partial
    aggregation by model (a ``pivot`` would aggregate by (model, task) first).
    """
    wide = _by_task(results, tasks, model, task, score)
    return wide.na.fill(fill, subset=list(tasks))


def _by_task(results: DataFrame, tasks: Sequence[str], model: str, task: str, score: str) -> DataFrame:
    return results.groupBy(model).agg(*[
        F.first(F.when(F.col(task) == t, F.col(score)), ignorenulls=True).alias(t) for t in tasks])


def score_matrix(results: DataFrame, models: DataFrame, tasks: Sequence[str], model: str = "model",
                 task: str = "task", score: str = "score") -> DataFrame:
    """For every (model, task) the stored score or 0.0; unknown model -> zeros.

    One row per model with a column per listed task (conditional
    aggregates), left join from the model dimension, unpivot: the output has
    |models| x |tasks| rows and no cross join is planned.
    """
    wide = _by_task(results, tasks, model, task, score)
    m = models.select(model).distinct().join(wide, model, "left")
    cells = F.array(*[F.struct(F.lit(t).alias(task),
                               F.coalesce(F.col(f"`{t}`").cast("double"), F.lit(0.0)).alias(score))
                      for t in tasks])
    return m.select(model, F.inline(cells))


def pending_work(models: DataFrame, tasks: Sequence[str], results: DataFrame, model: str = "model",
                 task: str = "task", recalc: bool = False) -> DataFrame:
    """(model, task) pairs with no stored result, or all pairs when ``recalc``."""
    pairs = models.select(model).distinct().select(model, F.explode(_task_rows(tasks)).alias(task))
    if recalc:
        return pairs
    return pairs.join(results.select(model, task), [model, task], "left_anti")


# ----------------------------------------------------------------- J3
def parse_model_args(margs: Sequence[str] | None) -> list[tuple[str, str]]:
    """``"pattern:args"`` list -> (pattern, args) by first mention; the args of
    one pattern are put together with blanks, in order."""
    rules = [m.partition(":") for m in margs or ()]
    if any(not colon for _, colon, _ in rules):
        raise ValueError("a model rule needs the form pattern:args")
    return [(pattern, " ".join(args for other, _, args in rules if other == pattern))
            for pattern in dict.fromkeys(r[0] for r in rules)]


def match_model_args(models: DataFrame, margs: Sequence[str] | DataFrame, path: str = "path",
                     name: str = "model_args") -> DataFrame:
    """Args of the first pattern (in given order) contained in the path; '' if none.

    A pattern list given as a parameter compiles to one CASE expression. A
    pattern table ``(ord, pattern, args)`` of any size is matched over the
    distinct paths by an index on each pattern's rarest gram.
    """
    if not isinstance(margs, DataFrame):
        expr = F.lit("")
        for pat, args in reversed(parse_model_args(margs)):
            expr = F.when(F.instr(F.col(path), pat) > 0, F.lit(args)).otherwise(expr)
        return models.withColumn(name, expr)
    listed = margs.select(F.col("ord").cast("long").alias("ord"), F.col("pattern"), F.col("args")).where("pattern is not null")
    pats = listed.groupBy("pattern").agg(  # equal patterns: their args in order, as in the list form
        F.min("ord").alias("ord"), F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("ord", "args"))), lambda x: x["args"]))
        .alias("args")).select("ord", "pattern", "args")
    hits = _match_by_grams(models.select(path).distinct(), pats, path, name)
    return (models.join(hits, path, "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(""))))


GRAM = 3


def _grams(text: str, size: Column) -> Column:
    """Distinct substrings of ``size`` characters."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.col(text).substr(i, size)))


def _match_by_grams(paths: DataFrame, pats: DataFrame, path: str, name: str) -> DataFrame:
    """(path, first-match args).

    A path is listed under its substrings of 1 to ``GRAM`` characters. A
    pattern is looked up under one of its own substrings of ``min(L, GRAM)``
    characters, the one that the fewest paths hold; if no path holds it, the
    pattern has no match. ``instr`` confirms what is found. An empty pattern
    is in every path and is applied as a constant (the smallest ``ord``).
    """
    size = F.least(F.length("pattern"), F.lit(GRAM))
    listed = (paths.select(path, F.explode(F.sequence(F.lit(1), F.least(F.length(path), F.lit(GRAM)))).alias("_k")).where("_k > 0")
              .select(path, "_k", F.explode(_grams(path, F.col("_k"))).alias("_g")))
    held = listed.groupBy("_k", "_g").agg(F.count(F.lit(1)).alias("_n"))
    own = pats.where(F.length("pattern") > 0).select("ord", "pattern", "args", size.alias("_k"), F.explode(_grams("pattern", size)).alias("_g"))
    rarest = (own.join(held, ["_k", "_g"], "left")
              .groupBy("ord", "pattern", "args").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_k", "_g")).alias("_r"))
              .where("_r.n > 0").select("ord", "pattern", "args", "_r._k", "_r._g"))
    cand = listed.join(rarest, ["_k", "_g"]).where(F.instr(F.col(path), F.col("pattern")) > 0).select(path, "ord", "args")
    empty = pats.where(F.length("pattern") == 0).agg(F.min_by("args", "ord").alias("_ea"),
                                                     F.min("ord").alias("_eo"))
    best = cand.groupBy(path).agg(F.min_by("args", "ord").alias("_a"), F.min("ord").alias("_o"))
    e = empty.first()  # a global aggregate: exactly one row
    out = paths.join(best, path, "left")
    if e["_eo"] is None:
        return out.select(path, F.col("_a").alias(name))
    pick = F.when(F.col("_o").isNull() | (F.lit(e["_eo"]) < F.col("_o")), F.lit(e["_ea"])).otherwise(F.col("_a"))
    return out.select(path, pick.alias(name))


# ----------------------------------------------------------------- J4, W2, W3
def task_stats(scores: DataFrame, task: str = "task", score: str = "score") -> DataFrame:
    return scores.groupBy(task).agg(F.max(score).alias("task_max"), F.min(score).alias("task_min"))


def with_task_stats(scores: DataFrame, task: str = "task", score: str = "score") -> DataFrame:
    """Per-task maximum and minimum beside every row (aggregate + join back)."""
    return scores.join(task_stats(scores, task, score), task)


def cap_normalise(scores: DataFrame, task: str = "task", score: str = "score") -> DataFrame:
    """``score * (100 / max)`` per task; untouched when ``max <= 0``."""
    s = with_task_stats(scores, task, score)
    v = F.when(F.col("task_max") > 0, F.col(score) * (F.lit(100.0) / F.col("task_max"))).otherwise(F.col(score))
    return s.withColumn(score, v).drop("task_max", "task_min")


def range_normalise(scores: DataFrame, task: str = "task", score: str = "score") -> DataFrame:
    """``100 * (v - min) / (max - min)``; untouched when ``max <= 0``; 0 when all equal."""
    s = with_task_stats(scores, task, score)
    r = F.coalesce(F.try_divide(F.lit(100.0) * (F.col(score) - F.col("task_min")),
                                F.col("task_max") - F.col("task_min")), F.lit(0.0))
    v = F.when(F.col("task_max") > 0, r).otherwise(F.col(score))
    return s.withColumn(score, v).drop("task_max", "task_min")


# ----------------------------------------------------------------- A9-A12, W5, T5
def task_winner(scores: DataFrame, model: str = "model", task: str = "task", score: str = "score",
                tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """Model with the highest score per task.

    Ties go to the first model in list order: ``tiebreak`` (e.g. size desc,
    path desc as ``[-size, ...]``) or model ascending.
    """
    order = [(-F.col(score)).alias("k0")]
    order += list(tiebreak) if tiebreak else [F.col(model).alias("k1")]
    return scores.groupBy(task).agg(F.min_by(F.col(model), F.struct(*order)).alias("winner"),
                                    F.max(score).alias("best_score"))


def normalised_score(matrix: DataFrame, model: str = "model", task: str = "task", score: str = "score",
                     n_tasks: int | None = None) -> DataFrame:
    """A10: mean over tasks of ``score / task max``; non-positive scores add 0.

    ``n_tasks`` counts every selected task (missing ones included); by
    default the rows per model of the zero-filled matrix.
    """
    s = matrix.join(task_stats(matrix, task, score).select(task, "task_max"), task)
    part = F.when(F.col(score) > 0, F.col(score) / F.col("task_max")).otherwise(F.lit(0.0))
    denom = F.lit(float(n_tasks)) if n_tasks else F.count(F.lit(1))
    return s.groupBy(model).agg((F.sum(part) / denom).alias("norm_score"))


def total_score(matrix: DataFrame, model: str = "model", score: str = "score") -> DataFrame:
    """Sum of (normalised) task scores per model."""
    return matrix.groupBy(model).agg(F.sum(score).alias("total_score"))


def model_time(results: DataFrame, model: str = "model", seconds: str = "seconds") -> DataFrame:
    """Seconds summed over tasks."""
    return results.groupBy(model).agg(F.sum(seconds).cast("long").alias("seconds"))


def rank_models(df: DataFrame, score: str, model: str = "model", name: str = "rank") -> DataFrame:
    """1-based rank by ``score`` descending, ties by model (distributed index)."""
    return dense_index(df, [F.desc(score), F.asc(model)], name).withColumn(name, F.col(name) + 1)


def order_by_size(models: DataFrame, size: str = "size", path: str = "path") -> DataFrame:
    """T4: size descending, ties by path descending."""
    return models.orderBy(F.desc(size), F.desc(path))


def leaderboard(matrix: DataFrame, tasks: Sequence[str], model: str = "model", task: str = "task",
                score: str = "score", digits: int = 9) -> DataFrame:
    """T5: rank, model, normalised aggregate and the per-task scores."""
    norm = normalised_score(matrix, model, task, score, n_tasks=len(tasks))
    norm = norm.withColumn("norm_score", F.round("norm_score", digits))
    wide = wide_scores(matrix, tasks, model, task, score)
    return rank_models(norm.join(wide, model), "norm_score", model)


# ----------------------------------------------------------------- A14-A16
def fit_by_group(points: DataFrame, group: Sequence[str], x: str, y: str, max_degree: int = 2) -> DataFrame:
    """Per-group least-squares coefficients of ``y`` on ``(x - x_mid) / x_scale``.

    Points without an x or y are left out. The others are first
    pre-aggregated to (group, x), combined map-side, so a hot group shrinks
    to its distinct x values; the group's mean and spread centre them (sizes
    that lie close together would cancel in power sums about zero), and the
    power sums are taken of the centred values.
    """
    group = list(group)
    if not group:
        points, group = points.withColumn("_all", F.lit(0)), ["_all"]
    points = points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    xy = (points.groupBy(*group, F.col(x).cast("double").alias("_x"))
          .agg(F.count(F.lit(1)).cast("double").alias("_w"), F.sum(F.col(y).cast("double")).alias("_sy")))
    frame = xy.groupBy(*group).agg(*centre_aggs(F.col("_x"), F.col("_w")))
    s = (F.col("_x") - F.col("x_mid")) / F.col("x_scale")
    moments = xy.join(frame, group).groupBy(*group, "x_mid", "x_scale").agg(*moment_aggs(s, F.col("_w"), F.col("_sy")))
    co = poly_coefficients(max_degree)
    return moments.select(*group, "x_mid", "x_scale", "m_n", co["degree"].alias("degree"),
                          co["c0"].alias("c0"), co["c1"].alias("c1"), co["c2"].alias("c2"))


def predict_time(points: DataFrame, targets: DataFrame, group: Sequence[str], x: str, y: str,
                 fallback: Column | None = None, max_degree: int = 2) -> DataFrame:
    """Predicted ``y`` at each target ``x``; fewer than 2 points -> ``fallback``.

    Coefficients are one row per group (joined back; AQE broadcasts them).
    """
    group = list(group)
    fits = fit_by_group(points, group, x, y, max_degree)
    t = targets.join(fits, group, "left")
    s = (F.col(x).cast("double") - F.col("x_mid")) / F.col("x_scale")
    poly = poly_eval([F.col("c0"), F.col("c1"), F.col("c2")], s, clamp=0.0)
    fb = fallback if fallback is not None else F.lit(1.0)
    pred = F.when((F.coalesce(F.col("m_n"), F.lit(0)) >= 2) & F.col(x).isNotNull(), poly).otherwise(fb)
    return t.withColumn("predicted", pred).drop("x_mid", "x_scale", "m_n", "degree", "c0", "c1", "c2")


def fallback_rate(points: DataFrame, x: str, y: str) -> Column:
    """Scalar ``Σy / Σx`` over the points that have both (NULL unless ``Σx > 0``)."""
    points = points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    sx, sy = F.sum(F.col(x).cast("double")), F.sum(F.col(y).cast("double"))
    return points.agg(F.when(sx > 0, sy / sx)).scalar()


def fallback_time(points: DataFrame, targets: DataFrame, x: str, y: str) -> DataFrame:
    """``Σ time / Σ size * target size``; 1.0 without data."""
    rate = fallback_rate(points, x, y)
    pred = F.coalesce(rate * F.col(x), F.lit(1.0))
    return targets.withColumn("predicted", pred)


def model_eta(models: DataFrame, tasks: Sequence[str], results: DataFrame, model: str = "model",
              task: str = "task", size: str = "size", seconds: str = "seconds") -> DataFrame:
    """Per model known seconds + predicted seconds; ``exact`` if all known.

    ``models`` carries (model, size); ``results`` (model, task, seconds), rows
    without a time do not count. Fits use only listed models with a size, per
    task; a model without a size gets 1.0 for each task it has no time of.
    """
    sized = models.select(model, size)
    pairs = sized.select(model, size, F.explode(_task_rows(tasks)).alias(task))
    known = results.select(model, task, F.col(seconds).cast("double").alias("_known")).where("_known is not null")
    points = known.join(sized.where(F.col(size).isNotNull()), model)
    rate = fallback_rate(points, size, "_known")
    fb = F.coalesce(rate * F.col(size), F.lit(1.0))
    pred = predict_time(points.select(task, size, "_known"), pairs, [task], size, "_known", fallback=fb)
    full = pred.join(known, [model, task], "left")
    return (full.groupBy(model)
            .agg(F.sum(F.coalesce(F.col("_known"), F.col("predicted"))).alias("eta_seconds"),
                 F.bool_and(F.col("_known").isNotNull()).alias("exact")))
