"""Least-squares polynomial fits from grouped power sums.

The fit needs only ``n, Σs, Σs², Σs³, Σs⁴, Σy, Σsy, Σs²y`` per group, all
partial aggregates, with ``s = (x - mean) / max |x - mean|`` so that sizes
close together keep their digits. The normal equations are solved in closed
form (Cramer's rule) as Column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def centre_aggs(x: Column, w: Column) -> list[Column]:
    """Mean (``x_mid``) and largest distance from it (``x_scale``, 1 when 0) of
    pre-aggregated points: one row per distinct ``x``, ``w`` points each."""
    mid = F.sum(w * x) / F.sum(w)
    far = F.greatest(F.max(x) - mid, mid - F.min(x))
    return [mid.alias("x_mid"), F.when(far > 0, far).otherwise(F.lit(1.0)).alias("x_scale")]


def moment_aggs(s: Column, w: Column, sy: Column) -> list[Column]:
    """Power sums in the centred ``s``; ``sy`` = sum of ``y`` of the points at ``s``."""
    return [F.sum(w).alias("m_n"), F.count(s).alias("m_distinct"),
            *[F.sum(w * F.pow(s, F.lit(float(k)))).alias(f"m_s{k}") for k in range(1, 5)],
            F.sum(sy).alias("m_t0"), F.sum(s * sy).alias("m_t1"), F.sum(s * s * sy).alias("m_t2")]


def _det3(a, b, c, d, e, f, g, h, i):
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


def poly_coefficients(max_degree: int = 2) -> dict[str, Column]:
    """Coefficients ``c0, c1, c2`` (in scaled x) and the degree used.

    degree = min(max_degree, distinct x - 1): 0 -> mean, 1 -> line, 2 -> parabola.
    """
    n, s1, s2, s3, s4 = (F.col(c).cast("double") for c in ("m_n", "m_s1", "m_s2", "m_s3", "m_s4"))
    t0, t1, t2 = F.col("m_t0"), F.col("m_t1"), F.col("m_t2")
    degree = F.least(F.lit(max_degree), F.col("m_distinct") - 1)
    # degree 1
    d1 = n * s2 - s1 * s1
    b1 = F.try_divide(n * t1 - s1 * t0, d1)
    a1 = (t0 - b1 * s1) / n
    # degree 2
    d = _det3(n, s1, s2, s1, s2, s3, s2, s3, s4)
    c0 = F.try_divide(_det3(t0, s1, s2, t1, s2, s3, t2, s3, s4), d)
    c1 = F.try_divide(_det3(n, t0, s2, s1, t1, s3, s2, t2, s4), d)
    c2 = F.try_divide(_det3(n, s1, t0, s1, s2, t1, s2, s3, t2), d)
    mean = t0 / n
    return {
        "degree": degree,
        "c0": F.when(degree >= 2, c0).when(degree == 1, a1).otherwise(mean),
        "c1": F.when(degree >= 2, c1).when(degree == 1, b1).otherwise(F.lit(0.0)),
        "c2": F.when(degree >= 2, c2).otherwise(F.lit(0.0)),
    }


def poly_eval(coeffs, x: Column, clamp: float | None = 0.0) -> Column:
    """M4: Horner evaluation, optionally clamped below at ``clamp``."""
    acc = None
    for c in reversed(list(coeffs)):
        c = F.col(c) if isinstance(c, str) else c
        acc = c if acc is None else acc * x + c
    return F.greatest(F.lit(clamp), acc) if clamp is not None else acc
