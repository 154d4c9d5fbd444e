"""Scalar special functions used on driver-side results (p-values, MLE steps)."""

from __future__ import annotations

import math


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b), by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_inc(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    frac = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            frac *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * frac / a


def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t."""
    if df <= 0 or math.isnan(t):
        return math.nan
    if math.isinf(t):
        return 0.0
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    """P(F >= f) for the F distribution."""
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def pearson_p(r: float, n: float) -> float:
    """Two-sided p-value of a Pearson correlation over n rows."""
    if n < 3 or math.isnan(r):
        return math.nan
    if abs(r) >= 1.0:
        return 0.0
    return t_two_sided(r * math.sqrt((n - 2.0) / (1.0 - r * r)), n - 2.0)


def digamma(x: float) -> float:
    out = 0.0
    while x < 8.0:
        out -= 1.0 / x
        x += 1.0
    y = 1.0 / (x * x)
    return out + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y / 240)))


def trigamma(x: float) -> float:
    out = 0.0
    while x < 8.0:
        out += 1.0 / (x * x)
        x += 1.0
    y = 1.0 / (x * x)
    return out + 1.0 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y / 30)))


def gamma_shape(mean: float, mean_log: float) -> float:
    """Maximum-likelihood gamma shape from the mean and the mean of logs."""
    s = math.log(mean) - mean_log
    k = (3 - s + math.sqrt((s - 3) ** 2 + 24 * s)) / (12 * s)
    for _ in range(50):
        step = (math.log(k) - digamma(k) - s) / (1.0 / k - trigamma(k))
        k = max(k - step, k / 10)
        if abs(step) < 1e-13 * k:
            break
    return k
