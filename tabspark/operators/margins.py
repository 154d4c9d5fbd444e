"""Linear machines with a margin: hinge terms smoothed step by step, minimised by Newton steps from weighted moments.

The objective is alpha / 2 |w|^2 + c t + mean of h(u) over the rows, h(u) = max(0, u), where every u
is linear in the coefficients, the intercept and, for the nu machines, a free margin or tube width t:

====================  =============================  =====================
loss                  u                              c
====================  =============================  =====================
hinge                 1 - y f                        0
epsilon_insensitive   f - y - e and y - f - e        0
nu_hinge              t - y f                        -nu
nu_insensitive        f - y - t and y - f - t        nu
====================  =============================  =====================

h is replaced by a quadratic within ``width`` of its kink; the width shrinks until it
is ``WIDTHS[-1]`` of the scale of f. One evaluation of value, gradient and second derivatives is
one pass, whose result has (p + 2)(p + 3) / 2 numbers for each partition.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabspark.functions.scalar import dbl, dot
from tabspark.operators import gram as G
from tabspark.operators.quantiles import exact_quantiles

log = logging.getLogger(__name__)

#: Smoothing widths in turn, as shares of the scale of the decision values; Newton steps for each.
WIDTHS, STEPS = (0.5, 0.05, 0.005), 50
#: A gain this small against the value ends a width; times a step is damped before it is given up.
TOLERANCE, ATTEMPTS = 1e-8, 12
#: Numbers a partition should have at least, and partitions whose sums go to the driver as they are.
CELLS, DIRECT = 2_000_000, 64


@dataclass(frozen=True)
class Machine:
    """A fitted machine: coefficients on the original scale, the margin or tube, and the gap to a dual value."""

    coef: np.ndarray
    intercept: float
    margin: float
    objective: float
    gap: float
    passes: int


def _terms(loss: str, x: np.ndarray, y: np.ndarray, f: np.ndarray, t: float, e: float):
    """(u, derivative of u by (w, b, t) as (sign of each row, derivative by t)) of every term."""
    if loss == "hinge":
        return [(1.0 - y * f, -y, 0.0)]
    if loss == "nu_hinge":
        return [(t - y * f, -y, 1.0)]
    width, d = (t, -1.0) if loss == "nu_insensitive" else (e, 0.0)
    one = np.ones(len(y))
    return [(f - y - width, one, d), (y - f - width, -one, d)]


def _pass(data: DataFrame, parts: int, loss: str, theta: np.ndarray, width: float, e: float, p: int) -> tuple[dict, np.ndarray, np.ndarray]:
    """({value, exact value, dual sum, weight, square of f}, gradient, second derivatives) of the loss, by (w, b, t)."""
    d = p + 2
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, grad, hess = np.zeros(5), np.zeros(d), np.zeros((d, d))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            f = x @ theta[:p] + theta[p]
            head[3] += w.sum()
            head[4] += w @ (f * f)
            for u, sign, by_t in _terms(loss, x, y, f, theta[p + 1], e):
                inside = np.abs(u) <= width
                slope = np.where(inside, (u + width) / (2 * width), (u > 0).astype(float))
                head[0] += w @ np.where(inside, (u + width) ** 2 / (4 * width), np.maximum(u, 0.0))
                head[1] += w @ np.maximum(u, 0.0)
                a = w * slope
                head[2] += a @ ((1.0 if loss == "hinge" else 0.0) + (sign < 0) * (y if "insensitive" in loss else 0.0)
                                - (sign > 0) * (y if "insensitive" in loss else 0.0) - (e if loss == "epsilon_insensitive" else 0.0))
                grad[:p] += x.T @ (a * sign)
                grad[p] += a @ sign
                grad[p + 1] += by_t * a.sum()
                k = inside & (w > 0)
                if k.any():
                    z = np.column_stack([x[k] * sign[k, None], sign[k], np.full(k.sum(), by_t)])
                    hess += z.T @ (z * (w[k] / (2 * width))[:, None])
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([head, grad, hess[upper]])], pa.list_(pa.float64()))], names=["v"])

    sums = data.select("x", "y", "w").mapInArrow(run, "v array<double>")
    total = np.zeros(5 + d + len(upper[0]))
    if parts <= DIRECT:
        for r in sums.collect():
            total += r["v"]
    else:
        for r in sums.select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect():
            total[r["at"]] = r["v"]
    hess = np.zeros((d, d))
    hess[upper] = total[5 + d:]
    n = total[3]
    return (dict(zip(("value", "exact", "dual", "weight", "square"), [*(total[:3] / n), n, total[4] / n])), total[5:5 + d] / n,
            (hess + hess.T - np.diag(np.diag(hess))) / n)


def fit(df: DataFrame, features: list[str], label: str, loss: str, alpha: float, nu: float | None = None, epsilon: float = 0.1,
        weight: str | None = None, fit_intercept: bool = True) -> Machine:
    """Minimise the objective; for classes the label is positive or not. Rows with a null or NaN take no part."""
    classes = loss in ("hinge", "nu_hinge")
    p, free = len(features), loss.startswith("nu_")
    g = G.gram(df, [*features, label])
    mean = g.mean[:p] if fit_intercept else np.zeros(p)
    target = F.when(dbl(label) > 0, 1.0).otherwise(-1.0) if classes else dbl(label)
    good = F.lit(True)
    for c in (*features, label):
        good = good & dbl(c).isNotNull() & ~F.isnan(dbl(c))
    x = F.array(*[dbl(c) - F.lit(float(m)) for c, m in zip(features, mean)])
    data = df.filter(good).select(x.alias("x"), target.alias("y"), (F.col(weight) if weight else F.lit(1.0)).alias("w"))
    parts = min(data.rdd.getNumPartitions(), max(1, -(-int(g.n) * (p + 2) // CELLS)))
    data = data.coalesce(parts).persist()
    if loss == "nu_hinge":
        share = {r["y"]: r["n"] for r in data.groupBy("y").agg(F.sum("w").alias("n")).collect()}
        most = 2 * min(share.get(1.0, 0.0), share.get(-1.0, 0.0)) / max(sum(share.values()), 1e-300)
        if not 0 < nu <= most:
            data.unpersist()
            raise ValueError(f"nu {nu} is infeasible: at most {most:.4f} here")
    # a start: least squares, and a margin or tube of its size
    ls = G.least_squares(g, features, label, 1e-6 * float(np.trace(g.scatter[:p, :p])) / p, fit_intercept)
    theta = np.zeros(p + 2)
    theta[:p] = ls.coef
    centre = float(g.mean[p])
    theta[p] = (centre if fit_intercept else 0.0)
    if classes:
        theta[:p + 1] = 0.0
    theta[p + 1] = 0.0 if not free or classes else float(np.sqrt(ls.rss / max(g.n, 1)))
    lin = np.zeros(p + 2)
    if free:
        lin[p + 1] = -nu if classes else nu
    held = [*range(p), *([p] if fit_intercept else []), *([p + 1] if free else [])]
    ridge = np.zeros(p + 2)
    ridge[:p] = alpha
    spread = float(np.sqrt(g.scatter[p, p] / g.n)) or 1.0
    passes = 0

    def at(theta, width):
        nonlocal passes
        passes += 1
        stats, grad, hess = _pass(data, parts, loss, theta, width, epsilon, p)
        return stats["value"] + lin @ theta + 0.5 * ridge @ (theta * theta), grad + lin + ridge * theta, hess + np.diag(ridge), stats

    scale = 1.0 if classes else spread
    for share in WIDTHS:
        value, grad, hess, stats = at(theta, share * scale)
        size = np.sqrt(stats["square"])
        if loss == "nu_hinge" and size > 0:  # the margin, and with it the scale, is free
            scale = size
            value, grad, hess, stats = at(theta, share * scale)
        damp = 0.0
        for _ in range(STEPS):
            h = hess[np.ix_(held, held)]
            unit = max(float(np.diag(h).max()), 1e-12)
            for attempt in range(ATTEMPTS):
                step = np.zeros(p + 2)
                step[held] = np.linalg.solve(h + np.eye(len(held)) * unit * max(damp, 1e-10), grad[held])
                gain = float(grad[held] @ step[held])
                new = at(theta - step, share * scale)
                if new[0] <= value - 1e-4 * gain:
                    break
                damp = max(30 * damp, 1e-8)
            else:
                gain = 0.0  # no way down that can be told from rounding
            if gain <= TOLERANCE * max(abs(value), 1e-12):
                break
            theta, damp = theta - step, damp / 100 if damp > 1e-8 else 0.0
            value, grad, hess, stats = new
        else:
            log.warning("%s: no convergence at width %s", loss, share)
    if loss == "nu_hinge" and value >= 0:
        log.warning("nu %s is too small for these classes: no margin is left", nu)
    coef = theta[:p].copy()
    intercept = float(theta[p] - coef @ mean)
    # a dual value from the slopes, which are multipliers between 0 and 1; exact where the intercept's gradient is 0
    push = (grad - lin - ridge * theta)[:p]
    dual = stats["dual"] - (push @ push) / (2 * alpha) if alpha > 0 else float("nan")
    primal = stats["exact"] + lin @ theta + 0.5 * alpha * coef @ coef
    margin = float(theta[p + 1])
    if free:
        # the margin that belongs to these coefficients: an exact quantile of the decision values or residuals
        f = dot([F.col("x")[i] for i in range(p)], coef) + F.lit(float(theta[p]))
        value_of = F.col("y") * f if classes else F.abs(F.col("y") - f)
        margin = exact_quantiles(data, {"m": value_of}, [nu if classes else 1.0 - nu])["m"][0]
    data.unpersist()
    return Machine(coef, intercept, margin, float(primal), float(primal - dual), passes)
