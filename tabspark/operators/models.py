"""Estimator catalogue: one interface over moment fits, Spark ML and gradient fits.

``estimator(name, features, label, params).fit(df).transform(df)`` adds a double
``prediction`` column, plus ``score`` (probability or margin of the positive
class) for two-class classifiers.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as mlc
from pyspark.ml import regression as mlr
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tabspark.functions.scalar import dbl, dot, ident
from tabspark.operators import gram as G
from tabspark.operators import margins
from tabspark.operators import reduce as R
from tabspark.operators.fitted import Fitted, kind
from tabspark.operators.profile import class_weights

log = logging.getLogger(__name__)

MAX_CLASSES = 1_000
#: Passes without this relative gain after which a fit of a loss with kinks ends.
PATIENCE, GAIN = 10, 1e-3
#: Bins of a feature in boosted trees, values of a feature that are counted one by one, and cells in a partition.
TREE_BINS, TREE_VALUES, TREE_ROWS = 32, 10_000, 20_000
TREE = "__tree_"


@dataclass
class Spec:
    name: str
    features: list[str]
    label: str
    params: dict
    builder: object

    def fit(self, df: DataFrame) -> Fitted:
        return self.builder(df, self.features, self.label, dict(self.params))


def balanced(df: DataFrame, label: str, params: dict) -> tuple[DataFrame, str | None]:
    """Adds the balanced weight column when asked for."""
    if params.get("class_weight") != "balanced":
        return df, None
    rows = class_weights(df, label).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has over {MAX_CLASSES} classes")
    w = None
    for r in rows:
        cond = F.col(ident(label)) == F.lit(r[0])
        w = F.when(cond, r[1]) if w is None else w.when(cond, r[1])
    return df.withColumn("__w", w), "__w"


# --- moment-based linear models ---------------------------------------------------------

@kind("linear")
def _linear(df, s):
    f = dot([dbl(c) for c in s["features"]], s["coef"]) + F.lit(s["intercept"]) if s["features"] else F.lit(s["intercept"])
    if not s["margin"]:
        return df.withColumn("prediction", f)
    return df.withColumn("score", f).withColumn("prediction", F.when(F.col("score") > 0, 1.0).otherwise(0.0))


def linear_model(fit: G.LinearFit, margin: bool = False) -> Fitted:
    """A linear function of the features; with ``margin`` its sign is the class."""
    return Fitted("linear", {"features": list(fit.features), "coef": np.asarray(fit.coef, float), "intercept": float(fit.intercept),
                             "margin": margin}, {"fit": fit})


def from_moments(g, features, label, params) -> Fitted:
    fit = G.least_squares if not params.get("positive") else G.positive_least_squares
    return linear_model(fit(g, features, label, float(params.get("alpha", 0.0)), params.get("fit_intercept", True)))


def fit_least_squares(df, features, label, params):
    return from_moments(G.gram(df, [*features, label]), features, label, params)


def fit_ridge(df, features, label, params):
    return fit_least_squares(df, features, label, {"alpha": 1.0, **params})


def fit_ridge_classifier(df, features, label, params):
    """Ridge on -1/+1 targets, class by sign."""
    weighted, w = balanced(df, label, params)
    signed = weighted.withColumn("__y", F.when(dbl(label) > 0, 1.0).otherwise(-1.0))
    alpha, icpt = float(params.get("alpha", 1.0)), params.get("fit_intercept", True)
    if w is None:
        fit = G.least_squares(G.gram(signed, [*features, "__y"]), features, "__y", alpha, icpt)
    else:
        # Per-class moments carry the weights: scale and add them.
        parts = G.grams_by(signed, [*features, "__y"], "__y")
        total = sum(p.n for p in parts.values())
        scaled = []
        for p in parts.values():
            f = total / (len(parts) * p.n)
            scaled.append(G.Gram(p.names, p.n * f, p.shift, p.s1 * f, p.s2 * f))
        fit = G.least_squares(G.sum_grams(scaled), features, "__y", alpha, icpt)
    return linear_model(fit, margin=True)


# --- Spark ML models ------------------------------------------------------------------------

@kind("spark")
def _spark(df, s):
    model = s["model"]
    out = model.transform(df)
    if hasattr(model.stages[-1], "getProbabilityCol"):
        out = out.withColumn("score", vector_to_array("probability")[1])
    elif hasattr(model.stages[-1], "getRawPredictionCol"):
        out = out.withColumn("score", vector_to_array("rawPrediction")[1])
    return out.drop("__features", "rawPrediction", "probability", *[c for c in out.columns if c.startswith(TREE)])


def _spark_fit(df, features, label, stage, weight=None):
    stage.setFeaturesCol("__features").setLabelCol("__label").setPredictionCol("prediction")
    if weight:
        stage.setWeightCol(weight)
    data = df.withColumn("__label", dbl(label))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="__features"), stage])
    model = pipe.fit(data)
    return Fitted("spark", {"model": model}, {"model": model})


def fit_lasso(df, features, label, params):
    return _spark_fit(df, features, label, mlr.LinearRegression(
        regParam=float(params.get("alpha", 1.0)), elasticNetParam=1.0, standardization=False,
        fitIntercept=params.get("fit_intercept", True), maxIter=int(params.get("max_iter", 100))))


def _glm(family):
    """Mean half deviance plus alpha / 2 |w|^2.

    The solver divides the penalty by the sum of its working weights instead of the
    row count, so it is given alpha times rows / weights, repeated until the weights
    of the fit agree with those it was given. The logarithm of what a fit asks for is
    nearly linear in that of what it was given: after two fits the next goes to the
    crossing of their secant.
    """
    def fit(df, features, label, params):
        alpha, power = float(params.get("alpha", 1.0)), {"poisson": 1.0, "gamma": 2.0}.get(family, float(params.get("power", 0.0)))
        log_link = params.get("link", "log") == "log" or (params.get("link") == "auto" and power > 0)
        if not alpha or (power == 2.0 and log_link) or (power == 0.0 and not log_link):
            return once(df, features, label, params)
        # the columns of the fits, read 25 times at most
        data = df.select(*[dbl(c).alias(c) for c in dict.fromkeys([*features, label])]).persist()
        given, tried = alpha, []
        for _ in range(25):
            model = once(data, features, label, {**params, "alpha": given})
            mu = F.col("prediction")
            weight = model.transform(data).agg(F.avg(F.pow(mu, F.lit((2.0 if log_link else 0.0) - power)))).first()[0]
            want = alpha / weight
            if abs(want - given) <= 1e-8 * want:
                break
            tried.append((math.log(given), math.log(want / given)))
            given = want
            if len(tried) > 1 and tried[-1][1] != tried[-2][1]:
                (x0, f0), (x1, f1) = tried[-2:]
                step = -f1 * (x1 - x0) / (f1 - f0)
                # beyond a plain step's reach the secant is not trusted
                if abs(step) <= 10 * abs(f1):
                    given = math.exp(x1 + step)
        data.unpersist()
        return model

    def once(df, features, label, params):
        link = params.get("link", "log")
        args = dict(regParam=float(params.get("alpha", 1.0)), maxIter=int(params.get("max_iter", 50)), tol=float(params.get("tol", 1e-6)),
                    fitIntercept=params.get("fit_intercept", True))
        if family == "tweedie":
            power = float(params.get("power", 0.0))
            link_power = 0.0 if link == "log" or (link == "auto" and power > 0) else 1.0
            stage = mlr.GeneralizedLinearRegression(family="tweedie", variancePower=power, linkPower=link_power, **args)
        else:
            stage = mlr.GeneralizedLinearRegression(family=family, link=link, **args)
        return _spark_fit(df, features, label, stage)
    return fit


def _bin_edges(df, features) -> list[list[float]]:
    """Thresholds between the ``TREE_BINS`` bins of each feature, from all rows: halfway between two values.

    With more values than bins a bin has about the same number of rows (the rule of Spark's trees, which see a
    sample); with over ``TREE_VALUES`` values the thresholds are approximate quantiles.
    """
    each = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), dbl(c).alias("v")) for i, c in enumerate(features)])).alias("e"))
    counts = each.select("e.*").filter("v IS NOT NULL AND NOT isnan(v)").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).persist()
    few = {r["i"]: r["n"] <= TREE_VALUES for r in counts.groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
    values = {}
    for r in counts.filter(F.col("i").isin([i for i, f in few.items() if f])).collect():
        values.setdefault(r["i"], []).append((r["v"], r["n"]))
    many = [i for i, f in few.items() if not f]
    probs = [k / TREE_BINS for k in range(1, TREE_BINS)]
    cuts = df.agg(*[F.percentile_approx(dbl(features[i]), probs, 10_000).alias(str(i)) for i in many]).first() if many else ()
    counts.unpersist()
    edges = {i: sorted(set(q)) for i, q in zip(many, cuts)}
    for i, found in values.items():
        v, n = (np.array(a, dtype=float) for a in zip(*sorted(found)))
        if len(v) <= TREE_BINS:
            edges[i] = list((v[:-1] + v[1:]) / 2)
            continue
        edges[i], stride, total = [], n.sum() / TREE_BINS, np.cumsum(n)
        want = stride
        for j in range(1, len(v)):
            if abs(total[j - 1] - want) < abs(total[j] - want):
                edges[i].append(float(v[j - 1] + v[j]) / 2)
                want += stride
    return [edges.get(i) or [0.0] for i in range(len(features))]


def _boosted(kind, defaults):
    """Boosted trees; leaf-count and growth-policy parameters have no counterpart and are ignored.

    Trees see a row by its bins only, so the rows of the same bins (and class) are one row with their mean target and
    their number as weight: sums of targets, gradients and weights of every node are those of the rows, and every tree
    reads the occupied cells instead of the rows.
    """
    def fit(df, features, label, params):
        p = {**defaults, **params}
        cls = mlc.GBTClassifier if kind == "classifier" else mlr.GBTRegressor
        if "num_leaves" in p:
            p.setdefault("max_depth", max(1, round(math.log2(p["num_leaves"] + 1))))
        stage = cls(maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]),
                    maxDepth=int(p.get("max_depth") or 5), seed=int(p.get("seed", 42)), weightCol="__weight", labelCol="__label",
                    featuresCol="__features", predictionCol="prediction")
        # a bin of Bucketizer starts at its bound, a tree's left side ends at its threshold
        bounds = [[-math.inf, *np.nextafter(e, math.inf).tolist(), math.inf] for e in _bin_edges(df, features)]
        values, bins = ([f"{TREE}{k}{i}" for i in range(len(features))] for k in "vb")
        cast = ", ".join(f"CAST({ident(c)} AS DOUBLE) AS {v}" for c, v in zip(features, values))
        prepare = [SQLTransformer(statement=f"SELECT *, {cast} FROM __THIS__"),
                   Bucketizer(splitsArray=bounds, inputCols=values, outputCols=bins)]
        # a missing target stays an error
        y = F.coalesce(dbl(label), F.lit(math.nan))
        # without Bucketizer's metadata, which makes trees take the ordered bins as unordered categories
        rows = PipelineModel(prepare).transform(df).select(*[F.col(b).alias(b, metadata={}) for b in bins], y.alias("__label"))
        by = [*bins, "__label"] if kind == "classifier" else bins
        mean = [] if kind == "classifier" else [F.avg("__label").alias("__label")]
        cells = rows.groupBy(*by).agg(*mean, F.count(F.lit(1)).cast("double").alias("__weight")).persist()
        n = cells.count()
        parts = max(1, -(-n // TREE_ROWS))
        if parts < cells.rdd.getNumPartitions():
            cells = cells.coalesce(parts)
        # thresholds are sought in a sample of maxBins squared rows: in all cells, for a rare bin to be seen
        stage.setMaxBins(max(TREE_BINS, math.isqrt(n) + 1))
        model = Pipeline(stages=[VectorAssembler(inputCols=bins, outputCol="__features"), stage]).fit(cells)
        cells.unpersist()
        model = PipelineModel([*prepare, *model.stages])
        return Fitted("spark", {"model": model}, {"model": model, "cells": n})
    return fit


def fit_logistic(df, features, label, params):
    df, w = balanced(df, label, params)
    penalty = params.get("penalty", "l2")
    mix = {"l1": 1.0, "l2": 0.0, None: 0.0}.get(penalty, float(params.get("l1_ratio") or 0.0))
    n = df.select(F.count(F.lit(1)) if w is None else F.sum(w)).first()[0]
    reg = 0.0 if penalty is None else 1.0 / (float(params.get("C", 1.0)) * n)
    return _spark_fit(df, features, label, mlc.LogisticRegression(
        regParam=reg, elasticNetParam=mix, standardization=False, maxIter=int(params.get("max_iter", 100)),
        tol=float(params.get("tol", 1e-6)), fitIntercept=params.get("fit_intercept", True)), w)


# --- full-batch gradient models --------------------------------------------------------------

# Losses on the margin y*f (classification) or the residual f-y (regression):
# value, derivative and a curvature bound (None: not smooth).
MARGIN_LOSSES = {
    "hinge": (lambda m: F.greatest(F.lit(0.0), 1 - m), lambda m: F.when(m < 1, -1.0).otherwise(0.0), None),
    "perceptron": (lambda m: F.greatest(F.lit(0.0), -m), lambda m: F.when(m <= 0, -1.0).otherwise(0.0), None),
    "squared_hinge": (lambda m: F.when(m < 1, (1 - m) * (1 - m)).otherwise(0.0),
                      lambda m: F.when(m < 1, -2.0 * (1 - m)).otherwise(0.0), 2.0),
    "log_loss": (lambda m: F.when(m > 0, F.log1p(F.exp(-m))).otherwise(F.log1p(F.exp(m)) - m),
                 lambda m: F.when(m > 0, -F.exp(-m) / (1 + F.exp(-m))).otherwise(-1.0 / (1 + F.exp(m))), 0.25),
    "modified_huber": (lambda m: F.when(m < -1, -4.0 * m).when(m < 1, (1 - m) * (1 - m)).otherwise(0.0),
                       lambda m: F.when(m < -1, -4.0).when(m < 1, -2.0 * (1 - m)).otherwise(0.0), 2.0),
    "squared_error": (lambda m: (1 - m) * (1 - m) / 2, lambda m: m - 1, 1.0),
}


def _outside(r, e):
    return F.greatest(F.lit(0.0), F.abs(r) - e)


RESIDUAL_LOSSES = {
    "squared_error": (lambda r, e: r * r / 2, lambda r, e: r, 1.0),
    "huber": (lambda r, e: F.when(F.abs(r) <= e, r * r / 2).otherwise(e * F.abs(r) - e * e / 2),
              lambda r, e: F.greatest(F.lit(-e), F.least(F.lit(e), r)), 1.0),
    "epsilon_insensitive": (_outside, lambda r, e: F.when(F.abs(r) > e, F.signum(r)).otherwise(0.0), None),
    "squared_epsilon_insensitive": (lambda r, e: _outside(r, e) * _outside(r, e),
                                    lambda r, e: 2.0 * F.signum(r) * _outside(r, e), 2.0),
}
# Other spellings of the same losses.
LOSS_NAMES = {"log": "log_loss", "squared_loss": "squared_error"}


def _lbfgs(evaluate, theta, passes: int, first_step: float, tol: float = 1e-7, memory: int = 8):
    """Limited-memory quasi-Newton descent; every evaluation is one pass over the table."""
    value, grad = evaluate(theta)
    used, pairs = 1, []
    while used < passes:
        d, weights = grad.copy(), []
        for s, y in reversed(pairs):
            a = (s @ d) / (s @ y)
            weights.append(a)
            d = d - a * y
        d = d * ((pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else first_step)
        for (s, y), a in zip(pairs, reversed(weights)):
            d = d + s * (a - (y @ d) / (s @ y))
        step = 1.0
        while used < passes:
            new_value, new_grad = evaluate(theta - step * d)
            used += 1
            if new_value <= value - 1e-4 * step * (grad @ d):
                break
            step /= 4
        else:
            return theta
        s, y = -step * d, new_grad - grad
        gain = value - new_value
        theta, value, grad = theta + s, new_value, new_grad
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        if gain <= tol * max(1.0, abs(value)):
            return theta
    log.warning("no convergence in %s passes", passes)
    return theta


def _proximal(evaluate, theta, passes: int, curvature, lmax: float, shrink: float, p: int, last: bool,
              smooth_alpha: float):
    """Proximal gradient with momentum, or a decaying subgradient for losses with kinks.

    The latter stops after ``PATIENCE`` passes without a gain of ``GAIN`` of the best objective.
    """
    point, t, best, mark = theta.copy(), 1.0, (math.inf, theta), (math.inf, 0)
    lip = (curvature or 1.0) * lmax + smooth_alpha
    for k in range(1, passes + 1):
        base = point if curvature else theta
        objective, grad = evaluate(base)
        if objective < best[0]:
            best = (objective, base.copy())
        if objective < mark[0] - GAIN * abs(mark[0] if math.isfinite(mark[0]) else 0.0):
            mark = (objective, k)
        step = 1.0 / lip if curvature else 1.0 / (lip ** 0.5 * math.sqrt(k))
        new = base - step * grad
        new[:p] = np.sign(new[:p]) * np.maximum(0, np.abs(new[:p]) - step * shrink)
        if curvature:
            t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
            point = new + (t - 1) / t_next * (new - theta)
            t = t_next
        done = np.max(np.abs(new - theta)) < 1e-6
        theta = new
        if done or (not curvature and k - mark[1] >= PATIENCE):
            break
    else:
        log.warning("no convergence in %s passes", passes)
    # A zero vector has zero perceptron loss, so the last iterate counts there.
    return theta if curvature or last else best[1]


def margin_machine(df, features, label, params, classification: bool) -> Fitted:
    """A machine with a hinge or a tube (:mod:`margins`), its penalty on the original scale.

    ``C`` weighs the summed loss against half the squared coefficients, ``alpha`` the penalty against the
    mean loss. With ``nu`` the margin (classes) or tube (numbers) is free: at most this share of the rows
    lies beyond it and at least this share on or beyond it.
    """
    df, w = balanced(df, label, params)
    nu = params.get("nu")
    if nu is not None:
        loss, alpha = ("nu_hinge", 1.0) if classification else ("nu_insensitive", None)
    else:
        loss, alpha = params["loss"], None if "C" in params else float(params.get("alpha", 1e-4))
    if alpha is None:
        n = df.count() if w is None else df.agg(F.sum(w)).first()[0]
        alpha = 1.0 / (float(params.get("C", 1.0)) * max(n, 1))
    m = margins.fit(df, features, label, loss, alpha, nu, float(params.get("epsilon", 0.1)), w, params.get("fit_intercept", True))
    fit = G.LinearFit(tuple(features), m.coef, m.intercept, 0.0, 0.0, 0.0, np.zeros(len(features)), 0.0)
    out = linear_model(fit, margin=classification)
    out.info["machine"] = m
    return out


def linear_gd(df, features, label, params, classification: bool):
    """Full-batch fit of mean loss + penalty on standardised columns.

    An evaluation is one aggregate of the loss and its p partial derivatives.
    """
    loss = LOSS_NAMES.get(params.get("loss"), params.get("loss")) or ("hinge" if classification else "squared_error")
    table = MARGIN_LOSSES if classification else RESIDUAL_LOSSES
    if loss not in table:
        raise ValueError(f"unknown loss {loss!r}")
    if loss in ("hinge", "epsilon_insensitive") and params.get("penalty", "l2") == "l2":
        return margin_machine(df, features, label, {**params, "loss": loss}, classification)
    value_of, slope_of, curvature = table[loss]
    penalty, mix = params.get("penalty", "l2"), float(params.get("l1_ratio", 0.15))
    l1 = {"l1": 1.0, "l2": 0.0, None: 0.0}.get(penalty, mix)
    iters = int(params.get("max_iter") or params.get("iterations") or params.get("epochs") or 1000)
    df, w = balanced(df, label, params)

    g = G.gram(df, [*features, label])
    p = len(features)
    mean, std = g.mean[:p], np.sqrt(np.clip(np.diag(g.scatter)[:p] / g.n, 0, None))
    std[std == 0] = 1.0
    alpha = 1.0 / (float(params["C"]) * g.n) if "C" in params else float(params.get("alpha", 1e-4))
    if penalty is None:
        alpha = 0.0
    iy = g.names.index(label)
    ym, ys = (0.0, 1.0) if classification else (g.mean[iy], math.sqrt(max(g.scatter[iy, iy] / g.n, 1e-300)))
    eps = float(params.get("epsilon", 0.1)) / ys
    lmax = float(np.linalg.eigvalsh(g.scatter[:p, :p] / g.n / np.outer(std, std)).max()) + 1.0
    y = (F.when(dbl(label) > 0, 1.0).otherwise(-1.0) if classification
         else (dbl(label) - F.lit(float(ym))) / F.lit(float(ys)))
    names = [f"x{i}" for i in range(p)]
    data = df.select(*[((dbl(c) - F.lit(float(m))) / F.lit(float(s))).alias(n)
                       for c, m, s, n in zip(features, mean, std, names)],
                     y.alias("y"), (F.col(w) if w else F.lit(1.0)).alias("w")).dropna().persist()
    icpt = 1.0 if params.get("fit_intercept", True) else 0.0

    def gradient(theta):
        f = dot([F.col(n) for n in names], theta[:p]) + F.lit(float(theta[p]))
        m = F.col("m")
        if classification:
            value, slope = value_of(m), slope_of(m) * F.col("y")
            step = data.withColumn("m", F.col("y") * f)
        else:
            value, slope = value_of(m, eps), slope_of(m, eps)
            step = data.withColumn("m", f - F.col("y"))
        step = step.withColumns({"v": value * F.col("w"), "d": slope * F.col("w")})
        row = step.agg(F.sum("w"), F.sum("v"), F.sum("d"), *[F.sum(F.col("d") * F.col(n)) for n in names]).first()
        s = np.array(row, dtype=float)
        return np.append(s[3:], s[2] * icpt) / s[0], s[1] / s[0]

    def penalised(theta):
        grad, value = gradient(theta)
        w2 = theta[:p] @ theta[:p]
        return (value + alpha * ((1 - l1) / 2 * w2 + l1 * np.abs(theta[:p]).sum()),
                grad + alpha * (1 - l1) * np.append(theta[:p], 0.0))

    # The moments already hold the least-squares solution: a start near the optimum.
    sxy = g.scatter[:p, iy] / g.n / std * (2.0 if classification else 1.0 / ys)
    corr = g.scatter[:p, :p] / g.n / np.outer(std, std)
    theta = np.append(np.linalg.pinv(corr + alpha * (1 - l1) * np.eye(p)) @ sxy,
                      (2 * g.mean[iy] - 1) * icpt if classification else 0.0)
    if curvature and l1 == 0.0:
        theta = _lbfgs(penalised, theta, iters, 1.0 / (curvature * lmax + alpha))
    else:
        theta = _proximal(penalised, theta, iters, curvature, lmax, alpha * l1, p,
                          last=loss == "perceptron", smooth_alpha=alpha)
    data.unpersist()
    coef = theta[:p] / std * ys
    intercept = (theta[p] * ys + ym) - coef @ mean
    fit = G.LinearFit(tuple(features), coef, float(intercept), 0.0, 0.0, g.n, np.zeros(p), 0.0)
    return linear_model(fit, margin=classification)


def _gd(classification, **defaults):
    return lambda df, fs, lb, params: linear_gd(df, fs, lb, {**defaults, **params}, classification)


# --- kernel models: Nystroem features under a linear model -----------------------------------

def _kernelised(inner, n_components=100, key="row_id", **defaults):
    def fit(df, features, label, params):
        p = {**defaults, **params}
        kernel = p.pop("kernel", "rbf")
        gamma = p.pop("gamma", None)
        if gamma in ("scale", "auto", None):
            gamma = None
        m = int(p.pop("n_components", n_components))
        degree, seed = int(p.pop("degree", 3)), int(p.pop("seed", 42))
        g = G.gram(df, features)
        std = np.sqrt(np.diag(g.scatter) / g.n)
        std[std == 0] = 1.0
        state = {"features": list(features), "mean": g.mean, "std": std, "kernel": kernel, "degree": degree}
        base = df.withColumn("__x", _scaled(state))
        state["marks"], state["norm"], state["gamma"] = R.nystroem_fit(base, "__x", key, m, kernel, gamma, degree, 1.0, seed)
        names = [f"__k_{i}" for i in range(len(state["marks"]))]
        lifted = _lift(df, state).persist()
        model = inner(lifted, names, label, p)
        lifted.unpersist()
        return Fitted("kernel", {**state, "inner": model}, model.info)
    return fit


def _scaled(s):
    return F.array(*[(dbl(c) - F.lit(float(a))) / F.lit(float(d)) for c, a, d in zip(s["features"], s["mean"], s["std"])])


def _lift(df, s):
    """The kernel features of every row beside its columns."""
    return R.nystroem_apply(df.withColumn("__x", _scaled(s)), "__x", df.columns, s["marks"], s["norm"], s["kernel"], s["gamma"],
                            s["degree"], 1.0, "__k_")


@kind("kernel")
def _kernel_model(df, s):
    return s["inner"].transform(_lift(df, s)).drop(*[f"__k_{i}" for i in range(len(s["marks"]))])


# --- moment classifiers -------------------------------------------------------------------------

def _class_moments(df, features, label):
    parts = G.grams_by(df.filter(F.col(ident(label)).isNotNull()), features, label)
    if len(parts) > MAX_CLASSES:
        raise ValueError(f"{label} has over {MAX_CLASSES} classes")
    classes = sorted(parts)
    return classes, [parts[c] for c in classes]


def _quadratic_scorer(features, classes, quad, lin, const) -> Fitted:
    return Fitted("quadratic", {"features": list(features), "classes": np.array(classes, dtype=float), "quad": quad, "lin": np.asarray(lin),
                                "const": np.asarray(const)}, {"classes": classes})


@kind("quadratic")
def _quadratic(df, state):
    """argmax over classes of x'Qx + Lx + c (Q is None, diagonal or full per class)."""
    shared = df.sparkSession.sparkContext.broadcast((state["quad"], state["lin"], state["const"]))
    labels = state["classes"]

    @F.pandas_udf("struct<prediction double, score double>")
    def score(x: pd.Series) -> pd.DataFrame:
        q, b, c = shared.value
        a = np.stack(x.to_numpy()) if len(x) else np.zeros((0, b.shape[1]))
        s = a @ b.T + c
        if q is not None:
            s = s + ((a * a) @ q.T if q.ndim == 2 else np.einsum("ni,kij,nj->nk", a, q, a))
        top = s.argmax(1) if len(s) else np.zeros(0, dtype=int)
        prob = np.exp(s - s.max(1, keepdims=True)) if len(s) else s
        prob = prob / prob.sum(1, keepdims=True) if len(s) else s
        return pd.DataFrame({"prediction": labels[top], "score": prob[:, -1]})

    out = df.withColumn("__s", score(F.array(*[dbl(c) for c in state["features"]])))
    return out.withColumns({"prediction": F.col("__s.prediction"), "score": F.col("__s.score")}).drop("__s")


def fit_gaussian_nb(df, features, label, params):
    classes, parts = _class_moments(df, features, label)
    total = G.sum_grams(parts)
    eps = float(params.get("var_smoothing", 1e-9)) * float(np.max(np.diag(total.scatter) / total.n))
    mean = np.array([p.mean for p in parts])
    var = np.array([np.diag(p.scatter) / p.n for p in parts]) + eps
    prior = np.log([p.n / total.n for p in parts])
    const = prior - 0.5 * (np.log(2 * np.pi * var) + mean ** 2 / var).sum(1)
    return _quadratic_scorer(features, classes, -0.5 / var, mean / var, const)


def _ledoit_wolf(df, features, label, value, part):
    """Shrunk covariance of one class: standardised columns, the Ledoit-Wolf share, scaled back."""
    p, cov = len(features), part.scatter / part.n
    sd = np.sqrt(np.diag(cov))
    sd[sd == 0] = 1.0
    s = cov / np.outer(sd, sd)
    size = None
    for c, m, d in zip(features, part.mean, sd):
        z = (dbl(c) - F.lit(float(m))) / F.lit(float(d))
        size = z * z if size is None else size + z * z
    fourth = df.filter(F.col(ident(label)) == F.lit(value)).agg(F.sum(size * size)).first()[0] or 0.0
    mu, squares = np.trace(s) / p, (s * s).sum()
    delta = (squares - 2 * mu * np.trace(s) + p * mu * mu) / p
    beta = min((fourth / part.n - squares) / (p * part.n), delta)
    share = beta / delta if delta > 0 else 0.0
    s = (1 - share) * s + share * mu * np.eye(p)
    return s * np.outer(sd, sd)


def fit_lda(df, features, label, params):
    classes, parts = _class_moments(df, features, label)
    n = sum(p.n for p in parts)
    cov = sum(p.scatter for p in parts) / n
    if params.get("shrinkage") not in (None, 0):
        s = params["shrinkage"]
        if s == "auto":
            cov = sum(_ledoit_wolf(df, features, label, c, p) * (p.n / n) for c, p in zip(classes, parts))
        else:
            cov = (1 - float(s)) * cov + float(s) * np.trace(cov) / len(cov) * np.eye(len(cov))
    mean = np.array([p.mean for p in parts])
    lin = mean @ np.linalg.pinv(cov)
    const = np.log([p.n / n for p in parts]) - 0.5 * np.einsum("ki,ki->k", lin, mean)
    return _quadratic_scorer(features, classes, None, lin, const)


def fit_qda(df, features, label, params):
    classes, parts = _class_moments(df, features, label)
    n = sum(p.n for p in parts)
    reg = float(params.get("reg_param", 0.0))
    quad, lin, const = [], [], []
    for p in parts:
        cov = (1 - reg) * p.scatter / max(p.n - 1, 1) + reg * np.eye(len(features))
        inv = np.linalg.pinv(cov)
        val = np.linalg.eigvalsh(cov)
        logdet = float(np.log(val[val > 1e-12]).sum())
        quad.append(-0.5 * inv)
        lin.append(inv @ p.mean)
        const.append(math.log(p.n / n) - 0.5 * logdet - 0.5 * p.mean @ inv @ p.mean)
    return _quadratic_scorer(features, classes, np.array(quad), np.array(lin), np.array(const))


def fit_knn(df, features, label, params):
    """The training table as it is; with a ``recall`` also an index of cells that a query visits in part."""
    key = params.get("key", "row_id")
    train = df.select(ident(key), F.array(*[dbl(c) for c in features]).alias("x"), dbl(label).alias("label"))
    k, metric = int(params.get("n_neighbors", 5)), params.get("metric", "minkowski")
    index = {}
    if params.get("recall") is not None:
        from tabspark.operators.neighbours import fit_index

        fit = fit_index(train, k, metric, float(params["recall"]), key)
        index = {"centres": fit.centres, "probes": fit.probes}
    return Fitted("neighbours", {"train": train, "features": list(features), "key": key, "k": k,
                                 "weights": params.get("weights", "uniform"), "metric": metric, **index})


@kind("neighbours")
def _neighbours(df, s):
    from tabspark.operators.neighbours import CellIndex, knn_classify

    asked = df.select(ident(s["key"]), F.array(*[dbl(c) for c in s["features"]]).alias("x"))
    index = CellIndex(s["centres"], s["probes"], s["metric"]) if "centres" in s else None
    return df.join(knn_classify(s["train"], asked, s["k"], s["weights"], key=s["key"], metric=s["metric"], index=index), s["key"])


# --- catalogue --------------------------------------------------------------------------------------

REGRESSORS = {
    "LinearRegression": fit_least_squares,
    "Ridge": fit_ridge,
    "Lasso": fit_lasso,
    "LassoLars": fit_lasso,
    "KernelRidge": _kernelised(fit_ridge, kernel="linear"),
    "TweedieRegressor": _glm("tweedie"),
    "GammaRegressor": _glm("gamma"),
    "PoissonRegressor": _glm("poisson"),
    "GradientBoostingRegressor": _boosted("regressor", {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}),
    "XGBRegressor": _boosted("regressor", {"n_estimators": 100, "learning_rate": 0.3, "max_depth": 6}),
    "LGBMRegressor": _boosted("regressor", {"n_estimators": 100, "learning_rate": 0.1}),
    "SGDRegressor": _gd(False),
    "MBSGDRegressor": _gd(False),
    "LinearSVR": _gd(False, loss="epsilon_insensitive", C=1.0, epsilon=0.0),
    "PassiveAggressiveRegressor": _gd(False, loss="epsilon_insensitive", C=1.0),
    "SVR": _kernelised(_gd(False, loss="epsilon_insensitive", C=1.0)),
    "NuSVR": _kernelised(lambda df, fs, lb, params: margin_machine(df, fs, lb, params, False), nu=0.5, C=1.0),
}
CLASSIFIERS = {
    "LogisticRegression": fit_logistic,
    "RidgeClassifier": fit_ridge_classifier,
    "KNeighborsClassifier": fit_knn,
    "LinearDiscriminantAnalysis": fit_lda,
    "QuadraticDiscriminantAnalysis": fit_qda,
    "GaussianNB": fit_gaussian_nb,
    "GradientBoostingClassifier": _boosted("classifier", {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}),
    "XGBClassifier": _boosted("classifier", {"n_estimators": 100, "learning_rate": 0.3, "max_depth": 6}),
    "LGBMClassifier": _boosted("classifier", {"n_estimators": 100, "learning_rate": 0.1}),
    "SGDClassifier": _gd(True),
    "MBSGDClassifier": _gd(True),
    "PassiveAggressiveClassifier": _gd(True, loss="hinge", C=1.0),
    "LinearSVC": _gd(True, loss="squared_hinge", C=1.0),
    "SVC": _kernelised(_gd(True, loss="hinge", C=1.0)),
    "NuSVC": _kernelised(lambda df, fs, lb, params: margin_machine(df, fs, lb, params, True), nu=0.5),
}


_LINEAR = ("alpha", "C", "penalty", "l1_ratio", "loss", "epsilon", "class_weight", "fit_intercept", "max_iter", "iterations", "epochs")
_KERNEL = ("kernel", "gamma", "degree", "n_components", "seed", "key")
_TREES = ("n_estimators", "learning_rate", "max_depth", "seed")
#: Parameters that change the fit of a model.
EFFECTIVE = {
    "LinearRegression": ("fit_intercept", "positive"),
    "Ridge": ("alpha", "fit_intercept", "positive"),
    "RidgeClassifier": ("alpha", "fit_intercept", "class_weight"),
    "KernelRidge": ("alpha", "fit_intercept", *_KERNEL),
    "TweedieRegressor": ("power", "alpha", "link", "max_iter", "tol", "fit_intercept"),
    **dict.fromkeys(("Lasso", "LassoLars"), ("alpha", "fit_intercept", "max_iter")),
    **dict.fromkeys(("GammaRegressor", "PoissonRegressor"), ("alpha", "link", "max_iter", "tol", "fit_intercept")),
    **dict.fromkeys(("GradientBoostingRegressor", "XGBRegressor", "GradientBoostingClassifier", "XGBClassifier"), _TREES),
    **dict.fromkeys(("LGBMRegressor", "LGBMClassifier"), (*_TREES, "num_leaves")),
    **dict.fromkeys(("SGDRegressor", "MBSGDRegressor", "LinearSVR", "PassiveAggressiveRegressor", "SGDClassifier", "MBSGDClassifier",
                     "PassiveAggressiveClassifier", "LinearSVC"), _LINEAR),
    **dict.fromkeys(("SVR", "SVC"), (*_LINEAR, *_KERNEL)),
    **dict.fromkeys(("NuSVR", "NuSVC"), ("nu", "C", "class_weight", "fit_intercept", "max_iter", *_KERNEL)),
    "LogisticRegression": ("C", "penalty", "l1_ratio", "class_weight", "max_iter", "tol", "fit_intercept"),
    "KNeighborsClassifier": ("n_neighbors", "weights", "metric", "key"),
    "LinearDiscriminantAnalysis": ("shrinkage",),
    "QuadraticDiscriminantAnalysis": ("reg_param",),
    "GaussianNB": ("var_smoothing",),
}
#: Parameters that are taken and have no effect: they choose a solver, or a tree form without a counterpart.
WITHOUT_EFFECT = ("solver", "dual", "intercept_scaling", "grow_policy", "objective", "criterion", "early_stopping", "n_jobs", "verbose",
                  "random_state")


def effective(name: str, params: dict) -> dict:
    """The parameters that change the fit; an unknown one is an error."""
    if name not in EFFECTIVE:
        raise ValueError(f"unknown model {name!r}: choose from {sorted(EFFECTIVE)}")
    idle = {*WITHOUT_EFFECT, *(("loss",) if "loss" not in EFFECTIVE[name] else ()), *(("tol", "max_iter") if "tol" not in EFFECTIVE[name] else ())}
    unknown = set(params) - set(EFFECTIVE[name]) - idle
    if unknown:
        raise ValueError(f"{name} has no parameters {sorted(unknown)}")
    return {k: v for k, v in params.items() if k in EFFECTIVE[name]}


def estimator(name: str, features: list[str], label: str, params: dict | None = None) -> Spec:
    builder = REGRESSORS.get(name) or CLASSIFIERS.get(name)
    if builder is None:
        raise ValueError(f"unknown model {name!r}: choose from {sorted({**REGRESSORS, **CLASSIFIERS})}")
    return Spec(name, list(features), label, params or {}, builder)


def predict(df: DataFrame, model: Fitted, keep: list[str]) -> DataFrame:
    return model.transform(df).select(*map(ident, keep), F.col("prediction").cast("double").alias("prediction"))


def transformed_target(df: DataFrame, name: str, features: list[str], label: str, method: str = "yeo-johnson",
                       params: dict | None = None) -> Fitted:
    """Fit on a transformed target, predict on the original scale."""
    from tabspark.operators.transforms import Scaler

    t = Scaler(method, [label], standardize=True).fit(df)
    inner = estimator(name, features, label, params).fit(t.transform(df))
    return Fitted("target", {"inner": inner, "transform": t, "label": label}, {"inner": inner, "transform": t})


@kind("target")
def _target(df, s):
    return s["inner"].transform(df).withColumn("prediction", F.expr(s["transform"].inverse_sql(s["label"], "prediction")))
