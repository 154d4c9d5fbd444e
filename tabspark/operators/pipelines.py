"""Search over pipelines: a step is fitted once per fold and setting, and shared by all trials below it.

A pipeline is a list of (name, kind); the last kind is a model. Trials are
dictionaries of ``name`` (another kind for that step) and ``name__parameter``. Steps
that are affine in the columns (scalers, PCA, selection) carry the per-fold moments
along as p x p algebra, so least-squares models below them cost no pass over the table.
"""

from __future__ import annotations

import logging
import math
from contextlib import nullcontext
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from threading import Lock

import numpy as np
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.scalar import dbl, dot, ident, num
from tabspark.operators import curves
from tabspark.operators import gram as G
from tabspark.operators import reduce as R
from tabspark.operators import select
from tabspark.operators.encode import polynomial_name, polynomial_terms
from tabspark.operators.fitted import Fitted, kind
from tabspark.operators.information import neighbour_information
from tabspark.operators.metrics import CLASSIFICATION, REGRESSION, f1_macro_from
from tabspark.operators.models import effective, estimator, from_moments
from tabspark.operators.search import MOMENT_MODELS, RESULT_SCHEMA, metrics_by_set, task_of
from tabspark.operators.scorers import Scorer, scores_by
from tabspark.operators.small import small_table
from tabspark.operators.transforms import AFFINE, PLAIN, POWER, Scaler
from tabspark.operators.twopart import HURDLE_DEFAULTS, HURDLE_PARTS, HurdleModel

log = logging.getLogger(__name__)

#: Parameters of each step kind with their defaults; scalers have none.
STEP_PARAMS = {
    "poly": {"degree": 2, "interaction_only": False, "include_bias": True, "n_dimensions": None},
    "pca": {"n_components": None, "standardize": False},
    "select_k_best": {"k": 10, "score_func": "f"},
    "nystroem": {"n_components": 100, "kernel": "rbf", "gamma": None, "degree": 3, "coef0": 1.0, "seed": 42},
    "identity": {},
}
HURDLE = "HurdleRegression"
HURDLE_PARAMS = ("clf_name", "reg_name", "clf_params", "reg_params")
#: Models that are scored in one pass.
SCORED_AT_ONCE = 16
FAILURES = (ArithmeticError, ValueError, IllegalArgumentException, np.linalg.LinAlgError)


# --- fitted steps -----------------------------------------------------------------------------

def _others(df: DataFrame, inputs: list[str]) -> list[str]:
    return [ident(c) for c in df.columns if c not in set(inputs)]


@kind("affine")
def _affine(df, s):
    """(x - mean) @ weights under new names, in place of the inputs; a vector of weights scales column by column."""
    x, w = [dbl(c) - F.lit(float(m)) for c, m in zip(s["inputs"], s["mean"])], s["weights"]
    out = [c * F.lit(float(k)) for c, k in zip(x, w)] if w.ndim == 1 else [dot(x, w[:, k]) for k in range(w.shape[1])]
    return df.select(*_others(df, s["inputs"]), *[c.alias(n) for c, n in zip(out, s["outputs"])])


@kind("subset")
def _subset(df, s):
    return df.drop(*[c for c in s["inputs"] if c not in s["outputs"]])


@kind("poly")
def _poly(df, s):
    terms = [F.expr(" * ".join(f"CAST({ident(c)} AS DOUBLE)" for c in t) or num(1)).alias(n) for t, n in zip(s["terms"], s["outputs"])]
    return df.select(*_others(df, s["inputs"]), *terms)


@kind("landmarks")
def _landmarks(df, s):
    """Kernel features of a Nystroem map in place of the inputs."""
    arr = df.withColumn("__x", F.array(*[dbl(c) for c in s["inputs"]]))
    keep = [c for c in df.columns if c not in set(s["inputs"])]
    return R.nystroem_apply(arr, "__x", keep, s["marks"], s["norm"], s["kernel"], s["gamma"], s["degree"], s["coef0"], s["prefix"])


def _mapped(g: G.Gram, columns: list[str], label: str, mean: np.ndarray, weights: np.ndarray, names: list[str]) -> G.Gram:
    """Moments of (x - mean) @ weights and the label from those of x and the label."""
    at = [*g.index(columns), g.names.index(label)]
    w = np.diag(weights) if weights.ndim == 1 else weights
    a = np.zeros((len(columns) + 1, w.shape[1] + 1))
    a[:-1, :-1], a[-1, -1] = w, 1.0
    return G.Gram((*names, label), g.n, a.T @ (g.shift[at] - np.append(mean, 0.0)), a.T @ g.s1[at], a.T @ g.s2[np.ix_(at, at)] @ a)


@dataclass
class Node:
    """A table behind a chain of fitted steps, in one fold; ``parts`` are moments per fold, by kind of rows."""

    df: DataFrame
    columns: list[str]
    parts: dict[str, dict] = field(default_factory=dict)
    shared: dict | None = None  # moments that all folds may use: nothing above was fitted
    stages: list[Fitted] = field(default_factory=list)


class _Run:
    """One search: its table, folds and caches."""

    def __init__(self, df: DataFrame, label: str, fold: str, key: str, mask: Column | None):
        self.df, self.label, self.fold, self.key, self.mask = df, label, fold, key, mask
        self.lock, self.shared_lock, self.fits = Lock(), Lock(), 0

    def train(self, node: Node, k) -> DataFrame:
        rows = node.df if k is None else node.df.filter(F.col(ident(self.fold)) != k)
        return rows if self.mask is None else rows.filter(self.mask)

    def moments(self, node: Node, k, rows: str = "all") -> G.Gram:
        """Training moments of fold ``k``: all rows, or the positive ones."""
        own = node.parts if node.shared is None else node.shared
        with nullcontext() if node.shared is None else self.shared_lock:
            if rows not in own:
                df = node.df if self.mask is None else node.df.filter(self.mask)
                df = df.filter(dbl(self.label) > 0) if rows == "positive" else df
                own[rows] = G.grams_by(df, [*node.columns, self.label], self.fold)
        parts = [g for f, g in own[rows].items() if f != k]
        if not parts:
            raise ValueError("no rows to fit on")
        return G.sum_grams(parts)

    def affine(self, node: Node, mean, weights, names) -> Node:
        mean, weights = np.asarray(mean, float), np.asarray(weights, float)
        model = Fitted("affine", {"inputs": node.columns, "mean": mean, "weights": weights, "outputs": names})
        known = node.parts if node.shared is None else node.shared
        parts = {r: {f: _mapped(g, node.columns, self.label, mean, weights, names) for f, g in own.items()} for r, own in known.items()}
        return Node(model.transform(node.df), names, parts, None, [*node.stages, model])

    def need(self, node: Node, k, hurdle: bool) -> G.Gram:
        """Training moments, with those of the positive rows beside them where a hurdle model comes below."""
        if hurdle:
            self.moments(node, k, "positive")
        return self.moments(node, k)

    def step(self, node: Node, name: str, what: str, params: dict, k, task: str, hurdle: bool) -> Node:
        """The table behind one more step, fitted without fold ``k``."""
        cols = node.columns
        if what == "identity":
            return node
        if what == "standard":
            g = self.need(node, k, hurdle)
            ix = g.index(cols)
            std = np.sqrt(np.clip(np.diag(g.scatter)[ix] / g.n, 0, None))
            return self.affine(node, g.mean[ix], 1.0 / np.where(std > 0, std, 1.0), list(cols))
        if what in AFFINE:
            self.need(node, k, hurdle)
            fit = AFFINE[what](self.train(node, k), cols)
            return self.affine(node, [fit[c][0] for c in cols], [1.0 / fit[c][1] for c in cols], list(cols))
        if what in PLAIN or what in POWER:
            model = Scaler(what, cols, standardize=what in POWER).fit(self.train(node, k))
            plain = what in PLAIN and node.shared is not None
            return Node(model.transform(node.df), list(cols), {}, {} if plain else None, [*node.stages, model])
        if what == "pca":
            g = self.need(node, k, hurdle)
            ix = g.index(cols)
            mean, std = R._standardizer(g, len(cols), params["standardize"])
            val, vec = np.linalg.eigh(g.scatter[np.ix_(ix, ix)] / (g.n - 1) / np.outer(std, std))
            order = np.argsort(val)[::-1]
            ratio = np.clip(val[order], 0, None)
            many = len(cols) if params["n_components"] is None else R.components_for(ratio / ratio.sum(), params["n_components"])
            return self.affine(node, mean, (R._fix_signs(vec[:, order]) / std[:, None])[:, :many], [f"{name}_{i + 1}" for i in range(many)])
        if what == "select_k_best":
            best = self.best(node, params, k, task, hurdle)
            model = Fitted("subset", {"inputs": cols, "outputs": best})
            # moments of more columns than needed serve as they are
            return Node(model.transform(node.df), best, dict(node.parts if node.shared is None else node.shared), None, [*node.stages, model])
        if what == "poly":
            many = len(cols) if params["n_dimensions"] is None else min(params["n_dimensions"], len(cols))
            if many <= 0:
                raise ValueError("n_dimensions must be positive")
            terms = polynomial_terms(cols[:many], int(params["degree"]), params["interaction_only"], params["include_bias"]) + [(c,) for c in cols[many:]]
            names = [polynomial_name(t) for t in terms]
            model = Fitted("poly", {"inputs": cols, "terms": [list(t) for t in terms], "outputs": names})
            return Node(model.transform(node.df), names, {}, None if node.shared is None else {}, [*node.stages, model])
        p = {**params, "inputs": cols, "prefix": f"{name}_"}
        base = self.train(node, k).withColumn("__x", F.array(*[dbl(c) for c in cols]))
        gamma = None if params["gamma"] in (None, "scale", "auto") else float(params["gamma"])
        p["marks"], p["norm"], p["gamma"] = R.nystroem_fit(base, "__x", self.key, int(params["n_components"]), params["kernel"], gamma,
                                                           int(params["degree"]), float(params["coef0"]), int(params["seed"]))
        model = Fitted("landmarks", p)
        return Node(model.transform(node.df), [f"{name}_{i}" for i in range(len(p["marks"]))], {}, None, [*node.stages, model])

    def best(self, node: Node, params: dict, k, task: str, hurdle: bool) -> list[str]:
        """The ``k`` columns with the highest score, in column order."""
        many = len(node.columns) if params["k"] == "all" else min(int(params["k"]), len(node.columns))
        if params["score_func"] == "f" and task == "regression":
            g = self.need(node, k, hurdle)
            iy, c = g.names.index(self.label), g.corr()
            r2 = [0.0 if math.isnan(c[i, iy]) else c[i, iy] ** 2 for i in g.index(node.columns)]
            top = sorted(range(len(r2)), key=lambda i: (-r2[i], node.columns[i]))[:many]
            return [node.columns[i] for i in sorted(top)]
        fn = {"f": select.anova_scores, "mutual_info": lambda *a: select.mutual_information(*a, regression=task == "regression"),
              "chi2": select.chi2_scores, "mutual_info_neighbours": neighbour_information}.get(params["score_func"])
        if params["score_func"] == "mutual_info_neighbours" and task == "regression":
            raise ValueError("mutual_info_neighbours needs a class; use mutual_info")
        if fn is None:
            raise ValueError(f"unknown score_func {params['score_func']!r}")
        scored = {r["feature"]: r["score"] for r in fn(self.train(node, k), node.columns, self.label).collect()}
        value = {c: -math.inf if scored.get(c) is None or math.isnan(scored[c]) else scored[c] for c in node.columns}
        top = set(sorted(node.columns, key=lambda c: (-value[c], c))[:many])
        return [c for c in node.columns if c in top]

    def fit(self, node: Node, model: str, params: dict, k, made: dict) -> Fitted:
        """A fitted model of this node; the parts of hurdle models are made once."""
        if model == HURDLE:
            cname, rname = params["clf_name"], params["reg_name"]
            clf = self.part(node, "clf", cname, params["clf_params"], k, made)
            reg = self.part(node, "reg", rname, params["reg_params"], k, made)
            return HurdleModel(clf, reg)
        return self.part(node, "model", model, params, k, made)

    def part(self, node: Node, role: str, model: str, params: dict, k, made: dict) -> Fitted:
        at = (role, model, frozen(params))
        if at not in made:
            try:
                made[at] = self._part(node, role, model, params, k)
                with self.lock:
                    self.fits += 1
            except FAILURES as err:
                made[at] = err
        if isinstance(made[at], Exception):
            raise made[at]
        return made[at]

    def _part(self, node: Node, role: str, model: str, params: dict, k) -> Fitted:
        if model in MOMENT_MODELS and role != "clf":
            return from_moments(self.moments(node, k, "positive" if role == "reg" else "all"), node.columns, self.label, {**MOMENT_MODELS[model], **params})
        rows, label = self.train(node, k), self.label
        if role == "clf":
            rows, label = rows.withColumn("__pos", F.when(dbl(label) > 0, 1.0).otherwise(0.0)), "__pos"
        elif role == "reg":
            rows = rows.filter(dbl(label) > 0)
        return estimator(model, node.columns, label, params).fit(rows)


def frozen(value):
    """A value that can be looked up: dictionaries and lists by their content."""
    if isinstance(value, dict):
        return tuple(sorted((k, frozen(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(map(frozen, value))
    return (type(value).__name__, value)


# --- trials -----------------------------------------------------------------------------------

def resolve(pipeline: list[tuple[str, str]], trial: dict) -> list[tuple[str, str, dict]]:
    """(name, kind, parameters) of every step of a trial; a key that names no step or parameter is an error.

    Model parameters without effect on the fit are left out, so trials that differ in them
    only are one fit. ``None`` and "passthrough" make a step the identity.
    """
    names = [n for n, _ in pipeline]
    own: dict[str, dict] = {n: {} for n in names}
    kinds = dict(pipeline)
    for key, value in trial.items():
        name, _, param = key.partition("__")
        if name not in own:
            raise ValueError(f"{key!r} names no step of {names}")
        if param:
            own[name][param] = value
        else:
            kinds[name] = "identity" if value in (None, "passthrough") else value
    out = []
    for name in names[:-1]:
        what = kinds[name]
        if what in AFFINE or what in PLAIN or what in POWER:
            defaults: dict = {}
        elif what in STEP_PARAMS:
            defaults = STEP_PARAMS[what]
        else:
            raise ValueError(f"unknown step {what!r} for {name!r}")
        unknown = set(own[name]) - set(defaults)
        if unknown and what != "identity":
            raise ValueError(f"step {name!r} ({what}) has no parameters {sorted(unknown)}")
        out.append((name, what, {} if what == "identity" else {**defaults, **own[name]}))
    name, model = names[-1], kinds[names[-1]]
    return [*out, (name, model, hurdle_params(own[name]) if model == HURDLE else effective(model, own[name]))]


def hurdle_params(given: dict) -> dict:
    """Names and effective parameters of both parts; ``clf_params`` may be one dictionary or single keys behind it."""
    out = {"clf_name": "LogisticRegression", "reg_name": "LinearRegression", "clf_params": {}, "reg_params": {}}
    for key, value in given.items():
        head, _, rest = key.partition("__")
        if head not in HURDLE_PARAMS or bool(rest) and not head.endswith("params"):
            raise ValueError(f"a hurdle model has no parameter {key!r}")
        if rest:
            out[head] = {**out[head], rest: value}
        elif head.endswith("params"):
            out[head] = {**value, **out[head]}
        else:
            out[head] = value
    for role in ("clf", "reg"):
        name = out[f"{role}_name"]
        if name not in HURDLE_PARTS:
            raise ValueError(f"estimator {name} not supported: choose from {HURDLE_PARTS}")
        out[f"{role}_params"] = effective(name, {**HURDLE_DEFAULTS.get(name, {}), **out[f"{role}_params"]})
    return out


def search(df: DataFrame, features: list[str], label: str, pipeline: list[tuple[str, str]], trials: list[dict], fold: str = "fold",
           key: str = "row_id", mask: Column | None = None, scorers: list[Scorer] = (), parallelism: int = 4) -> DataFrame:
    """Long results, one row per (trial, fold, set, metric), of every trial of a pipeline.

    Folds run beside each other on a few driver threads. In a fold the trials form a
    tree: what they share from the first step on is fitted and computed once, models
    with equal effective parameters are one fit, and all models behind one chain of
    steps are scored in one pass. Training rows are those of the other folds (and of
    ``mask``); both sets are scored. A step or model that cannot be fitted scores NaN
    and the log has the reason; if nothing could be fitted, that is an error.
    ``scorers`` add metrics of one's own.
    """
    chains = [resolve(pipeline, t) for t in trials]
    tasks = {task_of(c[-1][1]) for c in chains}
    if len(tasks) != 1:
        raise ValueError("trials of one search are all of one task")
    task = tasks.pop()
    names = [*(REGRESSION if task == "regression" else CLASSIFICATION), *(s.name for s in scorers)]
    data = df.persist()
    folds = sorted(r[0] for r in data.select(ident(fold)).distinct().collect())
    run = _Run(data, label, fold, key, mask)
    shared: dict = {}

    def below(node: Node, at: int, own: list[int], k, shares: dict) -> list[tuple]:
        name = chains[own[0]][at][0]
        if at == len(pipeline) - 1:
            return leaves(node, own, k)
        groups: dict = {}
        for t in own:
            groups.setdefault(frozen(list(chains[t][at][1:])), []).append(t)
        rows = []
        for setting, group in groups.items():
            _, what, params = chains[group[0]][at]
            try:
                nxt = run.step(node, name, what, params, k, task, any(chains[t][-1][1] == HURDLE for t in group))
            except FAILURES as err:
                log.warning("step %s of fold %s failed: %s", name, k, str(err)[:200])
                rows += missing(group, k)
                continue
            own_shares = shares
            if nxt is not node and nxt.shared is not None:
                # one set of moments serves this setting in all folds
                with run.lock:
                    own_shares = shares.setdefault(("step", setting), {})
                    nxt.shared = own_shares.setdefault("moments", {})
            keep = len(group) > 1 and nxt is not node
            if keep:
                nxt.df = nxt.df.persist()
            rows += below(nxt, at + 1, group, k, own_shares)
            if keep:
                nxt.df.unpersist()
        return rows

    def missing(own: list[int], k) -> list[tuple]:
        return [(t, str(trials[t]), int(k), s, m, math.nan) for t in own for s in ("train", "val") for m in names]

    def leaves(node: Node, own: list[int], k) -> list[tuple]:
        made: dict = {}
        fitted: dict = {}
        rows, at = [], {}
        for t in own:
            _, model, params = chains[t][-1]
            spec = (model, frozen(params))
            at.setdefault(spec, []).append(t)
            if spec in fitted:
                continue
            try:
                fitted[spec] = run.fit(node, model, params, k, made)
            except FAILURES as err:
                log.warning("trial %s fold %s failed: %s", t, k, str(err)[:200])
                fitted[spec] = None
        good = [s for s, m in fitted.items() if m is not None]
        for s in fitted:
            if fitted[s] is None:
                rows += missing(at[s], k)
        tagged = node.df.withColumn("__set", F.when(F.col(ident(fold)) == k, "val").otherwise("train"))
        if mask is not None:
            tagged = tagged.filter((F.col("__set") == "val") | mask)
        for start in range(0, len(good), SCORED_AT_ONCE):
            part = good[start:start + SCORED_AT_ONCE]
            try:
                values = _scored(tagged, [fitted[s] for s in part], label, task, scorers)
            except FAILURES as err:
                log.warning("scores of fold %s failed: %s", k, str(err)[:200])
                values = {}
            for i, s in enumerate(part):
                rows += [(t, str(trials[t]), int(k), side, m, float(values.get((i, side, m), math.nan)))
                         for t in at[s] for side in ("train", "val") for m in names]
        return rows

    def one(k):
        return below(Node(data, list(features), {}, shared.setdefault("moments", {})), 0, list(range(len(trials))), k, shared)

    with ThreadPool(max(1, min(parallelism, len(folds)))) as pool:
        rows = [r for part in pool.imap(one, folds) for r in part]
    data.unpersist()
    log.info("%s trials in %s folds took %s fits", len(trials), len(folds), run.fits)
    if rows and all(math.isnan(r[-1]) for r in rows):
        raise ValueError("no trial could be fitted; the log has the reasons")
    return small_table(df.sparkSession, sorted(rows, key=lambda r: (r[0], r[2])), RESULT_SCHEMA)


def _scored(tagged: DataFrame, fitted: list[Fitted], label: str, task: str, scorers: list[Scorer]) -> dict:
    """{(model, set, metric): value} of several models from one pass."""
    wide = tagged
    for i, m in enumerate(fitted):
        wide = m.transform(wide)
        score = F.col("score") if "score" in wide.columns else F.lit(None)
        wide = wide.withColumns({f"__p{i}": F.col("prediction").cast("double"), f"__s{i}": score.cast("double")}).drop("prediction", "score")
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"__p{i}").alias("prediction"), F.col(f"__s{i}").alias("score"))
                                for i in range(len(fitted))]))
    long = wide.select(dbl(label).alias("__y"), "__set", cells.alias("m")).select(
        "__y", F.concat_ws(":", "m.i", "__set").alias("__by"), "m.prediction", "m.score").persist()
    out = {}
    for by, metric, value in [*metrics_by_set(long, "__y", "__by", task), *scores_by(long, "__y", "__by", scorers)]:
        i, side = by.split(":")
        out[int(i), side, metric] = value
    long.unpersist()
    return out


def fit_pipeline(df: DataFrame, features: list[str], label: str, pipeline: list[tuple[str, str]], trial: dict, key: str = "row_id") -> Fitted:
    """The whole pipeline of one trial fitted on every row, as one model that can be saved."""
    *steps, (_, model, params) = resolve(pipeline, trial)
    data = df.withColumn("__fold", F.lit(0))
    run = _Run(data, label, "__fold", key, None)
    node = Node(data, list(features), {}, None)
    for name, what, own in steps:
        node = run.step(node, name, what, own, None, task_of(model), model == HURDLE)
    return Fitted("sequence", {"stages": [*node.stages, run.fit(node, model, params, None, {})]})


def best_pipeline(df: DataFrame, results: DataFrame, features: list[str], label: str, pipeline: list[tuple[str, str]], trials: list[dict],
                  metric: str, scorers: list[Scorer] = (), key: str = "row_id") -> tuple[int, Fitted]:
    """(number, model) of the trial with the best mean of ``metric`` on the held-out folds, fitted on every row."""
    from tabspark.operators.metrics import minimised

    down = next((s.minimise for s in scorers if s.name == metric), minimised(metric))
    means = results.filter((F.col("set") == "val") & (F.col("metric") == metric)).groupBy("trial").agg(F.avg("value").alias("v")).collect()
    known = [(r["v"] if down else -r["v"], r["trial"]) for r in means if r["v"] is not None and not math.isnan(r["v"])]
    if not known:
        raise ValueError(f"no results for metric {metric!r}")
    best = min(known)[1]
    return best, fit_pipeline(df, features, label, pipeline, trials[best], key)


# --- decision thresholds ----------------------------------------------------------------------

@kind("threshold")
def _threshold(df, s):
    """The class of a score at the tuned threshold."""
    return s["inner"].transform(df).withColumn("prediction", F.when(F.col("score") >= F.lit(s["threshold"]), 1.0).otherwise(0.0))


def out_of_fold(df: DataFrame, features: list[str], label: str, pipeline: list[tuple[str, str]], trial: dict, fold: str = "fold",
                key: str = "row_id") -> DataFrame:
    """``df`` with the score of a pipeline that was fitted on the other folds."""
    data = df.persist()
    folds = sorted(r[0] for r in data.select(ident(fold)).distinct().collect())
    out = None
    for k in folds:
        model = fit_pipeline(data.filter(F.col(ident(fold)) != k), features, label, pipeline, trial, key)
        own = data.filter(F.col(ident(fold)) == k)
        scored = own.join(model.transform(own).select(ident(key), dbl("score").alias("score")), key)
        out = scored if out is None else out.unionByName(scored)
    return out


def tune_threshold(df: DataFrame, features: list[str], label: str, pipeline: list[tuple[str, str]], trial: dict, fold: str = "fold",
                   key: str = "row_id", thresholds: list[float] | None = None, objective=f1_macro_from) -> tuple[Fitted, DataFrame]:
    """(model, curve): the pipeline fitted on every row, with the threshold that is best on rows each fold's own fit has not seen.

    ``curve`` has the mean objective of the folds at every threshold; ties go to the lowest. ``key`` is unique.
    """
    scored = out_of_fold(df, features, label, pipeline, trial, fold, key)
    curve = curves.threshold_curve(scored, label, "score", fold, thresholds or curves.threshold_grid()).persist()
    best = curves.best_threshold(curve).first()
    inner = fit_pipeline(df, features, label, pipeline, trial, key)
    return Fitted("threshold", {"inner": inner, "threshold": float(best["threshold"])}, {"score": best["score"]}), curve
