"""Hyperparameter grids and spaces: lookup, merging, extension and expansion."""

from __future__ import annotations

import math
import random
from copy import deepcopy
from dataclasses import dataclass
from itertools import product

import numpy as np


@dataclass(frozen=True)
class Real:
    low: float
    high: float
    log: bool = False

    def draw(self, rng: random.Random) -> float:
        if self.log:
            return math.exp(rng.uniform(math.log(self.low), math.log(self.high)))
        return rng.uniform(self.low, self.high)


@dataclass(frozen=True)
class Integer:
    low: int
    high: int

    def draw(self, rng: random.Random) -> int:
        return rng.randint(self.low, self.high)


@dataclass(frozen=True)
class Categorical:
    values: tuple

    def draw(self, rng: random.Random):
        return rng.choice(self.values)


# The candidate values of every model; a list holds several grids.
GRIDS: dict[str, dict | list[dict]] = {
    "LinearRegression": {"fit_intercept": [True, False]},
    "Ridge": {"alpha": [0.0005, 0.1, 1.0, 10.0], "fit_intercept": [True, False]},
    "Lasso": {"alpha": [0.0005, 0.1, 1.0, 10.0], "fit_intercept": [True, False]},
    "LassoLars": {"alpha": [0.0005, 0.1, 1.0, 10.0], "fit_intercept": [True, False]},
    "KernelRidge": {"alpha": [0.0005, 0.1, 1.0, 10.0], "kernel": ["linear", "poly", "rbf"], "degree": [2, 3]},
    "TweedieRegressor": {"power": list(np.linspace(1.0, 2.0, 4)), "alpha": list(np.logspace(-3, 1, 4)), "link": ["log", "identity"],
                         "max_iter": [5000]},
    "GammaRegressor": {"alpha": list(np.linspace(1e-6, 1, 10)), "fit_intercept": [True, False], "solver": ["lbfgs", "newton-cholesky"],
                       "max_iter": [1000, 5000]},
    "PoissonRegressor": {"alpha": list(np.logspace(-3, 1, 10)), "fit_intercept": [True, False]},
    "LGBMRegressor": {"num_leaves": [31, 127], "learning_rate": [0.01, 0.1], "n_estimators": [20, 40]},
    "XGBRegressor": {"n_estimators": [100, 300, 500], "max_depth": [3, 5, 7], "grow_policy": ["depthwise", "lossguide"],
                     "objective": ["reg:squarederror"]},
    "GradientBoostingRegressor": {"n_estimators": [100, 200, 300], "learning_rate": [0.01, 0.1], "max_depth": [3, 5, 7]},
    "SVR": {"C": [0.1, 1, 10, 100], "kernel": ["linear", "rbf", "poly"], "gamma": [0.1, 1, "scale", "auto"]},
    "NuSVR": {"nu": [0.1, 0.5, 0.9], "kernel": ["linear", "rbf", "poly"], "gamma": [0.1, 1, "scale", "auto"]},
    "LinearSVR": {"C": [0.1, 1, 10, 100], "intercept_scaling": [1, 10], "loss": ["epsilon_insensitive", "squared_epsilon_insensitive"],
                  "fit_intercept": [True], "max_iter": [5000]},
    "PassiveAggressiveRegressor": {"C": [0.1, 1, 10, 100, 1000, 100000], "fit_intercept": [True, False], "max_iter": [1000, 5000],
                                   "loss": ["epsilon_insensitive", "squared_epsilon_insensitive"]},
    "SGDRegressor": {"alpha": [0.0001, 0.001, 0.01], "penalty": ["l1", "l2", "elasticnet"],
                     "loss": ["squared_error", "huber", "epsilon_insensitive", "squared_epsilon_insensitive"], "fit_intercept": [True],
                     "max_iter": [5000]},
    "LogisticRegression": [
        {"C": [0.1, 1, 10, 100], "dual": [False, True], "class_weight": ["balanced", None], "intercept_scaling": [1, 10],
         "max_iter": [5000], "tol": [0.0001], "penalty": [None, "l2"], "solver": ["lbfgs"]},
        {"C": [0.1, 1, 10, 100], "dual": [False, True], "class_weight": ["balanced", None], "intercept_scaling": [1, 10],
         "max_iter": [5000], "tol": [0.0001], "penalty": ["l1"], "solver": ["liblinear"]},
        {"C": [0.1, 1, 10, 100], "dual": [False, True], "class_weight": ["balanced", None], "intercept_scaling": [1, 10],
         "max_iter": [5000], "tol": [0.0001], "penalty": ["elasticnet"], "l1_ratio": [0.2, 0.5, 0.75]},
    ],
    "RidgeClassifier": {"alpha": [0.0005, 0.1, 1.0, 10.0], "fit_intercept": [True, False], "class_weight": ["balanced"]},
    "KNeighborsClassifier": {"n_neighbors": [1, 3, 5, 7, 9], "weights": ["uniform", "distance"],
                             "metric": ["cosine", "haversine", "minkowski"]},
    "LinearDiscriminantAnalysis": {"solver": ["svd", "lsqr", "eigen"], "shrinkage": [None, "auto"]},
    "QuadraticDiscriminantAnalysis": {"reg_param": [0, 0.1, 0.5, 1.0]},
    "GaussianNB": {"var_smoothing": [1e-09]},
    "LGBMClassifier": {"num_leaves": [31, 127], "learning_rate": [0.01, 0.1], "n_estimators": [20, 40]},
    "XGBClassifier": {"n_estimators": [100, 300, 500], "max_depth": [3, 5, 7], "grow_policy": ["depthwise", "lossguide"],
                      "objective": ["binary:logistic"]},
    "GradientBoostingClassifier": {"n_estimators": [100, 300, 500], "max_depth": [3, 5, 7], "loss": ["log_loss", "exponential"],
                                   "criterion": ["friedman_mse", "mse"]},
    "SVC": {"C": [0.1, 1, 10, 100], "kernel": ["linear", "rbf", "poly"], "gamma": [0.1, 1, "scale", "auto"], "class_weight": ["balanced"]},
    "NuSVC": {"nu": [0.1, 0.5, 0.9], "kernel": ["linear", "rbf", "poly"], "gamma": [0.1, 1, "scale", "auto"], "class_weight": ["balanced"]},
    "LinearSVC": [
        {"C": [0.1, 1, 10, 100], "class_weight": ["balanced"], "fit_intercept": [True], "max_iter": [5000], "penalty": ["l1"],
         "loss": ["squared_hinge"]},
        {"C": [0.1, 1, 10, 100], "class_weight": ["balanced"], "fit_intercept": [True], "max_iter": [5000], "penalty": ["l2"],
         "loss": ["hinge", "squared_hinge"]},
    ],
    "PassiveAggressiveClassifier": {"C": [0.1, 1, 10, 100], "fit_intercept": [True, False], "max_iter": [5000],
                                    "loss": ["hinge", "squared_hinge"], "class_weight": ["balanced"], "early_stopping": [True]},
    "SGDClassifier": {"alpha": [0.0001, 0.001, 0.01], "penalty": ["l1", "l2", "elasticnet"],
                      "loss": ["hinge", "log_loss", "modified_huber", "squared_hinge", "perceptron"], "class_weight": ["balanced"],
                      "fit_intercept": [True], "max_iter": [5000]},
    "MBSGDClassifier": {"alpha": [0.0001, 0.001, 0.01], "penalty": ["l1", "l2", "elasticnet"], "loss": ["hinge", "log", "squared_loss"],
                        "fit_intercept": [True], "epochs": [1000, 5000]},
}
# What each model is sampled from where that is a range; other parameters are drawn from their candidates.
RANGES: dict[str, dict] = {
    "Ridge": {"alpha": Real(0.0001, 100, log=True)},
    "Lasso": {"alpha": Real(0.0001, 100, log=True)},
    "LassoLars": {"alpha": Real(0.0001, 100, log=True)},
    "KernelRidge": {"alpha": Real(0.0001, 100, log=True), "degree": Integer(2, 3)},
    "TweedieRegressor": {"power": Real(1.0, 2.0), "alpha": Real(0.001, 10, log=True)},
    "GammaRegressor": {"alpha": Real(1e-06, 1, log=True)},
    "PoissonRegressor": {"alpha": Real(0.001, 10, log=True)},
    "LGBMRegressor": {"num_leaves": Integer(31, 127), "learning_rate": Real(0.01, 0.1, log=True), "n_estimators": Integer(20, 40)},
    "XGBRegressor": {"n_estimators": Integer(100, 500), "max_depth": Integer(3, 7)},
    "GradientBoostingRegressor": {"n_estimators": Integer(100, 300), "learning_rate": Real(0.01, 0.1, log=True), "max_depth": Integer(3, 7)},
    "SVR": {"C": Real(0.1, 10, log=True), "gamma": Real(0.01, 0.1, log=True), "degree": Integer(2, 3)},
    "NuSVR": {"nu": Real(0.1, 0.9), "gamma": Real(0.01, 0.1, log=True)},
    "LinearSVR": {"C": Real(0.1, 100, log=True), "intercept_scaling": Integer(1, 10)},
    "PassiveAggressiveRegressor": {"C": Real(0.1, 100000, log=True)},
    "SGDRegressor": {"alpha": Real(0.0001, 0.01, log=True)},
    "LogisticRegression": {"C": Real(0.1, 100, log=True)},
    "RidgeClassifier": {"alpha": Real(0.0001, 100, log=True)},
    "KNeighborsClassifier": {"n_neighbors": Integer(3, 9)},
    "QuadraticDiscriminantAnalysis": {"reg_param": Real(0, 1)},
    "GaussianNB": {"var_smoothing": Real(1e-09, 1e-07, log=True)},
    "LGBMClassifier": {"num_leaves": Integer(31, 127), "learning_rate": Real(0.01, 0.1, log=True), "n_estimators": Integer(20, 40)},
    "XGBClassifier": {"n_estimators": Integer(100, 500), "max_depth": Integer(3, 7)},
    "GradientBoostingClassifier": {"n_estimators": Integer(100, 500), "max_depth": Integer(3, 7),
                                   "learning_rate": Real(0.01, 0.1, log=True)},
    "SVC": {"C": Real(0.1, 10, log=True), "gamma": Real(0.01, 0.1, log=True), "degree": Integer(2, 3)},
    "NuSVC": {"nu": Real(0.1, 0.9), "gamma": Real(0.01, 0.1, log=True)},
    "LinearSVC": {"C": Real(0.1, 100, log=True)},
    "PassiveAggressiveClassifier": {"C": Real(0.1, 100, log=True)},
    "SGDClassifier": {"alpha": Real(0.0001, 0.01, log=True)},
    "MBSGDClassifier": {"alpha": Real(0.0001, 0.01, log=True)},
}


def _space(grid: dict, ranges: dict) -> dict:
    """Ranges where there are any, candidates elsewhere; a range may stand for a parameter that the grid leaves out."""
    return {**{p: ranges.get(p, Categorical(tuple(v))) for p, v in grid.items()}, **{p: r for p, r in ranges.items() if p not in grid}}


def available_grid(model: str, kind: str = "grid"):
    """Grid (``grid``) or sampling space (``bayes``) of a model by name."""
    if kind not in ("grid", "bayes"):
        raise ValueError(f"unknown grid kind {kind!r}")
    if model not in GRIDS:
        raise ValueError(f"no parameter grid for model {model}")
    grid = deepcopy(GRIDS[model])
    if kind == "grid":
        return grid
    ranges = RANGES.get(model, {})
    return [_space(g, ranges) for g in grid] if isinstance(grid, list) else _space(grid, ranges)


def _prefixed(grid, prefix):
    if not prefix:
        return grid
    if isinstance(grid, list):
        return [_prefixed(g, prefix) for g in grid]
    return {f"{prefix}__{k}": v for k, v in grid.items()}


def choose_grid(model: str, kind: str = "grid", prefix: str | None = None):
    return _prefixed(available_grid(model, kind), prefix)


def _as_list(g):
    return g if isinstance(g, list) else [g]


def combine(a, b):
    """Merge grids; two lists are paired up, a list and a dict are distributed."""
    if isinstance(a, dict) and isinstance(b, dict):
        return {**a, **b}
    if isinstance(a, list) and isinstance(b, list):
        return [{**x, **y} for x, y in zip(a, b)]
    return [{**x, **y} for x, y in product(_as_list(a), _as_list(b))]


def truncate(grid, subset: int = 2):
    """First ``subset`` candidates of every list."""
    if isinstance(grid, list):
        return [truncate(g, subset) for g in grid]
    return {k: (v[:subset] if isinstance(v, list) else v) for k, v in grid.items()}


def step_grid(step: str, fixed: dict | None = None, **candidates) -> dict:
    """Candidates of one preprocessing step under ``step__param`` keys."""
    out = {f"{step}__{k}": v for k, v in candidates.items() if v}
    out.update({f"{step}__{k}": [v] for k, v in (fixed or {}).items()})
    return out


def extended_grid(model: str | None, kind: str = "grid", prefix: str = "regressor",
                  pca: dict | None = None, poly: dict | None = None,
                  pca_fixed: dict | None = None, poly_fixed: dict | None = None):
    """A model grid with PCA and polynomial candidates added."""
    base = choose_grid(model, kind, prefix) if model else {}
    extra = {**step_grid("pca", pca_fixed, **(pca or {})), **step_grid("poly", poly_fixed, **(poly or {}))}
    return combine(base, extra)


def hurdle_grid(clf: str, reg: str, kind: str = "grid", scalers: list | None = None, select_k: dict | None = None,
                pca: dict | None = None, poly: dict | None = None) -> list[dict]:
    """Every combination for a two-part pipeline, as one-candidate grids."""
    base = {**({"scaler": scalers} if scalers else {}), **step_grid("pca", **(pca or {})),
            **step_grid("poly", **(poly or {})), **step_grid("select_k_best", **(select_k or {}))}
    out = []
    for c in _as_list(choose_grid(clf, kind, "hurdle__clf_params")):
        for r in _as_list(choose_grid(reg, kind, "hurdle__reg_params")):
            out += [{k: [v] for k, v in t.items()} for t in expand({**base, **c, **r})]
    return out


KERNEL_MAPPED = ("LinearSVC", "NuSVC", "LinearSVR", "NuSVR")


def grids_per_model(base: dict, key: str, kind: str = "grid") -> list[list[dict]]:
    """One grid list per model name in ``base[key]``.

    Kernel-map candidates stay only with the linear and nu support-vector models;
    a dimensionality-reduction step also gets a variant without it.
    """
    out = []
    for model in base[key]:
        mine = []
        for g in _as_list(combine(base, choose_grid(model, kind, key))):
            g = {**g, key: [model]}
            if model not in KERNEL_MAPPED:
                g = {k: v for k, v in g.items() if k != "nystroem" and not k.startswith("nystroem__")}
            mine.append(g)
            if "dimensionality_reduction" in g:
                plain = {k: v for k, v in g.items() if k != "dimensionality_reduction__n_components"}
                mine.append({**plain, "dimensionality_reduction": ["identity"]})
        out.append(mine)
    return out


def expand(grid) -> list[dict]:
    """Cartesian product of a grid, or of each grid in a list."""
    if isinstance(grid, list):
        return [t for g in grid for t in expand(g)]
    keys = list(grid)
    return [dict(zip(keys, vs)) for vs in product(*[grid[k] for k in keys])]


def sample(space, n: int, seed: int = 42) -> list[dict]:
    """Seeded random trials from a space (or a list of spaces)."""
    rng = random.Random(seed)
    spaces = _as_list(space)
    return [{k: (v.draw(rng) if hasattr(v, "draw") else v) for k, v in rng.choice(spaces).items()}
            for _ in range(n)]


def describe(grid) -> str:
    """Text form of a grid."""
    if isinstance(grid, list):
        return "\n".join(f"Grid {i + 1}:\n{describe(g)}" for i, g in enumerate(grid))
    return "\n".join(f"\t{k}: {v}" for k, v in grid.items())
