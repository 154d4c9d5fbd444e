"""Univariate feature scores, role selection and recursive elimination."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Estimator
from pyspark.sql import DataFrame, functions as F

from tabspark.functions.scalar import dbl, equal_width_bin, ident
from tabspark.functions.special import f_upper
from tabspark.operators import gram as G
from tabspark.operators.fitted import Fitted, kind
from tabspark.operators.roles import infer_roles
from tabspark.operators.small import small_table


def skew_sets(df: DataFrame, numerical: list[str], threshold: float = 0.75) -> tuple[list[str], list[str], dict]:
    """(skewed by descending skewness, non-skewed, skewness per column)."""
    row = df.agg(*[F.skewness(dbl(c)) for c in numerical]).first() if numerical else []
    sk = {c: (v if v is not None and not math.isnan(v) else 0.0) for c, v in zip(numerical, row)}
    skewed = sorted((c for c in numerical if abs(sk[c]) > threshold), key=lambda c: -sk[c])
    return skewed, [c for c in numerical if c not in skewed], sk


class FeatureSetDecider(Estimator):
    """Keeps the categorical, numerical, skewed or non_skewed columns."""

    MODES = ("categorical", "numerical", "skewed", "non_skewed")

    def __init__(self, mode: str, skew_threshold: float = 0.75, keep: tuple[str, ...] = (), **role_flags):
        super().__init__()
        if mode not in self.MODES:
            raise ValueError(f"mode must be one of {self.MODES}")
        self.mode, self.skew_threshold, self.keep, self.role_flags = mode, skew_threshold, keep, role_flags

    def _fit(self, df: DataFrame) -> "FeatureSetModel":
        roles = infer_roles(df.drop(*self.keep), **self.role_flags)
        if self.mode in ("categorical", "numerical"):
            return FeatureSetModel(list(getattr(roles, self.mode)), self.keep)
        skewed, rest, _ = skew_sets(df, list(roles.numerical), self.skew_threshold)
        return FeatureSetModel(skewed if self.mode == "skewed" else rest, self.keep)


class FeatureSetModel(Fitted):
    def __init__(self, columns: list[str], keep: tuple[str, ...] = ()):
        super().__init__("columns", {"columns": list(columns), "keep": list(keep)})

    @property
    def columns(self) -> list[str]:
        return self.state["columns"]

    def feature_names_out(self) -> list[str]:
        return list(self.columns)


@kind("columns")
def _columns(df, s):
    return df.select(*map(ident, [*s["keep"], *s["columns"]]))


def feature_set_table(df: DataFrame, columns: list[str], threshold: float = 0.75) -> DataFrame:
    skewed, _, sk = skew_sets(df, columns, threshold)
    return small_table(df.sparkSession, 
        [(c, float(sk[c]), "skewed" if c in skewed else "non_skewed") for c in columns],
        "column string, skewness double, set string")


def _ranked_scores(df, rows: list[tuple[str, float]], k: int | None = None) -> DataFrame:
    order = sorted(rows, key=lambda r: (-r[1] if not math.isnan(r[1]) else math.inf, r[0]))
    out = [(c, float(s), i + 1) for i, (c, s) in enumerate(order)]
    return small_table(df.sparkSession, out[:k] if k else out, "feature string, score double, rank bigint")


def anova_scores(df: DataFrame, features: list[str], target: str, k: int | None = None) -> DataFrame:
    """One-way ANOVA F per feature from per-class moments (top k, ties by name)."""
    shift = G._pilot_shift(df, features)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(features):
        x = dbl(c) - F.lit(float(shift[i]))
        aggs += [F.sum(x).alias(f"s{i}"), F.sum(x * x).alias(f"q{i}")]
    rows = df.filter(F.col(ident(target)).isNotNull()).groupBy(ident(target)).agg(*aggs).collect()
    n, classes = sum(r["n"] for r in rows), len(rows)
    out = []
    for i, c in enumerate(features):
        total = sum(r[f"s{i}"] for r in rows)
        between = sum(r[f"s{i}"] ** 2 / r["n"] for r in rows) - total ** 2 / n
        within = sum(r[f"q{i}"] - r[f"s{i}"] ** 2 / r["n"] for r in rows)
        f = (between / (classes - 1)) / (within / (n - classes)) if within > 0 else math.nan
        out.append((c, f))
    return _ranked_scores(df, out, k)


def regression_f_scores(df: DataFrame, features: list[str], target: str, k: int | None = None) -> DataFrame:
    """F = r^2 (n-2) / (1-r^2) per feature, on the rows that have this feature and the target."""
    y = dbl(target)
    row = df.agg(*[F.struct(F.regr_sxy(y, dbl(c)), F.regr_sxx(y, dbl(c)), F.regr_syy(y, dbl(c)), F.regr_count(y, dbl(c))).alias(f"f{i}")
                   for i, c in enumerate(features)]).first()
    out = []
    for name, (sxy, sxx, syy, n) in zip(features, row):
        r2 = sxy * sxy / (sxx * syy) if sxx and syy else math.nan
        out.append((name, math.inf if r2 >= 1 else r2 * (n - 2) / (1 - r2)))
    return _ranked_scores(df, out, k)


def f_p_value(score: float, d1: float, d2: float) -> float:
    return f_upper(score, d1, d2)


def _binned(df, columns, bins):
    row = df.agg(*[F.struct(F.min(dbl(c)), F.max(dbl(c))) for c in columns]).first()
    return {c: equal_width_bin(dbl(c), lo, hi, bins) for c, (lo, hi) in zip(columns, row)}


def _mutual_information(cells: DataFrame) -> DataFrame:
    """Mutual information per feature from (feature, a, b) rows, in nats."""
    joint = cells.groupBy("feature", "a", "b").agg(F.count(F.lit(1)).alias("n")).cache()
    rows = joint.groupBy("feature", "a").agg(F.sum("n").alias("na"))
    cols = joint.groupBy("feature", "b").agg(F.sum("n").alias("nb"))
    total = joint.groupBy("feature").agg(F.sum("n").alias("nt"))
    full = joint.join(rows, ["feature", "a"]).join(cols, ["feature", "b"]).join(total, "feature")
    p = F.col("n") / F.col("nt")
    return full.groupBy("feature").agg(
        F.sum(p * F.log(F.col("n") * F.col("nt") / (F.col("na") * F.col("nb")))).alias("score"))


def mutual_information(df: DataFrame, features: list[str], target: str, bins: int = 10,
                       regression: bool = False) -> DataFrame:
    """Binned mutual information with a class, or with a binned numeric target."""
    df = df.filter(F.col(ident(target)).isNotNull())
    binned = _binned(df, [*features, target] if regression else features, bins)
    b = binned[target] if regression else F.col(ident(target)).cast("string")
    cells = df.select(b.alias("b"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), binned[c].alias("a")) for c in features])).alias("e"))
    return _mutual_information(cells.select("e.feature", "e.a", "b"))


def chi2_scores(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Sum over classes of (observed - expected)^2 / expected, observed being the feature sum."""
    rows = (df.filter(F.col(ident(target)).isNotNull()).groupBy(ident(target))
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(dbl(c)).alias(f"s{i}") for i, c in enumerate(features)])
            .collect())
    n = sum(r["n"] for r in rows)
    out = []
    for i, c in enumerate(features):
        total = sum(r[f"s{i}"] for r in rows)
        out.append((c, float(sum((r[f"s{i}"] - total * r["n"] / n) ** 2 / (total * r["n"] / n) for r in rows))))
    return small_table(df.sparkSession, out, "feature string, score double")


def univariate_cv_rank(df: DataFrame, features: list[str], target: str, fold: str = "fold",
                       scoring: str = "neg_rmse") -> DataFrame:
    """Features by the mean CV score of a one-feature linear fit.

    Per-fold moments give every fit: training moments are total minus fold.
    Standardising the feature does not change a least-squares prediction.
    """
    parts = G.grams_by(df, [*features, target], fold)
    total = G.sum_grams(parts.values())
    rows = []
    for c in features:
        scores = []
        for part in parts.values():
            fit = G.least_squares(total - part, [c], target)
            sse = G.validation_sse(part, fit, target)
            iy = part.names.index(target)
            scores.append({"neg_rmse": -math.sqrt(sse / part.n), "neg_mse": -sse / part.n,
                           "r2": 1 - sse / part.scatter[iy, iy]}[scoring])
        rows.append((c, float(np.mean(scores))))
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    return small_table(df.sparkSession, 
        [(c, s, i + 1) for i, (c, s) in enumerate(order)], f"feature string, {scoring} double, rank bigint")


def rfe_cv(df: DataFrame, features: list[str], target: str, fold: str = "fold", step: int = 50,
           max_iter: int = 20, max_depth: int = 3, seed: int = 42, parallelism: int = 4) -> DataFrame:
    """Recursive elimination by boosted-tree importance, macro F1 per feature count and fold."""
    from multiprocessing.pool import ThreadPool

    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    from tabspark.operators.metrics import macro_f1

    folds = [r[0] for r in df.select(fold).distinct().orderBy(fold).collect()]
    base = df.select(F.col(ident(fold)).alias("fold"), dbl(target).alias("label"),
                     *[dbl(c).alias(c) for c in features]).persist()

    def run(f):
        left, scores = list(features), []
        train, val = base.filter(F.col("fold") != f), base.filter(F.col("fold") == f)
        while True:
            asm = VectorAssembler(inputCols=left, outputCol="features")
            model = GBTClassifier(maxIter=max_iter, maxDepth=max_depth, seed=seed).fit(asm.transform(train))
            scored = model.transform(asm.transform(val)).select("label", "prediction")
            scores.append((len(left), macro_f1(scored, "label", "prediction")))
            if len(left) == 1:
                return scores
            imp = model.featureImportances.toArray()
            drop = min(step, len(left) - 1)
            gone = {left[i] for i in np.argsort(imp, kind="stable")[:drop]}
            left = [c for c in left if c not in gone]

    with ThreadPool(min(parallelism, len(folds))) as pool:
        runs = pool.map(run, folds)
    rows = [(n, float(s)) for run_scores in runs for n, s in run_scores]
    return (small_table(df.sparkSession, rows, "n_features bigint, score double")
            .groupBy("n_features").agg(F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score")))
