"""Second moments in one distributed pass, and the p x p algebra that follows.

Correlation, least squares, ridge, VIF, leverage and the elimination tests need
only n, the column sums and the cross products.  Those are one aggregate over the
table; everything afterwards is p x p NumPy on the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tabspark.functions.scalar import dbl, dot, ident, num
from tabspark.functions.special import f_upper, pearson_p, t_two_sided
from tabspark.operators.small import small_table

EXPRESSION_COLUMNS = 16
PILOT_ROWS = 256


@dataclass(frozen=True)
class Gram:
    """Moments of the columns shifted by ``shift``."""

    names: tuple[str, ...]
    n: float
    shift: np.ndarray
    s1: np.ndarray
    s2: np.ndarray

    def __sub__(self, other: "Gram") -> "Gram":
        return Gram(self.names, self.n - other.n, self.shift, self.s1 - other.s1, self.s2 - other.s2)

    def __add__(self, other: "Gram") -> "Gram":
        return Gram(self.names, self.n + other.n, self.shift, self.s1 + other.s1, self.s2 + other.s2)

    def index(self, cols) -> list[int]:
        return [self.names.index(c) for c in cols]

    @property
    def mean(self) -> np.ndarray:
        return self.shift + self.s1 / self.n

    @property
    def scatter(self) -> np.ndarray:
        """Centred cross products."""
        return self.s2 - np.outer(self.s1, self.s1) / self.n

    @property
    def raw(self) -> np.ndarray:
        """Uncentred cross products."""
        m = self.mean
        return self.scatter + self.n * np.outer(m, m)

    def corr(self) -> np.ndarray:
        c = self.scatter
        v = np.diag(c).copy()
        v[v <= 1e-14 * np.maximum(1.0, self.n * self.mean ** 2)] = np.nan
        return np.clip(c / np.sqrt(np.outer(v, v)), -1.0, 1.0)


def _pilot_shift(df: DataFrame, columns: list[str]) -> np.ndarray:
    """A point near the data: the mean of a few rows, only for numerical safety."""
    rows = df.selectExpr(*[f"CAST({ident(c)} AS DOUBLE) AS x{i}" for i, c in enumerate(columns)]).take(PILOT_ROWS)
    seen = np.array([[math.nan if v is None else v for v in r] for r in rows], dtype=float).reshape(-1, len(columns))
    seen = np.where(np.isfinite(seen), seen, math.nan)
    known = ~np.isnan(seen)
    return np.where(known, seen, 0.0).sum(0) / np.maximum(known.sum(0), 1)


def grams_by(df: DataFrame, columns: list[str], by: str | None = None) -> dict:
    """One Gram per value of ``by`` (few values, such as folds); key None without it.

    Rows with a null or NaN in any of the columns take no part, at any number of columns.
    """
    shift = _pilot_shift(df, columns)
    p = len(columns)
    group = f"{ident(by)} AS g" if by else "0 AS g"
    cells = [f"CAST({ident(c)} AS DOUBLE) - {num(s)}" for c, s in zip(columns, shift)]
    if p <= EXPRESSION_COLUMNS:
        x = df.selectExpr(group, *[f"{e} AS x{i}" for i, e in enumerate(cells)]).dropna(
            subset=[f"x{i}" for i in range(p)])
        aggs = [F.count(F.lit(1)).cast("double").alias("n")]
        aggs += [F.sum(f"x{i}").alias(f"a{i}") for i in range(p)]
        aggs += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"b{i}_{j}")
                 for i in range(p) for j in range(i, p)]
        grouped = x.groupBy("g").agg(*aggs) if by else x.agg(F.lit(0).alias("g"), *aggs)
        cells = []
        for row in grouped.collect():
            cells.append((row[0], -1, -1, row[1]))
            cells += [(row[0], -1, i, row[2 + i]) for i in range(p)]
            pos = 2 + p
            for i in range(p):
                for j in range(i, p):
                    cells.append((row[0], i, j, row[pos]))
                    pos += 1
    else:
        x = df.selectExpr(group, f"array({', '.join(cells)}) AS x").filter(
            "NOT exists(x, v -> v IS NULL OR isnan(v))")
        cells = [tuple(r) for r in _partial_products(x, p).groupBy("g", "i", "j")
                 .agg(F.sum("v").alias("v")).collect()]
    parts: dict = {}
    for g, i, j, v in cells:
        n, s1, s2 = parts.setdefault(g, ([0.0], np.zeros(p), np.zeros((p, p))))
        if v is None:
            continue
        if i >= 0:
            s2[i, j] = s2[j, i] = v
        elif j >= 0:
            s1[j] = v
        else:
            n[0] = v
    return {g if by else None: Gram(tuple(columns), n[0], shift, s1, s2) for g, (n, s1, s2) in parts.items()}


def _partial_products(x: DataFrame, p: int) -> DataFrame:
    """Per-partition cross products for wide tables, summed by the caller."""
    iu = np.triu_indices(p)

    def partial(batches):
        acc: dict = {}
        for pdf in batches:
            for g, part in pdf.groupby("g", sort=False):
                m = np.stack(part["x"].to_numpy())
                n, a, b = acc.get(g, (0.0, np.zeros(p), np.zeros((p, p))))
                acc[g] = (n + len(m), a + m.sum(0), b + m.T @ m)
        for g, (n, a, b) in acc.items():
            yield pd.DataFrame({
                "g": g,
                "i": np.concatenate([[-1], np.full(p, -1), iu[0]]),
                "j": np.concatenate([[-1], np.arange(p), iu[1]]),
                "v": np.concatenate([[n], a, b[iu]]),
            })

    gtype = dict(x.dtypes)["g"]
    return x.mapInPandas(partial, f"g {gtype}, i int, j int, v double")


def gram(df: DataFrame, columns: list[str]) -> Gram:
    return grams_by(df, columns)[None]


# --- correlation ---------------------------------------------------------------

def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r for every column pair i<j in column order (null for constants).

    Pairs use the rows where both are present, as long as nulls exist at all.
    """
    rows = _corr_rows(df, columns)
    return small_table(df.sparkSession, 
        [(a, b, None if math.isnan(r) else r) for a, b, r, _ in rows],
        "col_i string, col_j string, r double")


def _corr_rows(df, columns):
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1, len(columns))]
    g = gram(df, columns)
    if g.n == df.count():
        c = g.corr()
        return [(columns[i], columns[j], float(c[i, j]), g.n) for i, j in pairs]
    out = []
    for start in range(0, len(pairs), 64):
        chunk = pairs[start:start + 64]
        row = df.agg(*[F.struct(F.regr_sxy(dbl(columns[i]), dbl(columns[j])),
                                F.regr_sxx(dbl(columns[i]), dbl(columns[j])),
                                F.regr_syy(dbl(columns[i]), dbl(columns[j])),
                                F.regr_count(dbl(columns[i]), dbl(columns[j]))).alias(f"p{k}")
                       for k, (i, j) in enumerate(chunk)]).first()
        for (i, j), (sxy, sxx, syy, n) in zip(chunk, row):
            ok = sxx and syy
            out.append((columns[i], columns[j], sxy / math.sqrt(sxx * syy) if ok else math.nan, n))
    return out


def correlated_columns(df: DataFrame, columns: list[str], threshold: float = 0.95,
                       use_p_value: bool = True, p_value_threshold: float = 0.05) -> DataFrame:
    """Columns to prune: each flagged once, with its first partner in column order."""
    found: dict[str, tuple] = {}
    for a, b, r, n in _corr_rows(df, columns):
        if math.isnan(r) or abs(r) < threshold or b in found:
            continue
        p = pearson_p(r, n)
        if not use_p_value or p < p_value_threshold:
            found[b] = (b, a, r, p)
    return small_table(df.sparkSession, 
        [found[c] for c in columns if c in found],
        "column string, partner string, r double, p_value double")


# --- least squares ---------------------------------------------------------------

@dataclass(frozen=True)
class LinearFit:
    features: tuple[str, ...]
    coef: np.ndarray
    intercept: float
    rss: float
    tss: float
    n: float
    std_err: np.ndarray
    intercept_err: float

    @property
    def r2(self) -> float:
        return 1.0 - self.rss / self.tss if self.tss else math.nan

    @property
    def df_resid(self) -> float:
        return self.n - len(self.features) - 1

    def t_values(self) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.coef / self.std_err

    def p_values(self) -> list[float]:
        return [t_two_sided(float(t), self.df_resid) for t in self.t_values()]

    def predict(self):
        """Prediction as a column expression."""
        if not self.features:
            return F.lit(self.intercept)
        return dot([dbl(c) for c in self.features], self.coef) + F.lit(float(self.intercept))


def _pinv(m: np.ndarray) -> np.ndarray:
    d = np.sqrt(np.clip(np.diag(m), 0, None))
    d[d == 0] = 1.0
    return np.linalg.pinv(m / np.outer(d, d), rcond=1e-12, hermitian=True) / np.outer(d, d)


def least_squares(g: Gram, features: list[str], target: str, alpha: float = 0.0,
                  fit_intercept: bool = True) -> LinearFit:
    """Ordinary (alpha 0) or ridge least squares from the moments."""
    ix, iy = g.index(features), g.names.index(target)
    m = g.scatter if fit_intercept else g.raw
    a = m[np.ix_(ix, ix)] + alpha * np.eye(len(ix))
    b = m[ix, iy]
    inv = _pinv(a)
    coef = inv @ b
    intercept = float(g.mean[iy] - g.mean[ix] @ coef) if fit_intercept else 0.0
    tss = float(m[iy, iy])
    rss = float(tss - 2 * coef @ b + coef @ m[np.ix_(ix, ix)] @ coef)
    dof = g.n - len(ix) - (1 if fit_intercept else 0)
    s2 = rss / dof if dof > 0 else math.nan
    err = np.sqrt(np.clip(np.diag(inv) * s2, 0, None))
    mu = g.mean[ix]
    ierr = math.sqrt(max(s2 * (1.0 / g.n + mu @ inv @ mu), 0.0)) if dof > 0 and fit_intercept else math.nan
    return LinearFit(tuple(features), coef, intercept, max(rss, 0.0), tss, g.n, err, ierr)


def positive_least_squares(g: Gram, features: list[str], target: str, alpha: float = 0.0, fit_intercept: bool = True,
                           rounds: int = 10_000) -> LinearFit:
    """Least squares with no coefficient below zero: columns enter and leave a free set (p x p algebra)."""
    ix, iy = g.index(features), g.names.index(target)
    m = g.scatter if fit_intercept else g.raw
    a, b = m[np.ix_(ix, ix)] + alpha * np.eye(len(ix)), m[ix, iy]
    coef, free = np.zeros(len(ix)), np.zeros(len(ix), bool)
    limit = 1e-10 * max(np.abs(b).max(initial=0.0), 1e-300)
    for _ in range(rounds):
        slope = np.where(free, -np.inf, b - a @ coef)
        if free.all() or slope.max() <= limit:
            break
        free[int(slope.argmax())] = True
        while True:
            new = np.zeros(len(ix))
            new[free] = _pinv(a[np.ix_(free, free)]) @ b[free]
            if not (free & (new <= 0)).any():
                break
            low = np.flatnonzero(free & (new <= 0))
            part = coef[low] / np.maximum(coef[low] - new[low], 1e-300)
            coef = coef + part.min() * (new - coef)
            free[low[part <= part.min()]] = False
            coef[~free] = 0.0
        coef = new
    intercept = float(g.mean[iy] - g.mean[ix] @ coef) if fit_intercept else 0.0
    rss = float(m[iy, iy] - 2 * coef @ b + coef @ m[np.ix_(ix, ix)] @ coef)
    return LinearFit(tuple(features), coef, intercept, max(rss, 0.0), float(m[iy, iy]), g.n, np.full(len(ix), math.nan), math.nan)


def ols_table(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Term, coefficient, standard error, t and p, plus the R2 row."""
    fit = least_squares(gram(df, [*features, target]), features, target)
    t0 = fit.intercept / fit.intercept_err if fit.intercept_err else math.nan
    rows = [("const", fit.intercept, fit.intercept_err, t0, t_two_sided(t0, fit.df_resid))]
    rows += [(c, float(b), float(e), float(t), p) for c, b, e, t, p in
             zip(features, fit.coef, fit.std_err, fit.t_values(), fit.p_values())]
    rows.append(("r2", fit.r2, None, None, None))
    return small_table(df.sparkSession, 
        rows, "term string, coef double, std_err double, t double, p_value double")


def vif_values(g: Gram, features: list[str]) -> list[float]:
    """Uncentred variance inflation: G_ii (G^-1)_ii."""
    ix = g.index(features)
    m = g.raw[np.ix_(ix, ix)]
    return [float(v) for v in np.diag(m) * np.diag(_pinv(m))]


def vif_table(df: DataFrame, features: list[str]) -> DataFrame:
    return small_table(df.sparkSession, 
        list(zip(features, vif_values(gram(df, features), features))), "feature string, vif double")


def ridge_path(df: DataFrame, features: list[str], target: str, alphas: list[float]) -> DataFrame:
    """Ridge coefficients for every alpha from one pass."""
    g = gram(df, [*features, target])
    rows = []
    for a in alphas:
        fit = least_squares(g, features, target, a)
        rows += [(float(a), c, float(b)) for c, b in zip(features, fit.coef)]
        rows.append((float(a), "const", fit.intercept))
    return small_table(df.sparkSession, rows, "alpha double, term string, coef double")


def ridge_grid_cv(df: DataFrame, features: list[str], target: str, alphas: list[float],
                  fold: str = "fold") -> DataFrame:
    """Cross-validated RMSE of every alpha from per-fold moments: one pass for all fits."""
    parts = grams_by(df, [*features, target], fold)
    total = sum_grams(parts.values())
    rows = []
    for a in alphas:
        errs = []
        for part in parts.values():
            fit = least_squares(total - part, features, target, a)
            errs.append(math.sqrt(validation_sse(part, fit, target) / part.n))
        rows.append((float(a), float(np.mean(errs))))
    order = sorted(rows, key=lambda r: r[1])
    rank = {a: 1 + sum(1 for _, e in order if e < err) for a, err in rows}
    return small_table(df.sparkSession, 
        [(a, e, rank[a]) for a, e in rows], "alpha double, rmse double, rank bigint")


def sum_grams(parts) -> Gram:
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def validation_sse(g: Gram, fit: LinearFit, target: str) -> float:
    """Squared error of a fit on the rows behind ``g``."""
    ix, iy = g.index(fit.features), g.names.index(target)
    w = np.zeros(len(g.names))
    w[iy] = 1.0
    w[ix] = -fit.coef
    bias = float(w @ g.mean - fit.intercept)
    return float(w @ g.scatter @ w + g.n * bias * bias)


# --- leverage -----------------------------------------------------------------------

def leverage(df: DataFrame, features: list[str], g: Gram | None = None):
    """Hat diagonal x' G+ x as a column (no intercept added), by Arrow batches; null where a feature is null."""
    g = g or gram(df, features)
    ix = g.index(features)
    inv = _pinv(g.raw[np.ix_(ix, ix)])

    @F.pandas_udf("double")
    def quadratic(rows: pd.Series) -> pd.Series:
        m = np.stack(rows.to_numpy()).astype(float) if len(rows) else np.zeros((0, len(inv)))
        return pd.Series(np.einsum("ij,jk,ik->i", m, inv, m, optimize=True))

    x = [dbl(c) for c in features]
    whole = x[0].isNotNull()
    for c in x[1:]:
        whole = whole & c.isNotNull()
    return F.when(whole, quadratic(F.array(*[F.coalesce(c, F.lit(0.0)) for c in x])))


def hat_diag(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    return df.select(*map(ident, keep), leverage(df, features).alias("h"))


# --- backward elimination ---------------------------------------------------------------

def backward_elimination(df: DataFrame, features: list[str], target: str, test: str = "t",
                         significance_level: float = 0.05, vif_threshold: float | None = None):
    """(feature, kept, round, reason) rows; one feature leaves per round, one is always kept.

    The t and the partial F test share this loop because F = t squared.
    """
    g = gram(df, [*features, target])
    left, log = list(features), []
    while len(left) > 1:
        fit = least_squares(g, left, target)
        if test == "t":
            ps = fit.p_values()
            worst = int(np.nanargmax(ps))
            p, label = ps[worst], "p-value"
        else:
            f = fit.t_values() ** 2
            worst = int(np.nanargmin(f))
            p, label = f_upper(float(f[worst]), 1.0, fit.df_resid), "F-statistic"
        if p > significance_level:
            gone, reason = left[worst], f"{label}"
        else:
            vifs = vif_values(g, left) if vif_threshold is not None else []
            if not vifs or max(vifs) <= vif_threshold:
                break
            gone, reason = left[int(np.argmax(vifs))], "VIF"
        left.remove(gone)
        log.append((gone, 0, len(log) + 1, reason))
    return [(c, 1, 0, "significant") for c in left] + log


def backward_table(df: DataFrame, features: list[str], target: str, **options) -> DataFrame:
    return small_table(df.sparkSession, 
        backward_elimination(df, features, target, **options),
        "feature string, kept bigint, round bigint, reason string")


def non_significant_columns(df: DataFrame, features: list[str], target: str, test: str = "t",
                            significance_level: float = 0.05, vif_threshold: float | None = None) -> list[str]:
    rows = backward_elimination(df, features, target, test, significance_level, vif_threshold)
    return sorted(r[0] for r in rows if not r[1])
