"""PCA, LDA and ICA: moments in Spark, p x p algebra on the driver, projection as expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tabspark.functions.scalar import dbl, dot, ident
from tabspark.operators import gram as G
from tabspark.operators.small import small_table


def _standardizer(g: G.Gram, p: int, standardize: bool):
    mean = g.mean[:p]
    std = np.sqrt(np.diag(g.scatter)[:p] / g.n) if standardize else np.ones(p)
    std = np.where(std > 0, std, 1.0)
    return mean, std


def _fix_signs(v: np.ndarray) -> np.ndarray:
    """Largest loading of every component is positive."""
    big = np.abs(v).argmax(axis=0)
    return v * np.where(v[big, np.arange(v.shape[1])] < 0, -1.0, 1.0)


def project(df: DataFrame, columns: list[str], mean, weights: np.ndarray, keep: list[str],
            prefix: str = "c") -> DataFrame:
    """(x - mean) @ weights as named columns."""
    x = [dbl(c) - F.lit(float(m)) for c, m in zip(columns, mean)]
    return df.select(*map(ident, keep), *[dot(x, weights[:, k]).alias(f"{prefix}{k + 1}")
                                          for k in range(weights.shape[1])])


def pca_fit(df: DataFrame, columns: list[str], standardize: bool = True):
    """(mean, weights by component, explained-variance ratio)."""
    g = G.gram(df, columns)
    mean, std = _standardizer(g, len(columns), standardize)
    cov = g.scatter / (g.n - 1) / np.outer(std, std)
    val, vec = np.linalg.eigh(cov)
    order = np.argsort(val)[::-1]
    val, vec = np.clip(val[order], 0, None), _fix_signs(vec[:, order])
    return mean, vec / std[:, None], val / val.sum()


def components_for(ratio: np.ndarray, n_components: float | int) -> int:
    """A count, or the fewest components reaching a variance fraction."""
    if isinstance(n_components, float) and n_components < 1:
        return int(np.searchsorted(np.cumsum(ratio), n_components, side="left") + 1)
    return min(int(n_components), len(ratio))


def pca_project(df: DataFrame, columns: list[str], keep: list[str], n_components: float | int = 2,
                standardize: bool = True) -> DataFrame:
    mean, w, ratio = pca_fit(df, columns, standardize)
    return project(df, columns, mean, w[:, :components_for(ratio, n_components)], keep)


def pca_variance(df: DataFrame, columns: list[str], standardize: bool = True) -> DataFrame:
    _, _, ratio = pca_fit(df, columns, standardize)
    rows = [(i + 1, float(r), float(c)) for i, (r, c) in enumerate(zip(ratio, np.cumsum(ratio)))]
    return small_table(df.sparkSession, rows, "component bigint, ratio double, cumulative double")


def lda_project(df: DataFrame, columns: list[str], label: str, keep: list[str], n_components: int = 2,
                standardize: bool = True) -> DataFrame:
    """Discriminant axes from per-class moments; at most min(p, classes - 1)."""
    parts = G.grams_by(df, columns, label)
    total = G.sum_grams(parts.values())
    mean, std = _standardizer(total, len(columns), standardize)
    within = sum(p.scatter for p in parts.values()) / np.outer(std, std)
    between = total.scatter / np.outer(std, std) - within
    k = min(n_components, len(columns), len(parts) - 1)
    sw = within / (total.n - len(parts))
    val, vec = np.linalg.eigh(sw)
    good = val > 1e-10 * val.max()
    white = vec[:, good] / np.sqrt(val[good])
    ev, eu = np.linalg.eigh(white.T @ between @ white)
    axes = _fix_signs(white @ eu[:, np.argsort(ev)[::-1][:k]])
    return project(df, columns, mean, axes / std[:, None], keep)


def ica_project(df: DataFrame, columns: list[str], keep: list[str], n_components: int = 2,
                standardize: bool = True, max_iter: int = 30, tol: float = 1e-4, seed: int = 42) -> DataFrame:
    """Parallel fixed-point ICA with the log-cosh contrast, one aggregate per iteration."""
    g = G.gram(df, columns)
    mean, std = _standardizer(g, len(columns), standardize)
    cov = g.scatter / g.n / np.outer(std, std)
    val, vec = np.linalg.eigh(cov)
    top = np.argsort(val)[::-1][:n_components]
    white = (_fix_signs(vec[:, top]) / np.sqrt(val[top])) / std[:, None]
    k = white.shape[1]
    z = project(df, columns, mean, white, [], "z").persist()
    rng = np.random.default_rng(seed)
    w = _decorrelate(rng.normal(size=(k, k)))
    for _ in range(max_iter):
        aggs = []
        for a in range(k):
            u = dot([F.col(f"z{i + 1}") for i in range(k)], w[a])
            aggs += [F.avg(F.tanh(u) * F.col(f"z{i + 1}")) for i in range(k)]
            aggs.append(F.avg(1.0 - F.tanh(u) * F.tanh(u)))
        row = np.array(z.agg(*aggs).first(), dtype=float).reshape(k, k + 1)
        new = _decorrelate(row[:, :k] - row[:, k:] * w)
        shift = np.max(np.abs(np.abs(np.einsum("ij,ij->i", new, w)) - 1.0))
        w = new
        if shift < tol:
            break
    z.unpersist()
    return project(df, columns, mean, white @ w.T, keep)


def _decorrelate(w: np.ndarray) -> np.ndarray:
    val, vec = np.linalg.eigh(w @ w.T)
    return vec @ np.diag(1.0 / np.sqrt(np.clip(val, 1e-12, None))) @ vec.T @ w


def reduce(df: DataFrame, columns: list[str], method: str, keep: list[str], n_components: int = 2,
           label: str | None = None, seed: int = 42) -> DataFrame:
    """Dispatcher: tables that are already narrow enough pass through."""
    if method not in ("pca", "lda", "ica"):
        raise ValueError(f"unknown or unsupported reduction {method!r}")
    carry = keep + ([label] if label and label not in keep else [])
    if len(columns) <= n_components:
        return df.select(*map(ident, carry), *[dbl(c).alias(f"c{i + 1}") for i, c in enumerate(columns)])
    if method == "pca":
        return pca_project(df, columns, carry, n_components)
    if method == "lda":
        if label is None:
            raise ValueError("lda needs a label column")
        return lda_project(df, columns, label, carry, n_components)
    return ica_project(df, columns, carry, n_components, seed=seed)


# --- Nystroem kernel map -----------------------------------------------------------------

def nystroem(df: DataFrame, array_column: str, keep: list[str], order: str, n_components: int = 100,
             kernel: str = "rbf", gamma: float | None = None, degree: int = 3, coef0: float = 1.0,
             seed: int = 42, prefix: str = "k_") -> DataFrame:
    """Kernel features against a seeded sample of ``n_components`` landmark rows."""
    landmarks, norm, gamma = nystroem_fit(df, array_column, order, n_components, kernel, gamma, degree, coef0, seed)
    return nystroem_apply(df, array_column, keep, landmarks, norm, kernel, gamma, degree, coef0, prefix)


def _kernel(a, b, kernel, gamma, degree, coef0):
    if kernel == "rbf":
        d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
        return np.exp(-gamma * np.clip(d, 0, None))
    if kernel == "poly":
        return (gamma * a @ b.T + coef0) ** degree
    if kernel == "sigmoid":
        return np.tanh(gamma * a @ b.T + coef0)
    if kernel == "linear":
        return a @ b.T
    raise ValueError(f"unknown kernel {kernel!r}")


def nystroem_fit(df, array_column, order, n_components, kernel, gamma, degree, coef0, seed):
    from tabspark.functions.scalar import HASH_RANGE, hash32

    n = df.count()
    h = hash32(F.col(ident(order)), f"landmark{seed}")
    pool = df.select(h.alias("h"), F.col(ident(array_column)).cast("array<double>").alias("x"))
    if n > 100 * n_components:
        pool = pool.filter(F.col("h") < F.lit(int(20.0 * n_components / n * HASH_RANGE)))
    marks = np.array([r["x"] for r in pool.orderBy("h").limit(n_components).collect()])
    gamma = 1.0 / marks.shape[1] if gamma is None else gamma
    u, s, vt = np.linalg.svd(_kernel(marks, marks, kernel, gamma, degree, coef0))
    return marks, (u / np.sqrt(np.maximum(s, 1e-12))) @ vt, gamma


def nystroem_apply(df, array_column, keep, marks, norm, kernel, gamma, degree, coef0, prefix="k_"):
    shared = df.sparkSession.sparkContext.broadcast((marks, norm))

    @F.pandas_udf("array<double>")
    def embed(x: pd.Series) -> pd.Series:
        m, w = shared.value
        a = np.stack(x.to_numpy()) if len(x) else np.zeros((0, m.shape[1]))
        return pd.Series(list(_kernel(a, m, kernel, gamma, degree, coef0) @ w.T))

    out = df.select(*map(ident, keep), embed(F.col(ident(array_column)).cast("array<double>")).alias("__k"))
    return out.select(*map(ident, keep), *[F.col("__k")[i].alias(f"{prefix}{i}") for i in range(len(marks))])
